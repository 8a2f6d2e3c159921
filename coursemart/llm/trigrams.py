"""Boolean trigram queries from regular expressions."""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser

#: Strings kept apart while they are put together; beyond it a part of a pattern counts as unknown.
MAX_STRINGS = 64

Strings = set[str] | None


def _exact(node) -> Strings:
    """All strings, in lower case, that a parsed element can match, or None if there are too many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        found: set[str] = set()
        for k, v in value:
            if k is op.LITERAL:
                found.add(chr(v).lower())
            elif k is op.RANGE and v[1] - v[0] < MAX_STRINGS:
                found.update(chr(c).lower() for c in range(v[0], v[1] + 1))
            else:
                return None
        # A class of many characters would only multiply strings that no trigram can tell apart.
        return found if len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return _exact_all(value[-1])
    if kind is op.BRANCH:
        found = set()
        for branch in value[1]:
            part = _exact_all(branch)
            if part is None:
                return None
            found |= part
        return found if len(found) <= MAX_STRINGS else None
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 4:
        part, found = _exact_all(value[2]), set()
        if part is None:
            return None
        for n in range(value[0], value[1] + 1):
            if len(part) ** n > MAX_STRINGS:
                return None
            found |= {"".join(x) for x in product(part, repeat=n)}
        return found
    return {""} if kind is op.AT else None


def _exact_all(nodes) -> Strings:
    found = {""}
    for node in nodes:
        part = _exact(node)
        if part is None or len(part) * len(found) > MAX_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _smallest(clauses: set[frozenset[str]]) -> set[frozenset[str]]:
    return {c for c in clauses if not any(other < c for other in clauses)}


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives, each a list of trigrams (lower case) that must all occur; [] if the pattern has no mandatory trigram.

    Runs of elements with few possible strings are multiplied out; each run demands the trigrams of one of its strings, and all
    runs of a match are demanded together.
    """
    demands: list[set[frozenset[str]]] = []
    run = {""}

    def close() -> None:
        nonlocal run
        if all(len(s) >= 3 for s in run):
            demands.append(_smallest({_grams(s) for s in run}))
        run = {""}

    def walk(nodes) -> None:
        nonlocal run
        for node in nodes:
            kind, value = node
            part = _exact(node)
            if part is not None and len(part) * len(run) <= MAX_STRINGS:
                run = {a + b for a in run for b in part}
                continue
            close()
            if part is not None:
                run = part
            elif kind is op.SUBPATTERN:
                walk(value[-1])
                close()
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
                walk(value[2])
                close()

    walk(_parser.parse(pattern))
    close()
    query: set[frozenset[str]] = {frozenset()}
    for demand in demands:
        joined = {a | b for a in query for b in demand}
        query = _smallest(joined) if len(joined) <= MAX_STRINGS else query
    return [] if query == {frozenset()} else sorted(sorted(c) for c in query)
