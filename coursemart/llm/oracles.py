"""DuckDB SQL for the rows of those queries that SQL can express.

Trained models, XXH64, BPE, approximate search and slot-by-slot schedules are beyond it; ``tests/llm`` holds those against brute force.
"""

from __future__ import annotations

from coursemart.llm import fim, host_rules, licenses, secrets


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _host_rules() -> str:
    rules, limits = host_rules.RULES, host_rules.LIMITS
    fails = ", ".join(f"count(*) FILTER ({sql}) AS f_{r}" for r, sql in rules.items())
    moments = ", ".join(
        f"avg(f_{r} / n) AS m_{r}, var_pop(f_{r} / n) AS v_{r}, avg(1 / n) AS i_{r}" for r in rules
    )
    # Strength of the prior by moments, binomial noise taken off, as the operator documents it.
    prior = ", ".join(
        f"least(greatest(m_{r}, 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) AS a_{r}, a_{r} * (1 - a_{r}) AS s_{r}, "
        f"greatest(s_{r} / greatest(v_{r} - s_{r} * i_{r}, s_{r} * 1e-3::DOUBLE) - 1, 1.0::DOUBLE) AS k_{r}"
        for r in rules
    )
    over = " OR ".join(f"(f_{r} + a_{r} * k_{r}) / (n + k_{r}) > {limits[r]}::DOUBLE" for r in rules)
    base = " OR ".join(f"({rules[r]})" for r in host_rules.BASE)
    return rf"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), parts AS (
    SELECT rid, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), places AS (
    SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM parts WHERE len(words) > 2
), windows AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS often FROM places
), repeated AS (
    SELECT rid, count(DISTINCT i + j) AS n FROM windows, (VALUES (0), (1), (2)) AS steps(j) WHERE often > 1 GROUP BY rid
), counted AS (
    SELECT doc_id, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines
    FROM parts LEFT JOIN repeated USING (rid)
), hosts AS (
    SELECT source, count(*)::DOUBLE AS n, {fails} FROM counted WHERE trim(source) <> '' GROUP BY source
), moments AS (
    SELECT {moments} FROM hosts
), prior AS (
    SELECT {prior} FROM moments
), verdicts AS (
    SELECT source, {over} AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed,
    coalesce(rejected, false) AS host_rejected, NOT ({base}) AND NOT coalesce(rejected, false) AS kept
FROM counted LEFT JOIN verdicts USING (source)
"""


def _warc() -> str:
    # Five hex digits are twenty bits, so four digits of base 32.
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    bits = "('0x' || substr(sha1(p), 5 * (i // 4) + 1, 5))::BIGINT"
    digit = f"{letters}[(({bits} >> (15 - 5 * (i % 4))) & 31) + 1]"
    return f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS p FROM pages
), firsts AS (
    SELECT page_id, p, min(page_id) OVER (PARTITION BY p) AS first FROM payloads
)
SELECT page_id, strlen(p) AS payload_bytes, list_aggregate(list_transform(range(32), lambda i: {digit}), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


def _canonical_lines(text: str) -> str:
    plain = f"regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    body = f"' ' || replace(replace({plain}, chr(10), ' ' || chr(10) || ' '), ' ', '  ') || ' '"
    for old, new in licenses.EQUIVALENTS:
        a, b = (_text(f" {x.replace(' ', '  ')} ") for x in (old, new))
        body = f"replace({body}, {a}, {b})"
    lines = f"list_transform(string_split({body}, chr(10)), lambda x: regexp_replace(trim(x), ' +', ' ', 'g'))"
    return f"list_filter({lines}, lambda x: x <> '')"


def _canonical(lines: str) -> str:
    owner = r"'^(copyright c |(copyright|c) ([0-9]{4}|year)\b)'"
    return f"coalesce(array_to_string(list_filter({lines}, lambda x: NOT regexp_matches(x, {owner})), ' '), '')"


def _licenses() -> str:
    known = ", ".join(f"({_text(i)}, {_text(t)})" for i, t in licenses.KNOWN)
    return f"""
WITH texts(license_id, text) AS (VALUES {known}
), known AS (
    SELECT {_canonical("l")} AS form, min(license_id) AS license_id FROM (SELECT license_id, {_canonical_lines("text")} AS l FROM texts)
    GROUP BY form HAVING form <> ''
), lines AS (
    SELECT doc_id, {_canonical_lines("coalesce(text, '')")} AS l FROM documents
), forms AS (
    SELECT doc_id, true AS whole, {_canonical("l")} AS form FROM lines
    UNION ALL SELECT doc_id, false, unnest(l) FROM lines
), hits AS (
    SELECT doc_id, min(license_id) FILTER (whole) AS license_id,
        string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (NOT whole) AS notices, count(*) FILTER (NOT whole) AS n_notices
    FROM forms JOIN known USING (form) GROUP BY doc_id
)
SELECT d.doc_id, license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM documents d LEFT JOIN hits h ON d.doc_id IS NOT DISTINCT FROM h.doc_id
"""


def _secrets() -> str:
    found = " UNION ALL ".join(
        f"SELECT rid, {n} AS number, {_text(r.kind)} AS kind, t, string_split_regex(t, {_text(r.pattern)}) AS p, "
        f"regexp_extract_all(t, {_text(r.pattern)}) AS w, regexp_extract_all(t, {_text(r.pattern)}, {r.group}) AS g, {r.least} AS least FROM texts"
        for n, r in enumerate(secrets.RULES)
    )
    base = ", ".join(_text(r.kind) for r in secrets.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = {_text(r.kind)}) AS n_{r.kind}" for r in secrets.BASE_RULES)
    joined = "string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, number)"
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({found}
), numbered AS (
    SELECT *, unnest(range(1, len(w) + 1)) AS i FROM found WHERE len(w) > 0
), spans AS (
    SELECT rid, number, kind, length(g[i]) AS size, least, length(w[i]) AS wide,
        list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS begins
    FROM numbered
), kept AS (
    SELECT rid, number, kind, begins::BIGINT AS start, (begins + wide)::BIGINT AS finish FROM spans WHERE size >= least
), per_text AS (
    SELECT rid, {counts}, {joined} FILTER (kind IN ({base})) AS base, {joined} AS spans FROM kept GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_text USING (rid)
"""


def _fim() -> str:
    groups = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::UBIGINT AS h{i + 1}" for i in range(4))
    plain = " OR ".join(f"contains(text, {_text(s)})" for s in fim.SENTINELS)
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), drawn AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tok, {groups} FROM texts
), cut AS (
    SELECT *, len(tok) AS n,
        CASE WHEN doc_id IS NULL OR text = '' OR {plain} OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        least(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) AS a, greatest(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) AS b
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, form, array_to_string(tok[1:a], '') AS pre, array_to_string(tok[a + 1:b], '') AS mid,
        array_to_string(tok[b + 1:n], '') AS suf
    FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form = 'plain' THEN NULL ELSE length(pre) END::BIGINT AS prefix_chars,
    CASE WHEN form = 'plain' THEN NULL ELSE length(mid) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


SQL: dict[str, str] = {
    "op1_host_rules": _host_rules(),
    "op4_warc": _warc(),
    "op6_license_digests": _licenses(),
    "op7_secret_trigrams": _secrets(),
    "op11_fim_rotation": _fim(),
}
