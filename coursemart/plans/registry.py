"""The registry of auxiliary tables and the context their builders read from."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import DataFrame

from coursemart.operators.enrich import quoted
from coursemart.sources.raw import LmsSource

# Terms that hold tests and migrated content, by id and by name.
EXCLUDED_TERM_IDS = (35910000000000001, 35910000000000003, 35910000000000004, 35910000000000025)
EXCLUDED_TERM_NAMES = ("Tester Term", "Migrated Content", "Default Term", "Test Term")

SPARK_TYPES = {
    "bigint": "bigint",
    "int": "int",
    "tinyint": "int",
    "double": "double",
    "text": "string",
    "varchar": "string",
    "char": "string",
    "timestamp": "timestamp_ntz",
    "datetime": "timestamp_ntz",
}


@dataclass(frozen=True)
class Settings:
    excluded_term_ids: tuple[int, ...] = EXCLUDED_TERM_IDS
    excluded_term_names: tuple[str, ...] = EXCLUDED_TERM_NAMES
    # Some lookups compare ids of different kinds (a group id with an assignment id, say). They are the default, since
    # existing results rest on them; True compares like with like.
    key_fix: bool = False
    # True cuts text to the declared length of its column; by default text is kept whole, whatever the declaration.
    cut_text: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    builder: Callable[[Mart], DataFrame]
    in_build: bool = True


TABLES: dict[str, TableSpec] = {}


def parse_columns(text: str) -> tuple[tuple[str, str], ...]:
    """``"a bigint, b varchar(60)"`` -> (("a", "bigint"), ("b", "varchar(60)"))."""
    return tuple(tuple(part.split(None, 1)) for part in re.split(r"\s*,\s*", text.strip()))


def conform(df: DataFrame, columns: tuple[tuple[str, str], ...], cut_text: bool = False) -> DataFrame:
    """Declared columns only, in order and typed; missing ones become NULL. ``cut_text`` cuts text to the declared length."""
    present = set(df.columns)

    def column(name: str, declared: str) -> str:
        base, length = re.fullmatch(r"(\w+)(?:\((\d+)\))?", declared).groups()
        value = f"CAST({quoted(name) if name in present else 'NULL'} AS {SPARK_TYPES[base]})"
        if cut_text and length and name in present:
            value = f"left({value}, {length})"
        return f"{value} AS {quoted(name)}"

    return df.selectExpr(*(column(name, declared) for name, declared in columns))


def auxiliary_table(name: str, columns: str, in_build: bool = True):
    """Register a builder ``Mart -> DataFrame``; its result is brought to the declared columns.

    Register a table after the tables it reads: builds go through the registry in that order. ``in_build=False`` keeps an
    intermediate table out of full builds.
    """

    def register(builder: Callable[[Mart], DataFrame]) -> Callable[[Mart], DataFrame]:
        TABLES[name] = TableSpec(name, parse_columns(columns), builder, in_build)
        return builder

    return register


def sql_table(name: str, columns: str, query: str):
    """Register a table given as SQL. ``{name}`` in the query stands for a raw or an auxiliary table."""
    inputs = {field for _, field, _, _ in Formatter().parse(query) if field}

    def builder(mart: Mart) -> DataFrame:
        frames = {used: mart.aux(used) if used in TABLES else mart.raw(used) for used in inputs}
        spark = next(iter(frames.values())).sparkSession
        return spark.sql(query, **frames)

    return auxiliary_table(name, columns)(builder)


@dataclass
class Mart:
    """What builders see: ``raw`` tables, other ``aux`` tables and the settings.

    ``built`` holds auxiliary tables that exist as files already; the rest is composed lazily into the reader's plan.
    """

    source: LmsSource
    settings: Settings = field(default_factory=Settings)
    built: Mapping[str, DataFrame] = field(default_factory=dict)
    _composed: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def raw(self, name: str) -> DataFrame:
        return self.source[name]

    def aux(self, name: str) -> DataFrame:
        if name in self.built:
            return self.built[name]
        if name not in self._composed:
            spec = TABLES[name]
            self._composed[name] = conform(spec.builder(self), spec.columns, self.settings.cut_text)
        return self._composed[name]
