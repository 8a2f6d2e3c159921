"""Delimited exports. Every export is one distributed write; a table becomes a folder of part files, each with a header.

Dialects
--------
``tsv``         tab separated, NULL spelled ``NULL``; tab, line ends, NUL and backslash in text escaped with a backslash
``csv_quoted``  comma separated, every value in double quotes
``excerpt``     headerless commas, quotes where needed, NULL spelled ``\\N``; read back by ``sources.read_excerpt``

Records end with a line feed in all of them. Times keep their fractions of seconds, six digits where there are any.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from coursemart.functions.names import term_year
from coursemart.functions.text import sanitize_text
from coursemart.operators.batches import SHARED, volume_batches
from coursemart.operators.enrich import enrich_left
from coursemart.operators.rows import restrict_to_keys

ACCOUNT_BATCH_ROWS = 1000
SEQ_BATCH_ROWS = 50_000


def _strings(df: DataFrame, change) -> DataFrame:
    return df.select(
        *(
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema
        )
    )


def sanitize_strings(df: DataFrame) -> DataFrame:
    """Tabs to eight spaces and line feeds to one space in every string column."""
    return _strings(df, sanitize_text)


def _escape_text(c: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def _time_text(c: Column) -> Column:
    whole = F.date_trunc("second", c) == c
    return F.when(whole, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def times_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as the text that dumps show, whole in every digit."""
    return df.select(
        *(
            _time_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (TimestampNTZType, TimestampType)) else F.col(f.name)
            for f in df.schema
        )
    )


def escape_tsv(df: DataFrame) -> DataFrame:
    """Every column as the text the ``tsv`` dialect shows for it."""

    def shown(field):
        c = F.col(field.name)
        if isinstance(field.dataType, StringType):
            text = _escape_text(c)
        elif isinstance(field.dataType, (TimestampNTZType, TimestampType)):
            text = _time_text(c)
        else:
            text = c.cast("string")
        return F.coalesce(text, F.lit("NULL")).alias(field.name)

    return df.select(*(shown(field) for field in df.schema))


def export(
    df: DataFrame, dest: str, dialect: str = "tsv", sanitize: bool = False, partition_by: str | None = None
) -> None:
    """Write ``df`` to the folder ``dest``, replacing it."""
    rows = sanitize_strings(df) if sanitize else df
    rows = escape_tsv(rows) if dialect == "tsv" else times_as_text(rows)
    if dialect == "tsv":
        options = {"sep": "\t", "header": True, "quote": "", "escapeQuotes": False, "emptyValue": ""}
    elif dialect == "csv_quoted":
        options = {"sep": ",", "header": True, "quoteAll": True, "escape": '"', "nullValue": "NULL"}
    elif dialect == "excerpt":
        options = {"sep": ",", "header": False, "quote": '"', "escape": "\\", "nullValue": "\\N"}
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    writer = rows.write.mode("overwrite").options(
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        lineSep="\n",
        **options,
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.csv(dest)


def with_account_batch(df: DataFrame, key: str = "account_id", threshold: int = ACCOUNT_BATCH_ROWS) -> DataFrame:
    """Add ``batch``: the key itself for keys with many rows, one shared batch for all others (and for NULL keys)."""
    own = volume_batches(df, key, threshold).where(F.col("batch") != SHARED)
    return enrich_left(df, own, {key: key}, {"batch": "batch"}).fillna(SHARED, ["batch"])


def with_seq_batch(df: DataFrame, seq: str = "seq_num", size: int = SEQ_BATCH_ROWS) -> DataFrame:
    """Add ``batch``: 0 for numbers 1..size, 1 for the next ``size``, and so on."""
    return df.withColumn("batch", F.floor((F.col(seq) - 1) / size).cast("long"))


def _export_batches(batched: DataFrame, dest: str, dialect: str) -> None:
    # Rows of a batch come together into few files, while AQE splits a batch that is too large for one task.
    export(batched.hint("rebalance", "batch"), dest, dialect, partition_by="batch")


def export_by_account_batches(
    df: DataFrame, dest: str, key: str = "account_id", threshold: int = ACCOUNT_BATCH_ROWS, dialect: str = "tsv"
) -> None:
    _export_batches(with_account_batch(df, key, threshold), dest, dialect)


def export_by_seq_batches(
    df: DataFrame, dest: str, seq: str = "seq_num", size: int = SEQ_BATCH_ROWS, dialect: str = "tsv"
) -> None:
    _export_batches(with_seq_batch(df, seq, size), dest, dialect)


def rows_since_term_year(df: DataFrame, terms: DataFrame, start_year: int, term: str = "enrollment_term_id") -> DataFrame:
    """Rows whose term's name ends in ``start_year`` or later."""
    recent = terms.where(term_year("term_name") >= start_year)
    return restrict_to_keys(df, recent, {term: "term_id"})


@dataclass
class ExportReport:
    done: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    #: Table -> why its export failed.
    errors: dict[str, str] = field(default_factory=dict)


def export_all(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]], dest: str, dialect: str = "tsv", overwrite: bool = False
) -> ExportReport:
    """Export each table to its folder below ``dest``. Finished exports are left alone unless ``overwrite``; a table that
    fails is reported, and the others are exported all the same. A table may be given as a function that opens it."""
    report = ExportReport()
    for name, given in tables.items():
        path = f"{dest.rstrip('/')}/{name}"
        try:
            df = given if isinstance(given, DataFrame) else given()
            done = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
            files = done.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
            if not overwrite and files.exists(done):
                report.skipped.append(name)
                continue
            export(df, path, dialect)
            report.done.append(name)
        except Exception as error:  # noqa: BLE001 - one table's failure must not keep the others back
            report.errors[name] = str(error)
    return report
