"""The course catalog: XML records or CSV rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.catalog import course_code, instructor_list, quarter_names

# The columns of one catalog row.
CATALOG_COLUMNS = (
    "course_code string, subject string, course_name string, units_min int, units_max int, acad_year string, "
    "course_id int, acad_group string, department string, acad_career string, ger_fulfillment string, "
    "quarter_name string, instructors string"
)

_INSTRUCTOR = "array<struct<firstName: string, middleName: string, lastName: string>>"
_SCHEDULE = f"array<struct<instructors: struct<instructor: {_INSTRUCTOR}>>>"
_SECTION = f"array<struct<schedules: struct<schedule: {_SCHEDULE}>>>"

# The elements of a <course> record that are read.
CATALOG_XML_SCHEMA = (
    "year string, subject string, code string, title string, unitsMin string, unitsMax string, gers string, "
    "administrativeInformation struct<courseId: string, academicGroup: string, academicOrganization: string, "
    "academicCareer: string>, "
    "attributes struct<attribute: array<struct<name: string, description: string>>>, "
    f"sections struct<section: {_SECTION}>"
)


def read_catalog_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Catalog rows from comma-separated files with a header line and optional quotes. Empty text is no NULL here.

    A record with too few or too many values, or text where a number belongs, is an error. ``multi_line=False`` lets a large file without line breaks in its text be split between many tasks.
    """
    rows = (
        spark.read.schema(CATALOG_COLUMNS)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("lineSep", "\n")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.na.fill("")


class CatalogError(ValueError):
    """A response or file that is no complete catalog."""


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, plain): the text up to each closing ``course`` tag, and the same without comments."""
    text = spark.read.option("lineSep", "</course>").text(path)
    plain = F.regexp_replace("value", r"(?s)<!--.*?-->", "")
    return text.select(F.col("_metadata.file_path").alias("file"), "value", plain.alias("plain"))


def catalog_faults(spark: SparkSession, path: str) -> DataFrame:
    """(file, fault) of the files at ``path`` that are no whole catalog: an HTML page (its title is the fault), or XML that is cut.

    The files are read in pieces up to a closing ``course`` tag, so a large file is checked by many tasks. What follows the last
    course has to end with a closing tag and open no further course.
    """
    is_page = F.regexp_like("value", F.lit(r"(?is)<!doctype\s+html|<html[\s>]"))
    is_end = F.regexp_like("plain", F.lit(r"(?s)(</[\w:.-]+|/)>\s*$")) & ~F.regexp_like("plain", F.lit(r"<course(\s[^>]*[^/>])?>"))
    by_file = _pieces(spark, path).groupBy("file").agg(
        F.max(F.when(is_page, F.coalesce(response_title("value"), F.lit("HTML page")))).alias("page"),
        F.count_if(is_end).alias("ends"),
    )
    fault = F.when(F.col("page").isNotNull(), F.col("page")).when(F.col("ends") == 0, F.lit("catalog is cut short"))
    return by_file.select("file", fault.alias("fault")).where("fault IS NOT NULL")


def require_catalog(spark: SparkSession, path: str) -> None:
    """An error naming the first file that is no whole catalog, and why."""
    first = catalog_faults(spark, path).orderBy("file").first()
    if first:
        raise CatalogError(f"{first['file']}: {first['fault']}")


def read_catalog_xml(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row per <course> element that holds anything, with its nested fields.

    Files that are no whole catalog and broken elements are errors, comments are skipped. A file is cut at the closing tags, so
    that many tasks read a large one. A file in which a cut would fall into a comment or follow an element without
    content goes to the XML source, one task per file, and so do other encodings than UTF-8.
    """
    require_catalog(spark, path)
    options = {"rowTag": "course", "mode": "FAILFAST", "encoding": encoding}
    xml = spark.read.schema(CATALOG_XML_SCHEMA).options(**options)
    if encoding.upper() not in ("UTF-8", "UTF8"):
        return xml.xml(path).dropna("all")
    pieces = _pieces(spark, path)
    # One name per file at most.
    odd = pieces.where(F.regexp_like("plain", F.lit(r"<!--|-->|<course(\s[^>]*)?/>"))).select("file").distinct().collect()
    names = [row["file"] for row in odd]
    cut = pieces.where(~F.col("file").isin(names)) if names else pieces
    elements = cut.select(F.regexp_extract("plain", r"(?s)<course[\s>].*", 0).alias("_open")).where("_open <> ''")
    found = parse_catalog_text(elements.select(F.concat("_open", F.lit("</course>")).alias("_xml")), "_xml")
    return found.union(xml.xml(",".join(names)).dropna("all")) if names else found


def parse_catalog_text(df: DataFrame, xml: str) -> DataFrame:
    """The same nested fields from a column holding one <course> element per row. Broken XML is an error."""
    options = {"rowTag": "course", "mode": "FAILFAST"}
    return df.select(F.from_xml(xml, CATALOG_XML_SCHEMA, options).alias("_c")).select("_c.*")


def catalog_rows(nested: DataFrame) -> DataFrame:
    """Flatten catalog records to the columns of a catalog row; all native array functions."""
    admin = F.col("administrativeInformation")
    sections = F.col("sections.section")
    schedules = F.flatten(F.transform(sections, lambda s: _elements(s["schedules"]["schedule"])))
    instructors = F.flatten(F.transform(schedules, lambda s: _elements(s["instructors"]["instructor"])))
    return nested.select(
        course_code(F.col("subject"), F.col("code")).alias("course_code"),
        F.col("subject"),
        F.col("title").alias("course_name"),
        F.col("unitsMin").try_cast("int").alias("units_min"),
        F.col("unitsMax").try_cast("int").alias("units_max"),
        F.col("year").alias("acad_year"),
        admin["courseId"].try_cast("int").alias("course_id"),
        admin["academicGroup"].alias("acad_group"),
        admin["academicOrganization"].alias("department"),
        admin["academicCareer"].alias("acad_career"),
        F.coalesce(F.col("gers"), F.lit("")).alias("ger_fulfillment"),
        quarter_names(F.col("attributes.attribute")).alias("quarter_name"),
        instructor_list(instructors).alias("instructors"),
    )


def _elements(items: Column) -> Column:
    """The array, or an empty one where the element is missing."""
    return F.coalesce(items, F.array())


def response_title(body: Column | str) -> Column:
    """The page title when a response is an HTML page (``503 Service Unavailable``), else NULL."""
    text = F.col(body) if isinstance(body, str) else body
    return F.nullif(F.regexp_extract(text, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))
