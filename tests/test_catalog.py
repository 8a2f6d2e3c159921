import pytest
from conftest import rows
from pyspark.sql import functions as F

from coursemart.sources import (
    CatalogError,
    catalog_rows,
    parse_catalog_text,
    read_catalog_csv,
    read_catalog_xml,
    response_title,
)


def course(instructors=(), quarters=(), gers=None, code="10"):
    people = "".join(f"<instructor>{p}</instructor>" for p in instructors)
    attributes = "".join(
        f"<attribute><name>NQTR</name><value>X</value><description>{q}</description></attribute>" for q in quarters
    )
    return f"""<course><year>2018-2019</year><subject>AA</subject><code>{code}</code><title>I &lt;3 Flying</title>
        <description>with <b/> markup</description>
        {"" if gers is None else f"<gers>{gers}</gers>"}<unitsMin>1</unitsMin><unitsMax>3</unitsMax>
        <administrativeInformation><courseId>140583</courseId><academicGroup>ENGR</academicGroup>
        <academicOrganization>AERO</academicOrganization><academicCareer>UG</academicCareer></administrativeInformation>
        <attributes>{attributes}<attribute><name>OTHER</name><description>Autumn</description></attribute></attributes>
        <sections><section><schedules><schedule><instructors>{people}</instructors></schedule></schedules></section>
        <section></section></sections></course>"""


JANE = "<firstName>Jane</firstName><middleName>Q</middleName><lastName>Doe</lastName>"
KEN = "<firstName>Ken</firstName><lastName>Roe</lastName>"
BARE = "<middleName></middleName><lastName>Solo</lastName>"


def flat(spark, *records):
    return catalog_rows(parse_catalog_text(spark.createDataFrame([(r,) for r in records], "xml string"), "xml"))


def test_one_record(spark):
    row = flat(spark, course([JANE, KEN, JANE, BARE], ["Autumn", "Winter"], "THINK,WAY-ER")).first()
    assert row.asDict() == {
        "course_code": "AA10", "subject": "AA", "course_name": "I <3 Flying", "units_min": 1, "units_max": 3,
        "acad_year": "2018-2019", "course_id": 140583, "acad_group": "ENGR", "department": "AERO", "acad_career": "UG",
        "ger_fulfillment": "THINK,WAY-ER", "quarter_name": "Fall,Winter",
        "instructors": "Jane Q Doe, Ken Roe, Jane Q Doe,  Solo",
    }


def test_missing_parts(spark):
    row = flat(spark, course()).first()
    assert (row["ger_fulfillment"], row["quarter_name"], row["instructors"]) == ("", '""', "None listed")


def test_ten_names_and_an_ellipsis(spark):
    ten, eleven = flat(spark, course([KEN] * 10, code="1"), course([KEN] * 11, code="2")).orderBy("course_code").collect()
    assert ten["instructors"] == ", ".join(["Ken Roe"] * 10)
    assert eleven["instructors"] == ", ".join(["Ken Roe"] * 10) + "..."


def test_file_cut_into_many_splits(spark, tmp_path):
    body = "".join(course([JANE], ["Spring"], code=str(i)) for i in range(400))
    (tmp_path / "catalog.xml").write_text(f"<?xml version='1.0'?>\n<xml><courses>\n{body}\n</courses></xml>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        records = read_catalog_xml(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 4
        found = catalog_rows(records)
        assert found.count() == 400
        assert found.select("course_code").distinct().count() == 400
        assert found.where("instructors = 'Jane Q Doe' AND quarter_name = 'Spring'").count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


CSV = '''"course_code","subject","course_name","units_min","units_max","acad_year","course_id","acad_group","department","acad_career","ger_fulfillment","quarter_name","instructors"
"ATHLETIC25","ATHLETIC","VARSITY - Gymnastics (Men)","1","2","2019-2020","201035","MED","MEDDPT","UG","","Spring,Winter,Fall","Austin Lee, Thomas Gli"
BIO25Q,BIO,"Cystic ""fibrosis"": from conundrum, to success",3,3,2019-2020,111833,H&S,BIO,UG,"GER: DB-NatSci, WAY-SMA",Spring,Ron Kop
'''


def test_csv(spark, tmp_path):
    (tmp_path / "catalog.csv").write_text(CSV)
    assert rows(read_catalog_csv(spark, str(tmp_path))) == [
        ("ATHLETIC25", "ATHLETIC", "VARSITY - Gymnastics (Men)", 1, 2, "2019-2020", 201035, "MED", "MEDDPT", "UG", "",
         "Spring,Winter,Fall", "Austin Lee, Thomas Gli"),
        ("BIO25Q", "BIO", 'Cystic "fibrosis": from conundrum, to success', 3, 3, "2019-2020", 111833, "H&S", "BIO", "UG",
         "GER: DB-NatSci, WAY-SMA", "Spring", "Ron Kop"),
    ]


def test_error_page_instead_of_a_catalog(spark):
    pages = spark.createDataFrame(
        [("<html><head><TITLE>503 Service\nUnavailable</TITLE></head></html>",), ("<courses/>",), (None,)], "body string"
    )
    found = [r[0] for r in pages.select(response_title(F.col("body"))).collect()]
    assert found == ["503 Service\nUnavailable", None, None]


def catalog_file(folder, body, encoding="UTF-8"):
    text = f"<?xml version='1.0' encoding='{encoding}'?>\n<xml><courses>{body}</courses></xml>\n"
    (folder / "catalog.xml").write_bytes(text.encode(encoding))
    return str(folder / "catalog.xml")


@pytest.mark.parametrize(
    ("text", "says"),
    [
        ("<html><head><title>503 Service Unavailable</title></head></html>", "503 Service Unavailable"),
        ("<!DOCTYPE html>\n<p>no title</p>", "HTML page"),
        (f"<courses>{course()}{course()}", "cut short"),
        (f"<courses>{course()}{course()[:200]}", "cut short"),
        ("", "cut short"),
    ],
)
def test_no_catalog_is_an_error(spark, tmp_path, text, says):
    (tmp_path / "bad.xml").write_text(text or " ")
    with pytest.raises(CatalogError, match=says):
        read_catalog_xml(spark, str(tmp_path / "bad.xml"))


def test_comments_and_empty_elements_add_nothing(spark, tmp_path):
    body = f"<!-- {course(code='8')} --><course />{course(code='9')}<!-- <course> -->{course(code='10')}"
    found = catalog_rows(read_catalog_xml(spark, catalog_file(tmp_path, body)))
    assert rows(found.select("course_code")) == [("AA10",), ("AA9",)]
    assert catalog_rows(read_catalog_xml(spark, catalog_file(tmp_path, ""))).count() == 0


def test_other_encodings(spark, tmp_path):
    path = catalog_file(tmp_path, course().replace("Flying", "\u00c9tudes"), "ISO-8859-1")
    assert catalog_rows(read_catalog_xml(spark, path, "ISO-8859-1")).first()["course_name"] == "I <3 \u00c9tudes"


def test_broken_csv_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_catalog_csv(spark, str(tmp_path / "c.csv")).collect()
