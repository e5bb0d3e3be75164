"""XML split scan and extractors on the shapes from FIXTURES section 2."""
import os

from pyspark.sql import functions as F

from feedloom.operators import extract as X
from feedloom.sources import xml as XS

ASSIGN = """<?xml version="1.0"?>
<ns:assignments xmlns:ns="urn:x">
<ns:assignment-entry><ns:assignment><ns:reel-no>100</ns:reel-no><ns:frame-no>7</ns:frame-no>
<ns:date-recorded>19550104</ns:date-recorded><ns:page-count>3</ns:page-count>
<ns:correspondent><ns:person-or-organization-name>Corr</ns:person-or-organization-name><ns:address-3></ns:address-3>
<ns:address-4>Floor 2</ns:address-4></ns:correspondent></ns:assignment>
<ns:assignors><ns:assignor><ns:person-or-organization-name>A1</ns:person-or-organization-name><ns:city>X</ns:city></ns:assignor>
<ns:assignor><ns:person-or-organization-name>A2</ns:person-or-organization-name></ns:assignor></ns:assignors>
<ns:properties><ns:property><ns:serial-no>1</ns:serial-no></ns:property><ns:property><ns:serial-no>2</ns:serial-no>
</ns:property><ns:property><ns:serial-no>3</ns:serial-no><ns:registration-no>9</ns:registration-no></ns:property>
</ns:properties></ns:assignment-entry>
<ns:assignment-entry><ns:assignment><ns:reel-no>101</ns:reel-no></ns:assignment></ns:assignment-entry>
<ns:assignment-entry><ns:assignment><ns:reel-no>102</ns:reel-no><ns:frame-no>1</ns:frame-no>
<ns:date-recorded>20230230</ns:date-recorded><ns:page-count>2a</ns:page-count></ns:assignment>
<ns:properties><ns:property><ns:serial-no>5</ns:serial-no></ns:property></ns:properties></ns:assignment-entry>
</ns:assignments>
"""


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_assignment_properties_namespaced(spark, tmpdir_path):
    p = _write(tmpdir_path, "a.xml", ASSIGN)
    parsed = XS.read_xml(spark, p, "assignment-entry", X.ASSIGNMENT_SCHEMA, prefix="ns")
    rows = X.assignments_per_property(parsed, "TRTYRAG").orderBy("reel_no", "serial_no").collect()
    assert [(r.reel_no, r.serial_no) for r in rows] == [("100", "1"), ("100", "2"), ("100", "3"), ("102", "5")]
    r = rows[0]
    assert r.assignment_id == "100-7" and str(r.date_recorded) == "1955-01-04" and r.page_count == 3
    assert r.assignor_name == "A1" and r.assignor_address == "X" and r.correspondent_address_3 == "Floor 2"
    assert rows[3].date_recorded is None and rows[3].page_count is None
    kept = X.assignments_per_property(parsed, "TRTYRAG", keep_empty=True)
    assert kept.count() == 5
    first = X.assignments_first(parsed, "TRTYRAG").orderBy("reel_no").collect()
    assert [r.property_count for r in first] == [3, 0, 1] and first[1].assignment_id is None


def test_split_scan_equals_whole_file_scan(spark, tmpdir_path):
    recs = "".join(f"<case-file>\n  <serial-number>{70000000 + i}</serial-number>\n"
                   f"  <case-file-header><filing-date>19550104</filing-date><status-code>{i % 9}</status-code>"
                   f"</case-file-header>\n</case-file>\n" for i in range(3000))
    p = _write(tmpdir_path, "big.xml", "<?xml version='1.0'?>\n<case-files>\n" + recs + "</case-files>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        raw = XS.record_texts(spark, p, "case-file")
        assert raw.rdd.getNumPartitions() > 4
        split = XS.read_xml(spark, p, "case-file", X.CASE_FILE_SCHEMA)
        got = sorted(r[0] for r in X.extract_case_files(split, "T").select("serial_no").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = XS.read_xml_small(spark, p, "case-file", X.CASE_FILE_SCHEMA)
    ref = sorted(r[0] for r in whole.select(F.col("`serial-number`").cast("string")).collect())
    assert got == ref and len(got) == 3000


def test_proceeding_alternatives_and_roles(spark, tmpdir_path):
    text = """<ttab><proceeding-entry><number>91</number><type-code>OPP</type-code><status-code>A</status-code>
<filed-date>20200102</filed-date><party-information><party><role-code>P</role-code></party>
<party><role-code>p</role-code><party-name>Alice</party-name></party>
<party><role-code> D </role-code><person-or-organization-name>Bob</person-or-organization-name></party>
</party-information><mark-text>MARK</mark-text><goods-services> g1 </goods-services><gs-text>g1</gs-text>
<services>s2</services></proceeding-entry></ttab>"""
    p = _write(tmpdir_path, "p.xml", text)
    r = X.extract_proceedings(XS.read_xml(spark, p, "proceeding-entry", X.PROCEEDING_SCHEMA), "TTABYR").first()
    assert (r.proceeding_number, r.proceeding_type, r.status) == ("91", "OPP", "A")
    assert str(r.filing_date) == "2020-01-02" and r.applicant_name == "Alice" and r.opposer_name == "Bob"
    assert r.mark_description == "MARK" and r.goods_services == "g1; s2"


def test_malformed_record_is_rejected_not_fatal(spark, tmpdir_path):
    p = _write(tmpdir_path, "m.xml", "<r><case-file><serial-number>1</serial-number></case-file>"
                                     "<case-file><serial-number>2</case-file></r>")
    parsed = XS.read_xml(spark, p, "case-file", X.CASE_FILE_SCHEMA)
    assert parsed.filter(F.col("rec._corrupt_record").isNotNull()).count() == 1


def test_prefix_auto_detection(spark, tmpdir_path):
    p = _write(tmpdir_path, "ns.xml", ASSIGN)
    assert XS.detect_prefix(spark, p, "assignment-entry") == "ns"
    parsed = XS.read_xml(spark, p, "assignment-entry", X.ASSIGNMENT_SCHEMA, prefix="auto")
    assert parsed.count() == 3


def test_family_scan_of_plain_prefixed_and_foreign_files(spark, tmpdir_path):
    """A late prefix, a plain file, a file without the tag and a name with a space."""
    late = "<x>\n" + "<!-- line -->\n" * 2500 + ASSIGN.split("\n", 1)[1] + "</x>"
    _write(tmpdir_path, "late one.xml", late)
    _write(tmpdir_path, "plain.xml", ASSIGN.replace("ns:", ""))
    _write(tmpdir_path, "other.xml", "<r>" + "<row>1</row>" * 1000 + "</r>")
    got = XS.read_family(spark, tmpdir_path, "assignment", X.ASSIGNMENT_SCHEMA, glob="*.xml")
    per = {r.name: r.n for r in got.groupBy(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("name")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(per.values()) == [3, 3] and "other.xml" not in per
    none = XS.read_family(spark, os.path.join(tmpdir_path, "other.xml"), "assignment", X.ASSIGNMENT_SCHEMA)
    assert none.count() == 0 and none.columns == got.columns


def test_generic_fields_of_all_records(spark, tmpdir_path):
    recs = "".join(f"<rec><a>{i}</a></rec>\n" for i in range(1500)) + "<rec><a>x</a><late-field>9</late-field></rec>"
    p = _write(tmpdir_path, "g.xml", f"<r>{recs}</r>")
    assert XS.generic_records(spark, p, "rec").filter("late_field = '9'").count() == 1


def test_fallback_finds_late_markers_and_each_files_own_parent(spark, tmpdir_path):
    late = "<root>\n<!-- <x><proceeding-number>0</proceeding-number> -->\n" + "<note>n</note>\n" * 5000 + "<box>\n" + \
        "".join(f"<filing>\n<proceeding-number>{n}</proceeding-number><status>S</status></filing>\n" for n in range(3000)) + \
        "<filing><status>none</status></filing></box></root>"
    _write(tmpdir_path, "a late.xml", late)
    _write(tmpdir_path, "b.xml", "<n:r><n:cases><n:case a='1'><n:proceeding-number>9001</n:proceeding-number></n:case></n:cases></n:r>")
    _write(tmpdir_path, "c.xml", "<r><proceeding><proceeding-number>9002</proceeding-number></proceeding><odd><proceeding-number>1</proceeding-number></odd></r>")
    _write(tmpdir_path, "d.xml", "<r><other/></r>")
    want = sorted([*map(str, range(3000)), "9001"])
    only = [os.path.join(tmpdir_path, n) for n in ("a late.xml", "b.xml", "d.xml")]
    for size in ("4k", "128m"):  # splits within a record, and one for each file
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            tag, recs = XS.fallback_records(spark, only)
            got = XS.parse_records(recs, XS.flat_schema(["proceeding-number"])).select("rec.`proceeding-number`", "record_tag").collect()
            fam = XS.read_family(spark, tmpdir_path, "proceeding", X.PROCEEDING_SCHEMA, glob="*.xml").select("record_tag").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert tag == "case,filing" and sorted(r[0] for r in got) == want
        assert {(r[0] == "9001", r[1]) for r in got} == {(True, "case"), (False, "filing")}
        assert sorted({r[0] for r in fam}) == ["case", "filing", "proceeding"] and len(fam) == 3002
    assert XS.fallback_records(spark, os.path.join(tmpdir_path, "d.xml"))[0] is None
