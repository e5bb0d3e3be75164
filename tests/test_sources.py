"""CSV, ZIP, Stata, catalog and listing sources on the FIXTURES shapes."""
import json
import os
import zipfile

import pandas as pd

from feedloom.sources import archive as Z
from feedloom.sources import catalog as CT
from feedloom.sources import csv as CS
from feedloom.sources import files as FS
from feedloom.sources import stata as ST


def test_csv_case_sample(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "case.csv")
    with open(p, "w") as f:
        f.write("serial_number,registration_number,filing_date,registration_date,status_code,mark_identification\n"
                "12345678,0012345,2023-01-05,0000-00-00,REGISTERED, MARK \n"
                "12345679,,NaN,2023-02-30,PENDING,NULL\n"
                "00012,7,2023-01-07,,REGISTERED,x\n")
    df = CS.load_clean(spark, p, "TRCFECO2").orderBy("serial_no").collect()
    assert [r.serial_no for r in df] == [12, 12345678, 12345679]
    r = df[1]
    assert r.registration_number == 12345 and str(r.filing_date) == "2023-01-05" and r.registration_date is None
    assert r.mark_identification == "MARK" and r.data_source == "TRCFECO2 [CSV]"
    assert df[2].mark_identification is None and df[2].filing_date is None
    assert CS.rows_per_file(CS.read_csv(spark, p)).first().rows == 3


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data)


def test_zip_main_member_choice(spark, tmpdir_path):
    _zip(os.path.join(tmpdir_path, "a.zip"), {"readme.txt": "x", "data.xml": "<r/>", "data.csv": "serial_no\n1\n2\n"})
    _zip(os.path.join(tmpdir_path, "b.zip"), {"notes.pdf": "x", "case_file.dat": "serial_no\n3\n"})
    _zip(os.path.join(tmpdir_path, "c.zip"), {"a.pdf": "x", "b.doc": "y", "c.txt": "z"})
    chosen = {os.path.basename(r.archive): r.member
              for r in Z.main_member(Z.list_members(spark, tmpdir_path)).collect()}
    assert chosen == {"a.zip": "data.csv", "b.zip": "case_file.dat"}
    target = os.path.join(tmpdir_path, "staged")
    Z.extract_members(spark, tmpdir_path, Z.main_member(Z.list_members(spark, tmpdir_path)), target)
    lines = sorted(r.value for r in spark.read.text(target).collect())
    assert lines == ["1", "2", "3", "serial_no", "serial_no"]
    # Re-running skips archives already staged.
    Z.extract_members(spark, tmpdir_path, Z.main_member(Z.list_members(spark, tmpdir_path)), target)
    assert spark.read.text(target).count() == 5


def test_stata_sample(spark, tmpdir_path):
    pdf = pd.DataFrame({"assignment_id": ["1", "2", "3"], "serial_number": ["10", "20", "30"],
                        "date_recorded": ["2020-01-01", "2020-01-02", ""], "conveyance_text": ["a", "b", "c"],
                        "assignee_name": ["x", "y", "z"], "assignor_name": ["p", "q", "r"]})
    pdf.to_stata(os.path.join(tmpdir_path, "s.dta"), write_index=False, version=118)
    rows = ST.read_stata(spark, tmpdir_path, list(pdf.columns)).orderBy("assignment_id").collect()
    assert [r.serial_number for r in rows] == ["10", "20", "30"] and rows[2].date_recorded in ("", None)


def test_catalog(spark, tmpdir_path):
    doc = {"count": 1, "bulkDataProductBag": [
        {"productIdentifier": "TRTYRAP", "productTitleText": "Annual", "productTotalFileSize": "434260216",
         "productFileBag": {"fileDataBag": [
             {"fileName": "a.zip", "fileSize": "10", "fileTypeText": "Data"},
             {"fileName": "doc.pdf", "fileSize": "1", "fileTypeText": "Documentation"},
             {"fileName": "b.zip", "fileSize": "20", "fileTypeText": "Data"}]}},
        {"productIdentifier": "TTABYR", "mimeTypeIdentifierArrayText": ["XML"]}]}
    p = os.path.join(tmpdir_path, "catalog.json")
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    prods = CT.products(CT.read_catalog(spark, p, multi_line=True))
    got = {r.product_id: r for r in prods.collect()}
    assert got["TRTYRAP"].formats == [] and got["TTABYR"].formats == ["XML"] and got["TRTYRAP"].total_size == 434260216
    files = CT.data_files(prods).orderBy("position").collect()
    assert [(f.file_name, f.position) for f in files] == [("a.zip", 0), ("b.zip", 2)]


def test_listing_heads_inventory(spark, tmpdir_path):
    for name, text in {"x.csv": "Serial No,Filing-Date\n1,2\n3,4\n", "y.CSV": "a\n1\n", "z.log": "junk\n",
                       "w.xml": "<r/>\n"}.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    listing = FS.list_files(spark, tmpdir_path)
    assert sorted(os.path.basename(r.path) for r in listing.collect()) == ["w.xml", "x.csv", "y.CSV"]
    ok, rejected = FS.dispatch(listing)
    assert ok.count() == 3 and rejected.count() == 0
    inv = FS.header_inventory(spark, os.path.join(tmpdir_path, "*.csv"))
    cols = sorted((os.path.basename(r.file_path), r.position, r.column_name) for r in inv.collect())
    assert cols == [("x.csv", 0, "serial_no"), ("x.csv", 1, "filing_date")]
    heads = FS.head_lines(spark, os.path.join(tmpdir_path, "x.csv"), 2).orderBy("pos").collect()
    assert [h.line for h in heads] == ["Serial No,Filing-Date", "1,2"]
    drift = FS.schema_drift(inv, ["serial_no", "status_code"]).collect()
    assert sorted((d.column_name, d.issue) for d in drift) == [("filing_date", "unexpected"), ("status_code", "missing")]
    assert FS.file_hashes(spark, tmpdir_path, "*.xml").first().file_hash == __import__("hashlib").md5(b"<r/>\n").hexdigest()




def test_csv_file_positions_and_batches(spark, tmpdir_path):
    for name, n in [("a.csv", 2500), ("b.csv", 7)]:
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write("serial_no,note\n" + "".join(f"{i},row {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = CS.load_clean(spark, os.path.join(tmpdir_path, "*.csv"), "TRCFECO2", batch_size=1000)
        rows = [(os.path.basename(r.file_path), r.row_position, r.serial_no, r.batch_number) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(pos == serial and b == pos // 1000 for _, pos, serial, b in rows)
    assert sorted(r[1] for r in rows if r[0] == "a.csv") == list(range(2500))


def test_csv_headers_of_all_kinds(spark, tmpdir_path):
    """Column orders, quoted names, repeated and blank names, a byte-order mark, names that look like patterns, empty files."""
    from feedloom.sources import csv as CS
    from feedloom.sources import files as FS

    def write(name, text):
        with open(os.path.join(tmpdir_path, name), "w", encoding="utf-8") as f:
            f.write(text)
    write("a.csv", "id,name\n1,x\n2,y,EXTRA\n3\n")
    write("b [1]* 100%.CSV", '﻿"name","odd, name",id,id,\n"p,q",o,4,5,6\n')
    write("c.csv", "\n\nname,id\nz,7\n\nid,name\n")
    write("empty.csv", "")
    rows = CS.read_csv(spark, tmpdir_path, glob="*.[cC][sS][vV]")
    got = sorted((r["id"] or "", r["name"] or "", r["odd, name"], r["id.1"], r["_c4"], r["_corrupt_record"]) for r in rows.collect())
    assert got == [("1", "x", None, None, None, None), ("2", "y", None, None, None, "2,y,EXTRA"), ("3", "", None, None, None, "3"),
                   ("4", "p,q", "o", "5", "6", None), ("7", "z", None, None, None, None), ("name", "id", None, None, None, None)]
    assert rows.where("_corrupt_record is not null").select("_corrupt_record").count() == 2
    inv = FS.header_inventory(spark, tmpdir_path, glob="*.[cC][sS][vV]")
    assert sorted((r.position, r.column_name) for r in inv.collect()) == [
        (0, "id"), (0, "name"), (0, "name"), (1, "id"), (1, "name"), (1, "odd,_name"), (2, "id"), (3, "id.1"), (4, "_c4")]
    assert CS.read_csv(spark, os.path.join(tmpdir_path, "empty.csv")).count() == 0


def test_positions_of_two_record_tags(spark, tmpdir_path):
    """Records of two tags in one file get positions 0 to n - 1."""
    from feedloom.operators.positions import file_positions
    from feedloom.sources import xml as XS
    rec = "<{0}><number>{1}</number></{0}>"
    with open(os.path.join(tmpdir_path, "f.xml"), "w") as f:
        f.write("<all>" + "".join(rec.format(t, i) for i, t in enumerate(["proceeding-entry", "proceeding"] * 3)) + "</all>")
    rows = XS.read_family(spark, tmpdir_path, "proceeding", XS.flat_schema(["number"]), glob="*.xml")
    got = file_positions(rows, "pos", "record_tag").select("record_tag", "pos", "rec.number").collect()
    assert sorted(r.pos for r in got) == list(range(len(got))) and len({r.number for r in got}) == 6
