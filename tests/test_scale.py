"""Rendered files grow in number and not in size; scans and joins keep rows where they were read."""
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from feedloom.operators import profile as PR
from feedloom.operators.positions import file_positions
from feedloom.plans import q_files, q_load, q_stream, q_xml
from feedloom.plans import render as R
from feedloom.sources import xml as XS

ORDERS, LINES = 900, 2100


@pytest.fixture(scope="module")
def SF(spark):
    """Small tables of the driver's names and types."""
    d, k = tempfile.mkdtemp(prefix="feedloom-scale-"), F.col("id")
    day = F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 700 AS INT))")
    spark.range(ORDERS).select(k.alias("o_orderkey"), (k % 50).alias("o_custkey"), F.expr("substr('FOP', CAST(id % 3 AS INT) + 1, 1)").alias("o_orderstatus"),
                               day.alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority")).write.parquet(f"{d}/orders.parquet")
    spark.range(LINES).select(F.expr("id div 7").alias("l_orderkey"), (k % 7 + 1).cast("int").alias("l_linenumber"), (k % 20).alias("l_partkey"),
                              (k % 10).alias("l_suppkey"), (k % 50).cast("double").alias("l_quantity"), F.lit("R").alias("l_returnflag"),
                              F.lit("F").alias("l_linestatus"), day.alias("l_shipdate")).write.parquet(f"{d}/lineitem.parquet")
    return d


def _local(path):
    return path.removeprefix("file:").replace("///", "/")


@pytest.fixture()
def small_files(monkeypatch):
    """Few rows a file, as for a table that is many times larger; fixtures made anew."""
    monkeypatch.setattr(R, "_RENDERED", {})
    for module in (R, q_files, q_load):
        for name in ("CSV_ROWS", "XML_ROWS"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, 200)


def test_spread_deals_by_rows(spark):
    df = spark.range(1000)
    assert R.spread(df, 4, 100).rdd.getNumPartitions() == 10
    assert R.spread(df, 4, 10_000).rdd.getNumPartitions() == 4
    assert R.spread(df.limit(1), 4, 100, like=df).rdd.getNumPartitions() == 10


def test_record_files_are_compressed_and_grow_in_number(spark, SF, small_files):
    path = _local(q_xml.assignment_dir(spark, SF))
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    files = glob.glob(f"{path}/part-*")
    assert len(files) >= n // 200 and all(f.endswith(".gz") for f in files)
    assert XS.record_texts(spark, path, "assignment-entry").count() == n


def test_whole_file_documents_grow_in_number(spark, SF, small_files, monkeypatch):
    seen = []
    real = XS.read_xml_whole
    monkeypatch.setattr(XS, "read_xml_whole", lambda s, path, *a: seen.append(path) or real(s, path, *a))
    n = q_xml.xml_small_scan(spark, SF).count()
    assert n == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert len(glob.glob(f"{_local(seen[0])}/*.xml")) >= n // 200


def test_samples_scan_no_file_for_a_tag_it_lacks(spark, tmpdir_path, monkeypatch):
    with open(os.path.join(tmpdir_path, "a.xml"), "w") as f:
        f.write("<entries>" + "".join(f"<entry><assignment>\n<reel-no>{i}</reel-no></assignment></entry>" for i in range(9)) + "</entries>")
    with open(os.path.join(tmpdir_path, "b.xml"), "w") as f:
        f.write("<entries><ns:record>1</ns:record></entries>")
    scans, real = [], XS.record_texts
    monkeypatch.setattr(XS, "record_texts", lambda s, paths, tag, *a: scans.append((tag, len(paths))) or real(s, paths, tag, *a))
    rows = PR.xml_samples(spark, tmpdir_path, n=5).collect()
    assert scans == [("assignment", 1)]
    assert len(rows) == 5 and {r["tag"] for r in rows} == {"assignment"}


def test_record_starts_at_the_tag_itself(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.xml"), "w") as f:
        f.write("<r>é<case-file-header/><case-file\n a='1'>\U0001F600</case-file><x/><case-file>2</case-file></r>")
    got = [r["record"] for r in XS.record_texts(spark, tmpdir_path, "case-file").collect()]
    assert got == ["<case-file\n a='1'>\U0001F600</case-file>", "<case-file>2</case-file>"]


def test_positions_keep_rows_in_place(spark, tmpdir_path):
    spark.range(100).select(F.col("id").cast("string")).coalesce(1).write.mode("overwrite").text(tmpdir_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = file_positions(spark.read.text(tmpdir_path).select("value", F.col("_metadata.file_path").alias("file_path"),
                                                               F.col("_metadata.file_block_start").alias("block_start")))
        assert "SortMergeJoin" not in d._jdf.queryExecution().executedPlan().toString()
        assert d.where(F.col("value").cast("long") != F.col("row_position")).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_mixed_delivery_has_one_file_a_line_number(spark, SF, small_files):
    path = _local(q_load._mixed_dir(spark, SF))
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    want = {(r[0], r[1]) for r in li.select((F.col("l_orderkey") % 3).cast("int"), F.col("l_linenumber").cast("int")).distinct().collect()}
    files = [f for f in glob.glob(f"{path}/*/ln=*/*") if f.lower().endswith(".csv")]
    assert len(files) == len(want)
    # One job a generation writes its folders; one job a file wrote them before.
    assert len(glob.glob(f"{path}/*/_SUCCESS")) == 3


@pytest.mark.parametrize("name, rows, least", [("two_formats", ORDERS, 1), ("zip_roundtrip", LINES, 5)])
def test_archives_grow_in_number(spark, SF, small_files, monkeypatch, name, rows, least):
    import __spark_entry__ as E
    made, real = [], {m: m.scratch_path for m in (q_files, q_load)}
    for m in real:
        monkeypatch.setattr(m, "scratch_path", lambda s, n, m=m: made.append(real[m](s, n)) or made[-1])
    assert E.queries()[name](spark, SF).count() == rows
    assert len([f for p in made for f in glob.glob(f"{_local(p)}/**/*.zip", recursive=True)]) >= least


def test_stream_takes_a_fourth_of_the_files_a_batch(spark, SF, small_files, monkeypatch):
    sizes = []
    monkeypatch.setattr(q_stream.STR, "ingest_csv_stream", lambda *a, **k: sizes.append(k["files_per_batch"])
                        or spark.range(0).selectExpr("'' l_orderkey", "'' l_linenumber", "0L serial_no").write.parquet(a[3]))
    q_stream.stream_ingest(spark, SF)
    assert sizes[0] > 1


def _profile_by_records(texts):
    """Brute force: every record parsed whole, one at a time."""
    import re
    import xml.etree.ElementTree as ET
    strip, got = re.compile(r"<(/?)[A-Za-z0-9_.-]+:"), {}
    for text in texts:
        try:
            todo = [(ET.fromstring(strip.sub(r"<\1", text)), "", 0)]
        except ET.ParseError:
            continue
        while todo:
            el, above, depth = todo.pop()
            path = f"{above}/{el.tag}".lstrip("/")
            a = got.setdefault(path, [0, depth, set(), set(), False])
            a[0] += 1
            a[2] |= {k.rpartition("}")[2] for k in el.attrib}
            a[3] |= {k.tag for k in el}
            a[4] |= bool(el.text and el.text.strip())
            todo += [(k, path, depth + 1) for k in el]
    return {p: (n, d, sorted(a), sorted(c), t) for p, (n, d, a, c, t) in got.items()}


def test_path_profile_of_cut_down_records_equals_that_of_whole_ones(spark):
    import random
    from unittest import mock
    text = ["", " ", "\n  ", "a", " b ", "x > y", "]]>", "]]&gt;", "a&amp;b", "&lt;", "&#32;", "&#65;", "&foo;", "&", "é", " ", " x", "\x85",
            "\x01", "a\x02b", "￾", "￿z", "漢字 &amp; x", "<!-- > n <i> -->", "<!-- <j> -- -->", "<![CDATA[ <k> ]]>", "<?p >v<?>", " ", "a\"b'c",
            "x\ty", "é" * 40 + "&amp;" * 60, "q</i>", "<i>", "\U0001F600", "a\U0001F600", "="]
    tags, rng = ["i", "j", "n:k", "m"], random.Random(4)

    def element(depth):
        t = rng.choice(tags)
        attrs = rng.choice(["", "", ' a="1"', " b='x > y'", ' c="<"', ' d=">', ' a="1" a="2"', ' e="&gt;"', " "])
        if rng.random() < 0.1:
            return f"<{t}{attrs}/>"
        inside = "".join(rng.choice(text) if rng.random() < 0.6 or depth > 2 else element(depth + 1) for _ in range(rng.randint(0, 3)))
        return f"<{t}{attrs}>{inside}</{t}>"

    texts = [f"<r>{element(0)}{rng.choice(text[:5])}</r>" for _ in range(3000)] + [f"<r><i>{x}</i><j>{x}<m/>{x}</j></r>" for x in text]
    records = spark.createDataFrame([(t,) for t in [*texts, None]], "record string")
    got = {r["path"]: (r["occurrences"], r["depth"], r["attributes"], r["child_tags"], r["has_text"])
           for r in PR.xml_path_profile(PR.path_profile_partials(records)).collect()}
    want = _profile_by_records(texts)
    assert got == want and want["r"][0] > 500

    # Records that differ in their text alone are parsed once a batch; each was parsed before.
    import xml.etree.ElementTree as ET
    alike, parsed, real = [f"<r><i>{k}</i> <j>no. {k} &amp; co</j></r>" for k in range(200)], [], ET.fromstring
    cut = [r[0] for r in spark.createDataFrame([(t,) for t in alike], "record string").select(PR.structure_text("record")).collect()]
    import pandas as pd
    with mock.patch.object(ET, "fromstring", lambda t: parsed.append(t) or real(t)):
        out = pd.concat(PR._partial_batches([pd.DataFrame({"record": cut})], "record"))
    assert len(parsed) == 1 and out.set_index("path").occurrences.to_dict() == {"r": 200, "r/i": 200, "r/j": 200}


def test_large_files_are_hashed_as_they_are_read(spark, tmpdir_path, monkeypatch):
    import gzip
    import hashlib

    from feedloom.sources import files as FS
    contents = {"plain.csv": b"a,b\n" * 3000, "no end.csv": b"a,b\r\n" * 3000 + b"last", "mark.csv": b"\xef\xbb\xbf" + b"x\n" * 900,
                "mark%20[1] {x}.csv": b"\xef\xbb\xbf" + b"x\n" * 900 + b"\n\ny", "feeds.csv": b"\n" * 2000, "bytes.zip": bytes(range(256)) * 50,
                "one line.csv": b"z" * 5000, "packed.gz": gzip.compress(os.urandom(3000)), "small.csv": b"s\n"}
    for name, data in contents.items():
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(data)
    monkeypatch.setattr(FS, "WHOLE_BYTES", 500)
    seen, real = [], FS.streamed_hashes
    monkeypatch.setattr(FS, "streamed_hashes", lambda s, lengths: seen.append(real(s, lengths)) or seen[-1])
    settings = [spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")]
    want = {n: (len(c), hashlib.md5(c).hexdigest()) for n, c in contents.items()}
    got = {os.path.basename(r["path"]): (r["length"], r["file_hash"]) for r in FS.file_hashes(spark, tmpdir_path).collect()}
    assert got == want
    assert {os.path.basename(p) for p in seen[0]} == set(contents) - {"packed.gz", "small.csv"}
    assert settings == [spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")]
    got = {os.path.basename(r["path"]) for r in FS.file_hashes(spark, tmpdir_path, max_bytes=5000).collect()}
    assert got == {n for n, c in contents.items() if len(c) <= 5000}

    # Files that the reader splits all the same are read whole.
    monkeypatch.setattr(FS, "streamed_hashes", lambda s, lengths: {p: h for p, h in real(s, lengths).items() if "plain" in p})
    got = {os.path.basename(r["path"]): (r["length"], r["file_hash"]) for r in FS.file_hashes(spark, tmpdir_path).collect()}
    assert got == want


def test_feed_queries_run_in_methods_that_the_jvm_compiles(spark, SF):
    import __spark_entry__ as E
    for name in ("assignment_first", "assignment_per_property", "full_load"):
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        E.queries()[name](spark, SF)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000", name
