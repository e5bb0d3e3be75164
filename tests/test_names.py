from feedloom.functions import names as N


def test_strict_and_light():
    assert N.strict_name("Filing Date (YYYYMMDD)") == "filing_date_yyyymmdd"
    assert N.strict_name("__Mark--ID__") == "mark_id"
    assert N.light_name(" Serial-Number ") == "serial_number"


def test_alias_profiles(spark):
    df = spark.createDataFrame([("1", "2", "3", "x")], ["serial_number", "registration_number", "Filing Date", "file_location"])
    assert N.apply_aliases(df, "generic").columns == ["serial_no", "registration_number", "filing_dt", "file_location_cd"]
    assert N.apply_aliases(df, "alternate").columns == ["serial_no", "registration_no", "filing_dt", "file_location"]
    assert N.apply_aliases(df, "case_file").columns == ["serial_number", "registration_number", "filing_date"]


def test_collisions_coalesce_in_source_order(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "`Serial No` string, `serial-no` string")
    out = N.normalize_columns(df, "light")
    assert out.columns == ["serial_no"]
    assert [r[0] for r in out.collect()] == ["b", "a"]


def test_evolve_serial(spark):
    both = spark.createDataFrame([("1", None), (None, "2")], "serial_no string, serial_number string")
    assert sorted(r[0] for r in N.evolve_serial(both).collect()) == ["1", "2"]
    neither = spark.createDataFrame([("x",)], "a string")
    assert "serial_no" in N.evolve_serial(neither).columns


def test_align_union_and_to(spark):
    from pyspark.sql import types as T
    a = spark.createDataFrame([("1", "x")], "serial_no string, status_code string")
    b = spark.createDataFrame([("2", 5)], "serial_no string, batch_number int")
    u = N.align_union([a, b])
    assert set(u.columns) == {"serial_no", "status_code", "batch_number"} and u.count() == 2
    target = T.StructType([T.StructField("serial_no", T.LongType()), T.StructField("missing", T.StringType())])
    out = N.align_to(a, target)
    assert out.columns == ["serial_no", "missing", "_extras"]
    r = out.first()
    assert r.serial_no == 1 and r.missing is None and "status_code" in r._extras


def test_store_schemes_for_whole_file_writers():
    from feedloom.session import arrow_uri
    assert arrow_uri("/a/b") == arrow_uri("file:/a/b") == "file:///a/b" and arrow_uri("file:///a/b") == "file:///a/b"
    assert arrow_uri("s3a://bucket/x") == "s3://bucket/x" and arrow_uri("hdfs://host:1/x") == "hdfs://host:1/x"
    assert arrow_uri("abfss://c@h/x") == "abfs://c@h/x"
