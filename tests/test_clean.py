from pyspark.sql import functions as F

from plotkeep.functions import clean as C


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def values(spark, data, make):
    df = spark.createDataFrame([(d,) for d in data], "c string")
    return [r.v for r in df.select(make(F.col("c")).alias("v")).collect()]


def test_null_tokens_are_exact(spark):
    assert values(spark, [None, "null", "NULL", "Null", " null", "x"], C.null_tokens_to_null) == [
        None, None, None, "Null", " null", "x"]


def test_split_items(spark):
    assert values(spark, ["Rental;Special Needs; Mixed Use", ";;a;", "", None], C.split_items) == [
        ["Rental", "Special Needs", "Mixed Use"], ["a"], [], None]


def test_snap_to_ranks(spark):
    df = spark.createDataFrame([(0.5,), (0.66699999,), (0.8330001,), (1.0,), (0.7,), (None,)], "v double")
    assert [r.s for r in df.select(C.snap_to(F.col("v")).alias("s")).collect()] == [0.5, 0.667, 0.833, 1.0, None, None]


def test_code_label_unknown_is_null(spark):
    df = spark.createDataFrame([(1810,), (0,), (None,)], "c int")
    book = {1810: "Building", 1830: "Tank"}
    assert [r.v for r in df.select(C.code_label(F.col("c"), book).alias("v")).collect()] == ["Building", None, None]


def test_content_types(spark):
    paths = ["a/catalog.json", "a/styles/default.json", "a/roads.style.json", "a/x.parquet", "a/x.unknown", "a/X.PNG",
             "styles.json", "a/styles/x.png"]
    assert values(spark, paths, C.content_type) == [
        "application/json", C.STYLE_CONTENT_TYPE, C.STYLE_CONTENT_TYPE, "application/vnd.apache.parquet",
        "application/octet-stream", "image/png", "application/json", "image/png"]


def test_data_objects(spark):
    good = ["a/roads.parquet", "a/roads.PARQUET", "a/tiles.pmtiles", "dem/tile.tif", "_assets/x.parquet"]
    bad = ["a/scratch.geojson", "a/notes.md", "a/roads.parquet.tmp", "a/.hidden/x.parquet", ".work/tmp.parquet",
           "a/.parquet"]
    assert all(values(spark, good, C.is_data_object))
    assert not any(values(spark, bad, C.is_data_object))


def test_archive_key(spark):
    keys = ["p/versions/1.parquet", "versions/1.parquet", "p/reversions/1.parquet", "p/versions.parquet"]
    assert values(spark, keys, C.is_archive_key) == [True, True, False, False]


def test_bucket_uri(spark):
    df = spark.createDataFrame([("s3://b/a/c",), ("s3://b/a/c/",), ("s3://b",), ("s3://b/",), ("https://b/a",)], "u string")
    bucket, prefix = C.split_bucket_uri(F.col("u"))
    assert [tuple(r) for r in df.select(bucket, prefix).collect()] == [
        ("b", "a/c"), ("b", "a/c"), ("b", ""), ("b", ""), (None, None)]


def test_times(spark):
    text = C.iso_utc(C.utc_from_millis(F.lit(1791446400123)))
    assert one(spark, text) == "2026-10-08T08:00:00Z"
    assert one(spark, C.iso_utc(C.parse_iso_utc(F.lit("2026-10-08T08:00:00Z")))) == "2026-10-08T08:00:00Z"


def test_first_known(spark):
    assert one(spark, C.first_known(F.lit(None).cast("long"), F.lit(0), F.lit(7))) == 7
    assert one(spark, C.first_known(F.lit(""), F.lit("b"), empty="")) == "b"


def test_address_key(spark):
    assert values(spark, ["  12  main\tst ", "12 MAIN ST"], C.address_key) == ["12 MAIN ST", "12 MAIN ST"]


def test_typed_value_keeps_types_apart(spark):
    df = spark.createDataFrame([(1, "1", 1.0, True)], "i int, s string, d double, b boolean")
    out = [df.select(*C.typed_value(F.col(n), df.schema[n].dataType)).first() for n in "isdb"]
    assert [tuple(r) for r in out] == [(1.0, None), (None, "1"), (1.0, None), (1.0, None)]


def test_digests(spark):
    assert one(spark, C.md5_hex(F.lit("hello").cast("binary"))) == "5d41402abc4b2a76b9719d911017c592"
    assert one(spark, C.multihash(F.lit("hello").cast("binary"))).startswith("12202cf24dba5fb0a30e26e83b2ac5b9e29e")
