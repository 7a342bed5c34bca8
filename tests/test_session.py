from obsforge.session import materialize, scratch_path, shared_dir


def test_paths(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and "://" in a
    if before:
        assert before.rstrip("/") in a


def test_materialize_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, timestamp_ntz'2025-01-01 00:00:00' AS t")
    got = materialize(df, "t")
    assert got.dtypes == df.dtypes and [tuple(r) for r in got.collect()] == [tuple(r) for r in df.collect()]
    assert materialize(df.limit(0), "t").count() == 0
