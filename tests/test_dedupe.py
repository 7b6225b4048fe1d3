"""Latest-per-key deduplication: newest wins, ties broken by a total order."""

from datetime import datetime

from stratum.operators.dedupe import duplicate_groups, latest_per_key


def test_latest_per_key_prefers_newest_and_nulls_last(spark):
    rows = [("A", datetime(2026, 1, 1), "old"), ("A", datetime(2026, 2, 1), "new"), ("A", None, "null"), ("B", None, "only")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v string")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "ts").collect()}
    assert got == {"A": "new", "B": "only"}


def test_latest_per_key_is_deterministic_on_ties(spark):
    rows = [("A", 1, "x"), ("A", 1, "y"), ("A", 1, "x")]
    df = spark.createDataFrame(rows, "k string, ts int, v string")
    for parts in (1, 3, 7):
        got = latest_per_key(df.repartition(parts), ["k"], "ts").collect()
        assert [r["v"] for r in got] == ["y"]


def test_lineage_columns_break_ties(spark):
    rows = [("A", 1, "2026-01-01", "f1"), ("A", 1, "2026-01-02", "f0")]
    df = spark.createDataFrame(rows, "k string, ts int, data_ingestao string, arquivo_origem string")
    assert latest_per_key(df, ["k"], "ts").first()["arquivo_origem"] == "f0"


def test_duplicate_groups(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in duplicate_groups(df, ["k"]).collect()] == [(1, 2)]


def test_global_position_matches_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from stratum.operators.ordering import with_global_position

    df = spark.createDataFrame([(i % 7, f"p{i:04d}") for i in range(500)], "ts int, path string")
    order = [F.col("ts").desc(), F.col("path").asc()]
    got = {r["path"]: r["posicao"] for r in with_global_position(df, order, partitions=5).collect()}
    want = {r["path"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want
