"""Table sinks: alignment, idempotent quarantine, staged commits and recovery, SCD2 commit."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratum.operators.upsert import current_rows, scd2_apply
from stratum.sinks import tables as sink


@pytest.fixture()
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def test_align_to_schema(spark):
    df = spark.createDataFrame([("7", "x", 1)], "a string, b string, extra int")
    schema = StructType([StructField("a", LongType()), StructField("c", StringType()), StructField("b", StringType())])
    out = sink.align_to_schema(df, schema)
    assert out.columns == ["a", "c", "b"] and tuple(out.first()) == (7, None, "x")
    bad = sink.align_to_schema(spark.createDataFrame([("zz",)], "a string"), schema)
    assert bad.first()["a"] is None


def test_quarantine_append_is_idempotent(spark, db):
    t = f"{db}.q"
    df = spark.createDataFrame([(1, "r"), (2, "r"), (2, "r")], "id int, motivo_quarentena string")
    sink.append_quarantine(df, t)
    sink.append_quarantine(df, t)
    assert spark.table(t).count() == 2


def test_append_merges_schema(spark, db):
    t = f"{db}.b"
    sink.append(spark.createDataFrame([("1",)], "a string"), t, merge_schema=True)
    sink.append(spark.createDataFrame([("2", "x")], "a string, novo string"), t, merge_schema=True)
    rows = sorted(tuple(r) for r in spark.table(t).collect())
    assert rows == [("1", None), ("2", "x")]


def test_commit_state_reads_its_own_target(spark, db):
    t = f"{db}.s"
    sink.write_snapshot(spark.createDataFrame([(1, "a")], "id int, s string"), t)
    new = spark.table(t).withColumn("s", F.upper("s"))
    sink.commit_state(new, t)
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "A")]


def test_recover_finishes_interrupted_commit(spark, db):
    t = f"{db}.r"
    sink.write_snapshot(spark.createDataFrame([(1,)], "id int"), t)
    # simulate a crash right after the staging table was written
    sink.write_snapshot(spark.createDataFrame([(2,), (3,)], "id int"), t + sink.STAGING_SUFFIX)
    assert sink.recover(spark, t)
    assert sorted(r["id"] for r in spark.table(t).collect()) == [2, 3]
    assert not sink.table_exists(spark, t + sink.STAGING_SUFFIX)


def test_merge_into_rejects_duplicate_source_keys(spark, db):
    t = f"{db}.m"
    sink.merge_into(spark, spark.createDataFrame([(1, "a")], "id int, s string"), t, ["id"])
    with pytest.raises(ValueError):
        sink.merge_into(spark, spark.createDataFrame([(1, "b"), (1, "c")], "id int, s string"), t, ["id"])
    sink.merge_into(spark, spark.createDataFrame([(1, "b"), (2, "c")], "id int, s string"), t, ["id"])
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(1, "b"), (2, "c")]


def test_commit_scd2_partitions_and_is_repeatable(spark, db):
    t = f"{db}.scd"
    schema = "id int, v string"
    t1, t2 = datetime(2026, 1, 1), datetime(2026, 2, 1)
    sink.commit_scd2(scd2_apply(None, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["id"], ["v"], t1), t)
    src2 = spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], schema)
    changes = scd2_apply(current_rows(spark.table(t)), src2, ["id"], ["v"], t2)
    sink.commit_scd2(changes, t)
    rows = sorted((r["id"], r["v"], r["registro_atual"]) for r in spark.table(t).collect())
    assert rows == [(1, "A", True), (1, "a", False), (2, "b", True), (3, "c", True)]
    # a replayed commit of the same change set adds nothing
    changes_again = scd2_apply(current_rows(spark.table(t)), src2, ["id"], ["v"], t2)
    sink.commit_scd2(changes_again, t)
    assert spark.table(t).count() == 4


def test_fused_checks_one_scan_many_results(spark):
    from stratum.operators.checks import fused_checks

    df = spark.createDataFrame([(1, 5.0, "ALTA"), (2, -1.0, "X"), (None, 3.0, "BAIXA")], "id int, v double, sev string")
    out = fused_checks(df, "t", datetime(2026, 1, 1), not_empty=True, required=["id"], positive=[("pos", "v")], domains=[("dom", "sev", ["ALTA", "BAIXA"])])
    got = {r["teste"]: (r["status"], r["detalhe"]) for r in out.collect()}
    assert got == {
        "Tabela possui registros: t": ("APROVADO", "Quantidade: 3"),
        "Campos obrigatórios preenchidos: t": ("REPROVADO", "Registros inválidos: 1"),
        "pos": ("REPROVADO", "Registros inválidos: 1"),
        "dom": ("REPROVADO", "Registros inválidos: 1"),
    }
    # a single aggregation: one scan of the input
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_recover_scd2_after_interrupted_commit(spark, db):
    t = f"{db}.scd_rec"
    schema = "id int, v string"
    sink.commit_scd2(scd2_apply(None, spark.createDataFrame([(1, "a")], schema), ["id"], ["v"], datetime(2026, 1, 1)), t)
    changes = scd2_apply(current_rows(spark.table(t)), spark.createDataFrame([(1, "b")], schema), ["id"], ["v"], datetime(2026, 2, 1))
    # crash after staging: the staging table exists, the target is untouched
    sink.write_snapshot(changes, t + sink.SCD_STAGING_SUFFIX)
    assert sink.recover_scd2(spark, t)
    rows = sorted((r["id"], r["v"], r["registro_atual"]) for r in spark.table(t).collect())
    assert rows == [(1, "a", False), (1, "b", True)]


def test_skewed_key_dedupe_and_aggregate(spark):
    """A key holding a third of the rows: results stay whole and exact."""
    from stratum.operators.dedupe import latest_per_key

    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, ts int").repartition(6)
    latest = {r["k"]: r["ts"] for r in latest_per_key(df, ["k"], "ts").collect()}
    assert latest[0] == 2997 and len(latest) == 2001
    agg = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert agg[0] == 1000 and sum(agg.values()) == 3000


def test_bucketed_scd2_target_is_joined_without_shuffle(spark, db):
    t = f"{db}.scd_b"
    schema = "id int, v string"
    src1 = spark.createDataFrame([(i, f"v{i}") for i in range(20)], schema)
    sink.commit_scd2(scd2_apply(None, src1, ["id"], ["v"], datetime(2026, 1, 1)), t, bucket_by=(4, ["id"]))
    src2 = spark.createDataFrame([(i, f"w{i}" if i % 2 else f"v{i}") for i in range(25)], schema)
    changes = scd2_apply(current_rows(spark.table(t)), src2, ["id"], ["v"], datetime(2026, 2, 1), null_safe=False)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    # only the source is shuffled; the bucketed active set is read as is
    assert plan.count("Exchange hashpartitioning") == 1
    sink.commit_scd2(changes, t, run_ts=datetime(2026, 2, 1), bucket_by=(4, ["id"]))
    active = {r["id"]: r["v"] for r in current_rows(spark.table(t)).collect()}
    assert len(active) == 25 and active[1] == "w1" and active[2] == "v2"
    assert spark.table(t).filter("NOT registro_atual").count() == 10


def test_bucketed_merge_target_is_joined_without_shuffle(spark, db):
    from stratum.operators.upsert import merge_upsert

    t = f"{db}.mb"
    sink.merge_into(spark, spark.createDataFrame([(i, "a") for i in range(10)], "id int, s string"), t, ["id"], bucket_by=(4, ["id"]))
    source = spark.createDataFrame([(1, "b"), (20, "c")], "id int, s string")
    plan = merge_upsert(spark.table(t), source, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    sink.merge_into(spark, source, t, ["id"], bucket_by=(4, ["id"]))
    got = {r["id"]: r["s"] for r in spark.table(t).collect()}
    assert len(got) == 11 and got[1] == "b" and got[20] == "c" and got[2] == "a"


def test_quarantine_knows_a_row_by_its_content(spark, db):
    t = f"{db}.q2"
    columns = "id int, motivo_quarentena string, batch_id string, timestamp_ingestao timestamp"
    day = datetime(2026, 1, 1)
    first = spark.createDataFrame([(1, "r", "a", day), (2, "r", "a", day), (2, "r", "a", day)], columns)
    sink.append_quarantine(first, t)
    later = datetime(2026, 1, 2)
    again = first.union(spark.createDataFrame([(1, "r", "b", later), (3, "r", "b", later)], columns))
    sink.append_quarantine(again, t)
    counts = {r["id"]: r["n"] for r in spark.table(t).groupBy("id").agg(F.sum("ocorrencias").alias("n")).collect()}
    assert counts == {1: 1, 2: 2, 3: 1}
    # a further copy of a known row adds one occurrence, and what is there stays
    third = again.union(spark.createDataFrame([(1, "r", "c", later), (1, "r", "c", later)], columns))
    sink.append_quarantine(third, t)
    sink.append_quarantine(third, t)
    assert spark.table(t).filter("id = 1").agg(F.sum("ocorrencias")).first()[0] == 2
    plan = sink.quarantine_rows(first, spark.table(t))._jdf.queryExecution().executedPlan().toString()
    read = [part for part in plan.split("ReadSchema: ")[1:]]
    assert all("motivo_quarentena" not in part.split(">")[0] for part in read)  # of the history, key and count alone


@pytest.mark.parametrize("buckets", [None, 8])
@pytest.mark.parametrize("step", ["staged", "half", "published"])
def test_merge_survives_a_crash_at_each_step(spark, db, monkeypatch, buckets, step):
    t = f"{db}.m_{step}"
    sink.merge_into(spark, spark.range(100).selectExpr("id", "'old' AS v"), t, ["id"], key_buckets=buckets)
    change = spark.createDataFrame([(5, "new"), (200, "new")], "id long, v string")
    real = spark.sql

    def crash(*_args, **_kw):
        raise RuntimeError("crash")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="crash"):
        if step == "staged":  # the staging table is there, the target untouched
            m.setattr(sink, "_publish" if buckets is None else "align_to_schema", crash)
        elif step == "half":  # the overwrite had dropped the target, or its touched partitions
            def drop(*_args, **_kw):
                if buckets is None:
                    real(f"DROP TABLE {t}")
                else:
                    parts = spark.table(t + sink.MERGE_STAGING_SUFFIX).select(sink.KEY_BUCKET).distinct().collect()
                    for p in parts:
                        real(f"ALTER TABLE {t} DROP IF EXISTS PARTITION ({sink.KEY_BUCKET}={p[0]})")
                crash()

            m.setattr(sink, "_publish" if buckets is None else "align_to_schema", drop)
        else:  # published, but the staging table was not dropped
            m.setattr(spark, "sql", lambda q, *a, **k: crash() if q.startswith("DROP TABLE") else real(q, *a, **k), raising=False)
        sink.merge_into(spark, change, t, ["id"], key_buckets=buckets)
    after = spark.createDataFrame([(6, "later")], "id long, v string")
    sink.merge_into(spark, after, t, ["id"], key_buckets=buckets)
    rows = {r["id"]: r["v"] for r in spark.table(t).collect()}
    assert spark.table(t).count() == len(rows) == 101
    assert rows[5] == rows[200] == "new" and rows[6] == "later" and rows[7] == "old"


def test_merge_leaves_untouched_partitions_alone(spark, db):
    t = f"{db}.parts"
    sink.merge_into(spark, spark.range(200).selectExpr("cast(id AS int) AS id", "'old' AS v"), t, ["id"], key_buckets=16)
    before = {r[0] for r in spark.table(t).select("_metadata.file_path").distinct().collect()}
    change = spark.createDataFrame([(7, "new"), (900, "new")], "id long, v string")  # another key type
    sink.merge_into(spark, change, t, ["id"], key_buckets=16)
    after = {r[0] for r in spark.table(t).select("_metadata.file_path").distinct().collect()}
    folders = {f.split("faixa_chave=")[1].split("/")[0] for f in before}
    rewritten = {f.split("faixa_chave=")[1].split("/")[0] for f in before ^ after}
    assert len(folders) == 16 and 1 <= len(rewritten) <= 2
    assert spark.table(t).count() == 201 and spark.table(t).filter("v = 'new'").count() == 2
    sink.merge_into(spark, change.limit(0), t, ["id"], key_buckets=16)
    assert {r[0] for r in spark.table(t).select("_metadata.file_path").distinct().collect()} == after
