"""SCD2 and MERGE transforms (the original unit tests, plus invariants)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.upsert import current_rows, merge_upsert, scd2_apply, scd2_first_load

SCHEMA = "id_cliente bigint, nome string, renda double"
T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)


def test_scd2_first_load(spark):
    src = spark.createDataFrame([(1, "Maria", 2000.0)], SCHEMA)
    rows = scd2_first_load(src, T1).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["registro_atual"] is True and r["data_inicio_vigencia"] is not None and r["data_fim_vigencia"] is None


def test_scd2_change_keeps_history(spark):
    v1 = scd2_first_load(spark.createDataFrame([(1, "Maria", 2000.0)], SCHEMA), T1)
    out = scd2_apply(v1, spark.createDataFrame([(1, "Maria", 2500.0)], SCHEMA), ["id_cliente"], ["nome", "renda"], T2).collect()
    assert len(out) == 2
    active = [r for r in out if r["registro_atual"]]
    closed = [r for r in out if not r["registro_atual"]]
    assert len(active) == 1 and active[0]["renda"] == 2500.0 and active[0]["data_fim_vigencia"] is None
    assert closed[0]["renda"] == 2000.0 and closed[0]["data_fim_vigencia"] is not None


def test_scd2_unchanged_is_noop(spark):
    src = spark.createDataFrame([(1, "Maria", 2000.0)], SCHEMA)
    v1 = scd2_first_load(src, T1)
    out = scd2_apply(v1, src, ["id_cliente"], ["nome", "renda"], T2).collect()
    assert len(out) == 1 and out[0]["registro_atual"] and out[0]["data_inicio_vigencia"] == T1


def test_scd2_null_compare_values_are_equal(spark):
    src = spark.createDataFrame([(1, None, None)], SCHEMA)
    v1 = scd2_first_load(src, T1)
    assert scd2_apply(v1, src, ["id_cliente"], ["nome", "renda"], T2).count() == 1


def test_scd2_target_only_rows_stay_active(spark):
    v1 = scd2_first_load(spark.createDataFrame([(1, "A", 1.0), (2, "B", 2.0)], SCHEMA), T1)
    out = scd2_apply(v1, spark.createDataFrame([(3, "C", 3.0)], SCHEMA), ["id_cliente"], ["nome", "renda"], T2)
    assert sorted(r["id_cliente"] for r in current_rows(out).collect()) == [1, 2, 3]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=8, unique_by=lambda t: t[0]),
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=8, unique_by=lambda t: t[0]),
)
def test_scd2_invariants(spark, first, second):
    """At most one active version per key; reapplying the same source changes nothing."""
    schema = "k int, v string, n int"
    s1, s2 = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    state = scd2_first_load(s1, T1)
    after = scd2_apply(current_rows(state), s2, ["k"], ["v", "n"], T2)
    active = current_rows(after)
    assert active.groupBy("k").count().filter("count > 1").count() == 0
    assert sorted(r["k"] for r in active.collect()) == sorted({k for k, _, _ in first} | {k for k, _, _ in second})
    again = scd2_apply(active, s2, ["k"], ["v", "n"], T3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, active.collect()))
    # closed versions end where the next one starts
    for r in after.filter(~F.col("registro_atual")).collect():
        assert r["data_fim_vigencia"] == T2


def test_merge_update_insert_keep(spark):
    target = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "id bigint, s string, v double")
    source = spark.createDataFrame([(2, "B", 25.0), (3, "c", 30.0)], "id bigint, s string, v double")
    out = {r["id"]: (r["s"], r["v"]) for r in merge_upsert(target, source, ["id"]).collect()}
    assert out == {1: ("a", 10.0), 2: ("B", 25.0), 3: ("c", 30.0)}


def test_merge_update_subset_and_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 10.0)], "id bigint, s string, v double")
    source = spark.createDataFrame([(1, "A", 99.0), (2, "n", 5.0)], "id bigint, s string, v double")
    once = merge_upsert(target, source, ["id"], update={"s": "origem.s"})
    got = {r["id"]: (r["s"], r["v"]) for r in once.collect()}
    assert got == {1: ("A", 10.0), 2: ("n", 5.0)}
    twice = merge_upsert(once, source, ["id"], update={"s": "origem.s"})
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_merge_into_missing_target_creates_it(spark):
    source = spark.createDataFrame([(1, "a")], "id bigint, s string")
    assert merge_upsert(None, source, ["id"]).count() == 1


def test_scd2_effective_from_and_delete(spark):
    schema = "k int, v string, quando timestamp, op string"
    first = spark.createDataFrame([(1, "a", datetime(2026, 1, 5), "I"), (2, "b", datetime(2026, 1, 6), "I"), (3, "x", datetime(2026, 1, 7), "D")], schema)
    state = scd2_apply(None, first, ["k"], ["v"], T1, effective_from="quando", delete_when=F.col("op") == "D")
    assert sorted((r["k"], r["data_inicio_vigencia"]) for r in state.collect()) == [(1, datetime(2026, 1, 5)), (2, datetime(2026, 1, 6))]
    second = spark.createDataFrame([(1, "A", datetime(2026, 2, 3), "U"), (2, "b", datetime(2026, 2, 4), "D")], schema)
    out = scd2_apply(state, second, ["k"], ["v"], T2, effective_from="quando", delete_when=F.col("op") == "D").collect()
    got = sorted((r["k"], r["v"], r["registro_atual"], r["data_inicio_vigencia"], r["data_fim_vigencia"]) for r in out)
    assert got == [
        (1, "A", True, datetime(2026, 2, 3), None),
        (1, "a", False, datetime(2026, 1, 5), datetime(2026, 2, 3)),
        (2, "b", False, datetime(2026, 1, 6), datetime(2026, 2, 4)),
    ]


# ---------------------------------------------------------------- versions by event time

EVENTS = "id int, v string, seq int, em timestamp, op string"


def versions_of(df):
    days = lambda t: t and (t - datetime(2026, 1, 1)).days
    rows = [(r["id"], r["v"], days(r["data_inicio_vigencia"]), days(r["data_fim_vigencia"]), r["registro_atual"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def load(spark, existing, rows):
    from stratum.operators.upsert import scd2_event_time

    day = lambda n: None if n is None else datetime(2026, 1, 1) + timedelta(days=n)
    changes = spark.createDataFrame([(i, v, seq, day(n), op) for seq, (i, v, n, op) in enumerate(rows)], EVENTS)
    run_ts = datetime(2026, 2, 1)
    return scd2_event_time(existing, changes, ["id"], ["v"], "em", run_ts, order_by=["seq"], deleted=F.col("op") == "D")


def test_insert_updates_and_delete_of_one_key_in_one_load(spark):
    out = load(spark, None, [(1, "a", 1, "I"), (1, "b", 3, "U"), (1, "c", 5, "U"), (1, "c", 9, "D"), (2, None, 4, "I")])
    assert versions_of(out) == [(1, "a", 1, 3, False), (1, "b", 3, 5, False), (1, "c", 5, 9, False), (2, None, 4, None, True)]


def test_late_rows_go_into_history(spark):
    first = load(spark, None, [(1, "a", 1, "I"), (1, "c", 10, "U"), (2, "x", 1, "I"), (2, "x", 5, "D")])
    late = [(1, "b", 4, "U"), (1, "z", 0, "I"), (2, "y", 3, "U"), (2, "w", 8, "I")]
    second = load(spark, first, late)
    expected = [
        (1, "z", 0, 1, False), (1, "a", 1, 4, False), (1, "b", 4, 10, False), (1, "c", 10, None, True),
        (2, "x", 1, 3, False), (2, "y", 3, 5, False), (2, "w", 8, None, True),
    ]
    assert versions_of(second) == expected
    assert versions_of(load(spark, second, late)) == expected  # the same load again


def test_equal_neighbours_ties_and_null_keys(spark):
    rows = [(1, "a", 1, "I"), (1, "a", 2, "U"), (1, None, 3, "U"), (1, None, 4, "U"), (1, "b", 4, "U"), (1, "c", 4, "U")]
    rows += [(None, "n", 1, "I"), (None, "m", None, "U"), (3, "d", 2, "D")]
    assert versions_of(load(spark, None, rows)) == [
        (1, "a", 1, 3, False), (1, None, 3, 4, False), (1, "c", 4, None, True),
        (None, "n", 1, 31, False), (None, "m", 31, None, True),
    ]
    assert versions_of(load(spark, None, [])) == []


def test_versions_by_event_time_shuffle_once(spark):
    plan = load(spark, None, [(1, "a", 1, "I")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
