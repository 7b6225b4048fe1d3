"""Shuffles of the transactions: shared by a plan's uses, narrow for the event lookup, spread for the quarantine."""

import re

from conftest import SF_SMALL

import __spark_entry__ as entry
from stratum.operators.dedupe import spread_distinct
from stratum.plans import silver
from stratum.plans.damaged_queries import DamagedModel
from stratum.plans.driver_model import TS, Model

Q = entry.queries()


def physical(spark, name: str) -> str:
    """The plan without broadcasts, as large tables have it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q[name](spark, SF_SMALL)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_share_the_transactions_exchange(spark):
    for name in ("monthly_consumption", "client_refunds", "layer_counts"):
        plan = physical(spark, name)
        dealt = re.findall(r"[\]+:\- |]*(ReusedExchange|Exchange hashpartitioning\(id_transacao)", plan)
        assert "Exchange hashpartitioning(id_transacao" in dealt and "ReusedExchange" in dealt, name
        # lineitem is read for the transactions once and for the refunds once, though there are two facts
        assert len(re.findall(r"FileScan parquet \[l_orderkey[^\]]*l_suppkey", plan)) == 1, name


def test_event_parents_are_the_transactions(spark):
    keys = ["id_transacao", "id_cartao", "id_conta"]
    for model in (Model(spark, SF_SMALL), DamagedModel(spark, SF_SMALL)):
        whole = model.transactions()[0].select(*keys)
        narrow = silver.transaction_parents(model.bronze("transacoes"), model.cards()[0], TS)
        assert narrow.columns == keys
        assert sorted(narrow.collect()) == sorted(whole.collect())


def test_event_parents_take_the_latest_row(spark):
    columns = "id_transacao string, id_cartao string, data_transacao string, valor string, data_ingestao string"
    rows = [
        ("t1", "k1", "2026-01-01", "9", "2026-01-05"),
        ("t1", "k2", "2026-01-02", "1", "2026-01-05"),
        ("t1", "k1", "2026-01-03", "0", "2026-01-05"),  # newest, rejected for its value
        ("t1", "none", "2026-01-04", "5", "2026-01-05"),  # newest, rejected for its card
        ("t2", "k1", "2026-01-01", "5", "2026-01-06"),  # the later ingestion wins over the larger card
        ("t2", "k2", "2026-01-01", "7", "2026-01-05"),
        ("t3", "k1", "2026-01-01", "5", None),
        ("t3", "k2", "2026-01-01", "7", None),
        (None, "k1", "2026-01-01", "7", None),
    ]
    bronze = spark.createDataFrame(rows, columns).selectExpr(
        "*", "'E' AS estabelecimento", "'c' AS canal", "'br' AS pais", "'brl' AS moeda", "'1' AS mcc"
    )
    cards = spark.createDataFrame([("k1", "a1"), ("k2", "a2")], "id_cartao string, id_conta string")
    found = sorted(map(tuple, silver.transaction_parents(bronze, cards, TS).collect()))
    assert found == [("t1", "k2", "a2"), ("t2", "k1", "a1"), ("t3", "k2", "a2")]
    whole = silver.silver_transactions(bronze, cards, TS)[0].select("id_transacao", "id_cartao", "id_conta")
    assert found == sorted(map(tuple, whole.collect()))


def test_client_comes_with_the_card(spark):
    cards = spark.createDataFrame([("k1", "a1"), ("k2", "none"), ("k3", None)], "id_cartao string, id_conta string")
    accounts = spark.createDataFrame([("a1", "c1")], "id_conta string, id_cliente string")
    found = sorted(map(tuple, silver.cards_with_client(cards, accounts).select("id_cartao", "id_conta", "id_cliente").collect()))
    assert found == [("k1", "a1", "c1"), ("k2", "none", None), ("k3", None, None)]


def test_quarantine_spreads_an_unknown_card(spark):
    """The rows of one unknown card go to many partitions before they are compared."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bronze = spark.range(2000).selectExpr(
            "CAST(id DIV 2 AS string) AS id_transacao", "'-7' AS id_cartao", "'2026-01-01' AS data_transacao", "'5' AS valor",
            "'E' AS estabelecimento", "'c' AS canal", "'br' AS pais", "'brl' AS moeda", "'1' AS mcc",
        )
        cards = spark.createDataFrame([("k1", "a1")], "id_cartao string, id_conta string")
        quarantine = silver.silver_transactions(bronze, cards, TS)[1]
        sizes = quarantine.groupBy(quarantine["id_transacao"]).count()
        assert sizes.count() == 1000 and sizes.agg({"count": "max"}).first()[0] == 1
        assert quarantine.selectExpr("spark_partition_id() AS p").distinct().count() == 8
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_spread_distinct_is_distinct(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (None, "x"), (None, "x"), (1, "x")], "a int, b string")
    assert sorted(map(str, spread_distinct(rows).collect())) == sorted(map(str, rows.distinct().collect()))
    assert spread_distinct(rows).columns == ["a", "b"]
