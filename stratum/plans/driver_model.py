"""The data model on the driver's TPC-H-like tables.

Analogy (pure projections; every row of every table is used):

* client      = ``customer``  (id ``c_custkey``)
* account     = ``orders``    (id ``o_orderkey``, owner ``o_custkey``)
* card        = ``orders``    (one card per account, same id)
* transaction = ``lineitem``  (id ``"<l_orderkey>-<l_linenumber>"``, card ``l_orderkey``;
  the id is *not* unique in the data, which is what deduplication is for)
* refund      = ``lineitem`` rows with ``l_returnflag = 'R'`` (value = price x discount)
* risk event  = ``events``    (transaction ``"<event_id>-1"``, severity from ``event_type``)

The adapters emit Bronze-shaped frames (every value as text, like raw CSV),
so the silver parsers, rules and lookups run exactly as on raw files.  The
``*_sql`` twins are the same projections in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans import gold, silver

# Fixed run parameters of the registered queries (deterministic results).
RUN_TS = datetime(2026, 1, 1, 0, 0, 0)
RUN_TS_SQL = "TIMESTAMP '2026-01-01 00:00:00'"
TS = "timestamp_ntz"

# Severity given to each event type ("info" is outside the allowed domain).
EVENT_SEVERITY = (("error", "critica"), ("purchase", "alta"), ("signup", "media"), ("click", "baixa"), ("view", "info"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _renda_text() -> Column:
    """Income as text in a format chosen by market segment (exercises every parser branch)."""
    plain = _s("c_acctbal")
    return (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.translate(F.format_number("c_acctbal", 2), ",.", ".,"))
        .when(F.col("c_mktsegment") == "BUILDING", F.replace(plain, F.lit("."), F.lit(",")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.format_number("c_acctbal", 2))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit(" "), plain, F.lit(" ")))
        .otherwise(plain)
    )


def bronze_clients(customer: DataFrame) -> DataFrame:
    p = F.lpad(_s("c_custkey"), 11, "0")
    return customer.select(
        _s("c_custkey").alias("id_cliente"),
        F.concat(F.substring(p, 1, 3), F.lit("."), F.substring(p, 4, 3), F.lit("."), F.substring(p, 7, 3), F.lit("-"), F.substring(p, 10, 2)).alias("cpf"),
        F.col("c_name").alias("nome"),
        F.lower("c_mktsegment").alias("cidade"),
        _s("c_nationkey").alias("estado"),
        _renda_text().alias("renda"),
        F.lit(None).cast("string").alias("data_atualizacao"),
    )


def bronze_accounts(orders: DataFrame) -> DataFrame:
    return orders.select(
        _s("o_orderkey").alias("id_conta"),
        _s("o_custkey").alias("id_cliente"),
        F.lower("o_orderpriority").alias("tipo_conta"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("status_conta"),
        _s("o_orderdate").alias("data_atualizacao"),
    )


def bronze_cards(orders: DataFrame) -> DataFrame:
    return orders.select(
        _s("o_orderkey").alias("id_cartao"),
        _s("o_orderkey").alias("id_conta"),
        F.col("o_orderpriority").alias("tipo_cartao"),
        _s("o_totalprice").alias("limite"),
        F.col("o_orderstatus").alias("status_cartao"),
        _s("o_orderdate").alias("data_atualizacao"),
    )


def _line_id(prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), _s("l_orderkey"), F.lit("-"), _s("l_linenumber"))


def bronze_transactions(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _line_id().alias("id_transacao"),
        _s("l_orderkey").alias("id_cartao"),
        _s("l_shipdate").alias("data_transacao"),
        _s("l_extendedprice").alias("valor"),
        _s("l_partkey").alias("mcc"),
        F.concat(F.lit("S"), _s("l_suppkey")).alias("estabelecimento"),
        F.lower("l_linestatus").alias("canal"),
        F.lit("br").alias("pais"),
        F.lit("brl").alias("moeda"),
        F.col("l_returnflag").alias("tipo_transacao"),
    )


def bronze_refunds(lineitem: DataFrame) -> DataFrame:
    value = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)")
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        _line_id("E").alias("id_estorno"),
        _line_id().alias("id_transacao"),
        _s("l_shipdate").alias("data_estorno"),
        F.lit("DEVOLUCAO").alias("motivo"),
        value.cast("string").alias("valor_estorno"),
    )


def bronze_risk_events(events: DataFrame) -> DataFrame:
    sev = None
    for etype, level in EVENT_SEVERITY:
        cond = F.col("event_type") == etype
        sev = F.when(cond, F.lit(level)) if sev is None else sev.when(cond, F.lit(level))
    return events.select(
        _s("event_id").alias("id_evento"),
        F.concat(_s("event_id"), F.lit("-1")).alias("id_transacao"),
        F.col("event_type").alias("tipo_evento"),
        sev.alias("severidade"),
        _s("ts").alias("data_evento"),
    )


# ---------------------------------------------------------------------------
# Composed layers (plans only; no data is cached)
# ---------------------------------------------------------------------------


class Model:
    """Lazily composed silver and gold frames over one scale-factor folder.

    ``with_client``: the transactions get the client of their account in the
    card lookup, for the facts; silver's own columns stay.  For queries that
    use ``fact_transactions``: all their layers then share the transactions'
    shuffles.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, with_client: bool = False):
        self.with_client = with_client
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._layers: dict[str, object] = {}

    def t(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # bronze
    def bronze(self, entity: str) -> DataFrame:
        src = {
            "clientes": (bronze_clients, "customer"),
            "contas": (bronze_accounts, "orders"),
            "cartoes": (bronze_cards, "orders"),
            "transacoes": (bronze_transactions, "lineitem"),
            "estornos": (bronze_refunds, "lineitem"),
            "eventos_risco": (bronze_risk_events, "events"),
        }[entity]
        return src[0](self.t(src[1]))

    def _memo(self, key: str, build):
        """Build each layer once per model, so a query that needs it twice (e.g.
        cards for the transaction lookup and for the card dimension) carries one
        subtree, and Spark reuses its exchange instead of computing it twice."""
        if key not in self._layers:
            self._layers[key] = build()
        return self._layers[key]

    # silver: (valid latest per key, quarantine)
    def clients(self):
        return self._memo("clients", lambda: silver.silver_clients(self.bronze("clientes"), RUN_TS, TS))

    def accounts(self):
        return self._memo("accounts", lambda: silver.silver_accounts(self.bronze("contas"), RUN_TS, TS))

    def cards(self):
        return self._memo("cards", lambda: silver.silver_cards(self.bronze("cartoes"), RUN_TS, TS))

    def client_transactions(self):
        """``transactions`` with the ``id_cliente`` of their account."""

        def build():
            cards = silver.cards_with_client(self.cards()[0], self.accounts()[0])
            return silver.silver_transactions(self.bronze("transacoes"), cards, TS, passthrough=("tipo_transacao",), carry=("id_cliente",))

        return self._memo("client_transactions", build)

    def transactions(self):
        if self.with_client:
            return tuple(df.drop("id_cliente") for df in self.client_transactions())
        return self._memo(
            "transactions",
            lambda: silver.silver_transactions(self.bronze("transacoes"), self.cards()[0], TS, passthrough=("tipo_transacao",)),
        )

    def transaction_parents(self):
        """What risk events look up: of the transactions, where the query holds them anyway, else from narrow rows."""
        if self.with_client or "transactions" in self._layers:
            return self.transactions()[0]
        return self._memo("transaction_parents", lambda: silver.transaction_parents(self.bronze("transacoes"), self.cards()[0], TS))

    def risk_events(self):
        return self._memo("risk_events", lambda: silver.silver_risk_events(self.bronze("eventos_risco"), self.transaction_parents(), TS))

    def refunds(self):
        return self._memo("refunds", lambda: silver.silver_refunds(self.bronze("estornos"), TS))

    # gold
    def dim_clients(self):
        return self._memo("dim_clients", lambda: gold.dim_clients(self.clients()[0], unique=True))

    def dim_accounts(self):
        return self._memo("dim_accounts", lambda: gold.dim_accounts(self.accounts()[0], unique=True))

    def dim_cards(self):
        return self._memo("dim_cards", lambda: gold.dim_cards(self.cards()[0], unique=True))

    def fact_transactions(self):
        return self._memo("fact_transactions", lambda: gold.fact_transactions(self.client_transactions()[0]))

    def fact_refunds(self):
        if self.with_client:
            return self._memo("fact_refunds", lambda: gold.fact_refunds(self.refunds()[0], self.fact_transactions()))
        return self._memo("fact_refunds", lambda: gold.fact_refunds(self.refunds()[0], self.transactions()[0], dim_contas=self.dim_accounts()))

    def fact_risk(self):
        return self._memo("fact_risk", lambda: gold.fact_risk_events(self.risk_events()[0], dim_contas=self.dim_accounts()))
