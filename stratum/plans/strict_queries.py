"""Queries of the documented-but-uncoded rules (strict pack), with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import checks, consistency, metrics
from stratum.operators.checks import union_results
from stratum.operators.quality import rejected_fields, with_rejection_record
from stratum.plans import driver_oracle as O
from stratum.plans import gold
from stratum.plans.driver_model import RUN_TS, RUN_TS_SQL, TS, Model, table
from stratum.plans.registry import SUM, avg_money, register


@register(
    "account_client_fk",
    O.with_ctes(["clientes", "contas"], "SELECT * FROM silver_contas WHERE id_cliente IS NOT NULL AND id_cliente NOT IN (SELECT id_cliente FROM silver_clientes WHERE id_cliente IS NOT NULL)"),
)
def q_account_client_fk(spark, sf):
    m = Model(spark, sf)
    return consistency.missing_parent(m.accounts()[0], "id_cliente", m.clients()[0], "id_cliente")


@register(
    "card_account_fk",
    O.with_ctes(["contas", "cartoes"], "SELECT * FROM silver_cartoes WHERE id_conta IS NOT NULL AND id_conta NOT IN (SELECT id_conta FROM silver_contas WHERE id_conta IS NOT NULL)"),
)
def q_card_account_fk(spark, sf):
    m = Model(spark, sf)
    return consistency.missing_parent(m.cards()[0], "id_conta", m.accounts()[0], "id_conta")


@register(
    "refund_timing",
    O.with_ctes(
        ["transacoes", "estornos"],
        """SELECT * FROM (
  SELECT r.id_estorno, r.id_transacao, r.data_estorno, t.data_transacao,
    CASE WHEN t.id_transacao IS NULL THEN 'TRANSACAO_INEXISTENTE'
         WHEN r.data_estorno < t.data_transacao THEN 'ESTORNO_ANTES_DA_TRANSACAO' END AS violacao
  FROM silver_estornos r LEFT JOIN silver_transacoes t ON r.id_transacao = t.id_transacao) WHERE violacao IS NOT NULL""",
    ),
)
def q_refund_timing(spark, sf):
    m = Model(spark, sf)
    return consistency.refund_timing(m.refunds()[0], m.transactions()[0])


@register(
    "refunded_above_value",
    O.with_ctes(
        ["transacoes", "estornos"],
        f"""SELECT p.id_transacao, CAST(t.valor AS {SUM}) AS valor, p.valor_estornado, p.quantidade_estornos, 'ESTORNO_ACIMA_DO_VALOR' AS violacao
FROM (SELECT id_transacao, CAST(sum(valor_estorno) AS {SUM}) AS valor_estornado, count(*) AS quantidade_estornos FROM silver_estornos GROUP BY id_transacao) p
JOIN silver_transacoes t ON p.id_transacao = t.id_transacao WHERE p.valor_estornado > CAST(t.valor AS {SUM})""",
    ),
)
def q_refunded_above_value(spark, sf):
    m = Model(spark, sf)
    return consistency.refunded_above_value(m.refunds()[0], m.transactions()[0])


@register(
    "daily_transaction_summary",
    O.with_ctes(
        ["fato_transacoes"],
        f"""SELECT id_data, CAST(data_transacao AS DATE) AS data, count(id_transacao) AS quantidade_transacoes,
  count(DISTINCT id_cliente) AS quantidade_clientes, CAST(sum(valor) AS {SUM}) AS valor_total, {avg_money('valor')} AS valor_medio
FROM fato_transacoes GROUP BY id_data, CAST(data_transacao AS DATE)""",
    ),
)
def q_daily_summary(spark, sf):
    return gold.daily_transaction_summary(Model(spark, sf, with_client=True).fact_transactions())


@register(
    "account_movement_summary",
    O.with_ctes(
        ["fato_transacoes"],
        f"""SELECT id_conta, id_cliente, count(id_transacao) AS quantidade_transacoes, CAST(sum(valor) AS {SUM}) AS valor_total,
  min(data_transacao) AS primeira_movimentacao, max(data_transacao) AS ultima_movimentacao
FROM fato_transacoes GROUP BY id_conta, id_cliente""",
    ),
)
def q_account_summary(spark, sf):
    return gold.account_movement_summary(Model(spark, sf, with_client=True).fact_transactions())


_METRIC_SOURCES = [("clientes", "tag_clientes", False), ("transacoes", "tag_transacoes", True), ("eventos_risco", "tag_eventos", True), ("estornos", "tag_estornos", False)]


def _metrics_sql(source: str, tagged: str, first_match: bool) -> str:
    flagged = "motivo_quarentena IS NOT NULL" if first_match else "length(trim(coalesce(motivo_quarentena, ''))) > 0"
    return (
        f"SELECT '{source}' AS fonte, count(*) AS quantidade_entrada, count_if({flagged}) AS quantidade_invalidos, "
        f"{RUN_TS_SQL} AS data_processamento FROM {tagged}"
    )


@register(
    "pipeline_alerts",
    O.with_ctes(
        [s for s, _, _ in _METRIC_SOURCES],
        "SELECT fonte, CASE WHEN quantidade_entrada = 0 THEN 'CARGA_VAZIA' WHEN quantidade_invalidos / quantidade_entrada > 0.05 "
        "THEN 'ALTA_TAXA_REJEICAO' END AS alerta, quantidade_entrada, quantidade_invalidos, data_processamento FROM ("
        + " UNION ALL ".join(_metrics_sql(*x) for x in _METRIC_SOURCES)
        + ") WHERE quantidade_entrada = 0 OR quantidade_invalidos / quantidade_entrada > 0.05",
    ),
)
def q_pipeline_alerts(spark, sf):
    from stratum.plans.operator_queries import tagged

    m = Model(spark, sf)
    frames = [metrics.quality_metrics(s, tagged(m, s), RUN_TS, ts_type=TS) for s, _, _ in _METRIC_SOURCES]
    return consistency.reject_rate_alerts(union_results(frames))


_RECORD_SQL = f"""SELECT motivo_quarentena AS motivo, 'regras_estornos' AS regra, {RUN_TS_SQL} AS data_rejeicao, CAST(NULL AS VARCHAR) AS arquivo"""

# Spark's JSON of a row: fields in order, without those that are NULL
_RECORD_JSON = """'{' || concat_ws(',', '"id_estorno":"' || id_estorno || '"', '"id_transacao":"' || id_transacao || '"',
  '"data_estorno":"' || strftime(data_estorno, '%Y-%m-%dT%H:%M:%S.%g') || '"', '"motivo":"' || motivo || '"',
  '"valor_estorno":' || CAST(valor_estorno AS VARCHAR)) || '}'"""


@register(
    "rejection_records",
    O.with_ctes(["estornos"], f"{_RECORD_SQL}, {_RECORD_JSON} AS registro_original FROM quarantine_estornos"),
)
def q_rejection_records(spark, sf):
    """Rejected refunds as rejection records (reason, rule set, date, file, payload as JSON)."""
    quarantine = Model(spark, sf).refunds()[1]
    return with_rejection_record(quarantine, "regras_estornos", RUN_TS).withColumn("data_rejeicao", F.col("data_rejeicao").cast(TS))


@register(
    "rejection_payload",
    O.with_ctes(["estornos"], f"{_RECORD_SQL}, id_estorno, id_transacao, data_estorno, valor_estorno FROM quarantine_estornos"),
)
def q_rejection_payload(spark, sf):
    """The original fields of rejected refunds, read back from the JSON payload."""
    types = {"id_estorno": "string", "id_transacao": "string", "data_estorno": TS, "valor_estorno": "decimal(18,2)"}
    return rejected_fields(q_rejection_records(spark, sf), types)


# Loads are a type's events of an hour, of which those worth 50 or more count and
# those worth 90 or more are rejected; runs are single events, whose value is
# their minutes.
_MONITORING_SQL = f"""WITH m AS (
  SELECT event_type AS fonte, date_trunc('hour', ts) AS momento, count_if(value >= 50) AS entrada, count_if(value >= 90) AS invalidos
  FROM events GROUP BY ALL),
w AS (SELECT *, list(entrada::DOUBLE) OVER (PARTITION BY fonte ORDER BY epoch(momento)::BIGINT RANGE BETWEEN 2419200 PRECEDING AND 1 PRECEDING) AS antes FROM m),
r AS (SELECT *, list_aggregate(antes, 'median') AS referencia FROM w),
b AS (SELECT *, list_aggregate(list_transform(antes, lambda x: abs(x - referencia)), 'median') AS desvio FROM r)
SELECT 'CARGA_VAZIA' AS alerta, fonte AS objeto, momento, entrada::DOUBLE AS valor, CAST(NULL AS DOUBLE) AS referencia FROM b WHERE entrada = 0
UNION ALL SELECT 'ALTA_TAXA_REJEICAO', fonte, momento, invalidos / entrada, 0.05::DOUBLE FROM b WHERE entrada > 0 AND invalidos / entrada > 0.05::DOUBLE
UNION ALL SELECT 'VOLUME_ANORMAL', fonte, momento, entrada::DOUBLE, referencia FROM b
  WHERE len(antes) >= 5 AND abs(entrada - referencia) > greatest(3::DOUBLE * desvio, 0.1::DOUBLE * referencia)
UNION ALL SELECT 'FALHA_EXECUCAO', event_type, ts, NULL, NULL FROM events WHERE event_type = 'error'
UNION ALL SELECT 'TEMPO_EXCEDIDO', event_type, ts, value * 60, 3600::DOUBLE FROM events WHERE value * 60 > 3600
UNION ALL SELECT 'INTEGRIDADE_QUEBRADA', 'Integridade: clientes.c_custkey', {RUN_TS_SQL}, NULL, NULL
  WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL))"""


@register("monitoring_alerts", _MONITORING_SQL)
def q_monitoring_alerts(spark, sf):
    """All kinds of alerts, from a history of loads, of runs and a referential check."""
    events = table(spark, sf, "events")
    loads = events.groupBy(F.col("event_type").alias("fonte"), F.date_trunc("hour", "ts").cast(TS).alias("data_processamento")).agg(
        F.count_if(F.col("value") >= 50).alias("quantidade_entrada"), F.count_if(F.col("value") >= 90).alias("quantidade_invalidos")
    )
    runs = events.select(
        F.col("event_type").alias("notebook"),
        F.when(F.col("event_type") == "error", "ERRO").otherwise("SUCESSO").alias("status"),
        F.col("ts").cast(TS).alias("inicio"),
        (F.col("value") * 60).alias("duracao_segundos"),
    )
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    gate = checks.check_foreign_key(customers, "clientes", "c_custkey", orders, "o_custkey", RUN_TS, TS)
    return consistency.monitoring_alerts(loads, runs, gate, deviations=3.0)
