"""Registered queries over the driver tables, and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Every query reads whole tables (no samples, no id subsets) and goes through the
same library functions a pipeline run uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.plans import driver_oracle as O
from stratum.plans import gold
from stratum.plans.driver_model import Model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def avg_money(x: str) -> str:
    """Exact HALF_UP average of a 2-decimal money column as DECIMAL(22,6) (Spark ``avg``)."""
    s = f"CAST(sum({x}) * 100 AS HUGEINT)"
    n = f"count({x})"
    micro = f"((abs({s}) * 20000 + {n}) // (2 * {n}))"
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(CAST(CASE WHEN {s} < 0 THEN -{micro} ELSE {micro} END AS DECIMAL(38,0)) "
        f"* CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(22,6)) END"
    )


def pct(num: str, den: str, unscale: int = 1) -> str:
    """Exact HALF_UP ``round(num / den * 100, 2)`` as DOUBLE (``half_up_percent``)."""
    n = f"CAST({num} * {unscale} AS HUGEINT)"
    d = f"CAST({den} * {unscale} AS HUGEINT)"
    h = f"((abs({n}) * 20000 + abs({d})) // (2 * abs({d})))"
    return f"CAST(CASE WHEN {n} < 0 THEN -{h} ELSE {h} END AS DOUBLE) / 100"


SUM = "DECIMAL(38,2)"

# ---------------------------------------------------------------------------
# Silver entities and quarantines
# ---------------------------------------------------------------------------

_SILVER_KEYS = {
    "silver_clients": ("clientes", "silver_clientes", lambda m: m.clients()[0]),
    "silver_accounts": ("contas", "silver_contas", lambda m: m.accounts()[0]),
    "silver_cards": ("cartoes", "silver_cartoes", lambda m: m.cards()[0]),
    "silver_transactions": ("transacoes", "silver_transacoes", lambda m: m.transactions()[0]),
    "silver_events": ("eventos_risco", "silver_eventos", lambda m: m.risk_events()[0]),
    "silver_refunds": ("estornos", "silver_estornos", lambda m: m.refunds()[0]),
    "quarantine_clients": ("clientes", "quarantine_clientes", lambda m: m.clients()[1]),
    "quarantine_transactions": ("transacoes", "quarantine_transacoes", lambda m: m.transactions()[1]),
    "quarantine_events": ("eventos_risco", "quarantine_eventos", lambda m: m.risk_events()[1]),
    "quarantine_refunds": ("estornos", "quarantine_estornos", lambda m: m.refunds()[1]),
}

for _name, (_entity, _cte, _fn) in _SILVER_KEYS.items():
    register(_name, O.with_ctes([_entity], f"SELECT * FROM {_cte}"))(lambda spark, sf, _fn=_fn: _fn(Model(spark, sf)))

# ---------------------------------------------------------------------------
# Gold dimensions and facts
# ---------------------------------------------------------------------------


@register("dim_customer", O.with_ctes(["dim_clientes"], "SELECT * FROM dim_clientes"))
def q_dim_customer(spark, sf):
    return Model(spark, sf).dim_clients()


@register("dim_account", O.with_ctes(["dim_contas"], "SELECT * FROM dim_contas"))
def q_dim_account(spark, sf):
    return Model(spark, sf).dim_accounts()


@register("dim_card", O.with_ctes(["dim_cartoes"], "SELECT * FROM dim_cartoes"))
def q_dim_card(spark, sf):
    return Model(spark, sf).dim_cards()


@register("fact_transactions", O.with_ctes(["fato_transacoes"], "SELECT * FROM fato_transacoes"))
def q_fact_transactions(spark, sf):
    return Model(spark, sf, with_client=True).fact_transactions()


@register("fact_refunds", O.with_ctes(["fato_estornos"], "SELECT * FROM fato_estornos"))
def q_fact_refunds(spark, sf):
    return Model(spark, sf).fact_refunds()


@register("fact_risk", O.with_ctes(["fato_eventos_risco"], "SELECT * FROM fato_eventos_risco"))
def q_fact_risk(spark, sf):
    return Model(spark, sf).fact_risk()


_DIM_DATE_SQL = O.with_ctes(
    ["transacoes", "estornos", "eventos_risco"],
    """, dates AS (
  SELECT CAST(data_transacao AS DATE) AS d FROM silver_transacoes
  UNION ALL SELECT CAST(data_estorno AS DATE) FROM silver_estornos
  UNION ALL SELECT CAST(data_evento AS DATE) FROM silver_eventos),
bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM dates WHERE d IS NOT NULL),
days AS (SELECT CAST(g.ts AS DATE) AS data FROM bounds,
  generate_series(CAST(coalesce(lo, DATE '2025-01-01') AS TIMESTAMP), CAST(coalesce(hi, DATE '2026-12-31') AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts))
SELECT """
    + O.date_key("data")
    + """ AS id_data, data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
  strftime(data, '%B') AS nome_mes, CAST(quarter(data) AS INTEGER) AS trimestre, CAST(day(data) AS INTEGER) AS dia,
  strftime(data, '%A') AS dia_semana, CAST(dayofweek(data) + 1 AS INTEGER) AS numero_dia_semana,
  dayofweek(data) IN (0, 6) AS fim_de_semana
FROM days""",
).replace("\n, dates AS", ",\ndates AS")


@register("dim_date", _DIM_DATE_SQL)
def q_dim_date(spark, sf):
    m = Model(spark, sf)
    dates = gold.fact_dates(
        (m.transactions()[0], "data_transacao"),
        (m.refunds()[0], "data_estorno"),
        (m.risk_events()[0], "data_evento"),
    )
    return gold.dim_date(dates)


# ---------------------------------------------------------------------------
# Gold analytics
# ---------------------------------------------------------------------------

_CONSUMPTION_SQL = O.with_ctes(
    ["dim_clientes", "fato_transacoes", "dim_contas", "dim_cartoes"],
    f""", tx AS (
  SELECT id_cliente, count(id_transacao) AS quantidade_transacoes, CAST(sum(valor) AS {SUM}) AS valor_total_movimentado,
    {avg_money('valor')} AS valor_medio_transacao, max(valor) AS maior_transacao, min(valor) AS menor_transacao,
    min(data_transacao) AS data_primeira_transacao, max(data_transacao) AS data_ultima_transacao
  FROM fato_transacoes GROUP BY id_cliente),
acc AS (SELECT id_cliente, count(id_conta) AS quantidade_contas FROM dim_contas GROUP BY id_cliente),
crd AS (SELECT a.id_cliente, count(c.id_cartao) AS quantidade_cartoes
  FROM dim_cartoes c LEFT JOIN dim_contas a ON c.id_conta = a.id_conta GROUP BY a.id_cliente)
SELECT c.id_cliente, c.nome, c.cidade, c.estado, c.renda,
  CAST(coalesce(tx.quantidade_transacoes, 0) AS BIGINT) AS quantidade_transacoes,
  CAST(coalesce(tx.valor_total_movimentado, 0) AS {SUM}) AS valor_total_movimentado,
  CAST(coalesce(tx.valor_medio_transacao, 0) AS DECIMAL(22,6)) AS valor_medio_transacao,
  tx.maior_transacao, tx.menor_transacao,
  CAST(coalesce(acc.quantidade_contas, 0) AS BIGINT) AS quantidade_contas,
  CAST(coalesce(crd.quantidade_cartoes, 0) AS BIGINT) AS quantidade_cartoes,
  tx.data_primeira_transacao, tx.data_ultima_transacao
FROM dim_clientes c LEFT JOIN tx ON c.id_cliente = tx.id_cliente
  LEFT JOIN acc ON c.id_cliente = acc.id_cliente LEFT JOIN crd ON c.id_cliente = crd.id_cliente""",
).replace("\n, tx AS", ",\ntx AS")


@register("client_consumption", _CONSUMPTION_SQL)
def q_client_consumption(spark, sf):
    m = Model(spark, sf, with_client=True)
    return gold.client_consumption(m.dim_clients(), m.fact_transactions(), m.dim_accounts(), m.dim_cards())


_SHARE_SQL = O.with_ctes(
    ["fato_transacoes"],
    f""", per_type AS (
  SELECT id_cliente, tipo_transacao, count(id_transacao) AS quantidade_transacoes, CAST(sum(valor) AS {SUM}) AS valor_total,
    {avg_money('valor')} AS valor_medio
  FROM fato_transacoes GROUP BY id_cliente, tipo_transacao),
with_total AS (SELECT *, sum(valor_total) OVER (PARTITION BY id_cliente) AS valor_total_cliente FROM per_type)
SELECT id_cliente, tipo_transacao, quantidade_transacoes, valor_total, valor_medio,
  CASE WHEN valor_total_cliente > 0 THEN {pct('valor_total', 'valor_total_cliente', 100)} ELSE 0.0 END AS percentual_consumo_cliente
FROM with_total""",
).replace("\n, per_type AS", ",\nper_type AS")


@register("consumption_share", _SHARE_SQL)
def q_consumption_share(spark, sf):
    return gold.consumption_share(Model(spark, sf, with_client=True).fact_transactions())


_RISK_SQL = O.with_ctes(
    ["dim_clientes", "fato_eventos_risco"],
    """, per AS (
  SELECT id_cliente, count(id_evento) AS q, count_if(severidade = 'CRITICA') AS c, count_if(severidade = 'ALTA') AS a,
    count_if(severidade = 'MEDIA') AS m, count_if(severidade = 'BAIXA') AS b, max(data_evento) AS last_event
  FROM fato_eventos_risco WHERE id_cliente IS NOT NULL GROUP BY id_cliente)
SELECT d.id_cliente, d.nome, CAST(coalesce(q, 0) AS BIGINT) AS quantidade_eventos_risco,
  CAST(coalesce(c, 0) AS BIGINT) AS quantidade_risco_critico, CAST(coalesce(a, 0) AS BIGINT) AS quantidade_risco_alto,
  CAST(coalesce(m, 0) AS BIGINT) AS quantidade_risco_medio, CAST(coalesce(b, 0) AS BIGINT) AS quantidade_risco_baixo,
  last_event AS data_ultimo_evento_risco,
  CASE WHEN coalesce(c, 0) > 0 THEN 'CRITICO' WHEN coalesce(a, 0) > 0 THEN 'ALTO' WHEN coalesce(m, 0) > 0 THEN 'MEDIO'
       WHEN coalesce(b, 0) > 0 THEN 'BAIXO' ELSE 'SEM_EVENTOS' END AS classificacao_risco_cliente
FROM dim_clientes d LEFT JOIN per ON d.id_cliente = per.id_cliente""",
).replace("\n, per AS", ",\nper AS")


@register("client_risk", _RISK_SQL)
def q_client_risk(spark, sf):
    m = Model(spark, sf)
    return gold.client_risk(m.dim_clients(), m.fact_risk())


_REFUNDS_SQL = O.with_ctes(
    ["dim_clientes", "fato_transacoes", "fato_estornos"],
    f""", tx AS (SELECT id_cliente, count(id_transacao) AS n FROM fato_transacoes GROUP BY id_cliente),
rf AS (SELECT id_cliente, count(id_estorno) AS r, CAST(sum(valor_estorno) AS {SUM}) AS total,
    {avg_money('valor_estorno')} AS media, max(data_estorno) AS last_refund
  FROM fato_estornos GROUP BY id_cliente),
j AS (SELECT d.id_cliente, d.nome, CAST(coalesce(tx.n, 0) AS BIGINT) AS quantidade_total_transacoes,
    CAST(coalesce(rf.r, 0) AS BIGINT) AS quantidade_estornos, rf.total, rf.media, rf.last_refund
  FROM dim_clientes d LEFT JOIN tx ON d.id_cliente = tx.id_cliente LEFT JOIN rf ON d.id_cliente = rf.id_cliente)
SELECT id_cliente, nome, quantidade_total_transacoes, quantidade_estornos,
  CAST(coalesce(total, 0) AS {SUM}) AS valor_total_estornado, CAST(coalesce(media, 0) AS DECIMAL(22,6)) AS valor_medio_estorno,
  CASE WHEN quantidade_total_transacoes > 0 THEN {pct('quantidade_estornos', 'quantidade_total_transacoes')} ELSE 0.0 END
    AS percentual_transacoes_estornadas,
  last_refund AS data_ultimo_estorno
FROM j""",
).replace("\n, tx AS", ",\ntx AS")


@register("client_refunds", _REFUNDS_SQL)
def q_client_refunds(spark, sf):
    m = Model(spark, sf, with_client=True)
    return gold.client_refunds(m.dim_clients(), m.fact_transactions(), m.fact_refunds())


_MONTHLY_SQL = O.with_ctes(
    ["fato_transacoes", "fato_estornos"],
    f""", tx AS (
  SELECT id_cliente, CAST(year(data_transacao) AS INTEGER) AS ano, CAST(month(data_transacao) AS INTEGER) AS mes,
    count(id_transacao) AS quantidade_transacoes, CAST(sum(valor) AS {SUM}) AS valor_total, {avg_money('valor')} AS valor_medio
  FROM fato_transacoes GROUP BY ALL),
rf AS (
  SELECT id_cliente, CAST(year(data_estorno) AS INTEGER) AS ano, CAST(month(data_estorno) AS INTEGER) AS mes,
    count(id_estorno) AS quantidade_estornos, CAST(sum(valor_estorno) AS {SUM}) AS valor_estornado
  FROM fato_estornos GROUP BY ALL)
SELECT tx.id_cliente, tx.ano, tx.mes, tx.quantidade_transacoes, tx.valor_total, tx.valor_medio,
  CAST(coalesce(rf.quantidade_estornos, 0) AS BIGINT) AS quantidade_estornos,
  CAST(coalesce(rf.valor_estornado, 0) AS {SUM}) AS valor_estornado
FROM tx LEFT JOIN rf ON tx.id_cliente = rf.id_cliente AND tx.ano = rf.ano AND tx.mes = rf.mes""",
).replace("\n, tx AS", ",\ntx AS")


@register("monthly_consumption", _MONTHLY_SQL)
def q_monthly_consumption(spark, sf):
    m = Model(spark, sf, with_client=True)
    return gold.monthly_consumption(m.fact_transactions(), m.fact_refunds())
