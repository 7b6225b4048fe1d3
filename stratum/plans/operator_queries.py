"""Single-operator queries over the driver tables, each with its DuckDB oracle.

Each query exercises one operator family of the library on whole tables.
Registered on import into ``stratum.plans.registry``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratum.functions import columns as C
from stratum.functions import rules as R
from stratum.operators import checks, dedupe, ledger, metrics, quality, upsert
from stratum.plans import driver_oracle as O
from stratum.plans import gold, silver
from stratum.plans.driver_model import RUN_TS, RUN_TS_SQL, TS, Model, bronze_clients, table
from stratum.plans.registry import SUM, avg_money, pct, register  # noqa: F401
from stratum.sources.raw import add_lineage

T1 = datetime(2026, 1, 1)
T2 = datetime(2026, 2, 1)
T1_SQL = "TIMESTAMP '2026-01-01 00:00:00'"
T2_SQL = "TIMESTAMP '2026-02-01 00:00:00'"
BATCH = "lote-0001"


def _sorted_fingerprint_sql(cols):
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '∅')" for c in sorted(cols))
    return f"sha256(concat_ws('||', {parts}))"


# ---------------------------------------------------------------------------
# Bronze: fingerprint and lineage
# ---------------------------------------------------------------------------

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("row_fingerprint", f"SELECT o_orderkey, {_sorted_fingerprint_sql(ORDERS_COLS)} AS hash_linha FROM orders")
def q_row_fingerprint(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", C.row_fingerprint(orders).alias("hash_linha"))


REGION_COLS = ["r_regionkey", "r_name"]


@register(
    "lineage_columns",
    f"""SELECT r_regionkey, r_name, 'region.parquet' AS nome_arquivo_origem, DATE '2026-01-01' AS data_ingestao,
  {RUN_TS_SQL} AS timestamp_ingestao, '{BATCH}' AS batch_id, {_sorted_fingerprint_sql(REGION_COLS)} AS hash_linha,
  'v1' AS schema_version FROM region""",
)
def q_lineage_columns(spark, sf):
    from stratum.sources.raw import with_file_metadata

    region = with_file_metadata(table(spark, sf, "region"))
    out = add_lineage(region, BATCH, "v1", RUN_TS)
    # path, size and modification time depend on the machine; compare the rest
    return out.drop("arquivo_origem", "tamanho_arquivo_origem", "data_modificacao_arquivo").withColumn(
        "timestamp_ingestao", F.col("timestamp_ingestao").cast(TS)
    )


# ---------------------------------------------------------------------------
# Column functions
# ---------------------------------------------------------------------------


@register(
    "parse_decimal",
    f"WITH {O.BRONZE['clientes']} SELECT id_cliente, renda AS renda_texto, {O.parse_decimal('renda')} AS renda FROM bronze_clientes",
)
def q_parse_decimal(spark, sf):
    b = bronze_clients(table(spark, sf, "customer"))
    return b.select("id_cliente", F.col("renda").alias("renda_texto"), C.parse_decimal("renda").alias("renda"))


@register(
    "comma_decimal",
    "SELECT c_custkey, TRY_CAST(replace(replace(CAST(c_acctbal AS VARCHAR), '.', ','), ',', '.') AS DECIMAL(18,2)) AS renda FROM customer",
)
def q_comma_decimal(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.comma_decimal(F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))).alias("renda"))


for _entity, _key, _cte in [
    ("clientes", "standardize_clients", "std_clientes"),
    ("contas", "standardize_accounts", "std_contas"),
    ("cartoes", "standardize_cards", "std_cartoes"),
    ("estornos", "standardize_refunds", "std_estornos"),
]:

    def _std(spark, sf, _entity=_entity):
        m = Model(spark, sf)
        b = m.bronze(_entity)
        fn = {
            "clientes": lambda: silver.standardize_clients(b, RUN_TS, TS),
            "contas": lambda: silver.standardize_accounts(b, RUN_TS, TS),
            "cartoes": lambda: silver.standardize_cards(b, RUN_TS, TS),
            "estornos": lambda: silver.standardize_refunds(b, TS),
        }[_entity]
        return fn()

    register(_key, O.with_ctes([_entity], f"SELECT * FROM {_cte}"))(_std)


@register("standardize_transactions", O.with_ctes(["transacoes"], "SELECT * FROM std_transacoes"))
def q_std_transactions(spark, sf):
    return silver.standardize_transactions(Model(spark, sf).bronze("transacoes"), TS, passthrough=("tipo_transacao",))


@register("standardize_events", O.with_ctes(["eventos_risco"], "SELECT * FROM std_eventos"))
def q_std_events(spark, sf):
    return silver.standardize_risk_events(Model(spark, sf).bronze("eventos_risco"), TS)


_TS_TEXT_SQL = "CASE WHEN event_type IN ('error', 'click') THEN 'sem data' ELSE CAST(ts AS VARCHAR) END"
_TS_SECOND_SQL = "CASE WHEN event_type = 'click' THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END"


def _ts_text():
    return F.when(F.col("event_type").isin("error", "click"), F.lit("sem data")).otherwise(F.col("ts").cast("string"))


def _ts_second():
    return F.when(F.col("event_type") == "click", F.lit(None).cast("string")).otherwise(F.to_date("ts").cast("string"))


@register("safe_timestamp", f"SELECT event_id, TRY_CAST({_TS_TEXT_SQL} AS TIMESTAMP) AS data_evento FROM events")
def q_safe_timestamp(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", C.safe_timestamp(_ts_text(), TS).alias("data_evento"))


@register(
    "timestamp_fallback",
    f"SELECT event_id, COALESCE(TRY_CAST({_TS_TEXT_SQL} AS TIMESTAMP), TRY_CAST({_TS_SECOND_SQL} AS TIMESTAMP), {RUN_TS_SQL}) AS data_atualizacao FROM events",
)
def q_timestamp_fallback(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", C.timestamp_fallback(_ts_text(), _ts_second(), RUN_TS, TS).alias("data_atualizacao"))


@register(
    "optional_columns",
    "SELECT n_nationkey, CAST(n_name AS VARCHAR) AS n_name, CAST(NULL AS VARCHAR) AS n_comment, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation",
)
def q_optional_columns(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", C.optional_column(n, "n_name", "string"), C.optional_column(n, "n_comment", "string"), C.optional_column(n, "n_regionkey", "bigint"))


ALIGN_TARGET = StructType(
    [
        StructField("n_nationkey", LongType()),
        StructField("n_name", StringType()),
        StructField("n_regionkey", StringType()),
        StructField("r_name", StringType()),
    ]
)


@register(
    "align_schema",
    "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, CAST(NULL AS VARCHAR) AS r_name FROM nation",
)
def q_align_schema(spark, sf):
    from stratum.sinks.tables import align_to_schema

    return align_to_schema(table(spark, sf, "nation").withColumn("extra", F.lit(1)), ALIGN_TARGET)


@register(
    "blank_domain_positive",
    f"""SELECT o_orderkey, {O.is_blank("o_orderpriority")} AS prioridade_em_branco,
  (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) AS status_fora_dominio,
  (o_totalprice IS NULL OR o_totalprice <= 0) AS valor_nao_positivo,
  {O.is_blank("CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END")} AS status_em_branco
FROM orders""",
)
def q_blank_domain_positive(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        C.is_blank("o_orderpriority").alias("prioridade_em_branco"),
        C.not_in_domain("o_orderstatus", ["F", "O"]).alias("status_fora_dominio"),
        C.not_positive("o_totalprice").alias("valor_nao_positivo"),
        C.is_blank(F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(F.col("o_orderstatus"))).alias("status_em_branco"),
    )


@register(
    "normalize_path",
    f"""SELECT event_id, coalesce(regexp_replace(trim(CASE WHEN event_type = 'view' THEN NULL ELSE '  dbfs:/raw/' || event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv ' END), '^dbfs:', ''), '') AS caminho FROM events""",
)
def q_normalize_path(spark, sf):
    e = table(spark, sf, "events")
    raw = F.when(F.col("event_type") == "view", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("  dbfs:/raw/"), F.col("event_type"), F.lit("/"), F.to_date("ts").cast("string"), F.lit(".csv "))
    )
    return e.select("event_id", C.normalize_path(raw).alias("caminho"))


# ---------------------------------------------------------------------------
# Rules and quarantine
# ---------------------------------------------------------------------------

def tagged(m: Model, entity: str):
    """The standardised rows of an entity with their quarantine reason (all rows)."""
    b = m.bronze(entity)
    if entity == "clientes":
        return R.tag_reasons(silver.standardize_clients(b, RUN_TS, TS), R.client_rules())
    if entity == "contas":
        return R.tag_reasons(silver.standardize_accounts(b, RUN_TS, TS), R.account_rules())
    if entity == "cartoes":
        return R.tag_reasons(silver.standardize_cards(b, RUN_TS, TS), R.card_rules())
    if entity == "estornos":
        return R.tag_reasons(silver.standardize_refunds(b, TS), R.refund_rules())
    if entity == "transacoes":
        std = silver.standardize_transactions(b, TS, passthrough=("tipo_transacao",))
        return R.tag_first_reason(silver.lookup_card_account(std, m.cards()[0]), R.transaction_rules())
    std = silver.standardize_risk_events(b, TS)
    return R.tag_first_reason(silver.lookup_transaction(std, m.transaction_parents()), R.risk_event_rules())


for _entity, _key, _cte in [
    ("clientes", "reasons_clients", "tag_clientes"),
    ("contas", "reasons_accounts", "tag_contas"),
    ("cartoes", "reasons_cards", "tag_cartoes"),
    ("estornos", "reasons_refunds", "tag_estornos"),
    ("transacoes", "reasons_transactions", "tag_transacoes"),
    ("eventos_risco", "reasons_events", "tag_eventos"),
]:
    register(_key, O.with_ctes([_entity], f"SELECT * FROM {_cte}"))(lambda spark, sf, _entity=_entity: tagged(Model(spark, sf), _entity))


@register("split_valid", O.with_ctes(["estornos"], "SELECT * EXCLUDE (motivo_quarentena) FROM tag_estornos WHERE length(trim(coalesce(motivo_quarentena, ''))) = 0"))
def q_split_valid(spark, sf):
    tagged = R.tag_reasons(silver.standardize_refunds(Model(spark, sf).bronze("estornos"), TS), R.refund_rules())
    return quality.split_valid_invalid(tagged)[0]


@register("split_invalid", O.with_ctes(["estornos"], "SELECT * FROM tag_estornos WHERE length(trim(coalesce(motivo_quarentena, ''))) > 0"))
def q_split_invalid(spark, sf):
    tagged = R.tag_reasons(silver.standardize_refunds(Model(spark, sf).bronze("estornos"), TS), R.refund_rules())
    return quality.split_valid_invalid(tagged)[1]


_STRICT_RULES = [
    ("id_cliente IS NULL", "id_cliente ausente"),
    ("coalesce(length(cpf) <> 11, true)", "cpf inválido"),
    (O.is_blank("nome"), "nome ausente"),
    ("coalesce(length(estado) <> 2, true)", "estado inválido"),
    ("renda IS NULL", "renda inválida"),
]


@register(
    "strict_client_rules",
    O.with_ctes(["clientes"], f"SELECT id_cliente, {O._reasons(_STRICT_RULES)} FROM std_clientes"),
)
def q_strict_client_rules(spark, sf):
    std = silver.standardize_clients(Model(spark, sf).bronze("clientes"), RUN_TS, TS)
    return R.tag_reasons(std, R.strict_client_rules()).select("id_cliente", "motivo_quarentena")


# ---------------------------------------------------------------------------
# Deduplication and grouping
# ---------------------------------------------------------------------------


@register(
    "latest_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, "
    "event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) = 1",
)
def q_latest_per_key(spark, sf):
    return dedupe.latest_per_key(table(spark, sf, "events"), ["user_id"], "ts")


@register("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_distinct_rows(spark, sf):
    return dedupe.distinct_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@register(
    "duplicate_groups",
    "SELECT l_orderkey, l_linenumber, count(*) AS quantidade FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_duplicate_groups(spark, sf):
    return dedupe.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("date_bounds", "SELECT min(l_shipdate) AS data_inicial, max(l_shipdate) AS data_final FROM lineitem")
def q_date_bounds(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.min("l_shipdate").alias("data_inicial"), F.max("l_shipdate").alias("data_final"))


@register(
    "fact_dates_union",
    "SELECT CAST(o_orderdate AS DATE) AS data FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem "
    "UNION ALL SELECT CAST(ts AS DATE) FROM events",
)
def q_fact_dates_union(spark, sf):
    return gold.fact_dates((table(spark, sf, "orders"), "o_orderdate"), (table(spark, sf, "lineitem"), "l_shipdate"), (table(spark, sf, "events"), "ts"))


# ---------------------------------------------------------------------------
# MERGE and SCD2
# ---------------------------------------------------------------------------

_MERGE_TARGET_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
_MERGE_SOURCE_SQL = (
    "SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' "
    "UNION ALL SELECT o_orderkey + 10000000000, o_custkey, 'N', o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'"
)


def _merge_inputs(spark, sf):
    o = table(spark, sf, "orders")
    target = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    updates = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), "o_totalprice")
    inserts = o.filter(F.col("o_orderpriority") == "5-LOW").select(
        (F.col("o_orderkey") + F.lit(10000000000)).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"), "o_totalprice"
    )
    return target, updates.unionByName(inserts)


@register(
    "merge_upsert",
    f"""WITH t AS ({_MERGE_TARGET_SQL}), s AS ({_MERGE_SOURCE_SQL})
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def q_merge_upsert(spark, sf):
    target, source = _merge_inputs(spark, sf)
    return upsert.merge_upsert(target, source, ["o_orderkey"])


@register(
    "merge_update_subset",
    f"""WITH t AS ({_MERGE_TARGET_SQL}), s AS ({_MERGE_SOURCE_SQL})
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN t.o_orderkey IS NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def q_merge_update_subset(spark, sf):
    target, source = _merge_inputs(spark, sf)
    return upsert.merge_upsert(target, source, ["o_orderkey"], update={"o_orderstatus": "origem.o_orderstatus"})


SCD_KEYS = ["c_custkey"]
SCD_COMPARE = ["c_name", "c_acctbal", "c_mktsegment"]


def _scd_v1(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment")


def _scd_v2(spark, sf):
    v1 = _scd_v1(spark, sf)
    bumped = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).cast("decimal(18,2)")
    return v1.withColumn("c_acctbal", bumped)


_SCD_V1_SQL = "SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer"
_SCD_V2_SQL = (
    "SELECT c_custkey, c_name, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_acctbal AS DECIMAL(18,2)) + 1 "
    "ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer"
)
_SCD_COLS = "c_custkey, c_name, c_acctbal, c_mktsegment"


def _scd_apply_sql(source_sql: str) -> str:
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    changed = " OR ".join(f"a.{c} IS DISTINCT FROM s.{c}" for c in SCD_COMPARE)
    a_cols = ", ".join(f"a.{c}" for c in cols)
    s_cols = ", ".join(f"s.{c} AS s_{c}" for c in cols)
    s_out = ", ".join(f"s_{c}" for c in cols)
    return f"""WITH active AS (SELECT {_SCD_COLS}, {T1_SQL} AS data_inicio_vigencia, CAST(NULL AS TIMESTAMP) AS data_fim_vigencia,
    true AS registro_atual FROM ({_SCD_V1_SQL})),
  s AS (SELECT *, true AS in_src FROM ({source_sql})),
  j AS (SELECT {a_cols}, a.data_inicio_vigencia, a.data_fim_vigencia, {s_cols}, a.registro_atual AS in_tgt, s.in_src,
      coalesce(a.registro_atual AND s.in_src AND ({changed}), false) AS changed
    FROM active a FULL OUTER JOIN s ON a.c_custkey IS NOT DISTINCT FROM s.c_custkey)
SELECT {_SCD_COLS}, data_inicio_vigencia, {T2_SQL} AS data_fim_vigencia, false AS registro_atual FROM j WHERE changed
UNION ALL SELECT {s_out}, {T2_SQL}, CAST(NULL AS TIMESTAMP), true FROM j WHERE changed OR in_tgt IS NULL
UNION ALL SELECT {_SCD_COLS}, data_inicio_vigencia, data_fim_vigencia, true FROM j WHERE NOT changed AND in_tgt IS NOT NULL"""


@register(
    "scd2_first",
    f"SELECT {_SCD_COLS}, {T1_SQL} AS data_inicio_vigencia, CAST(NULL AS TIMESTAMP) AS data_fim_vigencia, true AS registro_atual FROM ({_SCD_V1_SQL})",
)
def q_scd2_first(spark, sf):
    return upsert.scd2_first_load(_scd_v1(spark, sf), T1, ts_type=TS)


@register("scd2_change", _scd_apply_sql(_SCD_V2_SQL))
def q_scd2_change(spark, sf):
    active = upsert.scd2_first_load(_scd_v1(spark, sf), T1, ts_type=TS)
    return upsert.scd2_apply(active, _scd_v2(spark, sf), SCD_KEYS, SCD_COMPARE, T2, ts_type=TS)


@register("scd2_noop", _scd_apply_sql(_SCD_V1_SQL))
def q_scd2_noop(spark, sf):
    active = upsert.scd2_first_load(_scd_v1(spark, sf), T1, ts_type=TS)
    return upsert.scd2_apply(active, _scd_v1(spark, sf), SCD_KEYS, SCD_COMPARE, T2, ts_type=TS)


@register("current_version", f"SELECT * FROM ({_scd_apply_sql(_SCD_V2_SQL)}) WHERE registro_atual")
def q_current_version(spark, sf):
    return upsert.current_rows(q_scd2_change(spark, sf))


# ---------------------------------------------------------------------------
# Joins: orphans, semi/anti
# ---------------------------------------------------------------------------


@register(
    "orphan_keys",
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS chave FROM orders WHERE o_custkey IS NOT NULL AND CAST(o_custkey AS VARCHAR) NOT IN "
    "(SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey IS NOT NULL)",
)
def q_orphan_keys(spark, sf):
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return checks.orphan_keys(table(spark, sf, "orders"), "o_custkey", customers, "c_custkey")


def _event_files(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.concat(F.lit("dbfs:/raw/"), F.col("event_type"), F.lit("/"), F.to_date("ts").cast("string"), F.lit(".csv")).alias("path"), "event_type")


_EVENT_FILES_SQL = "SELECT 'dbfs:/raw/' || event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS path, event_type FROM events"
_PENDING_SQL = f"SELECT DISTINCT path FROM ({_EVENT_FILES_SQL})"
_LOADED_SQL = f"SELECT DISTINCT regexp_replace(trim(path), '^dbfs:', '') AS path FROM ({_EVENT_FILES_SQL}) WHERE event_type <> 'error'"


def _pending_loaded(spark, sf):
    files = _event_files(spark, sf)
    pending = files.select("path").distinct()
    loaded = ledger.loaded_files(files.filter(F.col("event_type") != "error").withColumnRenamed("path", "arquivo_origem"))
    return pending, loaded


@register(
    "loaded_files",
    _LOADED_SQL,
)
def q_loaded_files(spark, sf):
    return _pending_loaded(spark, sf)[1]


@register(
    "pending_vs_loaded",
    f"WITH p AS ({_PENDING_SQL}), l AS ({_LOADED_SQL}) "
    "SELECT regexp_replace(trim(p.path), '^dbfs:', '') AS path FROM p WHERE regexp_replace(trim(p.path), '^dbfs:', '') NOT IN (SELECT path FROM l)",
)
def q_pending_vs_loaded(spark, sf):
    pending, loaded = _pending_loaded(spark, sf)
    norm = pending.select(C.normalize_path("path").alias("path"))
    return ledger.unconfirmed(norm, loaded)


_LEDGER_SQL = f"""WITH p AS ({_PENDING_SQL}), l AS ({_LOADED_SQL}),
  n AS (SELECT coalesce(regexp_replace(trim(path), '^dbfs:', ''), '') AS norm FROM p)
SELECT 'eventos' AS nome_fonte, split_part(norm, '/', -1) AS nome_arquivo, norm AS caminho_origem,
  CASE WHEN l.path IS NOT NULL THEN '/processados/eventos/' || split_part(norm, '/', -1) END AS caminho_destino,
  'bronze.eventos' AS tabela_bronze,
  CASE WHEN l.path IS NOT NULL THEN 'PROCESSADO' ELSE 'NAO_CONFIRMADO' END AS status_processamento,
  CASE WHEN l.path IS NOT NULL THEN 'Arquivo confirmado na Bronze e movido com sucesso.'
       ELSE 'O arquivo não foi encontrado na coluna arquivo_origem da tabela Bronze.' END AS mensagem,
  {RUN_TS_SQL} AS data_processamento
FROM n LEFT JOIN l ON n.norm = l.path"""


def _ledger(spark, sf):
    pending, loaded = _pending_loaded(spark, sf)
    return ledger.file_status(pending, loaded, "eventos", "bronze.eventos", RUN_TS, "/processados", ts_type=TS)


@register("ledger_status", _LEDGER_SQL)
def q_ledger_status(spark, sf):
    return _ledger(spark, sf)


# Orders as changes of their customer: the urgent half is loaded first, the rest
# (most of it late) second.  A pending order deletes, others set the status and
# priority from their date on.
_EVENT_LOAD_SQL = "SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS em, 2 AS prio, o_orderstatus = 'P' AS gone FROM orders WHERE o_orderpriority {which} ('1-URGENT', '2-HIGH')"


def _islands_sql(events: str) -> str:
    w = "OVER (PARTITION BY o_custkey ORDER BY em, prio, o_orderkey, o_orderstatus, o_orderpriority)"
    said = "CASE WHEN NOT gone THEN o_orderstatus || '|' || o_orderpriority END"
    return f"""(SELECT * FROM (
  SELECT *, lead(em) {w} AS fim FROM (
    SELECT * FROM (
      SELECT *, row_number() {w} AS n, lag({said}) {w} AS before FROM (
        SELECT * FROM (SELECT *, lead(em) {w} AS next_at FROM ({events})) WHERE next_at IS NULL OR next_at <> em))
    WHERE n = 1 OR before IS DISTINCT FROM {said})) WHERE NOT gone)"""


_FIRST_ISLANDS = _islands_sql(_EVENT_LOAD_SQL.format(which="IN"))
_SECOND_EVENTS = f"""{_EVENT_LOAD_SQL.format(which="NOT IN")}
  UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, em, 1, FALSE FROM v1
  UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, fim, 0, TRUE FROM v1 WHERE fim IS NOT NULL"""


@register(
    "scd2_event_time",
    f"WITH v1 AS (SELECT * FROM {_FIRST_ISLANDS}) "
    "SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, em AS data_inicio_vigencia, fim AS data_fim_vigencia, fim IS NULL AS registro_atual "
    f"FROM {_islands_sql(_SECOND_EVENTS)}",
)
def q_scd2_event_time(spark, sf):
    """Two loads of dated changes, with late rows, deletes and many versions of a key at once."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey", "o_orderdate")
    first = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    versions = None
    for load in (o.filter(first), o.filter(~first)):
        versions = upsert.scd2_event_time(
            versions,
            load,
            ["o_custkey"],
            ["o_orderstatus", "o_orderpriority"],
            "o_orderdate",
            RUN_TS,
            order_by=["o_orderkey"],
            deleted=F.col("o_orderstatus") == "P",
            ts_type=TS,
        )
    return versions.drop("o_orderdate")


# Files by order: all were listed once; what became of each follows from the order's
# status and priority, so that every place and every status occurs.
_RECONCILE_SQL = f"""WITH o AS (
  SELECT o_orderkey, 'raw/pedidos/' || o_orderkey || '.csv' AS origem, 'arquivo/pedidos/' || o_orderkey || '.csv' AS destino,
    o_orderstatus <> 'P' AS confirmado, o_orderpriority IN ('1-URGENT', '2-HIGH') AS no_destino,
    o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AS na_entrada FROM orders),
f AS (
  SELECT CASE WHEN confirmado OR na_entrada THEN origem END AS caminho_origem, destino,
    confirmado, no_destino, na_entrada FROM o WHERE confirmado OR na_entrada
  UNION ALL
  SELECT NULL, destino, FALSE, TRUE, FALSE FROM o WHERE NOT confirmado AND no_destino)
SELECT 'pedidos' AS nome_fonte, split_part(coalesce(caminho_origem, destino), '/', -1) AS nome_arquivo, caminho_origem,
  CASE WHEN no_destino THEN destino END AS caminho_destino, 'bronze.pedidos' AS tabela_bronze,
  CASE WHEN confirmado AND no_destino THEN 'PROCESSADO' WHEN confirmado AND na_entrada THEN 'ERRO_MOVIMENTACAO'
       WHEN confirmado OR no_destino THEN 'ERRO' ELSE 'NAO_CONFIRMADO' END AS status_processamento,
  CASE WHEN confirmado AND no_destino THEN 'Arquivo confirmado na Bronze e movido com sucesso.'
       WHEN confirmado AND na_entrada THEN 'O arquivo foi confirmado na Bronze, mas continua na entrada.'
       WHEN confirmado THEN 'O arquivo não está na entrada nem no destino.'
       WHEN no_destino THEN 'O arquivo está no destino sem confirmação na Bronze.'
       ELSE 'O arquivo não foi encontrado na coluna arquivo_origem da tabela Bronze.' END AS mensagem,
  {RUN_TS_SQL} AS data_processamento
FROM f"""


@register("file_reconciliation", _RECONCILE_SQL)
def q_file_reconciliation(spark, sf):
    """Source listing, archive listing and log joined: all four statuses."""
    o = table(spark, sf, "orders")
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".csv"))
    files = o.select(
        F.concat(F.lit("raw/pedidos/"), name).alias("caminho_origem"),
        F.col("o_orderkey").cast("bigint").alias("tamanho"),
        F.lit(RUN_TS).alias("data_modificacao"),
        F.concat(F.lit("arquivo/pedidos/"), name).alias("destino"),
        "o_orderstatus",
        "o_orderpriority",
    )
    there = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    here = F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED")
    done = files.filter(F.col("o_orderstatus") != "P")
    log = ledger.log_rows(done, "pedidos", "lote", ledger.COMMITTED, RUN_TS).union(
        ledger.log_rows(done, "pedidos", "lote", ledger.MOVING, RUN_TS, caminho_destino=F.col("destino"))
    )
    archived = files.filter(there).select(F.col("destino").alias("path"))
    return ledger.reconcile_files(files.filter(here), archived, log, "pedidos", "bronze.pedidos", RUN_TS, ts_type=TS)


@register(
    "ledger_summary",
    f"SELECT nome_fonte, status_processamento, count(*) AS quantidade_arquivos, max(data_processamento) AS ultima_execucao FROM ({_LEDGER_SQL}) GROUP BY ALL",
)
def q_ledger_summary(spark, sf):
    return ledger.ledger_summary(_ledger(spark, sf))


@register(
    "ledger_history",
    f"SELECT *, row_number() OVER (ORDER BY data_processamento DESC, caminho_origem ASC) AS posicao FROM ({_LEDGER_SQL})",
)
def q_ledger_history(spark, sf):
    return ledger.ledger_history(_ledger(spark, sf))


@register(
    "remaining_files",
    f"SELECT nome_fonte, count_if(status_processamento <> 'PROCESSADO') AS arquivos_restantes, "
    f"count_if(status_processamento = 'PROCESSADO') AS arquivos_processados FROM ({_LEDGER_SQL}) GROUP BY nome_fonte",
)
def q_remaining_files(spark, sf):
    return ledger.remaining_files(_ledger(spark, sf))


# ---------------------------------------------------------------------------
# Data-quality checks and metrics over the gold model
# ---------------------------------------------------------------------------


def _check_sql(name: str, count_sql: str, label: str) -> str:
    return (
        f"SELECT '{name}' AS teste, CASE WHEN n = 0 THEN 'APROVADO' ELSE 'REPROVADO' END AS status, "
        f"'{label}: ' || CAST(n AS VARCHAR) AS detalhe, {RUN_TS_SQL} AS data_execucao FROM (SELECT coalesce(({count_sql}), 0) AS n)"
    )


_DQ_UNIQUE = _check_sql(
    "Sem duplicidade: lineitem",
    "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)",
    "Grupos duplicados",
)


@register("dq_unique", _DQ_UNIQUE)
def q_dq_unique(spark, sf):
    return checks.check_unique(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], RUN_TS, TS)


_REQ_COLS = ["id_transacao", "id_cartao", "id_conta", "data_transacao", "valor"]
_DQ_REQUIRED = _check_sql(
    "Campos obrigatórios preenchidos: prata.transacoes",
    "SELECT count(*) FROM silver_transacoes WHERE " + " OR ".join(O.is_blank(c) for c in _REQ_COLS),
    "Registros inválidos",
)


@register("dq_required", O.with_ctes(["transacoes"], _DQ_REQUIRED))
def q_dq_required(spark, sf):
    return checks.check_required(Model(spark, sf).transactions()[0], "prata.transacoes", _REQ_COLS, RUN_TS, TS)


_DQ_FK = _check_sql(
    "Integridade: ouro.fato_eventos_risco.id_cliente",
    "SELECT count(*) FROM (SELECT DISTINCT CAST(id_cliente AS VARCHAR) AS k FROM fato_eventos_risco WHERE id_cliente IS NOT NULL) "
    "WHERE k NOT IN (SELECT CAST(id_cliente AS VARCHAR) FROM dim_clientes WHERE id_cliente IS NOT NULL)",
    "Chaves órfãs",
)


@register("dq_fk", O.with_ctes(["dim_clientes", "fato_eventos_risco"], _DQ_FK))
def q_dq_fk(spark, sf):
    m = Model(spark, sf)
    return checks.check_foreign_key(m.fact_risk(), "ouro.fato_eventos_risco", "id_cliente", m.dim_clients(), "id_cliente", RUN_TS, TS)


_DQ_POSITIVE = _check_sql(
    "Estornos possuem valor positivo",
    "SELECT count(*) FROM std_estornos WHERE valor_estorno IS NULL OR valor_estorno <= 0",
    "Registros inválidos",
)


@register("dq_positive", O.with_ctes(["estornos"], _DQ_POSITIVE))
def q_dq_positive(spark, sf):
    std = silver.standardize_refunds(Model(spark, sf).bronze("estornos"), TS)
    return checks.check_positive(std, "Estornos possuem valor positivo", "valor_estorno", RUN_TS, TS)


_DQ_DOMAIN = _check_sql(
    "Severidades possuem domínio válido",
    "SELECT count(*) FROM std_eventos WHERE severidade IS NULL OR severidade NOT IN ('BAIXA', 'MEDIA', 'ALTA', 'CRITICA')",
    "Registros inválidos",
)


@register("dq_domain", O.with_ctes(["eventos_risco"], _DQ_DOMAIN))
def q_dq_domain(spark, sf):
    std = silver.standardize_risk_events(Model(spark, sf).bronze("eventos_risco"), TS)
    from stratum.settings import SEVERITIES

    return checks.check_domain(std, "Severidades possuem domínio válido", "severidade", SEVERITIES, RUN_TS, TS)


_DQ_NOT_EMPTY = (
    "SELECT 'Tabela possui registros: ouro.fato_transacoes' AS teste, CASE WHEN n > 0 THEN 'APROVADO' ELSE 'REPROVADO' END AS status, "
    f"'Quantidade: ' || CAST(n AS VARCHAR) AS detalhe, {RUN_TS_SQL} AS data_execucao FROM (SELECT count(*) AS n FROM fato_transacoes)"
)


@register(
    "dq_report",
    O.with_ctes(
        ["dim_clientes", "fato_eventos_risco", "transacoes", "estornos"],
        f"{_DQ_NOT_EMPTY} UNION ALL {_DQ_REQUIRED} UNION ALL {_DQ_FK} UNION ALL {_DQ_POSITIVE.replace('std_estornos', 'silver_estornos')} "
        f"UNION ALL {_check_sql('Sem duplicidade: prata.transacoes', 'SELECT count(*) FROM (SELECT id_transacao FROM silver_transacoes GROUP BY ALL HAVING count(*) > 1)', 'Grupos duplicados')}",
    ),
)
def q_dq_report(spark, sf):
    m = Model(spark, sf, with_client=True)
    tables = {
        "ouro.fato_transacoes": checks.TableChecks(m.fact_transactions(), not_empty=True),
        "prata.transacoes": checks.TableChecks(m.transactions()[0], required=_REQ_COLS, unique=["id_transacao"]),
        "ouro.fato_eventos_risco": checks.TableChecks(m.fact_risk(), foreign=[("id_cliente", "ouro.dim_clientes", "id_cliente")]),
        "ouro.dim_clientes": checks.TableChecks(m.dim_clients()),
        "prata.estornos": checks.TableChecks(m.refunds()[0], positive=[("Estornos possuem valor positivo", "valor_estorno")]),
    }
    return checks.keyed_checks(tables, RUN_TS, TS)


_KEYS_SQL = {"clientes": "id_cliente", "contas": "id_conta", "cartoes": "id_cartao", "transacoes": "id_transacao", "eventos_risco": "id_evento", "estornos": "id_estorno"}


def _metrics_sql(source: str, tagged: str, first_match: bool) -> str:
    flagged = "motivo_quarentena IS NOT NULL" if first_match else "length(trim(coalesce(motivo_quarentena, ''))) > 0"
    return (
        f"SELECT '{source}' AS fonte, count(*) AS quantidade_entrada, "
        f"count(DISTINCT CASE WHEN NOT ({flagged}) THEN {_KEYS_SQL[source]} END) AS quantidade_validos, "
        f"count_if({flagged}) AS quantidade_invalidos, {RUN_TS_SQL} AS data_processamento FROM {tagged}"
    )


_METRIC_SOURCES = [
    ("clientes", "tag_clientes", False),
    ("contas", "tag_contas", False),
    ("cartoes", "tag_cartoes", False),
    ("transacoes", "tag_transacoes", True),
    ("eventos_risco", "tag_eventos", True),
    ("estornos", "tag_estornos", False),
]


@register(
    "quality_metrics",
    O.with_ctes([s for s, _, _ in _METRIC_SOURCES], " UNION ALL ".join(_metrics_sql(*x) for x in _METRIC_SOURCES)),
)
def q_quality_metrics(spark, sf):
    m = Model(spark, sf)  # one model: the card and transaction chains are shared
    frames = [metrics.quality_metrics(source, tagged(m, source), RUN_TS, ts_type=TS) for source, _, _ in _METRIC_SOURCES]
    return checks.union_results(frames)


_LAYERS = ["dim_clientes", "dim_contas", "dim_cartoes", "fato_transacoes", "fato_estornos", "fato_eventos_risco"]


@register(
    "layer_counts",
    O.with_ctes(_LAYERS, " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS quantidade, true AS existe FROM {t}" for t in _LAYERS)),
)
def q_layer_counts(spark, sf):
    m = Model(spark, sf, with_client=True)
    return metrics.layer_counts(
        {
            "dim_clientes": m.dim_clients(),
            "dim_contas": m.dim_accounts(),
            "dim_cartoes": m.dim_cards(),
            "fato_transacoes": m.fact_transactions(),
            "fato_estornos": m.fact_refunds(),
            "fato_eventos_risco": m.fact_risk(),
        }
    )


@register("any_per_key", "SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey * 10 AS chave_pedido FROM lineitem")
def q_any_per_key(spark, sf):
    """dropDuplicates on a key whose rows are equal on every kept column (DED-2's valid use)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10).alias("chave_pedido"))
    return dedupe.any_per_key(li, ["l_orderkey", "l_linenumber"])


@register(
    "table_profile",
    "SELECT count(*) AS linhas, count_if(l_returnflag IS NULL OR trim(l_returnflag) = '' OR l_shipdate IS NULL) AS obrigatorios_ausentes, "
    "count_if(l_quantity IS NULL OR l_quantity <= 0) AS nao_positivos_l_quantity, count_if(l_discount IS NULL OR l_discount <= 0) AS nao_positivos_l_discount, "
    "count_if(l_linestatus IS NULL OR l_linestatus NOT IN ('O')) AS fora_dominio_l_linestatus FROM lineitem",
)
def q_table_profile(spark, sf):
    li = table(spark, sf, "lineitem")
    return checks.table_profile(li, required=["l_returnflag", "l_shipdate"], positive=["l_quantity", "l_discount"], domains={"l_linestatus": ["O"]})
