"""End-to-end medallion run: raw files -> Bronze -> file ledger -> silver (+ quarantine) -> gold -> checks.

Steps communicate only through tables, as in the original design.  Control
flow (which source, which table) is a loop on the driver over a handful of
specs; all data work is Spark jobs.  Every write is either an overwrite of a
complete snapshot, an idempotent append (anti-join), a partition of its own or a
staging-table commit, so re-running a step after a failure, or re-running the
whole pipeline on the same inputs, changes no silver, quarantine or gold row.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratum.operators import checks, ledger, metrics
from stratum.functions.columns import ts_literal
from stratum.operators.upsert import current_rows, scd2_apply
from stratum.plans import gold, silver
from stratum.operators.quality import has_reason
from stratum.settings import CHECK_FAILED, ENTITIES, REASON_COLUMN, SEVERITIES, Settings
from stratum.sinks import tables as sink
from stratum.sources.raw import add_lineage, list_files, literal_path, move_files, qualified, read_raw

BRONZE_RESULT_SCHEMA = "fonte string, status string, batch_id string, quantidade_registros bigint, tabela string"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder by the log's key columns; a missing folder has none."""
    try:
        return ledger.listed_files(list_files(spark, path))
    except AnalysisException as e:
        # any other fault of the listing is one
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "caminho_origem string, tamanho bigint, data_modificacao timestamp")


def _file_log(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    return spark.table(settings.table("control", "lotes_arquivos")).filter(F.col("nome_fonte") == name)


def _load_batch(spark: SparkSession, settings: Settings, name: str, table: str, batch_id: str, run_ts: datetime) -> int:
    """Write the files of a batch's intent to its own partition of Bronze, then its commit rows.

    Run again after a crash anywhere, it replaces what the first attempt left.
    Returns the number of rows.
    """
    log = settings.table("control", "lotes_arquivos")
    intent = ledger.log_stage(_file_log(spark, settings, name), ledger.INTENT).filter(F.col("batch_id") == batch_id)
    paths = [r["caminho_origem"] for r in intent.select("caminho_origem").distinct().orderBy("caminho_origem").collect()]
    raw = read_raw(spark, [literal_path(path) for path in paths], settings.sources[name].fmt)
    sink.replace_partition(add_lineage(raw, batch_id, settings.schema_version, run_ts), table, "batch_id", batch_id)
    written = spark.table(table).filter(F.col("batch_id") == batch_id)
    sink.append(ledger.commit_rows(intent, written, run_ts), log)
    done = ledger.log_stage(_file_log(spark, settings, name), ledger.COMMITTED).filter(F.col("batch_id") == batch_id)
    return done.agg(F.sum("linhas").alias("rows")).first()["rows"] or 0


def ingest_source(spark: SparkSession, settings: Settings, name: str, batch_id: str, run_ts: datetime) -> tuple:
    """Load the new files of one source folder into Bronze, batch by batch.

    Pending are the listed files that the log of file batches does not have as
    committed; Bronze is not read for it.  A batch of at most
    ``max_files_per_batch`` files gets intent rows, its partition of Bronze and
    commit rows, in this order.  A batch that an earlier run left between the
    first and the last is written again before anything else.
    Returns ``(fonte, status, batch_id, rows, table)``; ``SEM_ARQUIVOS`` when
    there is nothing to load.
    """
    spec = settings.sources[name]
    table = spec.table or settings.table("bronze", name)
    log = settings.table("control", "lotes_arquivos")
    sink.create_control_tables(spark, settings.database_control)
    files = _listing(spark, spec.path)
    rows, batches = 0, 0

    interrupted = ledger.interrupted_batches(_file_log(spark, settings, name))
    gone = interrupted.join(files, list(ledger.FILE_KEY), "left_anti").first()
    if gone:
        raise RuntimeError(f"{gone['caminho_origem']} of the interrupted batch {gone['batch_id']} is gone or has changed")
    for batch in interrupted.select("batch_id").distinct().orderBy("batch_id").collect():  # one, unless runs overlapped
        rows += _load_batch(spark, settings, name, table, batch["batch_id"], run_ts)
        batches += 1
    first = batch_id
    while True:
        pending = ledger.pending_files(files, _file_log(spark, settings, name))
        pending = pending.orderBy(*ledger.FILE_KEY).limit(settings.max_files_per_batch)
        if not pending.head(1):
            break
        used = _file_log(spark, settings, name).filter(F.col("batch_id") == batch_id).head(1)
        batch_id = f"{first}-{uuid.uuid4().hex[:8]}" if used else batch_id
        sink.append(ledger.log_rows(pending, name, batch_id, ledger.INTENT, run_ts), log)
        rows += _load_batch(spark, settings, name, table, batch_id, run_ts)
        batches += 1
    return (name, "SUCESSO" if batches else "SEM_ARQUIVOS", first, rows, table)


def run_bronze(spark: SparkSession, settings: Settings, batch_id: str | None = None, run_ts: datetime | None = None) -> DataFrame:
    """Ingest every source with one batch id; results as a DataFrame."""
    batch_id = batch_id or str(uuid.uuid4())
    run_ts = run_ts or _now()
    rows = [ingest_source(spark, settings, name, batch_id, run_ts) for name in settings.sources]
    return spark.createDataFrame(rows, BRONZE_RESULT_SCHEMA)


# ---------------------------------------------------------------------------
# File ledger
# ---------------------------------------------------------------------------


def run_ledger(spark: SparkSession, settings: Settings, run_ts: datetime | None = None) -> DataFrame:
    """Move the confirmed files of every source and record what became of each file.

    With ``archive_root`` the files that the log has as committed are moved to
    ``<archive_root>/<source>``; their destinations are logged before.  The
    ledger then gets a row for each file whose status, by the listings of both
    folders, is not the one it has.  Returns the rows added.
    """
    run_ts = run_ts or _now()
    sink.create_control_tables(spark, settings.database_control)
    log = settings.table("control", "lotes_arquivos")
    control = settings.table("control", "controle_arquivos_processados")
    added = []
    for name, spec in settings.sources.items():
        archived = spark.createDataFrame([], "path string")
        if settings.archive_root:
            folder = f"{settings.archive_root.rstrip('/')}/{name}"
            archived = _listing(spark, folder).select(F.col("caminho_origem").alias("path"))
            plan = ledger.planned_moves(_listing(spark, spec.path), _file_log(spark, settings, name), archived, qualified(spark, folder), run_ts)
            to = F.col("caminho_destino")
            rows = ledger.log_rows(plan, name, "", ledger.MOVING, run_ts, caminho_destino=to)
            sink.append(rows.withColumn("batch_id", F.lit(None).cast("string")), log)
            moves = ledger.log_stage(_file_log(spark, settings, name), ledger.MOVING)
            still = moves.join(_listing(spark, spec.path), list(ledger.FILE_KEY), "left_semi")
            move_files(spark, still.select("caminho_origem", "caminho_destino"))
            archived = _listing(spark, folder).select(F.col("caminho_origem").alias("path"))
        found = ledger.reconcile_files(
            _listing(spark, spec.path),
            archived,
            _file_log(spark, settings, name),
            name,
            spec.table or settings.table("bronze", name),
            run_ts,
            moves=bool(settings.archive_root),
        )
        added.append(ledger.changed_rows(found, spark.table(control).filter(F.col("nome_fonte") == name)))
    rows = added[0]
    for more in added[1:]:
        rows = rows.unionByName(more)
    sink.append(rows, control)
    return spark.table(control).filter(F.col("data_processamento") == ts_literal(run_ts, "timestamp"))


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------


def _bronze(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    return spark.table(settings.sources[name].table or settings.table("bronze", name))


REJECTED = "rejeitado"


def _classified(spark: SparkSession, settings: Settings, name: str, tagged: DataFrame) -> DataFrame:
    """Write the tagged rows of a source once, by verdict, and read them back.

    Valid rows, rejected rows and counters are all taken from this table, whose
    partitions are the verdicts, so Bronze is read, parsed and joined once.
    """
    table = settings.table("silver", f"{name}__classificado")
    sink.write_snapshot(tagged.withColumn(REJECTED, has_reason()), table, [REJECTED])
    return spark.table(table)


def _valid(classified: DataFrame, keys, order_by: str) -> DataFrame:
    return silver.latest_per_key(classified.filter(~F.col(REJECTED)).drop(REJECTED, REASON_COLUMN), keys, order_by)


def _quarantine(settings: Settings, name: str, classified: DataFrame) -> None:
    rejected = classified.filter(F.col(REJECTED)).drop(REJECTED)
    sink.append_quarantine(rejected, settings.table("quarantine", name))


def _scd_entity(spark, settings: Settings, name: str, valid: DataFrame, run_ts: datetime) -> None:
    spec = ENTITIES[name]
    target = settings.table("silver", name)
    sink.recover_scd2(spark, target)
    active = current_rows(spark.table(target)) if sink.table_exists(spark, target) else None
    # silver keys are never NULL (the rules quarantine NULL ids), so a bucketed
    # target can be joined with plain equality and is not shuffled
    buckets = (settings.scd_buckets, list(spec.keys)) if settings.scd_buckets else None
    changes = scd2_apply(active, valid, spec.keys, spec.compare, run_ts, null_safe=buckets is None)
    sink.commit_scd2(changes, target, run_ts=run_ts, bucket_by=buckets, keys=spec.keys)


def tagged_source(spark: SparkSession, settings: Settings, name: str, run_ts: datetime) -> DataFrame:
    """Bronze of a source, standardised, joined with its parents and tagged with the reasons against each row."""
    bronze = _bronze(spark, settings, name)
    if name == "clientes":
        return silver.tag_reasons(silver.standardize_clients(bronze, run_ts), silver.client_rules())
    if name == "contas":
        return silver.tag_reasons(silver.standardize_accounts(bronze, run_ts), silver.account_rules())
    if name == "cartoes":
        return silver.tag_reasons(silver.standardize_cards(bronze, run_ts), silver.card_rules())
    if name == "transacoes":
        cards = current_rows(spark.table(settings.table("silver", "cartoes")))
        joined = silver.lookup_card_account(silver.standardize_transactions(bronze), cards)
        return joined.withColumn(REASON_COLUMN, silver.first_reason(silver.transaction_rules()))
    if name == "eventos_risco":
        transactions = spark.table(settings.table("silver", "transacoes"))
        joined = silver.lookup_transaction(silver.standardize_risk_events(bronze), transactions)
        return joined.withColumn(REASON_COLUMN, silver.first_reason(silver.risk_event_rules()))
    return silver.tag_reasons(silver.standardize_refunds(bronze), silver.refund_rules())


# key and ordering column of the valid rows of each source, parents first
SILVER_ORDER = {
    "clientes": ("id_cliente", "data_atualizacao"),
    "contas": ("id_conta", "data_atualizacao"),
    "cartoes": ("id_cartao", "data_atualizacao"),
    "transacoes": ("id_transacao", "data_transacao"),
    "eventos_risco": ("id_evento", "data_evento"),
    "estornos": ("id_estorno", "data_estorno"),
}


def run_silver(spark: SparkSession, settings: Settings, run_ts: datetime | None = None) -> DataFrame:
    """All six silver entities in dependency order; returns the quality metrics."""
    run_ts = run_ts or _now()
    out = []
    for name, (key, order_by) in SILVER_ORDER.items():
        classified = _classified(spark, settings, name, tagged_source(spark, settings, name, run_ts))
        _quarantine(settings, name, classified)
        valid, target = _valid(classified, [key], order_by), settings.table("silver", name)
        if name in ENTITIES:
            _scd_entity(spark, settings, name, valid, run_ts)
        elif name == "estornos":
            buckets = (settings.scd_buckets, [key]) if settings.scd_buckets else None
            sink.merge_into(spark, valid, target, [key], bucket_by=buckets, key_buckets=settings.merge_key_buckets)
        else:
            sink.write_snapshot(valid, target)
        out.append(metrics.quality_metrics(name, classified, run_ts))

    result = checks.union_results(out)
    sink.append(result, settings.table("control", "metricas_qualidade_prata"))
    for name in SILVER_ORDER:
        spark.sql(f"DROP TABLE IF EXISTS {settings.table('silver', f'{name}__classificado')}")
    return spark.table(settings.table("control", "metricas_qualidade_prata")).filter(
        F.col("data_processamento") == ts_literal(run_ts, "timestamp")
    )


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

GOLD_TABLES = (
    "dim_clientes",
    "dim_contas",
    "dim_cartoes",
    "dim_data",
    "fato_transacoes",
    "fato_estornos",
    "fato_eventos_risco",
    "analise_consumo_clientes",
    "analise_padrao_consumo",
    "analise_risco_clientes",
    "analise_estornos_clientes",
    "analise_consumo_mensal",
)


def run_gold(spark: SparkSession, settings: Settings, type_column: str = "tipo_transacao") -> DataFrame:
    """Build and write every gold table; facts are read back from their tables
    so later models do not recompute the upstream joins."""
    s = lambda n: spark.table(settings.table("silver", n))
    g = lambda n: spark.table(settings.table("gold", n))
    write = lambda df, n: sink.write_snapshot(df, settings.table("gold", n))

    write(gold.dim_clients(s("clientes")), "dim_clientes")
    write(gold.dim_accounts(s("contas")), "dim_contas")
    write(gold.dim_cards(s("cartoes")), "dim_cartoes")
    write(gold.dim_date(gold.fact_dates((s("transacoes"), "data_transacao"), (s("estornos"), "data_estorno"), (s("eventos_risco"), "data_evento"))), "dim_data")
    write(gold.fact_transactions(s("transacoes"), g("dim_contas"), unique=False, type_column=type_column), "fato_transacoes")
    write(gold.fact_refunds(s("estornos"), g("fato_transacoes"), unique=False), "fato_estornos")
    write(gold.fact_risk_events(s("eventos_risco"), unique=False, dim_contas=g("dim_contas")), "fato_eventos_risco")
    write(gold.client_consumption(g("dim_clientes"), g("fato_transacoes"), g("dim_contas"), g("dim_cartoes")), "analise_consumo_clientes")
    write(gold.consumption_share(g("fato_transacoes")), "analise_padrao_consumo")
    write(gold.client_risk(g("dim_clientes"), g("fato_eventos_risco")), "analise_risco_clientes")
    write(gold.client_refunds(g("dim_clientes"), g("fato_transacoes"), g("fato_estornos")), "analise_estornos_clientes")
    write(gold.monthly_consumption(g("fato_transacoes"), g("fato_estornos")), "analise_consumo_mensal")
    return metrics.layer_counts({n: g(n) for n in GOLD_TABLES})


# ---------------------------------------------------------------------------
# Quality gate
# ---------------------------------------------------------------------------


def run_checks(spark: SparkSession, settings: Settings, run_ts: datetime | None = None, raise_on_failure: bool = False) -> DataFrame:
    """Existence, volume, uniqueness, required fields, positivity, FK and domain checks."""
    run_ts = run_ts or _now()
    t = settings.table
    results = []
    required = [t("silver", n) for n in ("clientes", "contas", "cartoes", "transacoes", "eventos_risco", "estornos")] + [
        t("gold", n) for n in ("dim_clientes", "dim_contas", "fato_transacoes", "fato_eventos_risco", "fato_estornos", "analise_risco_clientes")
    ]
    exists = [(name, sink.table_exists(spark, name)) for name in required]
    results.append(
        spark.createDataFrame(
            [(f"Tabela existe: {n}", "APROVADO" if ok else "REPROVADO", "", run_ts) for n, ok in exists], checks.RESULT_SCHEMA
        )
    )
    present = {n for n, ok in exists if ok}

    # all checks of the present tables share one scan a table and one keyed aggregate
    not_empty = {t("silver", n) for n in ("clientes", "contas", "cartoes", "transacoes")} | {t("gold", n) for n in ("dim_clientes", "dim_contas", "fato_transacoes")}
    required = {
        t("silver", "transacoes"): ["id_transacao", "id_cartao", "id_conta", "data_transacao", "valor"],
        t("silver", "eventos_risco"): ["id_evento", "id_transacao", "tipo_evento", "severidade", "data_evento"],
        t("silver", "estornos"): ["id_estorno", "id_transacao", "valor_estorno", "data_estorno"],
    }
    positive = {
        t("gold", "fato_transacoes"): [("Transações possuem valor positivo", "valor")],
        t("gold", "fato_estornos"): [("Estornos possuem valor positivo", "valor_estorno")],
    }
    domains = {t("gold", "fato_eventos_risco"): [("Severidades possuem domínio válido", "severidade", SEVERITIES)]}
    missing_rows = []  # a check on a missing table fails with a fixed detail
    gone = "A tabela não existe."
    unique = {t("silver", name): [key] for name, (key, _) in SILVER_ORDER.items()} | {
        t("gold", "fato_transacoes"): ["id_transacao"],
        t("gold", "fato_eventos_risco"): ["id_evento"],
        t("gold", "fato_estornos"): ["id_estorno"],
    }
    foreign = {
        t("gold", "fato_transacoes"): [
            ("id_cliente", t("gold", "dim_clientes"), "id_cliente"),
            ("id_conta", t("gold", "dim_contas"), "id_conta"),
        ],
        t("gold", "fato_eventos_risco"): [("id_transacao", t("gold", "fato_transacoes"), "id_transacao")],
        t("gold", "fato_estornos"): [("id_transacao", t("gold", "fato_transacoes"), "id_transacao")],
    }
    tables = {}
    for name in sorted(not_empty | set(required) | set(positive) | set(domains) | set(unique)):
        if name not in present:
            if name in unique:
                missing_rows.append((f"Sem duplicidade: {name}", CHECK_FAILED, gone, run_ts))
            if name in not_empty:
                missing_rows.append((f"Tabela possui registros: {name}", CHECK_FAILED, gone, run_ts))
            if name in required:
                missing_rows.append((f"Campos obrigatórios: {name}", CHECK_FAILED, gone, run_ts))
            for test, *_ in positive.get(name, []) + domains.get(name, []):
                missing_rows.append((test, CHECK_FAILED, gone, run_ts))
            continue
        df = spark.table(name)
        absent = [c for c in required.get(name, []) if c not in df.columns]
        if absent:
            results.append(checks.check_required(df, name, required[name], run_ts))
        tables[name] = checks.TableChecks(
            df,
            not_empty=name in not_empty,
            required=[] if absent else required.get(name, []),
            positive=positive.get(name, []),
            domains=domains.get(name, []),
            unique=unique.get(name, []),
            foreign=[key for key in foreign.get(name, []) if key[1] in present],
        )
    for fact, keys in foreign.items():
        for column, dim, _ in keys:
            if not {fact, dim} <= present:
                missing_rows.append((f"Integridade: {fact}.{column}", CHECK_FAILED, "Tabela fato ou dimensão não existe.", run_ts))
    if tables:
        results.append(checks.keyed_checks(tables, run_ts))
    if missing_rows:
        results.append(spark.createDataFrame(missing_rows, checks.RESULT_SCHEMA))
    out = checks.union_results(results)
    if raise_on_failure:
        checks.assert_passed(out)
    return out


def run_gate(spark: SparkSession, settings: Settings, run_ts: datetime | None = None) -> int:
    """Store the results of all checks, then fail if one did not pass."""
    table = settings.table("control", "resultados_qualidade")
    run_ts = run_ts or _now()
    sink.append(run_checks(spark, settings, run_ts), table)
    stored = spark.table(table).filter(F.col("data_execucao") == ts_literal(run_ts, "timestamp"))
    checks.assert_passed(stored)
    return stored.count()


def run_all(spark: SparkSession, settings: Settings, batch_id: str | None = None, run_ts: datetime | None = None) -> DataFrame:
    """Bronze -> silver -> gold -> checks with a run log written even on failure."""
    run_ts = run_ts or _now()
    sink.create_control_tables(spark, settings.database_control)
    log = metrics.RunLog(spark)
    try:
        log.run("01_bronze", lambda: run_bronze(spark, settings, batch_id, run_ts).count())
        log.run("02_controle_arquivos", lambda: run_ledger(spark, settings, run_ts).count())
        log.run("03_prata", lambda: run_silver(spark, settings, run_ts).count())
        log.run("04_ouro", lambda: run_gold(spark, settings).count())
        log.run("05_qualidade", lambda: run_gate(spark, settings, run_ts))
    finally:
        sink.append(log.frame(), settings.table("control", "execucoes_pipeline"))
    return log.frame()
