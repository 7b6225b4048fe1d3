"""File ledger as table operators: which raw files reached Bronze, and their status.

Everything stays distributed: the set of loaded files is a DataFrame joined to
the pending listing (semi/anti joins), never a Python set on the driver.

The log of file batches (``LOG_COLUMNS``) is append-only and tells each file's
stages: ``INTENCAO`` before its batch is written to Bronze, ``CONFIRMADO`` (or
``SEM_LINHAS``, if it gave no row) after, ``MOVIMENTACAO`` with its destination
before it is moved.  A batch with an intent and no commit was interrupted and
is written again, to its own partition.  A file is known by path, size and
modification time, so one delivered anew under an old name is a new file.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.columns import normalize_path, ts_literal
from stratum.operators.ordering import with_global_position
from stratum.settings import (
    LEDGER_MESSAGE_IN_PLACE,
    LEDGER_MESSAGE_LOST,
    LEDGER_MESSAGE_NOT_MOVED,
    LEDGER_MESSAGE_PROCESSED,
    LEDGER_MESSAGE_UNCONFIRMED,
    LEDGER_MESSAGE_UNKNOWN,
)

LEDGER_COLUMNS = (
    "nome_fonte",
    "nome_arquivo",
    "caminho_origem",
    "caminho_destino",
    "tabela_bronze",
    "status_processamento",
    "mensagem",
    "data_processamento",
)

FILE_KEY = ("caminho_origem", "tamanho", "data_modificacao")
LOG_COLUMNS = ("nome_fonte", *FILE_KEY, "batch_id", "etapa", "linhas", "caminho_destino", "data_registro")
INTENT, COMMITTED, EMPTY, MOVING = "INTENCAO", "CONFIRMADO", "SEM_LINHAS", "MOVIMENTACAO"


def listed_files(listing: DataFrame) -> DataFrame:
    """A listing of ``sources.raw.list_files`` by the log's key columns."""
    return listing.select(
        normalize_path("path").alias("caminho_origem"),
        F.col("length").cast("bigint").alias("tamanho"),
        F.col("modification_time").alias("data_modificacao"),
    )


def log_stage(log: DataFrame, *stages: str) -> DataFrame:
    return log.filter(F.col("etapa").isin(*stages))


def pending_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files that no batch has committed; Bronze itself is not read."""
    return files.join(log_stage(log, COMMITTED, EMPTY).select(*FILE_KEY).distinct(), list(FILE_KEY), "left_anti")


def interrupted_batches(log: DataFrame) -> DataFrame:
    """Intent rows of batches that were never committed."""
    closed = log_stage(log, COMMITTED, EMPTY).select("nome_fonte", "batch_id").distinct()
    return log_stage(log, INTENT).join(closed, ["nome_fonte", "batch_id"], "left_anti")


def log_rows(files: DataFrame, source: str, batch_id: str, stage: str, run_ts: datetime, **values: Column) -> DataFrame:
    """Log rows of one stage for ``files`` (key columns)."""
    fixed = {
        "nome_fonte": F.lit(source),
        "batch_id": F.lit(batch_id),
        "etapa": F.lit(stage),
        "linhas": F.lit(None).cast("bigint"),
        "caminho_destino": F.lit(None).cast("string"),
        "data_registro": ts_literal(run_ts, "timestamp"),
    }
    columns = {k: F.col(k) for k in FILE_KEY} | fixed | values
    return files.select(*[columns[c].alias(c) for c in LOG_COLUMNS])


def commit_rows(intent: DataFrame, written: DataFrame, run_ts: datetime) -> DataFrame:
    """Closing rows of a batch: each file with the rows that Bronze holds of it.

    ``written`` is the batch's own part of Bronze.
    """
    rows = written.groupBy(normalize_path("arquivo_origem").alias("caminho_origem")).agg(F.count(F.lit(1)).alias("n"))
    found = intent.drop("linhas", "etapa", "data_registro").join(rows, "caminho_origem", "left")
    return found.select(
        "*",
        F.when(F.col("n") > 0, COMMITTED).otherwise(EMPTY).alias("etapa"),
        F.coalesce("n", F.lit(0)).alias("linhas"),
        ts_literal(run_ts, "timestamp").alias("data_registro"),
    ).select(*LOG_COLUMNS)


def planned_moves(files: DataFrame, log: DataFrame, archived: DataFrame, folder: str, run_ts: datetime) -> DataFrame:
    """Destination below ``folder`` of each committed file that is still at its source.

    A move planned earlier keeps its destination.  A name that the archive
    holds, or that another plan or another file of this one has, gets the run's
    time before its extension, and of several files the position as well.
    """
    committed = log_stage(log, COMMITTED).select(*FILE_KEY).distinct()
    plans = log_stage(log, MOVING).select(*FILE_KEY, "caminho_destino")
    waiting = files.join(committed, list(FILE_KEY)).join(plans.select(*FILE_KEY), list(FILE_KEY), "left_anti")
    name = F.element_at(F.split("caminho_origem", "/"), -1)
    taken = archived.select(normalize_path("path").alias("plain")).union(plans.select(F.col("caminho_destino").alias("plain")))
    at = F.row_number().over(Window.partitionBy("plain").orderBy(*FILE_KEY))
    marked = (
        waiting.withColumn("plain", F.concat(F.lit(folder.rstrip("/") + "/"), name))
        .withColumn("at", at)
        .join(taken.distinct().withColumn("taken", F.lit(True)), "plain", "left")
    )
    stamp = run_ts.strftime("_%Y%m%d_%H%M%S_%f")
    mark = F.concat(F.lit(stamp), F.when(F.col("at") > 1, F.concat(F.lit("_"), F.col("at"))).otherwise(""))
    # the last dot of the name, not one of a folder
    dotted = F.regexp_replace("plain", r"^(.*/[^/]*)(\.[^./]*)$", "$1\u0000$2")
    parts = F.split(dotted, "\u0000")
    renamed = F.concat(parts[0], mark, F.coalesce(F.get(parts, 1), F.lit("")))
    free = F.col("taken").isNull() & (F.col("at") == 1)
    return marked.select(*FILE_KEY, F.when(free, F.col("plain")).otherwise(renamed).alias("caminho_destino"))


def reconcile_files(
    files: DataFrame,
    archived: DataFrame,
    log: DataFrame,
    source: str,
    bronze_table: str,
    run_ts: datetime,
    moves: bool = True,
    ts_type: str = "timestamp",
) -> DataFrame:
    """One ledger row per file, from what is found: the source's listing, the archive's and the log.

    ``files`` has the log's key columns, ``archived`` a ``path``.  A full outer
    join tells:

    * ``NAO_CONFIRMADO``: listed, and no batch committed it with a row;
    * ``PROCESSADO``: committed, and at its destination (without ``moves``: at its source);
    * ``ERRO_MOVIMENTACAO``: committed, not at its destination, still at its source;
    * ``ERRO``: committed and in neither place, or in the archive without a commit.
    """
    keys = list(FILE_KEY)
    committed = log_stage(log, COMMITTED).select(*keys).distinct().withColumn("committed", F.lit(True))
    plans = log_stage(log, MOVING).groupBy(*keys).agg(F.max("caminho_destino").alias("caminho_destino"))
    known = committed.join(plans, keys, "left")
    here = files.select(*keys).distinct().withColumn("listed", F.lit(True))
    there = archived.select(normalize_path("path").alias("caminho_destino")).distinct().withColumn("moved", F.lit(True))
    found = here.join(known, keys, "full_outer").join(there, "caminho_destino", "full_outer")
    listed, done, moved = (F.coalesce(c, F.lit(False)) for c in ("listed", "committed", "moved"))
    there_now = moved if moves else listed
    cases = [
        (done & there_now, "PROCESSADO", LEDGER_MESSAGE_PROCESSED if moves else LEDGER_MESSAGE_IN_PLACE),
        (done & listed, "ERRO_MOVIMENTACAO", LEDGER_MESSAGE_NOT_MOVED),
        (done, "ERRO", LEDGER_MESSAGE_LOST),
        (listed, "NAO_CONFIRMADO", LEDGER_MESSAGE_UNCONFIRMED),
    ]
    status, message = F.lit("ERRO"), F.lit(LEDGER_MESSAGE_UNKNOWN)
    for condition, code, text in reversed(cases):
        status, message = F.when(condition, code).otherwise(status), F.when(condition, text).otherwise(message)
    target = F.col("caminho_destino") if moves else F.col("caminho_origem")
    return found.select(
        F.lit(source).alias("nome_fonte"),
        F.element_at(F.split(F.coalesce("caminho_origem", "caminho_destino"), "/"), -1).alias("nome_arquivo"),
        "caminho_origem",
        F.when(there_now, target).alias("caminho_destino"),
        F.lit(bronze_table).alias("tabela_bronze"),
        status.alias("status_processamento"),
        message.alias("mensagem"),
        ts_literal(run_ts, ts_type).alias("data_processamento"),
    )


def changed_rows(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose file has no ledger row yet, or whose latest one says something else."""
    said = ledger.groupBy("nome_fonte", F.coalesce("caminho_origem", "caminho_destino").alias("arquivo")).agg(
        F.max_by(F.struct("caminho_destino", "status_processamento"), "data_processamento").alias("latest")
    )
    new = found.withColumn("arquivo", F.coalesce("caminho_origem", "caminho_destino")).join(
        said, ["nome_fonte", "arquivo"], "left"
    )
    same = F.struct("caminho_destino", "status_processamento").eqNullSafe(F.col("latest"))
    return new.filter(~same).select(*found.columns)


def loaded_files(bronze: DataFrame, column: str = "arquivo_origem") -> DataFrame:
    """Distinct non-blank source files present in a Bronze frame (empty if the column is missing)."""
    if column not in bronze.columns:
        return bronze.sparkSession.createDataFrame([], "path string")
    p = normalize_path(column)
    return bronze.select(p.alias("path")).filter(F.col("path") != "").distinct()


def confirmed(pending: DataFrame, loaded: DataFrame, path_col: str = "path") -> DataFrame:
    """Pending files whose path reached Bronze."""
    return pending.join(loaded.select(F.col("path").alias(path_col)), path_col, "left_semi")


def unconfirmed(pending: DataFrame, loaded: DataFrame, path_col: str = "path") -> DataFrame:
    """Pending files with no row in Bronze (e.g. an empty or failed file)."""
    return pending.join(loaded.select(F.col("path").alias(path_col)), path_col, "left_anti")


def file_status(
    pending: DataFrame,
    loaded: DataFrame,
    source: str,
    bronze_table: str,
    run_ts: datetime,
    archive_root: str,
    path_col: str = "path",
    ts_type: str = "timestamp",
) -> DataFrame:
    """One ledger row per pending file: PROCESSADO when its rows are in Bronze
    (the file stream's archive step moves it), NAO_CONFIRMADO otherwise.
    ``loaded`` is distinct, so the left join cannot multiply rows."""
    flags = loaded.select(F.col("path").alias("__p"), F.lit(True).alias("__loaded"))
    p = pending.withColumn("__norm", normalize_path(path_col))
    joined = p.join(flags, p["__norm"] == flags["__p"], "left")
    ok = F.col("__loaded").isNotNull()
    name = F.element_at(F.split("__norm", "/"), -1)
    return joined.select(
        F.lit(source).alias("nome_fonte"),
        name.alias("nome_arquivo"),
        F.col("__norm").alias("caminho_origem"),
        F.when(ok, F.concat(F.lit(archive_root.rstrip("/") + "/" + source + "/"), name)).alias("caminho_destino"),
        F.lit(bronze_table).alias("tabela_bronze"),
        F.when(ok, F.lit("PROCESSADO")).otherwise(F.lit("NAO_CONFIRMADO")).alias("status_processamento"),
        F.when(ok, F.lit(LEDGER_MESSAGE_PROCESSED)).otherwise(F.lit(LEDGER_MESSAGE_UNCONFIRMED)).alias("mensagem"),
        ts_literal(run_ts, ts_type).alias("data_processamento"),
    )


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Files and last run per source and status."""
    return (
        ledger.groupBy("nome_fonte", "status_processamento")
        .agg(F.count(F.lit(1)).alias("quantidade_arquivos"), F.max("data_processamento").alias("ultima_execucao"))
        .orderBy("nome_fonte", "status_processamento")
    )


def ledger_history(ledger: DataFrame) -> DataFrame:
    """Ledger rows newest first, with their position as a column."""
    order = [F.col("data_processamento").desc(), F.col("caminho_origem").asc()]
    return with_global_position(ledger, order, "posicao")


def remaining_files(ledger: DataFrame) -> DataFrame:
    """Files per source still waiting (not confirmed) and already processed."""
    return ledger.groupBy("nome_fonte").agg(
        F.count_if(F.col("status_processamento") != "PROCESSADO").alias("arquivos_restantes"),
        F.count_if(F.col("status_processamento") == "PROCESSADO").alias("arquivos_processados"),
    )
