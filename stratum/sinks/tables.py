"""Table sinks: alignment, overwrite, append, idempotent quarantine, SCD2/MERGE commits.

Tables are catalog tables (``saveAsTable``) in Parquet.  Plain Parquet has no
MERGE and refuses to overwrite a table the same query reads, so transforms
return the complete new state and the commit goes through a staging table:

1. the new state is written to ``<table>__staging`` (a durable copy that cuts
   the lineage to the target -- no ``localCheckpoint``);
2. the target is overwritten from the staging table;
3. the staging table is dropped.

A crash between 1 and 3 leaves the staging table behind; ``recover`` redoes
step 2-3 from it, so a half-finished commit is never visible after restart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.columns import row_fingerprint
from stratum.settings import LINEAGE_COLUMNS, SCD_CURRENT, SCD_END, SCD_START
from stratum.functions.columns import ts_literal

STAGING_SUFFIX = "__staging"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_database(spark: SparkSession, name: str) -> None:
    database = name.split(".")[0] if "." in name else name
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Same columns, order and types as ``schema``: present columns are cast
    (``try_cast``: text that does not fit becomes NULL instead of failing),
    missing ones become typed NULLs, extra ones are dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def align_to_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return align_to_schema(df, spark.table(name).schema)


def write_snapshot(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Overwrite (schema replaced).  ``df`` must not read ``name`` itself; use
    ``commit_state`` for that.

    ``bucket_by=(n, keys)`` writes a bucketed, key-sorted table: later joins on
    ``keys`` read it already hash-partitioned and shuffle only the other side.
    """
    ensure_database(df.sparkSession, name)
    w = df.write.format("parquet").mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    w.saveAsTable(name)


def ensure_table(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create an empty table with ``df``'s schema if it does not exist."""
    if not table_exists(spark, name):
        write_snapshot(df.limit(0), name, partition_by)


def _with_new_columns(df: DataFrame, name: str) -> StructType:
    """The table's schema after adding the columns that only ``df`` has."""
    spark = df.sparkSession
    have = spark.table(name).schema.fieldNames()
    new = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    return spark.table(name).schema


def append(df: DataFrame, name: str, merge_schema: bool = False) -> None:
    """Append; with ``merge_schema`` new columns are added to the table first
    (the frame is aligned to the union of both schemas)."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        write_snapshot(df, name)
        return
    target = _with_new_columns(df, name) if merge_schema else spark.table(name).schema
    align_to_schema(df, target).write.format("parquet").mode("append").insertInto(name)


def replace_partition(df: DataFrame, name: str, column: str, value: str) -> None:
    """Make ``df`` the whole content of one partition of a table partitioned by ``column``.

    New columns are added to the table.  Written again after a crash, the
    partition holds the rows once; no other partition is touched.
    """
    spark = df.sparkSession
    df = df.withColumn(column, F.lit(value))
    ensure_table(spark, df, name, [column])
    if [c.name for c in spark.catalog.listColumns(name) if c.isPartition] != [column]:
        raise ValueError(f"{name} is not partitioned by {column}")
    schema = _with_new_columns(df, name)
    view = f"__part_{uuid.uuid4().hex}"
    align_to_schema(df, schema).drop(column).createOrReplaceTempView(view)
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    # a static partition spec: only this partition can be replaced
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{column}` = '{quoted}') SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


QUARANTINE_KEY = "chave_conteudo"
QUARANTINE_COUNT = "ocorrencias"
# columns that tell when and from where a row came, not what it says
VOLATILE_COLUMNS = frozenset(
    {*LINEAGE_COLUMNS, "id_lote", "data_hora_ingestao", "data_processamento", "hash_registro"} - {"hash_linha", "schema_version"}
)
BATCH_COLUMNS = ("batch_id", "id_lote")


def quarantine_rows(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per distinct content of rejected rows, with how often it occurs.

    ``chave_conteudo`` is the fingerprint of all columns but those of lineage,
    so a row that comes again in another batch is the same row; equal rows
    within a batch count each.  With ``history`` only what it lacks is returned:
    contents it does not have, and the further occurrences of those it has.
    Of the history two columns are read, and nothing is hashed again.
    """
    content = [c for c in df.columns if c not in VOLATILE_COLUMNS | {QUARANTINE_KEY, QUARANTINE_COUNT}]
    row = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    batch = [F.col(c) for c in BATCH_COLUMNS if c in df.columns]
    per_batch = (
        df.select(row_fingerprint(df.select(*content)).alias(QUARANTINE_KEY), F.struct(*batch, F.lit(0)).alias("__lote"), row.alias("__row"))
        .groupBy(QUARANTINE_KEY, "__lote")
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__row"))
    )
    found = per_batch.groupBy(QUARANTINE_KEY).agg(F.max("__n").alias(QUARANTINE_COUNT), F.min("__row").alias("__row"))
    if history is not None:
        had = history.groupBy(QUARANTINE_KEY).agg(F.sum(QUARANTINE_COUNT).alias("__had"))
        more = F.col(QUARANTINE_COUNT) - F.coalesce("__had", F.lit(0))
        found = found.join(had, QUARANTINE_KEY, "left").withColumn(QUARANTINE_COUNT, more)
        found = found.filter(F.col(QUARANTINE_COUNT) > 0)
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns], QUARANTINE_KEY, QUARANTINE_COUNT)


def append_quarantine(df: DataFrame, name: str) -> None:
    """Append the rejected rows that the table does not hold yet (``quarantine_rows``).

    A repeated load adds nothing; columns the table lacks are added to it.
    """
    spark = df.sparkSession
    history = spark.table(name) if table_exists(spark, name) else None
    append(quarantine_rows(df, history), name, merge_schema=True)


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Fail when a key occurs twice (MERGE / SCD2 sources must be unique)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} has duplicate keys {list(keys)}: {dup[0].asDict()}")


def recover(spark: SparkSession, name: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None) -> bool:
    """Finish a commit interrupted after its staging table was written."""
    staging = name + STAGING_SUFFIX
    if not table_exists(spark, staging):
        return False
    _publish(spark, staging, name, partition_by, bucket_by)
    return True


def _publish(
    spark: SparkSession, staging: str, name: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None
) -> None:
    write_snapshot(spark.table(staging), name, partition_by, bucket_by)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")


def commit_state(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None
) -> None:
    """Replace ``name`` with ``df`` even when ``df`` reads ``name`` (via staging)."""
    spark = df.sparkSession
    recover(spark, name, partition_by, bucket_by)
    staging = name + STAGING_SUFFIX
    write_snapshot(df, staging, partition_by, bucket_by)
    _publish(spark, staging, name, partition_by, bucket_by)


SCD_STAGING_SUFFIX = "__scd_staging"


def commit_scd2(
    changes: DataFrame,
    name: str,
    current: str = SCD_CURRENT,
    end: str = SCD_END,
    run_ts=None,
    start: str = SCD_START,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    keys: Sequence[str] | None = None,
) -> bool:
    """Commit the output of ``scd2_apply`` (new active set + versions it closed).

    The table is partitioned by the current flag.  Only the active partition is
    replaced (dynamic partition overwrite); closed versions are appended to the
    history partition, skipping any already there (same fingerprint), so
    history is never rewritten and a repeated commit adds nothing.

    With ``run_ts`` the commit is skipped when the run neither closed a version
    nor has an active one that the table lacks (the staged rows are checked,
    not the source lineage), and False is returned.  Given ``keys``, two active
    rows of one key are an error.

    ``bucket_by=(n, keys)`` creates the table bucketed by its keys, so the
    next ``scd2_apply`` (with ``null_safe=False``) joins the active set without
    shuffling it; later inserts keep the table's bucketing.
    """
    spark = changes.sparkSession
    recover_scd2(spark, name, current, end)
    if keys:
        assert_unique_keys(changes.filter(F.col(current)), keys, f"active set of {name}")
    if not table_exists(spark, name):
        write_snapshot(changes, name, [current], bucket_by)
        return True
    staging = name + SCD_STAGING_SUFFIX
    write_snapshot(changes, staging)
    if run_ts is not None:
        staged = align_to_schema(spark.table(staging), spark.table(name).schema)
        active = spark.table(name).filter(F.col(current)).select(*staged.columns)
        # a closed version, or an active one that the table doesn't have
        # (null-safe on all columns), is a change; a deleted key closes one
        closed = staged.filter(~F.col(current)).limit(1).count()
        if not closed and staged.filter(F.col(current)).exceptAll(active).limit(1).count() == 0:
            spark.sql(f"DROP TABLE IF EXISTS {staging}")
            return False
    _publish_scd2(spark, staging, name, current, end)
    return True


def recover_scd2(spark: SparkSession, name: str, current: str = SCD_CURRENT, end: str = SCD_END) -> bool:
    staging = name + SCD_STAGING_SUFFIX
    if not table_exists(spark, staging):
        return False
    _publish_scd2(spark, staging, name, current, end)
    return True


def _publish_scd2(spark: SparkSession, staging: str, name: str, current: str, end: str) -> None:
    schema = spark.table(name).schema
    staged = align_to_schema(spark.table(staging), schema)
    data_cols = [f.name for f in schema.fields if f.name != current]
    view = f"__scd_active_{abs(hash(name))}"
    staged.filter(F.col(current)).select(*data_cols).createOrReplaceTempView(view)
    # a static partition spec: only the active partition can be replaced
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{current}` = true) SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    closed = staged.filter(~F.col(current))
    # history rows that could be these same versions: same end time (semi join,
    # stays distributed however many distinct end times a run produces)
    history = spark.table(name).filter(~F.col(current))
    already = history.join(closed.select(end).distinct(), end, "left_semi").select(*schema.fieldNames())
    fp = "__fp"
    new_closed = closed.withColumn(fp, row_fingerprint(closed)).join(
        already.select(row_fingerprint(already).alias(fp)), fp, "left_anti"
    ).drop(fp)
    new_closed.write.format("parquet").mode("append").insertInto(name)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")


CONTROL_TABLES_DDL = {
    "lotes_arquivos": "nome_fonte STRING, caminho_origem STRING, tamanho BIGINT, data_modificacao TIMESTAMP, batch_id STRING, "
    "etapa STRING, linhas BIGINT, caminho_destino STRING, data_registro TIMESTAMP",
    "metricas_qualidade_prata": "fonte STRING, quantidade_entrada BIGINT, quantidade_validos BIGINT, quantidade_invalidos BIGINT, data_processamento TIMESTAMP",
    "controle_arquivos_processados": "nome_fonte STRING, nome_arquivo STRING, caminho_origem STRING, caminho_destino STRING, tabela_bronze STRING, "
    "status_processamento STRING, mensagem STRING, data_processamento TIMESTAMP",
    "execucoes_pipeline": "notebook STRING, status STRING, inicio STRING, fim STRING, duracao_segundos DOUBLE, retorno STRING, erro STRING",
}


def create_control_tables(spark: SparkSession, database: str) -> None:
    """Control tables with explicit DDL (created once, appended to afterwards)."""
    ensure_database(spark, database)
    for table, columns in CONTROL_TABLES_DDL.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet")


MERGE_STAGING_SUFFIX = "__merge_staging"
KEY_BUCKET = "faixa_chave"


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    update=None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    key_buckets: int | None = None,
) -> None:
    """MERGE upsert into a catalog table (plain Parquet has no row-level MERGE).

    The source keys must be unique.  By default the new state is rewritten in
    full through staging; with ``bucket_by=(n, keys)`` the table is kept
    bucketed by its keys, so the rewrite's join reads it without shuffling it.

    With ``key_buckets`` the table is partitioned by ``faixa_chave``, a hash of
    its keys, and only the partitions that hold a key of the source are read
    and rewritten; the files of the others stay.  The staged partitions are the
    commit marker: found by a later call, they are published before the table
    is read, so a crash at any step loses and repeats nothing.
    """
    from stratum.operators.upsert import merge_upsert

    recover(spark, name, (), bucket_by)  # before the target is read: an interrupted commit may have dropped it
    recover_merge(spark, name)
    assert_unique_keys(source, keys)
    exists = table_exists(spark, name)
    if key_buckets is None:
        commit_state(merge_upsert(spark.table(name), source, keys, update) if exists else source, name, (), bucket_by)
        return
    if not exists:
        write_snapshot(_with_key_bucket(source, source.schema, keys, key_buckets), name, [KEY_BUCKET])
        return
    target = spark.table(name)
    if KEY_BUCKET not in target.columns:
        raise ValueError(f"{name} is not partitioned by {KEY_BUCKET}")
    touched = _with_key_bucket(source, target.schema, keys, key_buckets).select(KEY_BUCKET).distinct().collect()
    if not touched:
        return
    # at most ``key_buckets`` numbers, which prune the target's partitions
    old = target.filter(F.col(KEY_BUCKET).isin([row[KEY_BUCKET] for row in touched])).drop(KEY_BUCKET)
    merged = merge_upsert(old, source, keys, update)
    staging = name + MERGE_STAGING_SUFFIX
    write_snapshot(_with_key_bucket(merged, merged.schema, keys, key_buckets), staging, [KEY_BUCKET])
    recover_merge(spark, name)


def recover_merge(spark: SparkSession, name: str) -> bool:
    """Publish the staged partitions of a merge, if there are any."""
    staging = name + MERGE_STAGING_SUFFIX
    if not table_exists(spark, staging):
        return False
    # in a session of its own: this write alone is dynamic, whatever the caller's says
    # (insertInto takes no such option and would replace the whole table)
    writer = spark.newSession()
    writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = align_to_schema(writer.table(staging), writer.table(name).schema)
    rows.write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return True


def _with_key_bucket(df: DataFrame, schema: StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with its key bucket; the keys are hashed as the table has them."""
    typed = [F.col(f"`{k}`").cast(schema[k].dataType) for k in keys]
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int"))
