"""Queries over raw files that Spark writes from the driver tables.

Each query exports a whole table to text files in a fresh folder below the
shared checkpoint folder (never a machine-local temp dir), then reads it back
through the Bronze readers.  Machine-dependent lineage (path, size, mtime,
ingestion time) is dropped from the compared output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans.driver_model import RUN_TS, table
from stratum.plans.registry import register
from stratum.session import scratch_path
from stratum.settings import SourceSpec
from stratum.sources.raw import add_lineage, read_raw

BATCH = "lote-arquivos"
VOLATILE = ["arquivo_origem", "nome_arquivo_origem", "tamanho_arquivo_origem", "data_modificacao_arquivo", "timestamp_ingestao"]


def _folder(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, "raw-exports", f"{kind}-{uuid.uuid4().hex}")


def _stable(df: DataFrame) -> DataFrame:
    return df.drop(*VOLATILE)


def _fp_sql(cols) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '∅')" for c in sorted(cols))
    return f"sha256(concat_ws('||', {parts}))"


# customer as CSV text, several files (one per market segment -> same header)
_CUST_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer_csv(spark: SparkSession, sf: str) -> str:
    folder = _folder(spark, "customer-csv")
    c = table(spark, sf, "customer")
    c.select(*[F.col(x).cast("string").alias(x) for x in _CUST_TEXT]).write.option("header", "true").csv(folder)
    return folder


_CUST_SQL = ", ".join(f"CAST({x} AS VARCHAR) AS {x}" for x in _CUST_TEXT)
_CSV_ORACLE = (
    f"SELECT {_CUST_SQL}, CAST(NULL AS VARCHAR) AS _registro_corrompido, DATE '2026-01-01' AS data_ingestao, "
    f"'{BATCH}' AS batch_id, {_fp_sql(_CUST_TEXT + ['_registro_corrompido']).replace('CAST(_registro_corrompido AS VARCHAR)', 'CAST(NULL AS VARCHAR)')} AS hash_linha, "
    f"'v1' AS schema_version FROM customer"
)


@register("read_raw_csv", _CSV_ORACLE)
def q_read_raw_csv(spark, sf):
    raw = read_raw(spark, _customer_csv(spark, sf), "csv")
    return _stable(add_lineage(raw, BATCH, "v1", RUN_TS))


_ORDERS_JSON = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@register(
    "read_raw_json",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders",
)
def q_read_raw_json(spark, sf):
    folder = _folder(spark, "orders-json")
    table(spark, sf, "orders").select(*_ORDERS_JSON).write.json(folder)
    raw = read_raw(spark, folder, "json")
    # every primitive arrives as text; the corrupt-record column exists only when a line is malformed
    return raw.select(*_ORDERS_JSON)


@register(
    "evolving_union",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, "
    "CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS l_linestatus, CAST(NULL AS VARCHAR) AS _registro_corrompido FROM lineitem",
)
def q_evolving_union(spark, sf):
    """Two header layouts in one folder: (orderkey, linenumber, returnflag) for
    returned lines, (linenumber, orderkey, linestatus, returnflag) for the rest.
    Read by name, nothing shifts by position."""
    folder = _folder(spark, "lineitem-evolving")
    li = table(spark, sf, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]])
    li.filter(F.col("l_returnflag").eqNullSafe("R")).select("l_orderkey", "l_linenumber", "l_returnflag").write.option("header", "true").csv(folder + "/a")
    li.filter(~F.col("l_returnflag").eqNullSafe("R")).select("l_linenumber", "l_orderkey", "l_linestatus", "l_returnflag").write.option("header", "true").csv(folder + "/b")
    raw = read_raw(spark, [folder + "/a", folder + "/b"], "csv")
    return raw.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "_registro_corrompido")


# customer again, as a spreadsheet would export it: quoted header with a comma in a
# name, folders with spaces, two layouts, one segment's lines without their last
# field and another's with one too many.  Lines are cut at the separator, so the
# two kinds of broken lines keep the fields that they have.
_MESSY_NAMES = ["código", "nome, completo", "saldo"]
_MESSY_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS "código", c_name AS "nome, completo",
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_acctbal AS VARCHAR) END AS saldo,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN c_mktsegment END AS segmento,
  CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS VARCHAR) || ',' || c_name
       WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_acctbal AS VARCHAR) || ',sobra'
  END AS _registro_corrompido,
  c_mktsegment || ' fim' AS pasta
FROM customer
"""


@register("read_raw_csv_messy", _MESSY_SQL)
def q_read_raw_csv_messy(spark, sf):
    folder = _folder(spark, "customer messy")
    c = table(spark, sf, "customer").select(*[F.col(x).cast("string").alias(x) for x in _CUST_TEXT])
    segment = F.col("c_mktsegment")
    full = F.concat_ws(",", "c_custkey", "c_name", "c_acctbal")
    line = (
        F.when(segment == "BUILDING", F.concat_ws(",", "c_custkey", "c_name"))
        .when(segment == "FURNITURE", F.concat(full, F.lit(",sobra")))
        .when(segment == "MACHINERY", F.concat_ws(",", "c_mktsegment", "c_acctbal", "c_name", "c_custkey"))
        .otherwise(full)
    )
    other = '"segmento","saldo","nome, completo","código"'
    header = F.when(segment == "MACHINERY", other).otherwise('"código", "nome, completo" ,saldo')
    where = F.concat(segment, F.lit(" fim")).alias("pasta")
    lines = c.select(where, F.lit(1).alias("pos"), "c_custkey", line.alias("value"))
    heads = c.select(where, F.lit(0).alias("pos"), F.lit(None).cast("string").alias("c_custkey"), header.alias("value")).distinct()
    # one file a segment, its header first
    rows = lines.union(heads).repartition("pasta").sortWithinPartitions("pasta", "pos", "c_custkey")
    rows.select("pasta", "value").write.partitionBy("pasta").text(folder)
    raw = read_raw(spark, folder + "/*", "csv")
    place = F.element_at(F.split("_meta_path", "/"), -2)
    return raw.select(*_MESSY_NAMES, "segmento", "_registro_corrompido", F.substring_index(place, "=", -1).alias("pasta"))


@register(
    "ledger_after_run",
    "SELECT 'clientes' AS nome_fonte, 'PROCESSADO' AS status_processamento, 'Arquivo confirmado na Bronze e movido com sucesso.' AS mensagem, "
    "count(*) AS linhas FROM customer GROUP BY c_mktsegment "
    "UNION ALL SELECT 'clientes', 'NAO_CONFIRMADO', 'O arquivo não foi encontrado na coluna arquivo_origem da tabela Bronze.', 0",
)
def q_ledger_after_run(spark, sf):
    """The file ledger after two runs over one file a market segment and one file with a header alone."""
    from stratum.plans import medallion
    from stratum.settings import Settings

    folder, run = _folder(spark, "customer-ledger"), uuid.uuid4().hex[:10]
    c = table(spark, sf, "customer").select(*[F.col(x).cast("string").alias(x) for x in _CUST_TEXT])
    split = c.withColumn("pasta", F.col("c_mktsegment")).repartition("pasta").sortWithinPartitions("pasta")
    split.write.partitionBy("pasta").option("header", "true").csv(f"{folder}/clientes")
    c.limit(0).coalesce(1).write.option("header", "true").csv(f"{folder}/clientes/pasta=vazia")
    settings = Settings(
        raw_root=folder,
        database_bronze=f"ledger_b_{run}",
        database_control=f"ledger_c_{run}",
        sources={"clientes": SourceSpec("clientes", f"{folder}/clientes/*", "csv", f"ledger_b_{run}.clientes")},
        archive_root=f"{folder}/processados",
    )
    for database in (settings.database_bronze, settings.database_control):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_path(spark, 'ledger-db', database)}'")
    for i in range(2):  # the second run finds nothing new
        medallion.ingest_source(spark, settings, "clientes", f"lote-{i}", RUN_TS)
        medallion.run_ledger(spark, settings, RUN_TS)
    log = spark.table(f"{settings.database_control}.lotes_arquivos").filter(F.col("linhas").isNotNull())
    rows = spark.table(f"{settings.database_control}.controle_arquivos_processados")
    joined = rows.join(log.select("caminho_origem", "linhas"), "caminho_origem")
    return joined.select("nome_fonte", "status_processamento", "mensagem", "linhas")


@register(
    "file_stream",
    f"SELECT {_CUST_SQL}, CAST(NULL AS VARCHAR) AS _registro_corrompido, 'v1' AS schema_version FROM customer",
)
def q_file_stream(spark, sf):
    """customer CSV files picked up by the availableNow file stream into a Bronze table."""
    from stratum.sinks.tables import table_exists
    from stratum.streaming.file_stream import start_bronze_stream

    folder = _customer_csv(spark, sf)
    run = uuid.uuid4().hex[:10]
    database = f"stream_{run}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_path(spark, 'stream-db', run)}'")
    bronze = f"{database}.clientes"
    spec = SourceSpec("clientes", folder, "csv", bronze)
    q = start_bronze_stream(spark, spec, bronze, scratch_path(spark, "stream-ckpt", run), run_id=run)
    q.awaitTermination()
    if not table_exists(spark, bronze):
        raise RuntimeError("file stream wrote nothing")
    return spark.table(bronze).select(*_CUST_TEXT, "_registro_corrompido", "schema_version")
