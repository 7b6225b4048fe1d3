"""Incremental Bronze ingestion with Structured Streaming.

Replaces the original driver loop that listed folders, moved files one by one
and committed one ledger row per file:

* a file stream over the source folder yields each *new* file exactly once
  (the streaming checkpoint remembers what was read; no file needs moving);
* ``cleanSource=archive`` moves files already committed to an archive folder
  (Spark archives a batch's files once a later batch commits);
* ``foreachBatch`` reads the new files with the batch reader (per-header
  grouping, corrupt-record capture, lineage) and writes them to the batch's own
  partition of Bronze, then one ledger row per file;
* ``trigger(availableNow=True)`` processes everything pending and stops, so the
  same code serves scheduled batch runs and continuous runs.

A micro-batch replayed after a failure is detected by its partition of Bronze
and skipped, so Bronze gets each file once.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.operators import ledger
from stratum.settings import SourceSpec
from stratum.sinks import tables as sink
from stratum.sources.raw import add_lineage, literal_path, read_raw


# The binary file source's fixed schema (streams need it up front).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming frame of file paths appearing under ``path`` (content never read)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modification_time"))


def _already_loaded(spark: SparkSession, table: str, batch_id: str) -> bool:
    if not sink.table_exists(spark, table):
        return False
    return spark.table(table).filter(F.col("batch_id") == batch_id).limit(1).count() > 0


def ingest_batch(
    spark: SparkSession,
    files: DataFrame,
    spec: SourceSpec,
    bronze_table: str,
    ledger_table: str | None,
    batch_id: str,
    schema_version: str,
    archive_root: str,
) -> int:
    """Load one micro-batch of files into Bronze; returns the number of files."""
    paths = sorted(r["path"] for r in files.select("path").collect())  # file names only (control data)
    if not paths:
        return 0
    # a batch is a replay only if it has the same files: a new checkpoint counts
    # its batches from 0 again
    batch_id = f"{batch_id}-{hashlib.sha256(chr(10).join(paths).encode()).hexdigest()[:16]}"
    replayed = _already_loaded(spark, bronze_table, batch_id)
    if not replayed:
        raw = read_raw(spark, [literal_path(path) for path in paths], spec.fmt)
        sink.replace_partition(add_lineage(raw, batch_id, schema_version), bronze_table, "batch_id", batch_id)
    if ledger_table and replayed and sink.table_exists(spark, ledger_table):
        # the first attempt may have ended between the two appends
        files = ledger.unconfirmed(
            files.withColumn("path", ledger.normalize_path("path")),
            spark.table(ledger_table).select(F.col("caminho_origem").alias("path")).distinct(),
        )
    if ledger_table:
        loaded = ledger.loaded_files(spark.table(bronze_table).filter(F.col("batch_id") == batch_id))
        rows = ledger.file_status(files, loaded, spec.name, bronze_table, datetime.now(timezone.utc).replace(tzinfo=None), archive_root)
        sink.append(rows, ledger_table)
    return len(paths)


def start_bronze_stream(
    spark: SparkSession,
    spec: SourceSpec,
    bronze_table: str,
    checkpoint: str,
    archive_dir: str | None = None,
    ledger_table: str | None = None,
    schema_version: str = "v1",
    run_id: str = "stream",
    available_now: bool = True,
    max_files_per_trigger: int | None = 10_000,
) -> StreamingQuery:
    """Start the file stream for one source; ``query.awaitTermination()`` to wait."""
    files = new_files(spark, spec.path, max_files_per_trigger, archive_dir)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        ingest_batch(spark, batch, spec, bronze_table, ledger_table, f"{run_id}-{epoch_id}", schema_version, archive_dir or "")

    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
