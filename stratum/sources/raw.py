"""Raw file sources for Bronze: CSV / JSON-lines with file lineage.

* Every value is read as text (no inference), so Bronze never loses data to a
  wrong guess; typing happens in silver with ``try_*`` parsers.
* Files whose headers differ are read per layout and unioned *by name* (a plain
  folder read maps later files by position, silently swapping columns when
  their order differs).  Headers are told from the first line of each file, so
  the files themselves are read once.
* Malformed rows are kept whole in the corrupt-record column.
* File path, name, size and modification time come from the hidden
  ``_metadata`` column of Spark's file sources; paths are plain, as a listing
  gives them, not URL-encoded.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.functions.columns import row_fingerprint
from stratum.settings import CORRUPT_COLUMN, RAW_FORMATS
from stratum.functions.columns import ts_literal

META_COLUMNS = {
    "_meta_path": "file_path",
    "_meta_name": "file_name",
    "_meta_size": "file_size",
    "_meta_mtime": "file_modification_time",
}

META_TYPES = {"_meta_path": "string", "_meta_name": "string", "_meta_size": "bigint", "_meta_mtime": "timestamp"}


def check_format(fmt: str) -> str:
    f = (fmt or "").lower().strip()
    if f not in RAW_FORMATS:
        raise ValueError(f"Unsupported raw format: {fmt!r}; use one of {', '.join(RAW_FORMATS)}")
    return f


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files under ``path`` (hidden ``_``/``.`` names and empty files are skipped by Spark).

    Only metadata is read: ``content`` is never selected, so the binary file
    source does not open the files.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length"),
        F.col("modificationTime").alias("modification_time"),
    )


def plain_path(encoded: Column) -> Column:
    """The path of a URL-encoded ``_metadata.file_path`` (where ``+`` is a plus sign)."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Add ``_meta_path/_meta_name/_meta_size/_meta_mtime`` of the file each row came from."""
    path = plain_path(F.col("_metadata.file_path"))
    columns = {alias: F.col(f"_metadata.{field}") for alias, field in META_COLUMNS.items()}
    columns |= {"_meta_path": path, "_meta_name": F.element_at(F.split(path, "/"), -1)}
    return df.select("*", *[column.alias(alias) for alias, column in columns.items()])


def literal_path(path: str) -> str:
    """``path`` for a reader: characters that would make it a pattern are escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme, as listings give it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def move_files(spark: SparkSession, moves: DataFrame) -> None:
    """Rename files: rows of (from, to), brought to the driver a partition at a time.

    Renames are metadata operations of the file system.  One that fails, or
    whose destination exists, leaves its file where it is; the listing shows it.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    made: set[str] = set()
    for source, target in moves.toLocalIterator():
        source, target = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
        files = source.getFileSystem(conf)
        try:
            if target.getParent().toString() not in made:
                files.mkdirs(target.getParent())
                made.add(target.getParent().toString())
            if not files.exists(target):
                files.rename(source, target)
        except Py4JJavaError:  # the file system's refusal; the reconciliation reports the file
            continue


def first_lines(spark: SparkSession, paths: Sequence[str], threads: int = 16) -> list[str | None]:
    """First line with text of each file, None where there is none.

    Only the beginning of a file is read, through the file system that Spark
    itself uses, some files at a time.  Spark's readers have no such partial
    read: a task that stops early still reads its whole split.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(name: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(name)
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            stream = codec.createInputStream(stream) if codec is not None else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
            while line is not None and not line.strip():
                line = reader.readLine()
            return line
        finally:
            stream.close()

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(first, paths))


def header_columns(spark: SparkSession, header: str, sep: str = ",") -> list[str]:
    """Column names of a header line, cut by Spark's CSV parser (quotes included).

    As in Spark, an empty name becomes ``_c<i>`` and a repeated one gets its
    position added.
    """
    # blanks around a name are not part of it, nor do they keep a quote from opening
    options = {"sep": sep, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    line = F.lit(header.removeprefix("\ufeff"))
    shape = spark.range(1).select(F.schema_of_csv(line, options)).first()[0]
    fields = ", ".join(f"{name} STRING" for name in re.findall(r"_c\d+(?=:)", shape))
    row = spark.range(1).select(F.from_csv(line, fields, options).alias("h"))
    names = [(name or "").strip() or f"_c{i}" for i, name in enumerate(row.first()["h"])]
    lower = [name.lower() for name in names]
    return [f"{name}{i}" if lower.count(name.lower()) > 1 else name for i, name in enumerate(names)]


def csv_layouts(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by the columns of their header; files without a line are left out."""
    names: dict[str, tuple[str, ...]] = {}
    out: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, first_lines(spark, paths), strict=True):
        if header is not None:
            if header not in names:
                names[header] = tuple(header_columns(spark, header, sep))
            out.setdefault(names[header], []).append(path)
    return out


def _string_schema(columns: Sequence[str], corrupt: str = CORRUPT_COLUMN) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns] + [StructField(corrupt, StringType(), True)])


def read_csv_group(
    spark: SparkSession, files: Sequence[str], columns: Sequence[str], sep: str = ",", check_header: bool = False
) -> DataFrame:
    """Files sharing one header, read with an all-text schema and a corrupt-record column.

    With ``check_header`` a file whose header has other names, or the same in
    another order, fails the read instead of filling the wrong columns.
    """
    df = (
        spark.read.schema(_string_schema(columns))
        .option("header", "true")
        .option("enforceSchema", str(not check_header).lower())
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(list(files))
    )
    return with_file_metadata(df)


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    sep: str = ",",
    uniform_header: bool = False,
    header: Sequence[str] | None = None,
) -> DataFrame:
    """Raw rows of a source folder, all text, plus ``_meta_*`` lineage columns.

    CSV: the first line of every file tells its layout; each layout is read on
    its own and the layouts are unioned by column name, missing columns as
    NULL.  Every file is read once.  The names of the files go through the
    driver, as they do in any file listing of Spark; ``run_bronze`` bounds them
    by reading a batch of files at a time.  ``uniform_header`` looks at one file
    only, and ``header`` at none: a file with another header then fails the
    read.  Rows with too few or too many fields are kept whole in the
    corrupt-record column.  Empty files have no rows.

    JSON lines: primitives are read as strings; malformed lines land in the
    corrupt-record column.
    """
    fmt = check_format(fmt)
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "json":
        df = (
            spark.read.option("multiLine", "false")
            .option("mode", "PERMISSIVE")
            .option("primitivesAsString", "true")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .json(paths)
        )
        return with_file_metadata(df)
    if header is not None:
        return read_csv_group(spark, paths, header, sep, check_header=True)
    files = [row["path"] for p in paths for row in list_files(spark, p).select("path").orderBy("path").toLocalIterator()]
    if uniform_header:
        layouts = next((found for f in files if (found := csv_layouts(spark, [f], sep))), {})
        frames = [read_csv_group(spark, paths, columns, sep, check_header=True) for columns in layouts]
    else:
        layouts = sorted(csv_layouts(spark, files, sep).items())
        frames = [read_csv_group(spark, [literal_path(f) for f in names], columns, sep) for columns, names in layouts]
    if not frames:
        return spark.createDataFrame([], _string_schema([])).withColumns(
            {alias: F.lit(None).cast(dtype) for alias, dtype in META_TYPES.items()}
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def add_lineage(
    df: DataFrame,
    batch_id: str,
    schema_version: str,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Bronze lineage: source file path/name/size/mtime, ingestion date and time,
    batch id, row fingerprint and schema version.

    The fingerprint covers the source columns only (sorted by name).
    ``run_ts`` fixes the ingestion time for reproducible runs; without it the
    query's ``current_timestamp`` is used (one value per query).
    """
    meta = set(META_COLUMNS)
    src = df.drop(*[c for c in df.columns if c in meta])
    now = ts_literal(run_ts, "timestamp") if run_ts is not None else F.current_timestamp()

    def meta_col(alias: str, dtype: str):
        return F.col(alias) if alias in df.columns else F.lit(None).cast(dtype)

    out = df.select(
        *[F.col(f"`{c}`") for c in src.columns],
        meta_col("_meta_path", "string").alias("arquivo_origem"),
        meta_col("_meta_name", "string").alias("nome_arquivo_origem"),
        meta_col("_meta_size", "bigint").alias("tamanho_arquivo_origem"),
        meta_col("_meta_mtime", "timestamp").alias("data_modificacao_arquivo"),
        F.to_date(now).alias("data_ingestao"),
        now.alias("timestamp_ingestao"),
        F.lit(batch_id).alias("batch_id"),
        row_fingerprint(src).alias("hash_linha"),
        F.lit(schema_version).alias("schema_version"),
    )
    return out
