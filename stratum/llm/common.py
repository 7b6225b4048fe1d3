"""Helpers shared by the operators: stored intermediate tables and word hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only a local session (tests) without the setting gets a folder of its own;
    on a cluster a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="stratum-llm-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="stratum-package-")) / "stratum-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage at a table that survives lost executors.  The write's own
    shuffle files go when it ends, so a chain of stages needs the disk of its
    largest stage instead of their sum.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stratum-llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/stratum-llm/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# fixed odd multipliers of the 64-bit mixing steps
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix), vectorised."""
    h = (h ^ (h >> np.uint64(30))) * MIX_B
    h = (h ^ (h >> np.uint64(27))) * MIX_C
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word (bytes); forgets everything beyond ``limit`` words."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z in lower case.

    ``bytes.split()`` cuts at exactly these six ASCII characters and
    ``bytes.lower()`` changes only A-Z.
    """
    return text.lower().split()
