"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import ship_package, stored
from stratum.llm.decontam import without_contaminated
from stratum.llm.ngram_join import Threshold, ngram_components
from stratum.llm.packing import pack
from stratum.llm.quality import quality_verdicts
from stratum.llm.suffix_dedup import without_repeats


# ids can be null or used for several texts: a decision is about an id and a text
KEY = ["doc_id", "text_md5"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_md5", F.md5(F.col("text").cast("binary")))


def _rows_of(keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose id and text are in ``chosen``; nulls match nulls."""
    kept = stored(chosen.select(*(F.col(k).alias(f"chosen_{k}") for k in KEY)).distinct(), "pipeline-ids")
    same = [keyed[k].eqNullSafe(kept[f"chosen_{k}"]) for k in KEY]
    return keyed.join(kept, same[0] & same[1], "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the forest reject."""
    ship_package(spark)
    keyed = _keyed(docs)
    verdicts = quality_verdicts(keyed, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=["text_md5"])
    return _rows_of(keyed, verdicts.filter("kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least document of each component linked at 0.8 of its 5-word shingles.

    Documents without a word are equal to each other; the least of them stays.
    The least document has the least id, null ids last, and of several texts
    with that id the least MD5.  So ids decide between copies only: rows with
    a null id or the same id whose texts do not link all stay.  Of rows with
    one id and text, the one least in the other columns stays.
    """
    ship_package(spark)
    keyed = _keyed(docs)
    found = ngram_components(keyed, n=5, threshold=Threshold(80, 100), carry=["text_md5"])
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *KEY)).alias("least")
    kept = found.groupBy("group_id").agg(least).select(*(F.col(f"least.{k}").alias(k) for k in KEY))
    copies = _rows_of(keyed, kept).groupBy(*KEY).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return copies.select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out what earlier documents have in strings of 50 bytes; drop what is left empty."""
    ship_package(spark)
    kept = without_repeats(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.filter(F.col("text").rlike(r"\S"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    ship_package(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens; one row per piece."""
    import public_tokenizers

    ship_package(spark)
    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), checksums=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packing),
]

# forest, suffix array, fingerprints and tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
