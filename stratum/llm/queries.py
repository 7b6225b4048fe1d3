"""The operators as queries over the driver tables (``opN_<name>``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    from stratum.llm.chat import format_conversations, window_digests

    said = "</s>[INST] ok [/INST]"
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(control)
    return window_digests(format_conversations(rows))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and isolation-forest verdict of every document."""
    from stratum.llm.quality import COUNTS, quality_verdicts

    rows = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *COUNTS, "base_failed", "kept", "score")


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets overlap by 90 percent."""
    from stratum.llm.ngram_join import Threshold, ngram_components

    rows = ngram_components(table(spark, sf_dir, "documents"), n=3, threshold=Threshold(90, 100))
    return rows.select("doc_id", "n_shingles", "component_id")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, held out or not."""
    from stratum.llm.langid import identify_languages

    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz and base scores of every document."""
    from stratum.llm.katz import katz_scores
    from stratum.llm.langid import id_remainder

    docs = table(spark, sf_dir, "documents")
    return katz_scores(docs, id_remainder(docs, 5) == 1)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that a document holds, with its best window of each."""
    from stratum.llm.decontam import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier one has in strings of 50."""
    from stratum.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page url."""
    from stratum.llm.url_filter import Rule, filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES])


# The pages' html holds no canonical link and no refresh, so no url has an
# alias; tests/llm checks the propagation on tables that have some.
ORACLES["op8_url_filter"] = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id, row_number() OVER () AS row_no,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT page_id, row_no,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fits AS (
  SELECT u.*, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.row_no ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared and inherited license of every document.

    The documents have no paths; theirs are ``source/thousand/doc_id``, and a
    document whose first line names a license is its folder's license file.
    """
    from stratum.llm.licenses import scan_licenses

    docs = table(spark, sf_dir, "documents")
    opens = F.substring_index("text", "\n", 1).rlike("(?i)licen[sc]e")
    name = F.concat(F.when(opens, "LICENSE.").otherwise(""), F.col("doc_id"))
    folder = F.floor(F.col("doc_id") / 1000).cast("string")
    return scan_licenses(docs, path=F.concat_ws("/", "source", folder, name))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens; one row per piece."""
    import public_tokenizers

    from stratum.llm.packing import pack

    docs = table(spark, sf_dir, "documents")
    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), checksums=True)


@query
def op11_ptolemaic_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the embeddings by centroids, with distances and inertia."""
    from stratum.llm.centroids import cluster_centroids

    rows = cluster_centroids(table(spark, sf_dir, "embeddings"))
    longs = [F.col(c).cast("long").alias(c) for c in ("cluster_inertia", "inertia")]
    return rows.select("vec_id", "cluster", "distance", *longs, "centroid_sha256")


def _centroid_sql(rounds: int) -> str:
    """DuckDB SQL of ``op11_ptolemaic_centroids``; every distance is computed."""
    distance = "list_sum(list_transform(list_zip(k.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        """
kept AS (
  SELECT vec_id, row_number() OVER () AS row_no,
         list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS cluster, x
  FROM kept QUALIFY cluster < 16)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (
  SELECT k.row_no, k.vec_id, k.x, c.cluster, {distance}::BIGINT AS distance
  FROM kept k, c{i} c
  QUALIFY row_number() OVER (PARTITION BY k.row_no ORDER BY distance, c.cluster) = 1)""")
        steps.append(f"""
e{i} AS (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM a{i}),
t{i} AS (SELECT cluster, place, sum(v)::HUGEINT AS total, count(*)::HUGEINT AS members FROM e{i} GROUP BY ALL),
m{i} AS (
  SELECT cluster,
         list(((total - (((total % members) + members) % members)) // members)::BIGINT ORDER BY place) AS x
  FROM t{i} GROUP BY cluster),
c{i + 1} AS (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (cluster))""")
    last = f"a{rounds}"
    return f"""WITH {",".join(steps)}
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance,
       (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM {last} a JOIN c{rounds} c USING (cluster)"""


ORACLES["op11_ptolemaic_centroids"] = _centroid_sql(3)


@query
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    import public_tokenizers

    from stratum.llm.bpe import encoding_digests

    return encoding_digests(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding."""
    from stratum.llm.whitening import whiten

    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
