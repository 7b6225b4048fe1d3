"""Benchmark decontamination with SimHash windows.

Windows of an item's size are fingerprinted; blocks of the fingerprint index
every pair within the Hamming radius, and the weighted similarity of their
word shingles decides.  Only DataFrame functions are used.

A window as similar as asked shares shingles with the item, so only windows
around shared shingles whose weight could suffice are fingerprinted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored

BITS = 64
FOUND = (
    "tid long, item_id long, start long, n_words long, similarity double, distance int"
)


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def gram_hashes(word_hashes: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive words; none if there are fewer."""
    count = F.size(word_hashes) - size + 1
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
        lambda i: F.xxhash64(*(F.get(word_hashes, i + k) for k in range(size))),
    )
    return F.when(count > 0, each).otherwise(F.array().cast("array<bigint>"))


def simhash(grams: Column) -> Column:
    """64 bits: each is set if it is in over half of the shingles' hashes."""

    def ones(bit: Column) -> Column:
        return F.aggregate(grams, F.lit(0).cast("long"), lambda n, h: n + _bit(h, bit))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.struct(b.alias("b"), ones(b).alias("n")))
    return F.aggregate(
        bits,
        F.lit(0).cast("long"),
        lambda total, x: total.bitwiseOR(F.when(2 * x["n"] > F.size(grams), _power(x["b"])).otherwise(F.lit(0).cast("long"))),
    )


def _bit(h: Column, bit: Column) -> Column:
    return F.call_function("shiftrightunsigned", h, bit).bitwiseAND(F.lit(1).cast("long"))


def _power(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def fingerprint_blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 blocks (number, bits): fingerprints within the radius agree on one of them."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"),
            )
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        )
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    shingle: int = 5,
    threshold: float = 0.8,
    radius: int = 23,
) -> DataFrame:
    """Windows of texts that match an item: ``tid, item_id, start, n_words, similarity, distance``.

    One row per text (``tid`` is its 64-bit hash), item and window start whose
    fingerprints differ in at most ``radius`` bits and whose weighted Jaccard
    similarity (multisets of shingles, weighted by their rarity among the
    items) reaches ``threshold``.  Items shorter than a shingle are one
    shingle; a text shorter than an item is one window.  The radius must leave
    room for the threshold: 64-bit fingerprints of windows at 0.8 differ in
    about 10 bits, and 23 is four deviations above.

    Null and empty texts and items match nothing.  Repeated rows count once
    here; null item ids are kept.  Empty tables give no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    listed = items.select(
        items["item_id"].cast("long").alias("item_id"), words_of(items["text"].cast("string")).alias("words")
    ).filter(F.size("words") > 0)
    listed = listed.select(
        "item_id",
        F.size("words").cast("long").alias("len"),
        F.least(F.size("words"), F.lit(shingle)).alias("gram"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    ).distinct()
    listed = stored(listed.withColumn("item", F.xxhash64("item_id", "hashes")), "items")
    sizes = [r.gram for r in listed.select("gram").distinct().collect()]  # at most `shingle` of them
    if not sizes:
        return spark.createDataFrame([], FOUND)
    by_size = F.coalesce(*(F.when(F.col("gram") == g, gram_hashes(F.col("hashes"), g)) for g in sizes))
    listed = stored(listed.withColumn("grams", by_size), "items")
    n_items = listed.count()
    grams = listed.select("item", "item_id", "len", "gram", F.posexplode("grams").alias("at", "h"))
    df = grams.groupBy("gram", "h").agg(F.countDistinct("item").alias("df"))
    weights = stored(df.select("gram", "h", (1 + F.log(F.lit(n_items) / F.col("df"))).alias("w")), "item-weights")
    rare = 1 + math.log(n_items)  # of a shingle that no item has
    item_grams = stored(
        grams.groupBy("item", "item_id", "len", "gram", "h").agg(F.count("*").alias("c")).join(weights, ["gram", "h"]),
        "item-grams",
    )
    item_weight = item_grams.groupBy("item").agg(F.sum(F.col("c") * F.col("w")).alias("item_weight"))

    texts = docs.select(docs["text"].cast("string").alias("text")).filter("text <> ''")
    texts = texts.select(
        F.xxhash64("text").alias("tid"), F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes")
    )
    every = None
    for g in sizes:
        part = texts.select(
            "tid",
            F.lit(g).alias("gram"),
            F.size("hashes").cast("long").alias("n"),
            F.posexplode(gram_hashes(F.col("hashes"), g)).alias("pos", "h"),
        )
        every = part if every is None else every.union(part)
    hits = stored(every.join(weights, ["gram", "h"]).distinct(), "item-hits")

    # windows that hold a hit, and the weight that they share with the item at most
    spans = hits.join(item_grams.select("item", "len", "gram", "h"), ["gram", "h"])
    last = F.greatest(F.col("n") - F.col("len"), F.lit(0).cast("long"))
    first = F.greatest(F.col("pos") - F.col("len") + F.col("gram"), F.lit(0).cast("long"))
    starts = F.sequence(F.least(first, last), F.least(F.col("pos").cast("long"), last))
    near = spans.select("tid", "item", "len", "gram", "n", "w", F.explode(starts).alias("start"))
    near = near.groupBy("tid", "item", "len", "gram", "n", "start").agg(F.sum("w").alias("most"))
    near = near.join(item_weight, "item").filter(F.col("most") >= threshold * F.col("item_weight") - 1e-9)
    windows = stored(near.select("tid", "len", "gram", "n", "start").distinct(), "item-windows")

    held = texts.join(windows.select("tid").distinct(), "tid", "left_semi")
    held = held.groupBy("tid").agg(F.first("hashes").alias("hashes"))
    size = F.least(F.col("len"), F.col("n"))
    inside = F.slice("hashes", F.col("start").cast("int") + 1, size.cast("int"))
    cut = windows.join(held, "tid").select("tid", "len", "gram", "start", size.alias("n_words"), inside.alias("hashes"))
    cut = stored(cut.withColumn("grams", by_size).drop("hashes"), "item-windows")
    cut = stored(cut.withColumn("print", simhash(F.col("grams"))), "item-prints")
    prints = stored(listed.withColumn("print", simhash(F.col("grams"))).select("item", "item_id", "len", "print"), "prints")

    def blocked(df: DataFrame, name: str, *keep: str) -> DataFrame:
        blocks = df.select("len", F.col("print").alias(name), *keep, F.inline(fingerprint_blocks(F.col("print"), radius)))
        return blocks

    pairs = (
        blocked(cut, "print", "tid", "start")
        .join(blocked(prints, "item_print", "item", "item_id"), ["len", "block", "bits"])
        .withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))))
        .filter(F.col("distance") <= radius)
        .select("tid", "start", "len", "item", "item_id", "distance")
        .distinct()
    )
    pairs = stored(pairs, "item-pairs")

    window_grams = (
        cut.select("tid", "start", "len", "gram", "n_words", F.explode("grams").alias("h"))
        .groupBy("tid", "start", "len", "gram", "n_words", "h")
        .agg(F.count("*").alias("c"))
        .join(weights, ["gram", "h"], "left")
        .withColumn("w", F.coalesce("w", F.lit(rare)))
    )
    window_weight = window_grams.groupBy("tid", "start", "len", "n_words").agg(
        F.sum(F.col("c") * F.col("w")).alias("window_weight")
    )
    common = (
        pairs.join(window_grams.select("tid", "start", "len", "h", F.col("c").alias("times")), ["tid", "start", "len"])
        .join(item_grams.select("item", "h", "c", "w"), ["item", "h"])
        .groupBy("tid", "start", "len", "item", "item_id", "distance")
        .agg(F.sum(F.least("times", "c") * F.col("w")).alias("common"))
    )
    scored = common.join(window_weight, ["tid", "start", "len"]).join(item_weight, "item")
    similarity = F.col("common") / (F.col("window_weight") + F.col("item_weight") - F.col("common"))
    return (
        scored.withColumn("similarity", similarity)
        .filter(F.col("similarity") >= threshold - 1e-9)
        .select("tid", "item_id", "start", "n_words", "similarity", "distance")
    )


def contamination_report(docs: DataFrame, items: DataFrame, **options: float) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity, distance``: each document's best window per item.

    Of equally similar windows the first counts.  Repeated rows of ``docs`` are
    reported each.
    """
    found = stored(contaminated(docs, items, **options), "contaminated")
    best = found.groupBy("tid", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words", "distance")).alias("best")
    )
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("tid"))
    return rows.join(best, "tid").select(
        "doc_id",
        "item_id",
        (-F.col("best.before")).alias("start"),
        "best.n_words",
        "best.similarity",
        "best.distance",
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **options: float) -> DataFrame:
    """``docs`` without the rows whose text holds a window that matches an item."""
    found = stored(contaminated(docs, items, **options).select("tid").distinct(), "contaminated")
    return docs.join(found, F.xxhash64(docs["text"]) == found["tid"], "left_anti")
