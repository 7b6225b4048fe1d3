"""Deduplication: latest version per key with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Secondary ordering columns used when the frame has them (newest first).
LINEAGE_ORDER = ("data_ingestao", "arquivo_origem")
LATEST_BY_LINEAGE = (*LINEAGE_ORDER, "hash_linha")  # all lineage columns that order rows before their own


def latest_order(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> list[Column]:
    """Ordering for "latest per key": main column(s) desc nulls last, then the
    lineage columns when present, then every remaining column, so the chosen
    row never depends on the physical order of the input."""
    mains = [order_by] if isinstance(order_by, str) else list(order_by)
    used = set(keys) | set(mains)
    order = [F.col(f"`{c}`").desc_nulls_last() for c in mains]
    for c in LINEAGE_ORDER:
        if c in df.columns and c not in used:
            order.append(F.col(c).desc_nulls_last())
            used.add(c)
    if "hash_linha" in df.columns and "hash_linha" not in used:
        order.append(F.col("hash_linha").desc_nulls_last())
        used.add("hash_linha")
    order += [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in used]
    return order


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Keep one row per key: the newest by ``order_by``, ties broken by a total order.

    ``row_number() == 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle, so a hot key sends at most one row per map task across the
    network.  Exact duplicates collapse here too, so no separate ``distinct``
    (a full shuffle of every column) is needed.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*latest_order(df, keys, order_by))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key when the rows of a key are known to be equal on the kept columns."""
    return df.dropDuplicates(list(keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def spread_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows, dealt once, by a hash of all their columns.

    After a join Spark would leave the rows dealt by the join's key, as this is
    one of the columns: the rows of a key that very many name (or of NULL)
    would be held by one task.
    """
    dealt = df.withColumn("__deal", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return dealt.repartition("__deal").distinct().drop("__deal")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("quantidade")).filter(F.col("quantidade") > 1)
