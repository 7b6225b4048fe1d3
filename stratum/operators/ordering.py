"""Global ordering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def with_global_position(df: DataFrame, order: Sequence[Column], name: str = "posicao", partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the global ``order``.

    ``row_number() OVER (ORDER BY ...)`` would move every row into one task.
    Here the rows are range-partitioned on the order and sorted within each
    partition; a row's position is its index inside its partition plus the
    row count of all earlier partitions.  The offsets come from one count per
    partition (a table with at most ``partitions`` rows), so nothing grows
    with the data in a single task.  Ties on the whole order may be numbered
    in any order, so give a total order for a deterministic result.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range bounds are sampled, and another plan over the same rows may sample
    # others; the checkpoint fixes one partitioning for both branches below
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    local = ranged.withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), _ROW_BITS) + 1)
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # at most `n` offset rows: a broadcast of a proven size
    return (
        local.join(F.broadcast(offsets), "__pid", "left")
        .withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).cast("bigint"))
        .drop("__pid", "__mid", "__local", "__off")
    )
