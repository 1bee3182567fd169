"""Positions of distinct values in sort order, without one task seeing all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import settle


def sorted_positions(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of `column` with their 0-based place in ascending order.

    Values are range-partitioned and written once, so that partition numbers
    are stable; each partition is numbered on its own and shifted by the sizes
    of those before it.
    """
    parts = settle(
        df.select(column).distinct().repartitionByRange(column).withColumn("_part", F.spark_partition_id()),
        "sorted",
    )
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    # One offset per partition of the shuffle, so this side is always small.
    return parts.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_offset") + place - 1).cast("bigint").alias(name)
    )
