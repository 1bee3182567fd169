"""Exact selection by rank: quantiles that never hold a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import settle

#: Bits that a pass fixes, and rows of one key that a task may rank.
BITS = 16
RANKED = 65_536


def with_ordered_bits(df: DataFrame, value: str, name: str = "_bits") -> DataFrame:
    """Add a 64-bit whole number for each double, in the order of the doubles; NaN comes last.

    The number is that of the double's own bits: its power of two above, its
    fraction below. Both follow from arithmetic that loses nothing, as only powers
    of two are multiplied and divided by. Zeros of either sign are one. Each step
    is a column of its own, so none is written out twice in generated code.
    """
    v, size, power, unit = (F.col(c) for c in (value, "_size", "_power", "_unit"))
    whole = 2**52
    steps = df.withColumn("_size", F.abs(v))
    steps = steps.withColumn("_power", F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023)))
    steps = steps.withColumn("_unit", F.pow(F.lit(2.0), power))
    below, above = (size < unit) & (power > -1022), (size / unit >= 2) & (power < 1023)  # log2 may be rounded
    moved = F.when(below, -1).when(above, 1).otherwise(0)
    steps = steps.withColumn("_moved", moved)
    share = size / (unit * F.when(F.col("_moved") == 0, 1.0).when(F.col("_moved") > 0, 2.0).otherwise(0.5))
    number = (
        F.when(F.isnan(v), F.lit(2**63 - 1))
        .when(size == float("inf"), F.lit(2047 * whole))
        .when(size == 0, F.lit(0).cast("bigint"))
        # the share is 1 to 2, below 1 for the least doubles of all
        .otherwise((power + F.col("_moved") + 1022) * F.lit(whole) + (share * float(whole)).cast("bigint"))
    )
    steps = steps.withColumn("_number", number)
    signed = F.when(v < 0, -F.col("_number")).otherwise(F.col("_number")).cast("bigint")
    # never NULL, so that a join on it adds no filter, which would be pushed below the steps and write them all out
    return steps.withColumn(name, F.coalesce(signed, F.lit(0).cast("bigint"))).drop("_size", "_power", "_unit", "_moved", "_number")


def select_ranks(rows: DataFrame, keys: Sequence[str], rank: Column) -> tuple[DataFrame, int]:
    """Which rows hold a rank: for every key at most two ranges of `_bits`, none of more than `RANKED` rows or one value.

    `rank` is an expression over `_total`, the rows of the key; the rows at its
    floor and its ceiling are looked for. Each pass counts rows in the map tasks
    by the next 16 bits of those that may still be meant. It ends when what is
    left of every key can be ranked in a task, at the latest when all 64 bits are
    fixed, and so whatever the values are. Returns `keys`, `_prefix` (the leading
    bits), `_start` (rows before them) and `_rank`, and how many bits lead. Eager;
    `rows` is read once a pass.
    """
    keys, hits = list(keys), None
    numbered = rows.select(*keys, "_bits")
    for fixed in range(BITS, 65, BITS):
        prefix = F.shiftright("_bits", 64 - fixed)
        if hits is None:
            counted = numbered.groupBy(*keys, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_count"))
            total = F.sum("_count").over(Window.partitionBy(*keys))
            counted = counted.withColumn("_total", total).withColumn("_rank", rank).withColumn("_start", F.lit(0).cast("bigint"))
            path = keys
        else:
            inside = numbered.withColumn("_above", F.shiftright("_bits", 64 - fixed + BITS))
            above = hits.select(*keys, F.col("_prefix").alias("_above"), "_start", "_rank")
            inside = inside.join(above if keys else F.broadcast(above), [*keys, "_above"])
            path = [*keys, "_above", "_start", "_rank"]
            counted = inside.groupBy(*path, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_count"))
        earlier = Window.partitionBy(*path).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_start", F.col("_start") + F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
        last = F.col("_start") + F.col("_count") - 1
        hit = counted.where((F.col("_start") <= F.ceil("_rank")) & (F.floor("_rank") <= last))
        hits = settle(hit.select(*keys, "_prefix", "_start", "_rank", "_count"), "ranks")
        most = hits.agg(F.max("_count")).first()[0] or 0
        if most <= RANKED:
            break
    return hits.drop("_count"), fixed


def exact_quantile(
    df: DataFrame, value: str, q: float = 0.5, keys: Sequence[str] = (), name: str = "median"
) -> DataFrame:
    """Interpolated quantile of the non-NULL values, one row per key.

    Where no key has more than 65,536 rows, these are ranked as they are. Else the
    rows that hold the wanted ranks are found by `select_ranks`, and of each key
    no more than that many are then ranked. Equal values are counted first.
    Without keys the answer is a single row, NULL on empty input. `df` is read
    once for the sizes, once a pass, and once more, and should be cheap to read.
    Eager as far as sizes and passes go.
    """
    keys, count = list(keys), F.count(F.lit(1))
    v = F.col("_v")
    rows = df.select(*keys, (F.col(value).cast("double") + 0.0).alias("_v")).where(v.isNotNull())
    largest = rows.groupBy(*keys).agg(count.alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest <= RANKED:
        path, whole = keys, Window.partitionBy(*keys)
        values = rows.groupBy(*keys, "_v").agg(count.alias("_n"))
        values = values.withColumns({"_start": F.lit(0).cast("bigint"), "_rank": q * (F.sum("_n").over(whole) - 1)})
    else:
        numbered = with_ordered_bits(rows, "_v")
        hits, fixed = select_ranks(numbered, keys, q * (F.col("_total") - 1))
        path = [*keys, "_prefix"]
        meant = numbered.withColumn("_prefix", F.shiftright("_bits", 64 - fixed)).join(hits if keys else F.broadcast(hits), path)
        values = meant.groupBy(*path, "_start", "_rank", "_v").agg(count.alias("_n"))
    running = Window.partitionBy(*path).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        values.withColumn("_last", F.col("_start") + F.sum("_n").over(running) - 1)
        .where((F.col("_last") >= F.floor("_rank")) & (F.col("_last") - F.col("_n") + 1 <= F.ceil("_rank")))
        .groupBy(*keys)
        .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_rank").alias("_rank"))
    )
    share = F.col("_rank") - F.floor("_rank")
    return ends.select(
        *keys,
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
        .otherwise((1 - share) * F.col("_lo") + share * F.col("_hi"))
        .alias(name),
    )
