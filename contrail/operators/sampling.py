"""Repeatable samples and splits that depend on row keys, not on partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.quantiles import select_ranks
from contrail.session import settle


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """32 hex digits that depend only on the seed and the key values."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def key_fraction(keys: Sequence[str], seed: int) -> Column:
    """Evenly spread number in [0, 1) that depends only on seed and keys."""
    head = F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("double")
    return head / float(16**8)


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """`n` rows (all, if fewer) picked by key digest; a distributed top-n."""
    return df.orderBy(key_digest(keys, seed), *keys).limit(n)


def key_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, about `test_size` of them in the test.

    The key alone decides, so no shuffle is needed and a rerun splits the same way.
    """
    test = key_fraction(keys, seed) < test_size
    return df.where(~test), df.where(test)


def key_number(keys: Sequence[str], seed: int) -> Column:
    """60 bits of the key digest, as a whole number; never NULL, so that a join on it adds no filter."""
    return F.coalesce(F.conv(F.substring(key_digest(keys, seed), 1, 15), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def stratified_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42, label: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the test has `test_size` of each class, to the nearest row (halves up).

    Of each class the rows with the smallest key digests are the test: the digest
    at the last place is found by counting, not by sorting, and rows are then
    compared with it where they are. Rows with that very digest (repeated keys)
    are told apart by all their columns. A NULL label is a class. Repeatable,
    whatever the order and the partitions of the input; eager as far as the
    thresholds go. `df` should be cheap to read. The class is `label`; if none is
    named, the column of that name, or else the ground flag.
    """
    label = label or ("label" if "label" in df.columns else "on_ground")
    number = key_number(keys, seed)
    classes = df.select(F.col(label).cast("string").alias("_class"), number.alias("_number"))
    classes = classes.withColumn("_class", F.coalesce("_class", F.lit("")))
    wanted = F.floor(F.col("_total") * F.lit(test_size) + 0.5)
    hits, fixed = select_ranks(classes.withColumn("_bits", F.col("_number")), ["_class"], F.greatest(wanted - 1, F.lit(0)).cast("double"))
    numbered = classes.withColumn("_prefix", F.shiftright("_number", 64 - fixed))
    inside = numbered.join(hits, ["_class", "_prefix"]).groupBy("_class", "_start", "_rank", "_number").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_class").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("_n").over(running), F.lit(0))
    last = inside.withColumn("_before", before).where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    sizes = classes.groupBy("_class").agg(F.count(F.lit(1)).alias("_total")).select("_class", wanted.alias("_wanted"))
    last = last.select("_class", F.col("_number").alias("_last"), "_n", "_before").join(sizes, "_class")
    limits = settle(last.select("_class", "_last", "_n", (F.col("_wanted") - F.col("_before")).alias("_of_last")), "split")
    own = df.withColumns({"_class": F.coalesce(F.col(label).cast("string"), F.lit("")), "_number": number}).join(limits, "_class")
    tied = (F.col("_number") == F.col("_last")) & (F.col("_n") > 1)
    clear = own.where(~tied).withColumn("_test", (F.col("_number") < F.col("_last")) | ((F.col("_number") == F.col("_last")) & (F.col("_of_last") > 0)))
    nth = F.row_number().over(Window.partitionBy("_class").orderBy(*[F.col(c).cast("string") for c in df.columns]))
    sides = clear.unionByName(own.where(tied).withColumn("_test", nth <= F.col("_of_last")))
    return sides.where(~F.col("_test")).select(*df.columns), sides.where("_test").select(*df.columns)
