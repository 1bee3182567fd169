"""Groups of members that share buckets, without forming all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import discard_all, forget
from contrail.llm.components import components
from contrail.session import settle

#: Rounds of comparing with a hub end when less than this share of a round's comparisons were links (what is left is
#: mostly apart), when the pairs left are at most so many times the bucket members, or after so many rounds.
#: What is left is compared in pairs, whatever its number, or in those that `apart` finds.
LINKED_SHARE, PAIRS_PER_MEMBER, HUB_ROUNDS = 0.05, 1, 10

#: Rounds of confirming what looks most alike end when no more than this share of the pairs were links, or after so many.
ALIKE_SHARE, ALIKE_ROUNDS = 0.2, 6


def linked_groups(
    members: DataFrame,
    sizes: DataFrame,
    compatible: str,
    confirm: Callable[[DataFrame], DataFrame],
    hub_rounds: int = HUB_ROUNDS,
    apart: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Confirmed links `a`, `b` between members of a bucket, and `node`, `component` of the linked ones.

    `members`: distinct `band`, `doc`; `sizes`: `doc` and columns that `compatible`, a
    condition for pairs, names plain for one member and with `_b` for the other.
    `confirm` returns those of the pairs `a`, `b` that are links. `apart`, if given,
    finds the pairs for it after the last round, without loss, from `doc`, `label`,
    `hub`, `hub_label`: the members of all buckets with one hub, which stands for itself.
    Links between members that others connect may be missing, no connection is.

    In each round every bucket names a hub, the member that meets the most others, and the rest of the bucket is
    compared with it: no more pairs than there are members. Linked groups are merged; the hub, now settled with all the
    others, leaves the bucket; buckets of one group are done.
    """
    spark, docs = sizes.sparkSession, sizes.select("doc")
    labels, links = docs.select("doc", F.col("doc").alias("label")), None
    others = sizes.select(*(F.col(c).alias(f"{c}_b") for c in sizes.columns))
    named = settle(mixed(members.select("band", "doc").join(labels, "doc")), "named")
    for _ in range(hub_rounds):
        if pairs_left(named) <= PAIRS_PER_MEMBER * named.count():
            break
        hubs = settle(hubs_of(named), "hubs")
        tried = named.join(hubs, "band").where("label <> hub_label").select("doc", "label", "hub", "hub_label").distinct()
        fit = tried.join(sizes, "doc").join(others, F.col("hub") == F.col("doc_b")).where(compatible)
        tried = settle(fit.select(F.col("doc").alias("a"), F.col("hub").alias("b"), "label", "hub_label"), "tried")
        found = settle(confirm(tried.select("a", "b")), "links")
        productive = found.count() > LINKED_SHARE * tried.count()
        # a label goes over to the smallest one that a link of this round joins it to
        ends = found.join(tried, ["a", "b"]).select(F.greatest("label", "hub_label").alias("label"), F.least("label", "hub_label").alias("low"))
        renamed = labels.join(ends.groupBy("label").agg(F.min("low").alias("low")), "label", "left")
        renamed = settle(renamed.select("doc", F.coalesce("low", "label").alias("label")), "labels")
        members = settle(mixed(named.join(hubs, "band").where("doc <> hub").select("band", "doc").join(renamed, "doc")), "named")
        discard_all(labels, tried, hubs, named)
        labels, named = renamed, members
        if links is not None:
            links, parts = settle(links.unionByName(found), "links"), (links, found)
            discard_all(*parts)
        else:
            links = found
        del hubs, ends, renamed, fit
        forget(spark)
        if not productive:
            break
    if apart is not None:
        around = named.join(hubs_of(named), "band").where("doc <> hub").select("doc", "label", "hub", "hub_label").distinct()
        left = settle(apart(settle(around, "around")), "apart")
        pairs = left
    else:
        left = settle(named.join(sizes, "doc"), "apart")
        other = left.select("band", *(F.col(c).alias(f"{c}_b") for c in left.columns if c != "band"))
        pairs = left.join(other, "band").where(f"doc < doc_b and label <> label_b and {compatible}")
        pairs = pairs.select(F.col("doc").alias("a"), F.col("doc_b").alias("b")).distinct()
    discard_all(named, labels)
    found = confirm(pairs)
    every = settle(found if links is None else links.unionByName(found), "links")
    discard_all(left, links)
    forget(spark)
    return every, components(every)


def alike_groups(members: DataFrame, docs: DataFrame, near: Callable[[DataFrame, bool], DataFrame], confirm: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`node`, `component` of those of `docs` (`doc`) that are linked to others; both ends of a link are members of a bucket.

    `members`: distinct `band`, `doc`. `near` gets them with a `label` each and returns pairs `a` < `b` under different
    labels, with `label` and `label_b`: all that may be links, or if told so those that look most alike, at most one
    for each member of a bucket. `confirm` returns those of the pairs `a`, `b` that are links.

    In each round what looks most alike is confirmed and linked groups are merged; what is apart in the end is confirmed
    whole. No pair is confirmed twice.
    """
    labels = docs.select("doc", F.col("doc").alias("label"))
    named = settle(mixed(members.select("band", "doc").join(labels, "doc")), "named")
    tested, links, whole = [], [], False
    while True:
        pairs = near(named, not whole).distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested).select("a", "b"), ["a", "b"], "left_anti")
        tested.append(settle(pairs, "near"))
        links.append(settle(confirm(tested[-1].select("a", "b")), "links"))
        if whole:
            break
        whole = links[-1].count() <= ALIKE_SHARE * tested[-1].count() or len(links) == ALIKE_ROUNDS
        ends = links[-1].join(tested[-1], ["a", "b"]).select(F.col("label").alias("a"), F.col("label_b").alias("b"))
        merged = components(ends).select(F.col("node").alias("label"), "component")
        old, labels = labels, settle(labels.join(merged, "label", "left").select("doc", F.coalesce("component", "label").alias("label")), "labels")
        left, named = named, settle(mixed(named.select("band", "doc").join(labels, "doc")), "named")
        discard_all(old, left)
        del old, left, merged, ends, pairs
        forget(docs.sparkSession)
    groups = components(reduce(DataFrame.unionByName, links))
    discard_all(labels, named, *tested, *links)
    return groups


def hubs_of(named: DataFrame) -> DataFrame:
    """`band`, `hub`, `hub_label`: the member of each bucket that meets the most others in all of its buckets."""
    met = named.join(named.groupBy("band").agg(F.count("*").alias("n")), "band").groupBy("doc").agg(F.sum("n").alias("met"))
    order = F.struct((-F.col("met")).alias("met"), F.xxhash64("doc").alias("order"), F.col("doc").alias("hub"), F.col("label").alias("hub_label"))
    return named.join(met, "doc").groupBy("band").agg(F.min(order).alias("h")).select("band", "h.hub", "h.hub_label")


def mixed(named: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one label; of buckets with the same members one is enough.

    Two buckets are the same if their members agree in number, smallest and largest label and two 64-bit sums.
    """
    sums = [F.bit_xor(F.xxhash64("doc", F.lit(i))).alias(f"sum{i}") for i in range(2)]
    bands = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), *sums).where("low < high")
    bands = bands.groupBy("low", "high", "n", "sum0", "sum1").agg(F.min("band").alias("band")).select("band")
    return named.join(bands, "band")


def pairs_left(named: DataFrame) -> float:
    """Pairs of a bucket under different labels, over all buckets."""
    each = named.groupBy("band", "label").agg(F.count("*").cast("double").alias("n")).groupBy("band")
    return each.agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("pairs")).agg(F.coalesce(F.sum("pairs") / 2, F.lit(0.0))).first()[0]
