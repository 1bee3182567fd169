"""Exact deduplication by recipes of content-defined chunks, in SQL functions alone.

A text is cut where its content says so: at the first line or sentence end after
a least length. Each chunk gets a 64-bit identifier and an SHA-256. Identifiers
are verified over the whole corpus: one that stands for a single SHA-256 names
its chunk; for the few others the SHA-256 list of the document joins the key.
Documents are then compared by their ordered identifier lists, so a text is read
once and never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import texts
from contrail.session import settle

MIN_CHARS, MAX_CHARS = 256, 4096


def chunks(text: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    """Consecutive chunks that together are the text; none for an empty one."""
    pattern = rf"(?s).{{{least},{most}}}?(?:(?<=[\n.!?;])|\z)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_duplicates(docs: DataFrame, least: int = MIN_CHARS, most: int = MAX_CHARS) -> DataFrame:
    """Groups of equal texts, one row per row of `docs`.

    Columns: `doc_id`, `keep_id` (largest id of the group), `group_size`,
    `kept` (the id is `keep_id`), `text_sha256`. NULL text counts as empty; all
    empty texts are one group. Repeated rows are members of their group, each
    counted. A NULL id is smaller than any other; it stays only if the group has
    no other. An empty table gives no rows.
    """
    recipe = F.transform(chunks(F.col("text"), least, most), lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("sha")))
    recipes = settle(texts(docs).select("doc_id", F.sha2("text", 256).alias("text_sha256"), recipe.alias("recipe")), "recipes")

    # identifiers that stand for more than one content
    parts = recipes.select(F.explode("recipe").alias("c")).select("c.id", "c.sha")
    doubtful = parts.distinct().groupBy("id").count().where("count > 1").select("id")
    marked = (
        recipes.select("text_sha256", F.explode("recipe.id").alias("id"))
        .join(doubtful, "id", "left_semi")
        .select("text_sha256")
        .distinct()
        .withColumn("verify", F.lit(True))
    )
    keyed = recipes.join(marked, "text_sha256", "left").select(
        "doc_id",
        "text_sha256",
        F.col("recipe.id").alias("ids"),
        F.when(F.col("verify"), F.col("recipe.sha")).otherwise(F.array().cast("array<binary>")).alias("shas"),
    )
    groups = keyed.groupBy("ids", "shas").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    return keyed.join(groups, ["ids", "shas"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id").eqNullSafe(F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))), F.lit(False)).alias("kept"),
        "text_sha256",
    )
