"""Upsert of a keyed batch into a keyed table, as one DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """A repeated key would match one target row twice; refuse it."""
    repeated = source.na.drop(subset=list(keys)).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"source repeats a key {tuple(keys)}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    unique: bool = False,
) -> DataFrame:
    """Target after the source was merged in on `keys`.

    A match takes `update_columns` from the source and the rest from the
    target; a source row without a match is inserted. A NULL key equals
    nothing: such rows of both sides pass through, outside the join, so that
    they cannot pile up in one of its tasks. Target rows meet only the keys of
    the source, and stay in place where Spark finds those small enough to
    broadcast; `source` is read four times and should be stored. `unique=True`
    states that the source keys are known to be unique and skips the check.
    """
    if not unique:
        require_unique_keys(source, keys)
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    given = source.select(
        *keys,
        *[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in rest],
    )
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    new = given.where(~keyless)
    updates = new.select(*keys, F.struct(*[c for c in rest if c in update_columns]).alias("_new"))
    matched = target.where(~keyless).join(updates, keys, "inner")
    changed = matched.select(*keys, *[F.col(f"_new.{c}") if c in update_columns else F.col(c) for c in rest])
    untouched = target.where(~keyless).join(new.select(*keys), keys, "left_anti")
    inserted = new.join(matched.select(*keys), keys, "left_anti")
    parts = [changed, untouched, inserted, target.where(keyless), given.where(keyless)]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*target.columns) for p in parts])
