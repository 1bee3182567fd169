"""Quality rules, report and gate. Each report is one aggregation pass."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.columns import to_bigint, to_boolean, to_double
from contrail.schemas import SILVER
from contrail.session import SkipBatch

log = logging.getLogger(__name__)


class QualityError(ValueError):
    """The data broke an enforced rule."""


@dataclass(frozen=True)
class Rule:
    """`broken` is true on a violating row; with `per_row=False` it is an aggregate."""

    name: str
    columns: tuple[str, ...]
    broken: Column
    severity: str = "error"
    per_row: bool = True


def silver_rules() -> list[Rule]:
    lat, lon = F.col("latitude"), F.col("longitude")
    has_position = lat.isNotNull() & lon.isNotNull()
    return [
        Rule("icao24 is present", ("icao24",), F.col("icao24").isNull()),
        Rule("icao24 is not blank", ("icao24",), F.trim("icao24") == ""),
        Rule("latitude within [-90, 90]", ("latitude",), ~lat.between(-90.0, 90.0)),
        Rule("longitude within [-180, 180]", ("longitude",), ~lon.between(-180.0, 180.0)),
        Rule("velocity is not negative", ("velocity",), F.col("velocity") < 0),
        Rule("on_ground is present", ("on_ground",), F.col("on_ground").isNull()),
        Rule("at least one row", (), F.count(F.lit(1)) < 1, per_row=False),
        Rule(
            "a position has a time",
            ("latitude", "longitude", "time_position"),
            has_position & F.col("time_position").isNull(),
        ),
        Rule(
            "an airborne row has a position",
            ("on_ground", "latitude", "longitude"),
            ~F.col("on_ground") & ~has_position,
            severity="warning",
        ),
    ]


def _coerced(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[Rule]]:
    """Cast text and numbers to the declared types, with a rule per cast."""
    readers = {T.DoubleType: to_double, T.LongType: to_bigint, T.BooleanType: to_boolean}
    casts, rules = {}, []
    for field in schema:
        read = readers.get(type(field.dataType))
        given = df.schema[field.name].dataType if field.name in df.columns else None
        castable = isinstance(given, (T.StringType, T.NumericType))
        if read is None or not castable or given == field.dataType:
            continue
        kept = f"_given_{field.name}"
        casts[kept] = F.col(field.name)
        casts[field.name] = read(F.col(field.name))
        unread = F.col(kept).isNotNull() & F.col(field.name).isNull()
        rules.append(Rule(f"{field.name} reads as {field.dataType.simpleString()}", (field.name,), unread))
    return (df.withColumns(casts) if casts else df), rules


def rule_counts(
    df: DataFrame, rules: Sequence[Rule] | None = None, schema: T.StructType = SILVER
) -> DataFrame:
    """Violations of every rule: (rule, severity, violations), zero included.

    A required column that is missing is one violation; the rules that need it
    are not evaluated.
    """
    coerced, casting = _coerced(df, schema)
    missing = [f.name for f in schema if f.name not in df.columns]
    active = [
        r
        for r in [*casting, *(silver_rules() if rules is None else rules)]
        if not set(r.columns) & set(missing)
    ]
    counts = [
        (F.count_if(r.broken) if r.per_row else r.broken.cast("bigint")).alias(f"_{i}")
        for i, r in enumerate(active)
    ]
    absent = [
        F.struct(
            F.lit(f"{name} exists").alias("rule"),
            F.lit("error").alias("severity"),
            F.lit(1).cast("bigint").alias("violations"),
        )
        for name in missing
    ]
    checked = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.severity).alias("severity"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, r in enumerate(active)
    ]
    return coerced.agg(*counts).select(F.inline(F.array(*absent, *checked)))


def validate(
    df: DataFrame, rules: Sequence[Rule] | None = None, schema: T.StructType = SILVER
) -> DataFrame:
    """The broken rules only, all of them rather than the first."""
    return rule_counts(df, rules, schema).where("violations > 0")


def valid_rows(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows that break no error rule."""
    broken = [r.broken for r in (silver_rules() if rules is None else rules) if r.per_row and r.severity == "error"]
    return df.where(reduce(lambda a, b: a & b, [~F.coalesce(b, F.lit(False)) for b in broken], F.lit(True)))


def enforce(violations: DataFrame) -> None:
    """Raise on broken error rules; log broken warning rules."""
    found = violations.collect()  # one row per rule
    for row in found:
        if row.severity == "warning":
            log.warning("%d rows: %s", row.violations, row.rule)
    errors = [f"{r.rule}: {r.violations}" for r in found if r.severity == "error"]
    if errors:
        raise QualityError("quality rules broken:\n" + "\n".join(errors))


def quality_report(silver: DataFrame) -> DataFrame:
    """One row of counts that the gate reads."""
    no_lat, ground = F.col("latitude").isNull(), F.col("on_ground")
    return silver.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("icao24").isNull()).alias("null_icao24"),
        F.count_if(no_lat).alias("null_latitude"),
        F.count_if(F.col("longitude").isNull()).alias("null_longitude"),
        F.count_if(ground & no_lat).alias("null_position_ground"),
        F.count_if(~ground & no_lat).alias("null_position_airborne"),
    )


def quality_gate(
    report: Row | Mapping[str, Any] | DataFrame | None,
    min_row_count: int = 1,
    fail_on_empty: bool = True,
    extra_checks: Mapping[str, Any] | None = None,
) -> bool:
    """True lets the batch through; False means there is no report yet.

    Too few rows raise `QualityError`, or `SkipBatch` if `fail_on_empty` is
    off. All differing `extra_checks` are listed in one `QualityError`.
    """
    if report is None:
        return False
    if isinstance(report, DataFrame):
        report = report.first()
    figures = report.asDict() if isinstance(report, Row) else dict(report)
    rows = figures.get("row_count", 0)
    if rows < min_row_count:
        reason = f"{rows} rows, at least {min_row_count} needed"
        raise QualityError(reason) if fail_on_empty else SkipBatch(reason)
    differing = [
        f"{key} is {figures.get(key)}, expected {wanted}"
        for key, wanted in (extra_checks or {}).items()
        if figures.get(key) != wanted
    ]
    if differing:
        raise QualityError("\n".join(differing))
    return True
