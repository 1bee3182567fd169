from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import quantiles
from contrail.operators.quantiles import RANKED, exact_quantile, select_ranks, with_ordered_bits


@pytest.mark.parametrize("q", [0.05, 0.5, 0.9])
def test_matches_sorting_everything(spark, q):
    rng = np.random.default_rng(7)
    groups = {
        "wide": np.concatenate([rng.normal(0, 1e6, 301), [0.0] * 40]),
        "hot": np.repeat([1.5, 2.5], [400, 401]),
        "tiny": rng.normal(0, 1e-9, 32),
        "one": np.array([-3.25]),
        "two": np.array([-1.0, 4.0]),
        "close": 200 + rng.integers(0, 5, 64) / 100,
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("wide", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in exact_quantile(df, "v", q, ["k"], "m").collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k] == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-20)


def test_a_million_distinct_values_under_one_key(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), (F.randn(3) * 1e3).alias("v"))
    got = exact_quantile(df, "v", 0.5, ["k"])
    expected = df.agg(F.percentile("v", 0.5)).first()[0]
    assert got.first().median == pytest.approx(expected, rel=1e-12)
    hits, _ = select_ranks(with_ordered_bits(df, "v"), ["k"], 0.5 * (F.col("_total") - 1))
    assert hits.count() <= 2 and hits.columns == ["k", "_prefix", "_start", "_rank"]


@pytest.mark.parametrize("ranked", [1, 7])
def test_every_pass_down_to_single_values(spark, monkeypatch, ranked):
    monkeypatch.setattr(quantiles, "RANKED", ranked)
    rng = np.random.default_rng(8)
    near = 1 + rng.permutation(3001) * 2.0**-52  # neighbours, one after the other
    groups = {"near": np.append(near, 1e300), "equal": np.full(500, -7.25), "mixed": np.concatenate([-near, near]), "odd": np.array([np.inf, 1.0, -np.inf])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: r.median for r in exact_quantile(df, "v", 0.5, ["k"]).collect()}
    assert got == pytest.approx({k: float(np.median(v)) for k, v in groups.items()}, rel=3e-16)


def test_no_distribution_leaves_many_rows_to_rank(spark):
    """Ten million distinct doubles within 1e-9 of each other, beside one far away."""
    n = 10_000_000
    near = spark.range(n).select((F.lit(1.0) + F.col("id") * F.lit(2.0**-53 * 2)).alias("v"))
    df = near.unionByName(spark.range(1).select(F.lit(1e300).alias("v")))
    rank = 0.5 * (F.col("_total") - 1)
    df = with_ordered_bits(df, "v")
    hits, fixed = select_ranks(df, [], rank)
    left = df.select(F.shiftright("_bits", 64 - fixed).alias("_prefix")).join(F.broadcast(hits), "_prefix")
    assert 0 < left.count() <= 2 * RANKED
    assert exact_quantile(df, "v").first().median == 1.0 + (n / 2) * 2.0**-52


def test_without_keys(spark):
    df = spark.range(1, 1001).select((F.col("id") / 7).alias("v"))
    assert exact_quantile(df, "v").first().median == pytest.approx(500.5 / 7)
    assert exact_quantile(df.where("v < 0"), "v").collect()[0].median is None


def test_bits_are_those_of_the_doubles(spark):
    rng = np.random.default_rng(9)
    edges = [2.0**e for e in range(-1074, 1024)] + [np.nextafter(2.0**e, 0) for e in range(-1073, 1024)] + [5e-324, 1.7976931348623157e308]
    values = np.concatenate([np.frombuffer(rng.bytes(80_000), dtype=np.float64), edges, [0.0]])
    values = values[np.isfinite(values)]
    values = np.concatenate([values, -values, [np.inf, -np.inf]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.v: r.b for r in with_ordered_bits(df, "v", "b").collect()}
    for v, b in got.items():
        assert b == np.sign(v) * np.float64(abs(v)).view(np.int64)
    last = spark.createDataFrame([(float("nan"),)], "v double")
    last = with_ordered_bits(last, "v", "b").first().b
    assert last > max(got.values())
