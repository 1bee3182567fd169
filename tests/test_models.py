from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from contrail.operators import classifier, features
from contrail.operators.classifier import classification_report
from contrail.operators.iforest import SIGNALS, IsolationForest, average_path, grow_tree, sample_per_tree, train_iforest
from contrail.operators.ordinal import sorted_positions
from contrail.operators.sampling import sample_n, stratified_split
from contrail.plans import models
from contrail.plans.pipeline import load_predictions
from contrail.session import settle
from contrail.sources.files import write_layer
from contrail.sources.tables import append_silver, read_table


def random_silver(spark, n=400, seed=42):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ground = i % 5 == 0
        rows.append(
            (
                f"{i:06d}",
                ["Norway", "Kenya", "Chile", "Japan"][int(rng.integers(4))],
                float(rng.uniform(-90, 90)),
                float(rng.uniform(-180, 180)),
                1700000000 + i,
                float(rng.uniform(0, 20) if ground else rng.uniform(100, 350)) if i % 17 else None,
                float(rng.uniform(-20, 20)) if i % 19 else None,
                float(rng.uniform(0, 360)) if i % 23 else None,
                float(0 if ground else rng.uniform(1000, 12000)) if i % 13 else None,
                ground,
            )
        )
    return spark.createDataFrame(
        rows,
        "icao24 string, origin_country string, latitude double, longitude double, time_position bigint,"
        " velocity double, vertical_rate double, true_track double, baro_altitude double, on_ground boolean",
    )


@pytest.fixture(scope="module")
def silver(spark):
    return random_silver(spark).cache()


@pytest.fixture(scope="module")
def trained(silver):
    matrix, encoder = features.engineer_features(silver)
    return models.train(matrix, encoder, trees=10)


def test_matrix_has_no_gaps(silver):
    matrix, encoder = features.engineer_features(silver)
    rows = matrix.collect()
    assert len(rows) == silver.count()
    assert all(r[c] is not None and np.isfinite(r[c]) for r in rows for c in features.FEATURES)
    assert {r.label for r in rows} == {0.0, 1.0}
    assert all(r.lat_bucket % 10 == 0 and r.lon_bucket % 10 == 0 for r in rows)
    velocities = [r.velocity for r in silver.collect() if r.velocity is not None]
    filled = {r.velocity for r in rows if r.meta.velocity is None}
    assert list(filled) == [pytest.approx(float(np.median(velocities)))]
    codes = {r.origin_country: r.country_encoded for r in encoder.collect()}
    assert codes == {"Chile": 0, "Japan": 1, "Kenya": 2, "Norway": 3, "Unknown": 4}


def test_saved_median_is_used(silver):
    rows = features.impute(silver, median=-1.0).where("velocity = -1").count()
    assert rows == silver.where("velocity IS NULL").count()


def test_unseen_and_missing_countries(spark, silver):
    encoder = features.fit_country_encoder(silver)
    odd = spark.createDataFrame([("Narnia",), (None,), ("Kenya",)], "origin_country string")
    got = [r.country_encoded for r in features.encode_country(odd, encoder).orderBy("origin_country").collect()]
    assert got == [4.0, 2.0, 4.0]
    with_null = features.fit_country_encoder(spark.createDataFrame([(None,), ("Zed",), ("Ares",)], "origin_country string"))
    assert {r.origin_country: r.country_encoded for r in with_null.collect()} == {"Ares": 0, "Unknown": 1, "Zed": 2}


def test_rows_without_ground_flag_are_dropped(silver):
    cut = silver.withColumn("on_ground", F.when(F.col("velocity") > 50, F.col("on_ground")))
    assert features.engineer_features(cut)[0].count() == cut.where("on_ground IS NOT NULL").count()
    with pytest.raises(ValueError):
        features.engineer_features(silver.withColumn("on_ground", F.lit(None).cast("boolean")))


def test_sorted_positions(spark):
    values = spark.range(500).select(F.format_string("k%d", F.col("id") % 300).alias("k"))
    got = {r.k: r.pos for r in sorted_positions(values, "k", "pos").collect()}
    assert got == {k: i for i, k in enumerate(sorted(f"k{i}" for i in range(300)))}


def test_split_is_stable_and_stratified(silver):
    train, test = stratified_split(silver, ["icao24"])
    assert train.count() + test.count() == silver.count()
    again = stratified_split(silver.repartition(7), ["icao24"])[1]
    assert {r.icao24 for r in test.collect()} == {r.icao24 for r in again.collect()}
    for flag in (True, False):
        share = test.where(F.col("on_ground") == flag).count() / silver.where(F.col("on_ground") == flag).count()
        assert 0.1 < share < 0.3


def test_each_class_gives_a_fifth_to_the_nearest_row(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 13, "e": 1000, None: 7}
    rows = [(c, i, i % 3) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "label string, i int, extra int").repartition(5)
    train, test = stratified_split(df, ["label", "i"])
    assert {r.label: r["count"] for r in test.groupBy("label").count().collect()} == {c: k for c, n in sizes.items() if (k := int(n * 0.2 + 0.5))}
    assert sorted(map(str, train.unionByName(test).collect())) == sorted(map(str, df.collect()))
    again = stratified_split(df.repartition(2), ["label", "i"])[1]
    assert set(map(tuple, again.collect())) == set(map(tuple, test.collect()))
    assert set(map(tuple, stratified_split(df, ["label", "i"], seed=1)[1].collect())) != set(map(tuple, test.collect()))


def test_repeated_keys_are_split_exactly(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(10)] + [("b", 1, 0)] * 10, "label string, i int, extra int")
    train, test = stratified_split(df, ["i"])
    assert {r.label: r["count"] for r in test.groupBy("label").count().collect()} == {"a": 2, "b": 2} and train.count() == 16
    assert stratified_split(df.where("false"), ["i"])[0].count() == 0


def test_sample(silver):
    picked = {r.icao24 for r in sample_n(silver, 50, ["icao24"]).collect()}
    assert len(picked) == 50
    assert picked == {r.icao24 for r in sample_n(silver.repartition(5), 50, ["icao24"]).collect()}
    assert picked != {r.icao24 for r in sample_n(silver, 50, ["icao24"], seed=1).collect()}
    assert sample_n(silver, 10**6, ["icao24"]).count() == silver.count()


def test_report_by_hand(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    got = {r["class"]: r for r in classification_report(spark.createDataFrame(pairs, "label int, prediction int")).collect()}
    ground = got["on_ground"]
    assert (ground.precision, ground.recall, ground.support) == (3 / 5, 3 / 4, 4)
    assert ground.f1 == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    only = classification_report(spark.createDataFrame([(0, 1)], "label int, prediction int")).collect()
    assert {(r.precision, r.recall, r.f1) for r in only} == {(0.0, 0.0, 0.0)}


def test_training_finds_the_pattern(trained):
    _, report, importances = trained
    assert all(r.f1 > 0.8 for r in report.collect())
    ranked = importances.collect()
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)
    assert {ranked[0].feature, ranked[1].feature} == {"velocity", "baro_altitude"}


def test_tree_by_brute_force():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(256, 3))
    nodes = grow_tree(points, 0, 42, 8)
    assert len(nodes) <= 2 * 256 - 1
    by_id = {n[1]: n for n in nodes}
    reached = {}
    for p in points:
        node, depth = by_id[0], 0
        while node[2] >= 0:
            node, depth = by_id[node[4] if p[node[2]] <= node[3] else node[5]], depth + 1
        reached.setdefault(node[1], []).append(depth)
    for leaf, depths in reached.items():
        assert by_id[leaf][6] == pytest.approx(depths[0] + float(average_path(len(depths))))
        assert depths[0] <= 8
    assert len(grow_tree(np.zeros((10, 3)), 0, 42, 4)) == 1
    assert list(average_path(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]


@pytest.mark.parametrize("n", [300, 8000])
def test_outliers_score_lowest(spark, n):
    base = spark.range(n).select(
        F.col("id").alias("key"),
        *[(100 + F.randn(i) * 5).alias(c) for i, c in enumerate(["velocity", "baro_altitude", "vertical_rate"])],
    )
    odd = spark.createDataFrame([(-1, 900.0, -50.0, 400.0), (-2, -300.0, 800.0, 0.0)], base.schema)
    rows = base.unionByName(odd).cache()
    forest = train_iforest(rows, trees=40)
    scored = forest.score(rows).cache()
    assert {r.key for r in scored.orderBy("anomaly_score").limit(2).collect()} == {-1, -2}
    share = scored.where("anomaly_score < 0").count() / rows.count()
    assert share == pytest.approx(0.05, abs=0.01)
    assert len(forest.nodes["tree"].unique()) == 40


def test_equal_rows_keep_their_share(spark):
    """A third of the rows are copies of one row; every tree sees about a third of them."""
    n = 30000
    rows = settle(
        spark.range(n).select(
            F.col("id").alias("key"),
            *[F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(i)).alias(c) for i, c in enumerate(SIGNALS)],
        )
    )
    sample = sample_per_tree(rows, n, 10, 256, 42, ["key"])
    per_tree = sample.groupBy("tree").agg(F.count("*").alias("n"), F.count_if(F.col("velocity") == 1).alias("copies")).collect()
    assert [r.n for r in per_tree] == [256] * 10
    assert all(0.2 < r.copies / r.n < 0.47 for r in per_tree)
    assert sorted(sample.collect()) == sorted(sample_per_tree(rows, n, 10, 256, 42, ["key"]).collect())


def test_forest_is_the_same_for_any_partitioning(spark):
    rows = settle(
        spark.range(5000).select(F.col("id").alias("icao24"), *[(F.randn(i) * 5).alias(c) for i, c in enumerate(SIGNALS)])
    )
    four, eight = (train_iforest(rows.repartition(n), trees=20, sample_size=64) for n in (4, 8))
    assert four.nodes.equals(eight.nodes) and four.offset == eight.offset
    assert four.sample == 64 and four.anomaly_share == pytest.approx(0.05, abs=0.01)


def test_scoring(spark, silver, trained, tmp_path):
    fitted, _, _ = trained
    stamp = "2026-05-14T12:00:00+00:00"
    scored = models.score_batch(silver, fitted, str(tmp_path), stamp, batch="20260514")
    rows = scored.collect()
    assert len(rows) == silver.count()
    assert all(0 <= r.onground_probability <= 1 and r.window_start == stamp for r in rows)
    assert {type(r.is_anomaly) for r in rows} == {bool}
    assert 0.02 < sum(r.is_anomaly for r in rows) / len(rows) < 0.08
    assert spark.read.option("header", True).csv(f"{tmp_path}/ml_20260514").count() == len(rows)
    raw = {r.icao24: r.velocity for r in silver.collect()}
    assert all(r.velocity == raw[r.icao24] for r in rows)
    assert load_predictions(scored, str(tmp_path / "wh")) == len(rows)
    assert load_predictions(scored, str(tmp_path / "wh")) == len(rows)
    assert read_table(spark, str(tmp_path / "wh"), "gold_ml_predictions").count() == len(rows)


def test_load_or_train(spark, silver, tmp_path, at):
    silver_dir, model_dir = str(tmp_path / "silver"), str(tmp_path / "models")
    whole = silver.selectExpr(
        "icao24", "origin_country", "latitude", "longitude", "time_position", "time_position AS last_contact",
        "velocity", "vertical_rate", "true_track", "baro_altitude", "on_ground",
    )
    for part in range(2):
        write_layer(whole.where(F.col("time_position") % 2 == part), f"{silver_dir}/flight_silver_{part}.csv")
    matrix, _ = models.build_feature_store(spark, _flat(silver_dir, tmp_path))
    assert matrix.count() == silver.count()
    flat = _flat(silver_dir, tmp_path)
    first = models.load_or_train(spark, flat, model_dir, now=at(1), trees=5)
    cached = models.load_or_train(spark, "/absent", model_dir, now=at(1) + timedelta(hours=24))
    assert cached.forest.offset == first.forest.offset
    assert cached.classifier.getNumTrees == 5
    same = [models.score_batch(silver, m, window_start="w").orderBy("icao24").collect() for m in (first, cached)]
    assert same[0] == same[1]
    assert not models.models_are_fresh(spark, model_dir, now=at(1) + timedelta(hours=24, seconds=1))
    with pytest.raises(FileNotFoundError):
        models.load_or_train(spark, "/absent", model_dir, force_retrain=True, now=at(2))


def _flat(folder, tmp_path):
    """Copy the part files to single CSVs named like the daily silver files."""
    from pathlib import Path

    target = tmp_path / "flat"
    target.mkdir(exist_ok=True)
    for i, part in enumerate(sorted(Path(folder).glob("*/part-*.csv"))):
        (target / f"flight_silver_{i}.csv").write_text(part.read_text())
    return str(target)


def test_ml_batch_can_run_again(spark, silver, tmp_path):
    root, silver_dir = str(tmp_path / "wh"), str(tmp_path / "silver")
    whole = silver.withColumn("last_contact", F.col("time_position"))
    write_layer(whole.coalesce(1), f"{silver_dir}/part")
    append_silver(whole, root, "b1")
    flat = _flat(silver_dir, tmp_path)
    run = lambda: models.run_ml_batch(spark, root, "b1", flat, str(tmp_path / "models"), "2024-01-01T10:00:00+00:00", trees=5)
    first = run()
    assert first["rows"] == silver.count() == first["loaded"] and run() == first
    assert read_table(spark, root, "gold_ml_predictions").count() == first["loaded"]


def test_a_forest_in_groups_is_the_mean_of_its_trees(spark, silver, tmp_path, monkeypatch):
    """No fit grows more trees than a group has, and the groups count by their trees, stored or not."""
    matrix, _ = features.engineer_features(silver)
    monkeypatch.setattr(classifier, "GROVE", 4)
    model, _ = classifier.train_onground(models.arranged(matrix), trees=10)
    assert [g.getNumTrees for g in model.groves] == [4, 4, 2] and model.getNumTrees == 10
    assert len({t.toDebugString for g in model.groves for t in g.trees}) > 4
    model.save(str(tmp_path / "onground"))
    again = classifier.OngroundForest.load(spark, str(tmp_path / "onground"))
    got = classifier.predict_onground(again, matrix).select("icao24", "onground_probability", "prediction").collect()
    rows = classifier.assemble(matrix).select("icao24", "features").collect()
    trees = [t for g in model.groves for t in g.trees]
    for r in rows[:25]:
        mean = float(np.mean([t.predictProbability(r.features)[1] for t in trees]))
        mine = next(g for g in got if g.icao24 == r.icao24)
        assert mine.onground_probability == pytest.approx(mean) and mine.prediction == float(mean > 0.5)
    shares = np.sum([t.featureImportances.toArray() for t in trees], axis=0) / len(trees)
    assert model.featureImportances == pytest.approx(shares)


def test_block_scores_follow_every_path(spark):
    """Rows across blocks get the score that walking each tree by hand gives, thresholds below zero included."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1300, 3))
    nodes = pd.DataFrame(
        [n for t in range(5) for n in grow_tree(points[:64], t, 42, 6)],
        columns=["tree", "node", "feature", "threshold", "low", "high", "path"],
    )
    forest = IsolationForest(nodes, 64, -0.5)
    rows = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], ["key", *SIGNALS]).coalesce(1)
    got = {r.key: r.anomaly_score for r in forest.score(rows).collect()}
    by = {(n.tree, n.node): n for n in nodes.itertuples()}
    for i, p in enumerate(points):
        paths = []
        for t in range(5):
            n = by[t, 0]
            while n.feature >= 0:
                n = by[t, n.low if p[n.feature] <= n.threshold else n.high]
            paths.append(n.path)
        assert got[i] == pytest.approx(0.5 - 2 ** (-np.mean(paths) / float(average_path(64))))


def test_rows_are_arranged_in_few_large_partitions(spark):
    """Each partition sends counts of all nodes, so partitions grow with a million rows, not with fewer."""
    rows = spark.range(3_000_000).withColumnRenamed("id", "icao24")
    assert models.arranged(rows).rdd.getNumPartitions() == 12
