"""Model jobs: feature store, training with a freshness policy, batch scoring."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from contrail.operators.classifier import (
    TREES,
    OngroundForest,
    classification_report,
    feature_importances,
    predict_onground,
    report_averages,
    train_onground,
)
from contrail.operators.features import engineer_features
from contrail.operators.iforest import IsolationForest, train_iforest
from contrail.operators.silver import dedupe_latest
from contrail.plans.pipeline import load_predictions
from contrail.schemas import PREDICTION_KEYS
from contrail.session import discard, path_exists, settle
from contrail.sources.files import read_silver_dir, write_layer
from contrail.sources.tables import read_table, utc_now

log = logging.getLogger(__name__)

MAX_AGE_HOURS = 24.0
#: Each partition brings its own counts of every node to a shuffle, so there are few large ones.
ROWS_PER_PARTITION, PARTITIONS = 1_000_000, 12


@dataclass
class Models:
    classifier: OngroundForest
    forest: IsolationForest
    encoder: DataFrame


def build_feature_store(spark: SparkSession, silver_dir: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows of every silver file of a folder, and the fitted encoder."""
    silver = read_silver_dir(spark, silver_dir)
    if "on_ground" not in silver.columns:
        raise ValueError("silver has no on_ground column, so there is nothing to learn from")
    return engineer_features(silver)


def build_score_features(silver: DataFrame, encoder: DataFrame, median: float | None = None) -> DataFrame:
    """Feature rows that keep the columns a prediction reports, as `meta`."""
    return engineer_features(silver, encoder, median)[0]


def arranged(matrix: DataFrame, ids: Sequence[str] = ("icao24", "time_position")) -> DataFrame:
    """Rows in partitions and an order that follow from the rows alone.

    Spark ML draws its samples partition by partition; this way a fit depends
    neither on the files of its input nor on the number of cores.
    """
    ids = [c for c in ids if c in matrix.columns]
    parts = max(PARTITIONS, -(-matrix.count() // ROWS_PER_PARTITION))
    rest = [c for c in matrix.columns if c not in (*ids, "meta")]
    return matrix.repartition(parts, *ids).sortWithinPartitions(*ids, *rest)


def train(matrix: DataFrame, encoder: DataFrame, trees: int = TREES) -> tuple[Models, DataFrame, DataFrame]:
    """Both models, with the held-out report and the importances."""
    matrix = settle(matrix, "features")  # read many times below
    classifier, held_out = train_onground(arranged(matrix), trees=trees)
    forest = train_iforest(matrix)
    log.info("share of anomalies in training: %s", forest.anomaly_share)
    report = classification_report(held_out)
    importances = feature_importances(matrix.sparkSession, classifier)
    return Models(classifier, forest, encoder), report, importances


def save_models(models: Models, path: str, now: datetime | None = None) -> None:
    """Save to a folder of its own; the pointer to it is written last.

    An interrupted save thus leaves the earlier models in force.
    """
    spark = models.encoder.sparkSession
    now = now or utc_now()
    version = now.strftime("%Y%m%d_%H%M%S_%f")
    home = f"{path}/{version}"
    models.classifier.save(f"{home}/onground")
    spark.createDataFrame(models.forest.nodes).write.mode("overwrite").parquet(f"{home}/forest")
    models.encoder.write.mode("overwrite").parquet(f"{home}/encoder")
    pointer = [(version, now, models.forest.sample, float(models.forest.offset), models.forest.anomaly_share)]
    schema = "version string, trained_at timestamp_ntz, sample int, offset double, anomaly_share double"
    spark.createDataFrame(pointer, schema).coalesce(1).write.mode("append").parquet(f"{path}/current")


def _newest(spark: SparkSession, path: str) -> Row:
    """The newest pointer; each save adds one, in a file of its own that appears whole or not at all."""
    return spark.read.parquet(f"{path}/current").orderBy(F.desc("version")).first()


def load_models(spark: SparkSession, path: str) -> Models:
    current = _newest(spark, path)
    home = f"{path}/{current.version}"
    nodes = spark.read.parquet(f"{home}/forest").toPandas()  # bounded by trees and sample size
    return Models(
        OngroundForest.load(spark, f"{home}/onground"),
        IsolationForest(nodes, current.sample, current.offset, current.anomaly_share),
        spark.read.parquet(f"{home}/encoder"),
    )


def models_are_fresh(
    spark: SparkSession, path: str, max_age_hours: float = MAX_AGE_HOURS, now: datetime | None = None
) -> bool:
    if not path_exists(spark, f"{path}/current/_SUCCESS"):
        return False
    trained_at = _newest(spark, path).trained_at
    return (now or utc_now()) - trained_at <= timedelta(hours=max_age_hours)


def load_or_train(
    spark: SparkSession,
    silver_dir: str,
    model_dir: str,
    force_retrain: bool = False,
    max_age_hours: float = MAX_AGE_HOURS,
    now: datetime | None = None,
    trees: int = TREES,
) -> Models:
    """Saved models while they are fresh, newly trained ones otherwise."""
    if not force_retrain and models_are_fresh(spark, model_dir, max_age_hours, now):
        return load_models(spark, model_dir)
    matrix, encoder = build_feature_store(spark, silver_dir)
    models, report, importances = train(matrix, encoder, trees)
    for row in [*report.collect(), *report_averages(report).collect(), *importances.collect()]:  # a few rows each
        log.info("%s", row.asDict())
    save_models(models, model_dir, now)
    return models


def score_features(matrix: DataFrame, models: Models, window_start: str | None = None) -> DataFrame:
    """Predictions for feature rows that carry `meta`."""
    scored = predict_onground(models.classifier, models.forest.score(matrix))
    window = window_start or utc_now().isoformat() + "+00:00"
    return scored.select(
        "meta.*",
        (F.col("prediction") == 1).alias("predicted_on_ground"),
        F.bround("onground_probability", 4).alias("onground_probability"),
        F.bround("anomaly_score", 6).alias("anomaly_score"),
        (F.col("anomaly_score") < 0).alias("is_anomaly"),
        F.lit(window).alias("window_start"),
    )


def score_batch(
    silver: DataFrame,
    models: Models,
    predictions_dir: str | None = None,
    window_start: str | None = None,
    batch: str = "batch",
    median: float | None = None,
) -> DataFrame:
    """Score a silver batch; written as CSV too if a folder is given."""
    scored = score_features(build_score_features(silver, models.encoder, median), models, window_start)
    if predictions_dir:
        write_layer(scored, f"{predictions_dir}/ml_{batch}")
    return scored


def run_ml_batch(
    spark: SparkSession,
    root: str,
    batch: str,
    silver_dir: str,
    model_dir: str,
    window_start: str,
    now: datetime | None = None,
    trees: int = TREES,
) -> dict[str, int]:
    """Score one silver batch with fresh models and load its predictions; returns and logs the totals.

    Predictions are keyed by aircraft and window, so running a batch again changes nothing.
    """
    silver = read_table(spark, root, "silver_flights").where(F.col("ingestion_batch") == batch)
    fitted = load_or_train(spark, silver_dir, model_dir, now=now, trees=trees)
    scored = settle(score_batch(silver, fitted, window_start=window_start), "scored")
    totals = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("predicted_on_ground").alias("on_ground"),
        F.count_if("is_anomaly").alias("anomalies"),
    ).first()
    latest = dedupe_latest(scored, PREDICTION_KEYS, [F.desc("anomaly_score"), F.desc("onground_probability")])
    figures = totals.asDict() | {"loaded": load_predictions(latest, root, now)}
    discard(scored)
    log.info("batch %s: %s", batch, figures)
    return figures
