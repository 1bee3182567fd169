"""Random forest that tells whether an aircraft is on the ground."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.operators.features import FEATURES
from contrail.operators.sampling import stratified_split
from contrail.session import listed

# Model settings.
TREES = 200
DEPTH = 10
MIN_LEAF = 5
TEST_SIZE = 0.2
SEED = 42
CLASS_NAMES = {0: "airborne", 1: "on_ground"}
#: Trees grown in one run over the rows: Spark keeps a draw of each row for every one of them, and counts for every node.
GROVE = 20


def assemble(matrix: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(matrix)


def class_weights(matrix: DataFrame) -> DataFrame:
    """Weight n / (classes * n_class) of each class, so that all count the same."""
    sizes = matrix.groupBy("label").agg(F.count(F.lit(1)).alias("support"))
    whole = sizes.agg(F.sum("support"), F.count(F.lit(1))).toDF("n", "classes")
    n, classes = (whole.select(c).scalar() for c in ("n", "classes"))
    return sizes.select("label", "support", (n / (classes * F.col("support"))).alias("weight"))


@dataclass
class OngroundForest:
    """A forest as groups of trees; each tree has the same weight, as in one forest of them all."""

    groves: list[RandomForestClassificationModel]

    @property
    def getNumTrees(self) -> int:
        return sum(g.getNumTrees for g in self.groves)

    @property
    def featureImportances(self) -> np.ndarray:
        """Mean of the groups by their trees, as shares of one."""
        whole = sum(g.getNumTrees * g.featureImportances.toArray() for g in self.groves)
        return whole / (whole.sum() or 1.0)

    def save(self, path: str) -> None:
        for i, grove in enumerate(self.groves):
            grove.write().overwrite().save(f"{path}/grove={i:04d}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OngroundForest:
        """What `save` left at the path; a model that lies there by itself is a forest of one group."""
        names = sorted(name for name, _ in listed(spark, path) if name.startswith("grove="))
        return cls([RandomForestClassificationModel.load(f"{path}/{n}" if n else path) for n in names or [""]])


def train_onground(
    matrix: DataFrame, keys: Sequence[str] = ("icao24", "time_position"), trees: int = TREES
) -> tuple[OngroundForest, DataFrame]:
    """Fit on 80 % of the rows; returns the model and the held-out rows, predicted.

    Every tree sees all of these rows. A few trees are grown at a time, so that
    what a row and a node take in memory does not grow with the number of trees.
    """
    train, test = stratified_split(matrix, keys, TEST_SIZE, SEED)
    weights = F.broadcast(class_weights(train).select("label", "weight"))  # one row per class
    rows = assemble(train).join(weights, "label").select("features", "label", "weight").persist()
    groves = []
    for first in range(0, trees, GROVE):
        forest = RandomForestClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            numTrees=min(GROVE, trees - first),
            maxDepth=DEPTH,
            minInstancesPerNode=MIN_LEAF,
            seed=SEED + first,
        )
        groves.append(forest.fit(rows))
    rows.unpersist()
    model = OngroundForest(groves)
    return model, predict_onground(model, test)


def predict_onground(model: OngroundForest, matrix: DataFrame) -> DataFrame:
    """Adds the class and its probability, the mean over all trees."""
    scored, shares = assemble(matrix), []
    for i, grove in enumerate(model.groves):
        alone = grove.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_grove{i}")
        scored = alone.transform(scored)
        shares.append(vector_to_array(f"_grove{i}")[1] * grove.getNumTrees)
    probability = reduce(lambda a, b: a + b, shares) / model.getNumTrees
    scored = scored.withColumn("onground_probability", probability)
    scored = scored.withColumn("prediction", (F.col("onground_probability") > 0.5).cast("double"))
    return scored.drop("features", *[f"_grove{i}" for i in range(len(model.groves))])


def classification_report(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    confusion = predicted.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("of_class"), zero.alias("guessed"), hit.alias("hits")),
        F.struct(F.col("guess").alias("class"), zero.alias("of_class"), F.col("n").alias("guessed"), zero.alias("hits")),
    )
    totals = (
        confusion.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("of_class", "guessed", "hits")])
    )
    zero_if_none = lambda ratio: F.coalesce(ratio, F.lit(0.0))
    precision = zero_if_none(F.try_divide("hits", "guessed"))
    recall = zero_if_none(F.try_divide("hits", "of_class"))
    names = F.create_map(*[F.lit(v) for pair in CLASS_NAMES.items() for v in pair])
    return totals.select(
        F.try_element_at(names, F.col("class")).alias("class"),
        precision.alias("precision"),
        recall.alias("recall"),
        zero_if_none(F.try_divide(2 * F.col("hits"), F.col("of_class") + F.col("guessed"))).alias("f1"),
        F.col("of_class").alias("support"),
    )


def report_averages(report: DataFrame) -> DataFrame:
    """Accuracy, plain and support-weighted means of a classification report, in its columns."""
    weight = F.col("support") / F.sum("support").over(Window.partitionBy())  # two classes
    weighted = report.select("*", weight.alias("weight"))
    figures = ("precision", "recall", "f1")
    means = weighted.agg(
        F.sum(F.col("recall") * F.col("weight")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in figures],
        *[F.sum(F.col(c) * F.col("weight")).alias(f"weighted_{c}") for c in figures],
        F.sum("support").alias("support"),
    )
    rows = [("accuracy", ["accuracy"] * 3), *((f"{k} avg", [f"{k}_{c}" for c in figures]) for k in ("macro", "weighted"))]
    structs = [
        F.struct(F.lit(name).alias("class"), *[F.col(c).alias(f) for c, f in zip(columns, figures, strict=True)], "support")
        for name, columns in rows
    ]
    return means.select(F.inline(F.array(*structs)))


def feature_importances(spark: SparkSession, model: OngroundForest) -> DataFrame:
    """Importance of each feature, highest first."""
    rows = [(name, float(v)) for name, v in zip(FEATURES, model.featureImportances)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))
