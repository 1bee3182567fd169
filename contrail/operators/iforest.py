"""Isolation forest (Liu, Ting and Zhou, 2008) trained and scored on Spark.

Spark draws a small sample for every tree and grows each tree in its own task.
Only the nodes, whose number is fixed by the settings, reach the driver; rows
are scored in place by a vectorised function.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.quantiles import exact_quantile
from contrail.session import discard, settle

# Tasks get the functions below with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Model settings.
SIGNALS = ["velocity", "baro_altitude", "vertical_rate"]
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.05
SEED = 42
#: Rows that are scored at a time.
BLOCK = 512

NODE = "tree int, node int, feature int, threshold double, low int, high int, path double"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    many = np.maximum(n, 3.0)
    harmonic = np.log(many - 1.0) + np.euler_gamma
    return np.where(n > 2, 2.0 * harmonic - 2.0 * (many - 1.0) / many, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, tree: int, seed: int, max_depth: int) -> list[tuple]:
    """Nodes of one tree, root first; leaves carry the path length they stand for."""
    rng = np.random.default_rng([seed, tree])
    nodes: list[tuple] = []
    todo = [(0, points, 0)]
    free = 1
    while todo:
        node, rows, depth = todo.pop()
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth >= max_depth or len(spread) == 0:
            nodes.append((tree, node, -1, 0.0, node, node, float(depth + average_path(len(rows)))))
            continue
        feature = int(rng.choice(spread))
        column = rows[:, feature]
        threshold = rng.uniform(column.min(), column.max())
        below = column <= threshold
        nodes.append((tree, node, feature, float(threshold), free, free + 1, 0.0))
        todo += [(free, rows[below], depth + 1), (free + 1, rows[~below], depth + 1)]
        free += 2
    return nodes


def sample_per_tree(
    matrix: DataFrame, n: int, trees: int, size: int, seed: int, ids: Sequence[str]
) -> DataFrame:
    """Up to `size` of the `n` rows for every tree: (tree, signals).

    Each row draws by a hash of its ids and signals, whatever file or partition
    it lies in: it goes to 2 * trees * size / n trees, the fraction by chance, at
    most to all of them. Which ones is again a matter of the hash, and so are the
    `size` rows that a tree keeps; the row number drops others in the map tasks.
    """
    row = F.xxhash64(F.lit(seed), *ids, *SIGNALS)
    chance = F.pmod(F.xxhash64("_row", F.lit(-1)), F.lit(1 << 20)) / (1 << 20)
    copies = F.least(F.lit(trees), F.floor(F.lit(2 * trees * size / max(n, 1)) + chance)).cast("int")
    places = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64("_row", t), t.alias("tree"))
    )
    order = Window.partitionBy("tree").orderBy("_place", *SIGNALS)
    return (
        matrix.select(*SIGNALS, row.alias("_row"))
        .withColumn("_copies", copies)
        .where("_copies > 0")
        .select("*", F.explode(F.slice(F.array_sort(places), F.lit(1), F.col("_copies"))).alias("_p"))
        .select(*SIGNALS, F.col("_p.tree").alias("tree"), F.xxhash64("_row", F.lit(-2), "_p.tree").alias("_place"))
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") <= size)
        .select("tree", *SIGNALS)
    )


@dataclass
class IsolationForest:
    """Node table of a fitted forest. `offset` separates anomalies from the rest.

    `anomaly_share` is the share of training rows that came out as anomalies.
    """

    nodes: pd.DataFrame
    sample: int
    offset: float = -0.5
    anomaly_share: float | None = None

    def _arrays(self) -> dict[str, np.ndarray]:
        """Nodes of all trees in one row of places: roots, signal, threshold, the places above and below it, path."""
        tree, node = (self.nodes[c].to_numpy() for c in ("tree", "node"))
        roots = np.arange(tree.max() + 1) * (node.max() + 1)
        places = roots[tree] + node
        grids = {"roots": roots}
        for name, kind in [("feature", "i8"), ("threshold", "f8"), ("path", "f8")]:
            grids[name] = np.zeros(len(roots) * (node.max() + 1), dtype=kind)
            grids[name][places] = self.nodes[name]
        grids["feature"] = np.maximum(grids["feature"], 0)  # a leaf leads to itself, whatever it looks at
        grids["next"] = np.zeros((len(grids["path"]), 2), dtype="i8")
        grids["next"][places, 0], grids["next"][places, 1] = (roots[tree] + self.nodes[c] for c in ("high", "low"))
        return grids

    def score(self, matrix: DataFrame, column: str = "anomaly_score") -> DataFrame:
        """Add the decision score; below zero is an anomaly. Rows go in blocks that stay in a core's cache."""
        grids = matrix.sparkSession.sparkContext.broadcast(self._arrays())
        scale, offset = float(average_path(self.sample)) or 1.0, self.offset
        depth = math.ceil(math.log2(max(self.sample, 2)))

        @F.pandas_udf("double")
        def decide(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            g = grids.value
            following = g["next"].ravel()
            for series in batches:
                x = np.stack([s.to_numpy(dtype=float) for s in series], axis=1)
                scores = np.empty(len(x))
                for start in range(0, len(x), BLOCK):
                    block = x[start : start + BLOCK]
                    signals, row = block.ravel(), np.arange(len(block)) * block.shape[1]
                    place = np.repeat(g["roots"][:, None], len(block), axis=1)
                    for _ in range(depth):
                        below = signals.take(g["feature"].take(place) + row) <= g["threshold"].take(place)
                        place = following.take(2 * place + below)
                    scores[start : start + BLOCK] = g["path"].take(place).mean(axis=0)
                yield pd.Series(-np.exp2(-scores / scale) - offset)

        return matrix.withColumn(column, decide(*SIGNALS))


def train_iforest(
    matrix: DataFrame,
    trees: int = TREES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    sample_size: int = SAMPLE,
    ids: Sequence[str] = ("icao24", "time_position"),
) -> IsolationForest:
    """Fit on the three signals; the offset puts `contamination` of the rows below zero.

    Each tree is grown from at most `sample_size` rows, a part of the algorithm.
    The same rows give the same forest, however they are partitioned. `matrix`
    should be stored rows, as it is read three times. Eager.
    """
    n = matrix.count()
    size = min(sample_size, n)
    max_depth = math.ceil(math.log2(max(size, 2)))

    def build(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(SIGNALS)  # the order of arrival must not matter
        grown = grow_tree(rows[SIGNALS].to_numpy(dtype=float), int(group[0]), seed, max_depth)
        return pd.DataFrame(grown, columns=["tree", "node", "feature", "threshold", "low", "high", "path"])

    # A tree gets at most `size` rows, so a group is small whatever the data.
    samples = sample_per_tree(matrix, n, trees, size, seed, [c for c in ids if c in matrix.columns])
    nodes = settle(samples.groupBy("tree").applyInPandas(build, NODE), "trees")
    # At most trees * (2 * size - 1) nodes come to the driver.
    forest = IsolationForest(nodes.orderBy("tree", "node").toPandas(), size, 0.0)
    raw = settle(forest.score(matrix.select(*SIGNALS), "score").select("score"), "scores")
    forest.offset = exact_quantile(raw, "score", contamination, name="offset").first().offset
    forest.anomaly_share = raw.agg(F.count_if(F.col("score") < forest.offset) / F.count(F.lit(1))).first()[0]
    discard(nodes)
    discard(raw)
    return forest
