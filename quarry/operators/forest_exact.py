"""Random forest grown level by level, all trees of a level in the same jobs (M-8, M-9).

The splits are those of ``tree`` (exact quantile thresholds, exact category counts); the tree
number is part of the node key (``node_id = heap number * trees + tree``), so a level of the
whole forest is one set of aggregates and its size is (rows x trees), not one job a tree.

* **Bootstrap.**  Row r counts w times in tree t, w from the Poisson(1) distribution by one
  md5 draw of (seed, row key, t): what sampling n of n rows with replacement tends to, drawn
  row by row, so the same on any layout.
* **Feature subset.**  Each node looks at the ``sqrt`` or ``log2`` of the encoded features with
  the smallest md5(seed:node:feature).
* **Rows** are written once, with their weights of all trees, and sent down the splits so far in
  each level (broadcast joins; written again every ``STRIDE`` levels); rows of leaves leave.
* **Prediction.**  The mean over the trees of the leaf's share of positives; 1 above 0.5.
* **Importance.**  A split adds its rows times its score to its feature; each tree's sum is
  scaled to 1, the trees that split at all are averaged.

Driver and broadcasts hold nodes and splits only: at most trees x 2^depth rows, parameters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.draws import uniform
from quarry.operators.encode import Encoder
from quarry.operators.tree import SPLIT_SCHEMA, best_splits, prepare
from quarry.session import cut_lineage

NODES = "node_id long, tree int, depth int, count long, positive long, feature_idx long, score double"
# P(at most k) of the Poisson distribution with mean 1.
CUMULATIVE = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]
STRIDE = 4  # levels that rows are sent down anew before they are written at their nodes


def bootstrap_weight(seed: int, key: Column, tree: Column) -> Column:
    """How often a row is drawn for a tree."""
    u = uniform(seed, key, F.concat(F.lit("tree:"), tree.cast("string")))
    return reduce(add, [(u > c).cast("long") for c in CUMULATIVE])


def subset_size(width: int, max_features: str) -> int:
    return max(1, int(math.sqrt(width) if max_features == "sqrt" else math.log2(width)))


def allowed_features(nodes: DataFrame, width: int, count: int, seed: int) -> DataFrame:
    """(node_id, feature_idx): the features each node may split on."""
    each = nodes.select("node_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))).alias("feature_idx"))
    rank = F.row_number().over(Window.partitionBy("node_id").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "node_id", "feature_idx"))))
    return each.withColumn("_r", rank).where(F.col("_r") <= count).drop("_r")  # a node's features are one row each


@dataclass
class Forest:
    encoder: Encoder
    trees: int
    nodes: list   # tuples in the order of NODES
    splits: list  # tuples in the order of SPLIT_SCHEMA

    def node_table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def _step(self, rows: DataFrame, depth: int, how: str = "left") -> DataFrame:
        """Rows at nodes of ``depth`` moved to their child; the others stay (leave, if ``how`` is inner)."""
        spark = rows.sparkSession
        level = spark.createDataFrame([s for s in self.splits if s[5] == depth], SPLIT_SCHEMA).drop("_depth")
        left = F.when(F.col("_kind") == "num", F.element_at("_x", F.col("_idx") + 1) <= F.col("_thr")).otherwise(
            ~F.element_at("_c", F.col("_idx") + 1).eqNullSafe(F.col("_cat")))
        heap, tree = F.floor(F.col("node_id") / self.trees), F.col("node_id") % self.trees
        child = (2 * heap + F.when(left, 0).otherwise(1)) * self.trees + tree
        return rows.join(F.broadcast(level), "node_id", how).withColumn("node_id", F.when(F.col("_kind").isNull(), F.col("node_id")).otherwise(child)).drop(
            "_kind", "_idx", "_cat", "_thr")

    def predict(self, frame: DataFrame, key: str) -> DataFrame:
        """``frame`` with ``probability`` and ``prediction``; ``key`` names a row."""
        rows = prepare(frame, self.encoder, None, keep=True).select(F.col(key).alias("_key"), "_x", "_c", F.explode(
            F.sequence(F.lit(0), F.lit(self.trees - 1))).alias("_t")).withColumn("node_id", F.col("_t").cast("long") + self.trees)
        for depth in range(max([s[5] + 1 for s in self.splits], default=0)):
            rows = self._step(rows, depth)
        share = self.node_table(frame.sparkSession).select("node_id", (F.col("positive") / F.col("count")).alias("_share"))
        # a sum a tree, combined before the shuffle, so that a row is shuffled once and not once a tree
        votes = rows.join(F.broadcast(share), "node_id").groupBy("_key").agg(
            *[F.sum(F.when(F.col("_t") == t, F.col("_share"))).alias(f"_v{t}") for t in range(self.trees)])
        mean = reduce(add, [F.coalesce(f"_v{t}", F.lit(0.0)) for t in range(self.trees)]) / self.trees  # in the trees' order
        votes = votes.select(F.col("_key").alias(key), mean.alias("probability"))
        return frame.join(votes, key).withColumn("prediction", (F.col("probability") > 0.5 + 1e-12).cast("int"))

    def importances(self, spark) -> DataFrame:
        """M-9: (feature, importance) of every encoded feature that any tree splits on."""
        split = self.node_table(spark).where(F.col("feature_idx").isNotNull())
        own = split.groupBy("tree", "feature_idx").agg(F.sum(F.col("count") * F.col("score")).alias("gain"))
        whole = own.groupBy("tree").agg(F.sum("gain").alias("all"))
        grown = max(1, len({n[1] for n in self.nodes if n[5] is not None}))
        mean = own.join(whole, "tree").groupBy("feature_idx").agg((F.sum(F.col("gain") / F.col("all")) / grown).alias("importance"))
        return mean.join(self.encoder.names(), "feature_idx").select("feature", "importance")


def grow_forest(train: DataFrame, key: str, encoder: Encoder, label: str, trees: int = 100, max_depth: int = 12, min_leaf: int = 10,
                max_features: str = "sqrt", seed: int = 42, bins: int = 32) -> Forest:
    """M-8 by the exact engine; ``key`` names a row of ``train``."""
    if trees < 1 or max_depth < 1 or min_leaf < 1:
        raise ValueError("trees, depth and leaf size must be positive")
    if max_features not in ("sqrt", "log2"):
        raise ValueError("max_features must be sqrt or log2")
    spark = train.sparkSession
    forest = Forest(encoder, trees, [], [])
    rows = prepare(train, encoder, label, keep=True).select(F.col(key).cast("string").alias("_key"), "_x", "_c", "_y")
    base = cut_lineage(rows.select("_x", "_c", "_y", F.array(*[bootstrap_weight(seed, F.col("_key"), F.lit(t)) for t in range(trees)]).alias("_ws")))
    drawn = base.select("_x", "_c", "_y", F.posexplode("_ws").alias("_t", "_w")).where(F.col("_w") > 0)
    start, written = drawn.select((F.col("_t") + trees).cast("long").alias("node_id"), "_x", "_c", "_y", "_w"), 0
    count = subset_size(encoder.width, max_features)
    for depth in range(max_depth + 1):
        frontier = start
        for done in range(written, depth):
            frontier = forest._step(frontier, done, "inner")
        if depth - written == STRIDE and depth < max_depth:
            start, written = cut_lineage(frontier), depth
            frontier = start
        stats = frontier.groupBy("node_id").agg(F.sum("_w").alias("n"), F.sum(F.col("_w") * F.col("_y")).alias("p")).collect()
        open_nodes = [(r["node_id"], r["n"], r["p"]) for r in stats if depth < max_depth and 0 < r["p"] < r["n"] and r["n"] >= 2 * min_leaf]
        best = {}
        if open_nodes:
            nodes = spark.createDataFrame(open_nodes, "node_id long, n long, p long")
            allowed = cut_lineage(allowed_features(nodes, encoder.width, count, seed))
            todo = frontier.join(F.broadcast(nodes.select("node_id")), "node_id", "left_semi")
            best = {r["node_id"]: r for r in best_splits(todo, nodes, encoder, "gini", min_leaf, bins, allowed=allowed).collect()}
        for r in sorted(stats, key=lambda r: r["node_id"]):
            s = best.get(r["node_id"])
            forest.nodes.append((r["node_id"], r["node_id"] % trees, depth, r["n"], r["p"], s and s["feature_idx"], s and s["score"]))
            if s:
                forest.splits.append((r["node_id"], s["kind"], s["idx"], s["category"], s["threshold"], depth))
        if not best:
            break
    return forest
