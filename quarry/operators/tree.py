"""Binary classification tree, grown level by level (M-4..M-7).

Semantics (per node):

* stop at ``max_depth``, at a pure node, or when ``count < 2 * min_leaf``;
* candidate thresholds per feature: a feature whose node values are all 0/1 (one-hot
  indicators, and numeric columns too) uses 0.5; other features use the distinct
  values of the ``bins`` inner quantiles (probabilities ``i / (bins + 1)``, linear
  interpolation); constant features are skipped;
* a row goes left when ``x <= threshold``; both sides need ``min_leaf`` rows;
* the best threshold per feature is the first maximum; across features (in encoder
  order) a later feature wins only with a score larger by more than 1e-12; a split is
  kept when its score is above 1e-6;
* a leaf predicts 1 when ``2 * positive >= count``.

Execution: one round of Spark jobs per depth for *all* nodes of that depth.  Rows are
routed to their node by broadcast joins with the (model-sized) split table; numeric
features are reduced to (node, feature, value) counts before quantiles are read off a
running count, so the data is never grouped whole into one task; indicator splits
are scored from (node, column, category) counts, so the one-hot matrix is never built.
``fit_tree`` takes all counts of a level, the nodes' own too, from one scan of the rows.
Only split rows (at most ``2^depth`` per round) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.running import running_totals
from quarry.session import cut_lineage
from quarry.functions.impurity import CRITERIA, split_score
from quarry.operators.encode import Encoder

NODE_SCHEMA = ("node_id long, parent_id long, depth int, count long, positive long, prediction int, "
               "feature string, threshold double, score double")
SPLIT_SCHEMA = "node_id long, _kind string, _idx int, _cat string, _thr double, _depth int"
MIN_SCORE = 1e-6
MARGIN = 1e-12


@dataclass
class TreeModel:
    criterion: str
    max_depth: int
    min_leaf: int
    bins: int
    encoder: Encoder
    nodes: list = field(default_factory=list)    # dicts in NODE_SCHEMA order
    splits: list = field(default_factory=list)   # dicts: node_id, kind, idx, category, threshold, depth

    def node_table(self, spark) -> DataFrame:
        rows = [tuple(n[k] for k in ("node_id", "parent_id", "depth", "count", "positive", "prediction",
                                     "feature", "threshold", "score")) for n in self.nodes]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def predict(self, frame: DataFrame, label: str | None = None) -> DataFrame:
        """M-6: adds ``node_id`` (leaf) and ``prediction``."""
        spark = frame.sparkSession
        rows = prepare(frame, self.encoder, label, keep=True)
        routed = route(rows, _split_frame(spark, self.splits), self.depth())
        leaves = F.broadcast(self.node_table(spark).select("node_id", "prediction"))
        return routed.join(leaves, "node_id").drop("_x", "_c")

    def depth(self) -> int:
        return max([s["depth"] + 1 for s in self.splits], default=0)


def prepare(frame: DataFrame, encoder: Encoder, label: str | None, keep: bool = False) -> DataFrame:
    """Rows as (numeric array ``_x``, category array ``_c``, label ``_y``)."""
    cols = [F.array(*[F.col(c).cast("double") for c in encoder.numeric]).alias("_x"),
            F.array(*[F.col(c).cast("string") for c in encoder.categorical]).alias("_c")]
    if label is not None:
        cols.append(F.col(label).cast("int").alias("_y"))
    return frame.select("*", *cols) if keep else frame.select(*cols)


def _split_frame(spark, splits) -> DataFrame:
    return spark.createDataFrame([(s["node_id"], s["kind"], s["idx"], s["category"], s["threshold"], s["depth"])
                                  for s in splits], SPLIT_SCHEMA)


def route(rows: DataFrame, splits: DataFrame, depth: int) -> DataFrame:
    """Send every row down ``depth`` levels of splits (heap numbering: 2i, 2i + 1)."""
    cur = rows.withColumn("node_id", F.lit(1).cast("long"))
    for d in range(depth):
        level = F.broadcast(splits.where(F.col("_depth") == d).drop("_depth"))
        cur = cur.join(level, "node_id", "left")
        go_left = (F.when(F.col("_kind") == "num", F.element_at("_x", F.col("_idx") + 1) <= F.col("_thr"))
                   .otherwise(~F.element_at("_c", F.col("_idx") + 1).eqNullSafe(F.col("_cat"))))
        child = F.col("node_id") * 2 + F.when(go_left, 0).otherwise(1)
        cur = (cur.withColumn("node_id", F.when(F.col("_kind").isNull(), F.col("node_id")).otherwise(child))
               .drop("_kind", "_idx", "_cat", "_thr"))
    return cur


def _quantile_probs(bins: int) -> list:
    step = 1.0 / (bins + 1)
    return [i * step for i in range(1, bins + 1)]


def _weighted(frontier: DataFrame) -> DataFrame:
    """``frontier`` with the weight ``_w`` of each row (1 if it has none)."""
    return frontier if "_w" in frontier.columns else frontier.withColumn("_w", F.lit(1).cast("long"))


def level_counts(frontier: DataFrame, numeric: int, categorical: int) -> DataFrame:
    """(node_id, pos, value, category, c, vp): rows and positives by value of every column, the
    ``numeric`` ones first, as a written table: all that a level needs to know, from one scan."""
    empty = (F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("category"))
    cols = [F.struct(F.get("_x", F.lit(i)).alias("value"), empty[1]) for i in range(numeric)]
    cols += [F.struct(empty[0], F.get("_c", F.lit(i)).alias("category")) for i in range(categorical)]
    long = frontier.select("node_id", "_y", F.posexplode(F.array(*cols)).alias("pos", "_v"))
    return cut_lineage(long.groupBy("node_id", "pos", F.col("_v.value").alias("value"), F.col("_v.category").alias("category")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.col("_y").cast("long")).alias("vp")))


def _value_stats(frontier: DataFrame, allowed: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """(node, numeric feature, distinct value) counts with running and group totals; only of the
    (node_id, feature_idx) of ``allowed``, if given.  ``counts``: these counts, if there already."""
    if counts is not None:
        return _with_totals(counts)
    rows = _weighted(frontier)
    if allowed is None:
        long = rows.select("node_id", "_y", "_w", F.posexplode("_x").alias("fidx", "value"))
    else:  # a row meets its node's features only (nodes x features: parameters)
        own = allowed.select("node_id", F.col("feature_idx").cast("int").alias("fidx"))
        long = rows.join(F.broadcast(own), (rows["node_id"] == own["node_id"]) & (own["fidx"] < F.size("_x"))).select(
            rows["node_id"], "_y", "_w", "fidx", F.get("_x", F.col("fidx")).alias("value"))
    vals = long.groupBy("node_id", "fidx", "value").agg(F.sum("_w").alias("c"), F.sum(F.col("_w") * F.col("_y")).alias("vp"))
    return _with_totals(cut_lineage(vals))  # read for the totals and again for the running counts


def _with_totals(vals: DataFrame) -> DataFrame:
    totals = vals.groupBy("node_id", "fidx").agg(
        F.sum("c").alias("n"), F.sum("vp").alias("p"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.sum(F.when(~F.col("value").isin(0.0, 1.0), 1).otherwise(0)).alias("nonbin"))
    stats = running_totals(vals, ["node_id", "fidx"], "value", {"c": "cum", "vp": "cump"}).join(totals, ["node_id", "fidx"])
    return stats.where(F.col("lo") < F.col("hi"))


def numeric_candidates(frontier: DataFrame, bins: int, allowed: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Every (node, numeric feature, threshold) with its left counts.

    Quantile thresholds interpolate between the values at ranks ``floor(pos)`` and
    ``floor(pos) + 1`` (``pos = (n - 1) * q``, computed as numpy's linear method); the
    rows left of a threshold are read off the running count at the same values, so no
    second pass over the data bins them.  0/1 features use 0.5.
    """
    stats = _value_stats(frontier, allowed, counts)
    binary = (stats.where((F.col("nonbin") == 0) & (F.col("value") == 0.0))
              .select("node_id", "fidx", F.lit(0.5).alias("threshold"), F.col("cum").alias("lc"),
                      F.col("cump").alias("lp"), "n", "p"))
    probs = ", ".join(f"{q!r}D" for q in _quantile_probs(bins))
    pos = f"((n - 1) * element_at(array({probs}), i))"
    lo_rank, hi_rank = f"floor({pos})", f"least(floor({pos}) + 1, n - 1)"
    inside = "({r} >= cum - c AND {r} < cum)"
    hits = F.expr(f"filter(sequence(1, {bins}), i -> {inside.format(r=lo_rank)} OR {inside.format(r=hi_rank)})")
    picked = (stats.where(F.col("nonbin") > 0)
              .select("node_id", "fidx", "value", "c", "cum", "cump", "n", "p", F.explode(hits).alias("i")))
    lo_in, hi_in = F.expr(inside.format(r=lo_rank)), F.expr(inside.format(r=hi_rank))
    ends = (picked.groupBy("node_id", "fidx", "i")
            .agg(F.max(F.when(lo_in, F.col("value"))).alias("a"), F.max(F.when(hi_in, F.col("value"))).alias("b"),
                 F.max(F.when(lo_in, F.col("cum"))).alias("cum_a"), F.max(F.when(lo_in, F.col("cump"))).alias("cump_a"),
                 F.max(F.when(hi_in, F.col("cum"))).alias("cum_b"), F.max(F.when(hi_in, F.col("cump"))).alias("cump_b"),
                 F.first(F.expr(pos)).alias("_pos"), F.first("n").alias("n"), F.first("p").alias("p")))
    gamma = F.col("_pos") - F.floor("_pos")
    diff = F.col("b") - F.col("a")
    thr = F.when(gamma >= 0.5, F.col("b") - diff * (F.lit(1.0) - gamma)).otherwise(F.col("a") + diff * gamma)
    below_b = F.col("threshold") < F.col("b")
    quant = (ends.withColumn("threshold", thr)
             .select("node_id", "fidx", "threshold",
                     F.when(below_b, F.col("cum_a")).otherwise(F.col("cum_b")).alias("lc"),
                     F.when(below_b, F.col("cump_a")).otherwise(F.col("cump_b")).alias("lp"), "n", "p"))
    return binary.unionByName(quant).select(
        "node_id", F.col("fidx").cast("long").alias("feature_idx"), "threshold", "lc", "lp", "n", "p",
        F.lit("num").alias("kind"), F.col("fidx").cast("int").alias("idx"),
        F.lit(None).cast("string").alias("category"))


def approx_candidates(frontier: DataFrame, bins: int, accuracy: int = 10000) -> DataFrame:
    """Named approximate mode of ``numeric_candidates``: thresholds from Spark's
    ``percentile_approx`` sketch (partially aggregated, mergeable: no task ever sees a
    whole node), then rows binned against them.  Not the reference's exact quantiles."""
    stats = _value_stats(frontier)
    binary = (stats.where((F.col("nonbin") == 0) & (F.col("value") == 0.0))
              .select("node_id", "fidx", F.lit(0.5).alias("threshold"), F.col("cum").alias("lc"),
                      F.col("cump").alias("lp"), "n", "p"))
    long = frontier.select("node_id", F.posexplode("_x").alias("fidx", "value"))
    probs = F.array(*[F.lit(q) for q in _quantile_probs(bins)])
    sketch = (long.groupBy("node_id", "fidx")
              .agg(F.array_sort(F.array_distinct(F.percentile_approx("value", probs, accuracy))).alias("thr")))
    ordinary = stats.where(F.col("nonbin") > 0).join(F.broadcast(sketch), ["node_id", "fidx"])
    binned = ordinary.withColumn("bin", F.size(F.filter("thr", lambda t: t < F.col("value"))))
    hist = binned.groupBy("node_id", "fidx", "bin").agg(
        F.sum("c").alias("bc"), F.sum("vp").alias("bp"), F.first("thr").alias("thr"),
        F.first("n").alias("n"), F.first("p").alias("p"))
    run = Window.partitionBy("node_id", "fidx").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    quant = (hist.withColumn("lc", F.sum("bc").over(run)).withColumn("lp", F.sum("bp").over(run))
             .where(F.col("bin") < F.size("thr"))
             .select("node_id", "fidx", F.element_at("thr", F.col("bin") + 1).alias("threshold"),
                     "lc", "lp", "n", "p"))
    return binary.unionByName(quant).select(
        "node_id", F.col("fidx").cast("long").alias("feature_idx"), "threshold", "lc", "lp", "n", "p",
        F.lit("num").alias("kind"), F.col("fidx").cast("int").alias("idx"),
        F.lit(None).cast("string").alias("category"))


def quantile_thresholds(frontier: DataFrame, bins: int) -> DataFrame:
    """(node_id, fidx, threshold): the distinct candidate thresholds (A-10)."""
    return (numeric_candidates(frontier, bins)
            .select("node_id", F.col("idx").alias("fidx"), "threshold").distinct())


def category_candidates(frontier: DataFrame, nodes: DataFrame, encoder: Encoder, allowed: DataFrame | None = None) -> DataFrame:
    """Every (node, indicator) with its left (indicator 0) counts; threshold 0.5.  Of columns
    without any indicator among the (node_id, feature_idx) of ``allowed``, none, if it is given."""
    rows = _weighted(frontier)
    if allowed is None:
        cl = rows.select("node_id", "_y", "_w", F.posexplode("_c").alias("cidx", "category"))
    else:
        own = cut_lineage(allowed.join(encoder.vocab, "feature_idx").select("node_id", "cidx").distinct())
        cl = rows.join(F.broadcast(own), rows["node_id"] == own["node_id"]).select(
            rows["node_id"], "_y", "_w", "cidx", F.get("_c", F.col("cidx")).alias("category"))
    return _indicators(cl.groupBy("node_id", "cidx", "category").agg(F.sum("_w").alias("rc"), F.sum(F.col("_w") * F.col("_y")).alias("rp")), nodes, encoder)


def _indicators(cs: DataFrame, nodes: DataFrame, encoder: Encoder) -> DataFrame:
    cs = cs.join(F.broadcast(nodes), "node_id").where(F.col("rc") < F.col("n"))
    cs = cs.join(encoder.vocab.select("cidx", "category", "feature_idx"), ["cidx", "category"])
    return cs.select("node_id", "feature_idx", F.lit(0.5).alias("threshold"),
                     (F.col("n") - F.col("rc")).alias("lc"), (F.col("p") - F.col("rp")).alias("lp"),
                     "n", "p", F.lit("cat").alias("kind"), F.col("cidx").cast("int").alias("idx"), "category")


def scored_candidates(frontier, nodes, encoder, criterion, min_leaf, bins, quantiles="exact", allowed=None, counts=None) -> DataFrame:
    """All split candidates of the frontier nodes with ``score`` and ``valid``; ``allowed``
    (node_id, feature_idx) limits the features of each node.  ``counts``: their ``level_counts``,
    if there already."""
    if quantiles not in ("exact", "approx"):
        raise ValueError("quantiles must be 'exact' or 'approx'")
    values = by_category = None
    if counts is not None:
        width = len(encoder.numeric)
        values = counts.where(F.col("pos") < width).select("node_id", F.col("pos").alias("fidx"), "value", "c", "vp")
        by_category = counts.where(F.col("pos") >= width).select(
            "node_id", (F.col("pos") - width).alias("cidx"), "category", F.col("c").alias("rc"), F.col("vp").alias("rp"))
    numeric = numeric_candidates(frontier, bins, allowed, values) if quantiles == "exact" else approx_candidates(frontier, bins)
    cands = numeric.unionByName(category_candidates(frontier, nodes, encoder, allowed) if by_category is None else _indicators(by_category, nodes, encoder))
    if allowed is not None:
        cands = cands.join(allowed.select("node_id", "feature_idx"), ["node_id", "feature_idx"], "left_semi")
    score = split_score(criterion, F.col("lc"), F.col("lp"), F.col("n"), F.col("p"))
    valid = (F.col("lc") >= min_leaf) & (F.col("n") - F.col("lc") >= min_leaf)
    return cands.withColumn("valid", valid).withColumn("score", score)


def best_splits(frontier: DataFrame, nodes: DataFrame, encoder: Encoder, criterion: str,
                min_leaf: int, bins: int, quantiles: str = "exact", allowed: DataFrame | None = None,
                counts: DataFrame | None = None) -> DataFrame:
    """M-4 for every node of a level: (node_id, feature_idx, kind, idx, category, threshold, score).

    Each feature's first maximum (highest score, then lowest threshold) is found by a map-side
    combined minimum; a node's features are then folded in order, a feature replacing the
    best only when its score is larger by more than 1e-12.  A best score of MIN_SCORE or less
    is no split.
    """
    cands = scored_candidates(frontier, nodes, encoder, criterion, min_leaf, bins, quantiles, allowed, counts).where("valid")
    item = F.struct("feature_idx", (-F.col("score")).alias("neg"), "threshold", "score", "kind", "idx", "category")
    # a feature's first maximum is all that can win: one row per (node, feature) is gathered
    per_feature = cands.groupBy("node_id", "feature_idx").agg(F.min(item).alias("best"))
    per_node = per_feature.groupBy("node_id").agg(F.array_sort(F.collect_list("best")).alias("cands"))
    fold = F.expr(f"aggregate(transform(cands, (x, i) -> named_struct('s', x.score, 'j', i)), "
                  f"named_struct('s', 0.0D, 'j', -1), "
                  f"(acc, x) -> if(x.s > acc.s + {MARGIN!r}D, x, acc))")
    chosen = per_node.select("node_id", "cands", fold.alias("best"))
    best = F.element_at("cands", F.col("best.j") + 1)
    return chosen.where((F.col("best.j") >= 0) & (F.col("best.s") > MIN_SCORE)).select(
        "node_id", best["feature_idx"].alias("feature_idx"), best["kind"].alias("kind"),
        best["idx"].alias("idx"), best["category"].alias("category"),
        best["threshold"].alias("threshold"), best["score"].alias("score"))


def fit_tree(train: DataFrame, encoder: Encoder, label: str, criterion: str = "gini",
             max_depth: int = 6, min_leaf: int = 120, bins: int = 32, quantiles: str = "exact") -> TreeModel:
    """M-5: grow the tree breadth first; returns the model (node table + splits).

    ``quantiles='approx'`` switches thresholds to the sketch-based mode (named, never
    silent) for features with very many distinct values per node."""
    if criterion not in CRITERIA:
        raise ValueError("criterion must be information_gain, gain_ratio or gini")
    spark = train.sparkSession
    rows = prepare(train, encoder, label).persist(StorageLevel.MEMORY_AND_DISK)
    model = TreeModel(criterion, max_depth, min_leaf, bins, encoder)
    try:
        for depth in range(max_depth + 1):
            frontier = route(rows, _split_frame(spark, model.splits), depth).where(
                F.col("node_id") >= (1 << depth))
            counts = None
            if depth < max_depth and encoder.numeric and quantiles == "exact":
                counts = level_counts(frontier, len(encoder.numeric), len(encoder.categorical))
                sums = counts.where(F.col("pos") == 0).groupBy("node_id").agg(F.sum("c").alias("n"), F.sum("vp").alias("p"))
            else:
                sums = frontier.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("long").alias("p"))
            stats = sums.collect()
            if not stats:
                break
            for r in stats:
                model.nodes.append({"node_id": r["node_id"], "parent_id": r["node_id"] // 2 or None,
                                    "depth": depth, "count": r["n"], "positive": r["p"],
                                    "prediction": int(2 * r["p"] >= r["n"]),
                                    "feature": None, "threshold": None, "score": None})
            open_nodes = [(r["node_id"], r["n"], r["p"]) for r in stats
                          if depth < max_depth and 0 < r["p"] < r["n"] and r["n"] >= 2 * min_leaf]
            if not open_nodes:
                break
            nodes = spark.createDataFrame(open_nodes, "node_id long, n long, p long")
            todo = frontier.join(F.broadcast(nodes.select("node_id")), "node_id", "left_semi")
            if counts is not None:
                counts = counts.join(F.broadcast(nodes.select("node_id")), "node_id", "left_semi")
            found = best_splits(todo, nodes, encoder, criterion, min_leaf, bins, quantiles, counts=counts).collect()
            if not found:
                break
            by_id = {n["node_id"]: n for n in model.nodes}
            for s in found:
                name = (encoder.numeric[s["idx"]] if s["kind"] == "num"
                        else f"{encoder.categorical[s['idx']]}={s['category']}")
                by_id[s["node_id"]].update(feature=name, threshold=s["threshold"], score=s["score"])
                model.splits.append({"node_id": s["node_id"], "kind": s["kind"], "idx": s["idx"],
                                     "category": s["category"], "threshold": s["threshold"],
                                     "depth": depth, "feature_idx": s["feature_idx"]})
    finally:
        rows.unpersist()
    return model
