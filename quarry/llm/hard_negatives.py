"""Hard negatives by anchor spanning-tree bounds.

Every anchor needs its best rows of the same label (positives) and, under each positive, the
best rows of other labels inside a score window.  Anchors and rows meet in tiles, a block of
anchors by a block of rows, one task each.

* **Tree.**  The anchors of a block are joined by a minimum spanning tree (Euclidean), built
  once and stored with the block.
* **Bounds.**  In a tile the root anchor scores all rows.  Down an edge of length e, the score
  of row x lies within e * |x| of its score at the parent: an interval for every row.
* **Rescoring.**  Only rows whose interval overlaps what the anchor looks for are scored: for
  positives, scores from the k-th best lower bound up; for negatives, each positive's window,
  cut at its k-th best lower bound.  Rescored rows have exact intervals for the children.

A tile returns its best few rows per anchor (and positive); the best of the tiles are the
result, so nothing depends on how blocks are dealt.  Blocks are hashes of the id: a label that
holds a third of the rows is spread like any other.  The work is anchors times rows, in blocks
of bounded memory; no pair is a row unless it is among its tile's best.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part; of rows with one id the least (label, vector) counts; ties go to the smaller id;
a vector shorter than another counts as filled with zeros; scores must fit in a long.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ANCHOR_BLOCK, ROW_BLOCK = 1024, 4096
POSITIVES, NEGATIVES = 5, 10
WINDOW = (30, 90)  # per cent of the positive's score

_PACK = "block int, width int, ids binary, labels binary, vectors binary"


# ------------------------------------------------------------------ rows and blocks

def scaled_rows(embeddings: DataFrame) -> DataFrame:
    """(id, label, vector): rows that take part, components as floor(256 * x)."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd).select(
        F.col("vec_id").alias("id"), label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vector"))
    least = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r"))
    return least.select("id", F.col("r.label").alias("label"), F.col("r.vector").alias("vector"))


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("id")
    width = max((len(v) for v in pdf["vector"]), default=0)
    vectors = np.zeros((len(pdf), width), dtype=np.int64)
    for i, v in enumerate(pdf["vector"]):
        vectors[i, :len(v)] = v
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "width": [width], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                         "labels": [pdf["label"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()]})


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    return ids, labels, np.frombuffer(row["vectors"], np.int64).reshape(len(ids), int(row["width"]))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length): places of a minimum spanning tree's nodes as they are reached
    (Prim, from place 0), each one's parent place (-1: root) and its edge's length, rounded up."""
    x = vectors.astype(np.float64)
    m = len(x)
    near, parent = np.full(m, np.inf), np.full(m, -1, dtype=np.int64)
    free, order, length = np.ones(m, bool), np.empty(m, np.int64), np.zeros(m)
    at = 0
    for k in range(m):
        order[k], free[at] = at, False
        length[at] = near[at] * (1 + 1e-9) if k else 0.0
        far = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        better = free & (far < near)
        near[better], parent[better] = far[better], at
        at = int(np.argmin(np.where(free, near, np.inf)))
    return order, parent, length


def _with_tree(pdf: pd.DataFrame) -> pd.DataFrame:
    out = _packed(pdf)
    order, parent, length = spanning_tree(_unpacked(out.iloc[0])[2])
    return out.assign(order=[order.tobytes()], parent=[parent.tobytes()], length=[length.tobytes()])


# ------------------------------------------------------------------ tiles

class Scores:
    """Intervals of all rows' scores at one anchor after another, down the tree."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        width = min(anchors.shape[1], rows.shape[1])  # what is missing counts as 0
        self.norm = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        a, x = anchors[:, :width], rows[:, :width]
        most = [int(np.abs(v).max(initial=0)) for v in (a, x)]
        self.small = most[0] * most[1] * max(width, 1) < 2 ** 52  # sums of products are exact as doubles
        kind = np.float64 if self.small else object
        self.a, self.x = a.astype(kind), x.astype(kind)
        self.low: dict[int, np.ndarray] = {}
        self.high: dict[int, np.ndarray] = {}
        self.rescored = 0

    def exact(self, anchor: int, which: np.ndarray) -> np.ndarray:
        self.rescored += len(which)
        return self.x[which] @ self.a[anchor] if len(which) < len(self.x) else self.x @ self.a[anchor]

    def enter(self, anchor: int, parent: int, length: float) -> tuple[np.ndarray, np.ndarray]:
        if parent < 0:
            score = np.asarray(self.exact(anchor, np.arange(len(self.x))), dtype=np.float64)
            slack = 0 if self.small else np.abs(score) * 1e-9 + 1
            self.low[anchor], self.high[anchor] = score - slack, score + slack
        else:
            reach = length * self.norm + (0 if self.small else np.abs(self.low[parent]) * 1e-9 + 1)
            self.low[anchor], self.high[anchor] = self.low[parent] - reach, self.high[parent] + reach
        return self.low[anchor], self.high[anchor]

    def rescore(self, anchor: int, which: np.ndarray) -> np.ndarray:
        """Exact scores (as whole numbers) of some rows, kept as their intervals."""
        score = self.exact(anchor, which)
        slack = 0 if self.small else 1 + np.abs(score.astype(np.float64)) * 1e-9
        self.low[anchor][which], self.high[anchor][which] = score.astype(np.float64) - slack, score.astype(np.float64) + slack
        return score.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or -inf."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -math.inf


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _visits(row):
    order, parent, length = (np.frombuffer(row[c], t) for c, t in (("order", np.int64), ("parent", np.int64), ("length", np.float64)))
    left = np.bincount(parent[parent >= 0], minlength=len(order))  # children to come
    for at in order.tolist():
        yield at, int(parent[at]), float(length[at]), left


def _release(scores: Scores, at: int, parent: int, left: np.ndarray) -> None:
    if parent >= 0:
        left[parent] -= 1
        if not left[parent]:
            del scores.low[parent], scores.high[parent]
    if not left[at]:
        del scores.low[at], scores.high[at]


def _positives_tile(k: int):
    def kernel(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            row = anchors.iloc[0]
            ids, labels, vectors = _unpacked(row)
            rid, rlabel, rvec = _unpacked(rows.iloc[0])
            scores = Scores(vectors, rvec)
            for at, parent, length, left in _visits(row):
                low, high = scores.enter(at, parent, length)
                mine = np.flatnonzero((rlabel == labels[at]) & (rid != ids[at]))
                which = mine[high[mine] >= _kth(low[mine], k)]
                if len(which):
                    found = scores.rescore(at, which)
                    best = _best(rid[which], found, k)
                    out += [(int(row["block"]), int(ids[at]), int(i), int(s)) for i, s in zip(rid[which][best], found[best], strict=True)]
                _release(scores, at, parent, left)
        return pd.DataFrame(out, columns=["block", "anchor_id", "positive_id", "positive_score"])
    return kernel


def _negatives_tile(k: int, window: tuple[int, int]):
    def kernel(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            row = anchors.iloc[0]
            ids, labels, vectors = _unpacked(row)
            rid, rlabel, rvec = _unpacked(rows.iloc[0])
            wanted: dict[int, list] = {}
            for a, p, s in np.frombuffer(row["wanted"], np.int64).reshape(-1, 3).tolist():
                wanted.setdefault(a, []).append((p, s))
            scores = Scores(vectors, rvec)
            for at, parent, length, left in _visits(row):
                low, high = scores.enter(at, parent, length)
                other = rlabel != labels[at]
                need, looks = np.zeros(len(rid), bool), []
                for p, s in wanted.get(int(ids[at]), ()):
                    least, most = -(-window[0] * s // 100), window[1] * s // 100
                    if least <= most:
                        looks.append((p, s, least, most))
                        floor = _kth(low[other & (low >= least) & (high <= most)], k)
                        need |= other & (high >= max(least, floor)) & (low <= most)
                which = np.flatnonzero(need)
                if len(which):
                    found = scores.rescore(at, which)
                    for p, s, least, most in looks:
                        fits = np.flatnonzero((found >= least) & (found <= most))
                        for j in fits[_best(rid[which][fits], found[fits], k)]:
                            out.append((int(ids[at]), p, int(rid[which[j]]), s, int(found[j])))
                _release(scores, at, parent, left)
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])
    return kernel


def _add_wanted(blocks: pd.DataFrame, positives: pd.DataFrame) -> pd.DataFrame:
    rows = positives[["anchor_id", "positive_id", "positive_score"]].to_numpy(np.int64)
    return blocks.assign(wanted=[np.ascontiguousarray(rows).tobytes()] * len(blocks))


# ------------------------------------------------------------------ operator

def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
         anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """Hard negatives of the anchors among ``rows(id long, label long, vector array<long>)``:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = cut_lineage(rows)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).first()
    blocks = [max(1, math.ceil(sizes[c] / size)) for c, size in (("n", row_block), ("a", anchor_block))]
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    packed = cut_lineage(rows.withColumn("block", block(blocks[0])).groupBy("block").applyInPandas(_packed, _PACK))
    trees = cut_lineage(rows.where(is_anchor).withColumn("block", block(blocks[1])).groupBy("block").applyInPandas(
        _with_tree, _PACK + ", order binary, parent binary, length binary"))
    # every block of anchors meets every block of rows: one tile a pair of blocks
    met = packed.withColumn("_lo", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1)))).withColumn("_hi", F.col("block"))
    beside = lambda t: t.withColumn("_hi", F.explode(F.sequence(F.lit(0), F.lit(blocks[0] - 1)))).withColumn("_lo", F.col("block"))

    def tiles(anchors: DataFrame, kernel, schema: str) -> DataFrame:
        return beside(anchors).groupBy("_lo", "_hi").cogroup(met.groupBy("_lo", "_hi")).applyInPandas(kernel, schema)

    def first(found: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), ident))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    near = tiles(trees, _positives_tile(positives), "block int, anchor_id long, positive_id long, positive_score long")
    best = first(near, ["block", "anchor_id"], "positive_score", "positive_id", positives)
    asked = cut_lineage(trees.groupBy("block").cogroup(best.drop("rank").groupBy("block")).applyInPandas(
        _add_wanted, _PACK + ", order binary, parent binary, length binary, wanted binary"))
    found = tiles(asked, _negatives_tile(negatives, window), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    return first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
