"""Hard negatives against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as H
from quarry.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors, positives=5, negatives=10, window=(30, 90)):
    """rows: {id: (label, ints)}"""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  a shorter vector counts as filled with zeros
    for a in anchors:
        scores = {i: dot(rows[a][1], v) for i, (_, v) in rows.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if rows[i][0] == rows[a][0]][:positives]:
            fit = [i for i in order if rows[i][0] != rows[a][0] and window[0] * scores[p] <= 100 * scores[i] <= window[1] * scores[p]][:negatives]
            out += [(a, p, k, i, scores[p], scores[i]) for k, i in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread,blocks", [(60, (7, 50)), (60, (1000, 4000)), (10 ** 9, (9, 64))])
def test_mined_against_all_pairs(spark, spread, blocks):
    rng = np.random.default_rng(3)
    centres = rng.integers(-spread, spread + 1, (6, 8))
    rows = {}
    for i in range(420):
        label = 0 if i % 3 == 0 else int(rng.integers(0, 5))  # one label has a third and more
        rows[i] = (label, [int(v) for v in centres[label] + rng.integers(-spread // 3, spread // 3 + 1, 8)][: 8 if i % 11 else 5])
    rows |= {1000 + i: rows[12] for i in range(40)}  # copies: ties
    frame = spark.createDataFrame([(i, x, v) for i, (x, v) in rows.items()], "id long, label long, vector array<long>")
    got = H.mine(frame, F.col("id") % 10 == 0, anchor_block=blocks[0], row_block=blocks[1])
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, [i for i in rows if i % 10 == 0])


def test_query_with_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, vec(), rng.randint(0, 2)) for i in range(330)]
    odd = [(1000, None, 1), (1100, [0.1, None], 1), (1200, [float("nan")], 1), (1300, [float("inf"), 1.0], 1), (1400, vec(), None), (None, vec(), 1)]
    empty = [(1500, [], 1)]  # scores 0 with every row
    table = spark.createDataFrame(rows + odd + empty + rows[:20], SCHEMA).withColumn("id", F.lit("x")).withColumn("block", F.lit("x"))
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    want = {}
    for i, v, label in rows + empty:
        want[i] = ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
    got = sorted(tuple(r) for r in op12_hard_negatives(spark, str(tmp_path)).collect())
    assert got == brute(want, [i for i in want if i % 100 == 0])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op12_hard_negatives(spark, str(tmp_path)).collect() == []


def test_bounds_hold_and_spare_work():
    """Near anchors: intervals hold the exact scores, and most rows are never rescored."""
    rng = np.random.default_rng(1)
    anchors = rng.integers(-3, 4, (40, 16)) + 200
    rows = rng.integers(-256, 257, (3000, 16))
    order, parent, length = H.spanning_tree(anchors)
    assert sorted(order.tolist()) == list(range(40)) and (parent < 0).sum() == 1
    scores, exact = H.Scores(anchors, rows), anchors @ rows.T
    for at in order.tolist():
        low, high = scores.enter(at, int(parent[at]), float(length[at]))
        assert (low <= exact[at]).all() and (exact[at] <= high).all()
        which = np.flatnonzero(high >= H._kth(low, 5))
        assert set(np.argsort(-exact[at], kind="stable")[:5]) <= set(which.tolist()) or len(set(exact[at])) < 3000
        scores.rescore(at, which)
    assert scores.rescored < 0.5 * exact.size
