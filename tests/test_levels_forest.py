"""Levels of many thresholds, principal components and the level-wise forest against brute force."""

import hashlib
import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import encode as E
from quarry.operators import forest_exact as FX
from quarry.operators import itemsets as I
from quarry.operators import scale as SC


def brute_levels(baskets, m):
    """(length, candidates, frequent) of a level-wise search at minimum count ``m``."""
    count = lambda s: sum(set(s) <= b for b in baskets)
    items = sorted(set().union(*baskets))
    level = [(i,) for i in items if count((i,)) >= m]
    out, k = [(1, len(items), len(level))], 2
    while level:
        have = set(level)
        singles = sorted({i for s in level for i in s})
        cands = [c for c in combinations(singles, k) if all(s in have for s in combinations(c, k - 1))]
        level = [c for c in cands if count(c) >= m]
        out.append((k, len(cands), len(level)))
        k += 1
    return out


def test_levels_of_all_thresholds_from_one_table(spark):
    rnd = random.Random(6)
    baskets = [frozenset(rnd.sample("abcdefgh", rnd.choice([1, 2, 3, 5, 6]))) for _ in range(80)]
    frame = spark.createDataFrame([(i, sorted(b)) for i, b in enumerate(baskets)], "basket_id long, items array<string>")
    found = I.frequent_itemsets(frame, "5%", engine="levelwise")
    minimums = {"5%": 4, "10%": 8, "20%": 16, "50%": 40, "100%": 80}
    got = {}
    for r in I.support_levels(found, 8, minimums).orderBy("length").collect():
        assert r["minimum_count"] == minimums[r["threshold"]]
        got.setdefault(r["threshold"], []).append((r["length"], r["candidates"], r["frequent"]))
    assert got == {t: brute_levels(baskets, m) for t, m in minimums.items()}
    assert [tuple(r) for r in I.itemset_levels(found, 8).orderBy("length").collect()] == got["5%"]


def test_components_against_svd(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(200, 5)) @ rnd.normal(size=(5, 5))
    x -= x.mean(axis=0)
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    loadings = SC.fit_pca2(pts)
    for got, want in zip(loadings, np.linalg.svd(x)[2][:2]):
        want = want if want[np.abs(want).argmax()] > 0 else -want
        assert got == pytest.approx(want.tolist(), abs=1e-9)
    rows = {r.id: (r.pc1, r.pc2) for r in SC.project_pca2(pts, loadings).collect()}
    assert all(rows[i] == pytest.approx((x[i] @ loadings[0], x[i] @ loadings[1])) for i in range(200))
    with pytest.raises(ValueError):
        SC.fit_pca2(pts.limit(1))


def records(spark, n=600):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        a, b, c = rnd.gauss(0, 1), float(rnd.randint(0, 1)), rnd.choice("xyz")
        rows.append((f"r{i}", a, b, c, rnd.choice("uv"), int(a + b + (c == "x") > 0.8)))
    return spark.createDataFrame(rows, "key string, a double, b double, c string, d string, label int")


def test_forest_grown_level_by_level(spark):
    data = records(spark)
    enc = E.fit_encoder(data, ["a", "b"], ["c", "d"])
    forest = FX.grow_forest(data, "key", enc, "label", trees=5, max_depth=3, min_leaf=10, seed=9)
    raw = {r["key"]: r for r in data.collect()}
    splits = {s[0]: s for s in forest.splits}
    nodes = {n[0]: n for n in forest.nodes}

    def weight(key, tree):
        u = (int(hashlib.md5(f"9:{key}:tree:{tree}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        return sum(u > sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12))

    def leaf(r, tree, visit=lambda node: None):
        node = 5 + tree
        while True:
            visit(node)
            if node not in splits:
                return node
            _, kind, idx, cat, thr, _ = splits[node]
            left = (r["a"], r["b"])[idx] <= thr if kind == "num" else (r["c"], r["d"])[idx] != cat
            node = (2 * (node // 5) + (not left)) * 5 + tree

    # every node counts the drawn rows that reach it, and splits only on its own features
    seen = {}
    for key, r in raw.items():
        for tree in range(5):
            leaf(r, tree, lambda node, w=weight(key, tree), y=r["label"]: seen.setdefault(node, []).append((w, y)))
    for node, found in seen.items():
        assert (nodes[node][3], nodes[node][4]) == (sum(w for w, _ in found), sum(w * y for w, y in found))
    width = enc.width
    for node, _, _, _, _, feature, score in forest.nodes:
        if feature is not None:
            own = sorted(range(width), key=lambda f: hashlib.md5(f"9:{node}:{f}".encode()).hexdigest())[:FX.subset_size(width, "sqrt")]
            assert feature in own and score > 0
    # predictions and importances
    for r in forest.predict(data, "key").collect():
        share = [nodes[leaf(raw[r["key"]], t)] for t in range(5)]
        p = sum(n[4] / n[3] for n in share) / 5
        assert r["probability"] == pytest.approx(p) and r["prediction"] == int(p > 0.5 + 1e-12)
    weights = {r["feature"]: r["importance"] for r in forest.importances(spark).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and max(weights, key=weights.get) in ("a", "b", "c=x")
    right = sum(r["prediction"] == r["label"] for r in forest.predict(data, "key").collect())
    assert right >= 0.85 * len(raw)


def test_forest_rows_meet_nodes_without_a_shuffle(spark, capsys, monkeypatch):
    """Nodes and splits are parameters: rows must not be shuffled by node, whose keys are few and hot;
    and a row's votes are summed before they are shuffled."""
    data = records(spark)
    enc = E.fit_encoder(data, ["a", "b"], ["c", "d"])
    forest = FX.grow_forest(data, "key", enc, "label", trees=3, max_depth=6, min_leaf=5, seed=9)
    assert max(s[5] for s in forest.splits) >= FX.STRIDE  # rows were written at their nodes on the way
    monkeypatch.setattr(FX, "STRIDE", 99)
    same = FX.grow_forest(data, "key", enc, "label", trees=3, max_depth=6, min_leaf=5, seed=9)
    assert (forest.nodes, forest.splits) == (same.nodes, same.splits)
    forest.predict(data, "key").explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(node_id" not in plan and "collect_list" not in plan


def test_forest_parameters_are_checked(spark):
    data = records(spark, 30)
    enc = E.fit_encoder(data, ["a"], ["c"])
    for bad in ({"trees": 0}, {"max_depth": 0}, {"min_leaf": 0}, {"max_features": "all"}):
        with pytest.raises(ValueError):
            FX.grow_forest(data, "key", enc, "label", **bad)
    one = FX.grow_forest(data.withColumn("label", F.lit(1)), "key", enc, "label", trees=2)  # nothing to split
    assert one.splits == [] and {r["prediction"] for r in one.predict(data, "key").collect()} == {1}


def test_forests_share_their_rows_and_do_not_depend_on_kept_node_ids(spark, monkeypatch):
    from quarry.operators import forest as RF
    rnd = random.Random(3)
    rows = [(f"k{i}", rnd.random(), rnd.choice("abc"), int(rnd.random() < 0.4)) for i in range(120)]
    frame = spark.createDataFrame(rows, "key string, x double, c string, label int")
    spreads, fitted = [], []
    passed, forest = RF.spread, RF.RandomForestClassifier
    monkeypatch.setattr(RF, "spread", lambda df, key: spreads.append(df.columns) or passed(df, key=key))
    monkeypatch.setattr(RF, "RandomForestClassifier", lambda **k: fitted.append(k["cacheNodeIds"]) or forest(**k))
    found = {}
    for limit in (1 << 29, 240):  # 120 rows x 2 trees are kept, x 4 are not
        monkeypatch.setattr(RF, "NODE_IDS", limit)
        found[limit] = [(f.importances.collect(), f.quality.collect()) for f in RF.fit_forests(
            frame, frame, ("x",), ("c",), "label", (2, 4), max_depth=3, min_leaf=2)]
    assert found[240] == found[1 << 29] and fitted == [True, True, True, False]
    assert len(spreads) == 2 and all("features" not in c and "key" not in c for c in spreads)
