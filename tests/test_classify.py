"""Tree, split, encoder, quality: FIXTURES V8-V11, V19, V20, V24."""

import math

import pytest

from quarry.functions.impurity import split_score
from quarry.operators import encode as E
from quarry.operators import quality as Q
from quarry.operators import split as S
from quarry.operators import tree as T
from pyspark.sql import functions as F


def score(spark, criterion, lc, lp, n, p):
    df = spark.createDataFrame([(lc, lp, n, p)], "lc long, lp long, n long, p long")
    return df.select(split_score(criterion, F.col("lc"), F.col("lp"), F.col("n"), F.col("p"))).first()[0]


def test_split_scores_published_roots(spark):
    assert score(spark, "information_gain", 17585, 1149, 32561, 7841) == pytest.approx(0.15210656150745572, abs=1e-12)
    assert score(spark, "gini", 17585, 1149, 32561, 7841) == pytest.approx(0.0723071420364454, abs=1e-12)
    assert score(spark, "gain_ratio", 31706, 7001, 32561, 7841) == pytest.approx(0.2932343985453742, abs=1e-12)
    assert score(spark, "information_gain", 17067, 815, 17585, 1149) == pytest.approx(0.05201644638289493, abs=1e-12)
    assert score(spark, "gini", 10507, 3478, 14976, 6692) == pytest.approx(0.06308804030464055, abs=1e-12)
    assert score(spark, "gain_ratio", 17289, 859, 31706, 7001) == pytest.approx(0.15964848389023611, abs=1e-12)


def rows(spark, xs, ys, cats=None):
    cats = cats or ["a"] * len(xs)
    return spark.createDataFrame([(str(i), float(x), c, y) for i, (x, c, y) in enumerate(zip(xs, cats, ys))],
                                 "k string, x double, c string, y int")


@pytest.mark.parametrize("criterion", ["information_gain", "gain_ratio", "gini"])
def test_separable_tree(spark, criterion):
    df = rows(spark, [0, 0, 0, 1, 1, 1], [0, 0, 0, 1, 1, 1])
    enc = E.fit_encoder(df, ["x"], ["c"])
    model = T.fit_tree(df, enc, "y", criterion, max_depth=2, min_leaf=1)
    assert model.splits[0]["threshold"] == 0.5 and model.splits[0]["feature_idx"] == 0
    pred = {r.k: r.prediction for r in model.predict(df, "y").collect()}
    assert [pred[str(i)] for i in range(6)] == [0, 0, 0, 1, 1, 1]


def test_leaf_tie_predicts_positive(spark):
    df = rows(spark, [1, 1], [0, 1])
    enc = E.fit_encoder(df, ["x"], ["c"])
    model = T.fit_tree(df, enc, "y", "gini", min_leaf=1)
    assert len(model.nodes) == 1 and model.nodes[0]["prediction"] == 1


def test_identical_features_first_wins(spark):
    df = spark.createDataFrame([(str(i), float(i % 2), float(i % 2), "a", i % 2) for i in range(8)],
                               "k string, x1 double, x2 double, c string, y int")
    enc = E.fit_encoder(df, ["x1", "x2"], ["c"])
    model = T.fit_tree(df, enc, "y", "gini", max_depth=1, min_leaf=1)
    assert model.splits[0]["feature_idx"] == 0


def test_numpy_quantile_thresholds(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(1).integers(0, 40, 101)]
    df = rows(spark, vals, [0, 1] * 50 + [0])
    enc = E.fit_encoder(df, ["x"], ["c"])
    prepared = T.prepare(df, enc, "y").withColumn("node_id", F.lit(1).cast("long"))
    got = sorted(r.threshold for r in T.quantile_thresholds(prepared, 32).collect())
    want = sorted(set(np.quantile(np.array(vals), np.linspace(0, 1, 34)[1:-1]).tolist()))
    assert got == want


def test_quality_half(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "a int, p int")
    r = Q.quality(df, "a", "p").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.5, 0.5, 0.5)
    zero = Q.quality(spark.createDataFrame([(0, 0)], "a int, p int"), "a", "p").first()
    assert (zero.precision, zero.recall, zero.f1) == (0.0, 0.0, 0.0)


def test_quota_reproduces_published_test_positives():
    for share, test_pos in ((0.6, 3137), (0.7, 2352), (0.8, 1568), (0.9, 784)):
        n_train = math.floor(share * 32561)
        quota = S.largest_remainder({0: 32561 - 7841, 1: 7841}, n_train)
        assert 7841 - quota[1] == test_pos


def test_stratified_split_exact_sizes(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as k", "cast(id % 3 = 0 as int) as y")
    sp = S.stratified_split(df, "k", "y", 0.8, seed=42).cache()
    assert sp.where("is_train").count() == 800
    by = {(r.y, r.is_train): r["count"] for r in sp.groupBy("y", "is_train").count().collect()}
    assert by[(1, True)] + by[(0, True)] == 800
    again = S.stratified_split(df, "k", "y", 0.8, seed=42)
    assert sp.select("k", "is_train").exceptAll(again.select("k", "is_train")).count() == 0
    with pytest.raises(ValueError):
        S.stratified_split(df, "k", "y", 1.0)


def test_one_hot_vocabulary(spark):
    train = spark.createDataFrame([("1", 0.0, "b"), ("2", 0.0, "a"), ("3", 0.0, "?"), ("4", 0.0, "b")],
                                  "k string, x double, c string")
    enc = E.fit_encoder(train, ["x"], ["c"])
    names = [r.feature for r in enc.names().orderBy("feature_idx").collect()]
    assert names == ["x", "c=?", "c=a", "c=b"]
    test = spark.createDataFrame([("a1", 0.0, "a"), ("q", 0.0, "?"), ("z", 0.0, "zzz")], "k string, x double, c string")
    hot = {(r.k, r.feature) for r in enc.coordinates(test, "k").where("feature != 'x'").collect()}
    assert hot == {("a1", "c=a"), ("q", "c=?")}


def test_approx_quantile_mode_runs_and_matches_on_small_domain(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    xs = [float(v) for v in rng.integers(0, 12, 300)]
    ys = [int(x > 5) for x in xs]
    df = rows(spark, xs, ys)
    enc = E.fit_encoder(df, ["x"], ["c"])
    exact = T.fit_tree(df, enc, "y", "gini", max_depth=2, min_leaf=5)
    approx = T.fit_tree(df, enc, "y", "gini", max_depth=2, min_leaf=5, quantiles="approx")
    assert exact.splits[0]["threshold"] == approx.splits[0]["threshold"] == 5.0
    with pytest.raises(ValueError):
        T.fit_tree(df, enc, "y", "gini", quantiles="nope")


def test_shares_split_in_the_same_scans(spark, monkeypatch):
    from quarry.operators import split as SP
    rows = spark.createDataFrame([(f"k{i % 90}", [0, 1, 1, None][i % 4]) for i in range(200)], "k string, y int")  # keys repeat, labels are missing
    shares = {"a": 0.3, "b": 0.6, "c": 0.9}
    want = {f: sorted((r.k, str(r.y)) for r in S.stratified_split(rows, "k", "y", s, 7).where("is_train").collect()) for f, s in shares.items()}
    calls, counted = [], SP.hash_counts
    monkeypatch.setattr(SP, "hash_counts", lambda *a: calls.append(a) or counted(*a))
    got = S.stratified_splits(rows, "k", "y", shares, 7).collect()
    assert len(calls) == 1 and len(got) == 200
    assert {f: sorted((r.k, str(r.y)) for r in got if r[f]) for f in shares} == want


def test_a_level_is_counted_in_one_scan(spark, monkeypatch):
    import random
    rnd = random.Random(4)
    rows = [(rnd.choice([0.0, 1.0, None, 2.5]), float(rnd.randrange(9)), rnd.choice("abc"), rnd.choice(["x", None])) for _ in range(300)]
    frame = spark.createDataFrame([(*r, int((r[1] > 4) != (r[2] == "a")) if i % 17 else i % 2) for i, r in enumerate(rows)], "n1 double, n2 double, c1 string, c2 string, y int")
    enc = E.fit_encoder(frame, ["n1", "n2"], ["c1", "c2"])
    todo = T.prepare(frame, enc, "y").selectExpr("*", "1L AS node_id")
    n = frame.selectExpr("1L AS node_id", "y").groupBy("node_id").agg({"y": "sum", "*": "count"}).toDF("node_id", "p", "n")
    want = T.best_splits(todo, n, enc, "gini", 5, 8).collect()
    assert T.best_splits(todo, n, enc, "gini", 5, 8, counts=T.level_counts(todo, 2, 2)).collect() == want and len(want) == 1
    scanned = lambda *a, **k: (_ for _ in ()).throw(AssertionError("scanned again"))
    monkeypatch.setattr(T, "category_candidates", scanned)
    model = T.fit_tree(frame, enc, "y", max_depth=2, min_leaf=5, bins=8)
    assert model.nodes[0]["count"] == 300 and model.splits[0]["feature_idx"] == want[0]["feature_idx"] and len(model.splits) > 1
