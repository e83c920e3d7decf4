"""Inputs that once met a cap, a rounding or a layout-dependent answer."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import itemsets as I
from quarry.operators import linkage as LK
from quarry.operators import partition as PT
from quarry.operators import rules as R
from quarry.operators import split as S
from quarry.operators.evaluate import group_spread
from quarry.operators.pairwise import within_group_sums
from quarry.params import min_count, parse_share
from quarry.sources.points import check_finite


def points(spark, n, seed=1):
    r = random.Random(seed)
    rows = [(i, [r.gauss(8 * (i % 3), 1.0), r.gauss(0, 1.0)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>"), dict(rows)


def test_thresholds_are_exact():
    assert parse_share("0.33333333334") * 3 > 1 and min_count("0.33333333334", 3) == 2
    assert min_count("33.3333333333333333333333333333333333%", 3) == 1 and min_count("1e-2", 250) == 3
    for bad in ("0", "-1%", "101%", "nan", "", "1.5", "abc", None):
        with pytest.raises(ValueError):
            parse_share(bad)


def test_confidence_sweep_agrees_with_the_rules(spark):
    sets = spark.createDataFrame([(["a"], 1, 3, 1.0), (["b"], 1, 3, 1.0), (["a", "b"], 2, 1, 0.3)],
                                 "items array<string>, length int, count long, support double")
    grid = ["0.33333333333", "0.33333333334", "20%"]
    swept = {r["confidence"]: r["rules"] for r in R.rule_count_by_confidence(sets, grid).collect()}
    assert swept == {g: R.generate_rules(sets, g).count() for g in grid} == {grid[0]: 2, grid[1]: 0, grid[2]: 2}


def test_support_sweep_reports_empty_thresholds(spark):
    sets = spark.createDataFrame([(["a"], 1, 5, 0.5)], "items array<string>, length int, count long, support double")
    rows = {r["threshold"]: r for r in I.support_sweep(sets, 10, ["1%", "90%"]).collect()}
    assert rows["1%"]["total"] == 1 and rows["90%"]["total"] == 0 and rows["90%"]["length"] is None


def test_wide_basket(spark):
    baskets = spark.createDataFrame([(1, [f"i{k:02}" for k in range(70)])], "basket_id long, items array<string>")
    got = I.exhaustive_itemsets(baskets, max_length=2)
    assert got.count() == 70 + math.comb(70, 2)


def test_split_keeps_rows_without_a_label(spark):
    frame = spark.createDataFrame([(i, None if i % 6 == 0 else i % 2) for i in range(31)], "k long, y int")
    done = S.stratified_split(frame, "k", "y", 0.8)
    assert done.count() == 31 and done.where("is_train").count() == math.floor(0.8 * 31)


def test_group_sums_by_two_keys_and_large_numbers(spark):
    frame = spark.createDataFrame([(r, c, i, [float(i)]) for i, (r, c) in enumerate((r, c) for r in (0, 1) for c in (0, 1000, 1000))],
                                  "run long, cluster long, id long, features array<double>")
    got = {(x["run"], x["cluster"], x["id"]): x["dist_sum"] for x in within_group_sums(frame, ["run", "cluster"]).collect()}
    assert got == {(0, 0, 0): 0, (0, 1000, 1): 1, (0, 1000, 2): 1, (1, 0, 3): 0, (1, 1000, 4): 1, (1, 1000, 5): 1}


def test_medoids_carry_their_clusters_numbers(spark):
    pts, _ = points(spark, 60)
    assign, medoids, summary = PT.kmedoids(pts, 3)
    own = {r["id"]: r["cluster"] for r in assign.collect()}
    meds = medoids.collect()
    assert len(meds) == 3 and all(own[m["id"]] == m["cluster"] for m in meds)
    first = {}
    for i in sorted(own):
        first.setdefault(own[i], i)
    assert sorted(first, key=first.get) == [1, 2, 3]
    assert summary.count() == 1


def test_kmeans_does_not_depend_on_the_input_layout(spark):
    pts, raw = points(spark, 200)
    out = []
    for parts in (4, 16):
        assign, centers, summary = PT.kmeans(pts.repartition(parts), 3, n_init=2, partitions=4)
        own, mid = {r["id"]: r["cluster"] for r in assign.collect()}, {r["cluster"]: r["features"] for r in centers.collect()}
        for i, c in own.items():  # every label is the nearest returned centre
            assert c == min(mid, key=lambda k: (math.dist(raw[i], mid[k]), k))
        objective = sum(math.dist(raw[i], mid[c]) ** 2 for i, c in own.items())
        assert abs(objective - summary.first()["objective"]) < 1e-6 * objective
        out.append(own)
    assert out[0] == out[1]


def test_spanning_tree_halving_equals_one_task(spark):
    r = random.Random(3)
    n = 60
    edges = spark.createDataFrame([(r.randrange(b), b, r.choice([r.random(), float(b)])) for b in range(1, n)], "a long, b long, height double")
    def rows(local):
        return sorted(map(tuple, LK.merges_of_tree(edges, n, local_edges=local).collect()))
    whole = rows(1000)
    assert len(whole) == n - 1 and whole[-1][4] == n and rows(9) == whole


def test_not_finite_points_are_refused(spark):
    for bad in (float("nan"), float("inf"), None):
        with pytest.raises(ValueError):
            check_finite(spark.createDataFrame([(1, [1.0, bad])], "id long, features array<double>"))


def test_median_of_a_hot_group(spark):
    frame = spark.range(1001).select(F.lit("g").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    assert group_spread(frame, "g", "v").first()["median"] == 500.0 ** 2


def test_a_row_of_a_large_group_is_sent_to_few_tiles(spark, monkeypatch):
    from quarry.operators import pairwise as PW
    sent, tile = [], PW.tile
    monkeypatch.setattr(PW, "tile", lambda *a: sent.append(tile(*a)) or sent[-1])
    x = [[float(i * i % 97), float(i % 13)] for i in range(150)]
    frame = spark.createDataFrame([(0 if i < 120 else 1, i, x[i]) for i in range(150)], "grp int, id long, features array<double>")
    got = {r["id"]: r["dist_sum"] for r in PW.within_group_sums(frame, block_size=2).collect()}
    assert got == pytest.approx({i: sum(math.dist(x[i], x[j]) for j in range(150) if (i < 120) == (j < 120)) for i in range(150)})
    assert sent[0].groupBy("id").count().agg({"count": "max"}).first()[0] == PW.GROUP_BLOCKS
