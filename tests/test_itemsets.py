"""Itemsets and rules: FIXTURES V1-V5, V18, V22 and the randomised brute-force check."""

import random
from itertools import combinations

import pytest

from quarry.operators import itemsets as I
from quarry.operators import rules as R
from quarry.params import min_count, parse_share


def frame(spark, baskets):
    rows = [(i, sorted(set(b))) for i, b in enumerate(baskets)]
    return spark.createDataFrame(rows, "basket_id long, items array<string>")


def found(df):
    return {tuple(r["items"]): r["count"] for r in df.collect()}


def brute(baskets, share):
    m = min_count(share, len(baskets))
    counts = {}
    for b in baskets:
        s = sorted(set(b))
        for k in range(1, len(s) + 1):
            for c in combinations(s, k):
                counts[c] = counts.get(c, 0) + 1
    return {c: v for c, v in counts.items() if v >= m}


def test_thresholds_and_invalid_values():
    assert min_count("7%", 100) == 7
    assert min_count("7.001%", 100) == 8
    for bad in ("0", "-1", "101%", "nan", "inf", "abc"):
        with pytest.raises(ValueError):
            parse_share(bad)
    with pytest.raises(ValueError):
        min_count(".1", 0)


def test_threshold_boundary(spark):
    baskets = [["a"]] * 7 + [["b"]] * 93
    b = frame(spark, baskets)
    assert ("a",) in found(I.frequent_itemsets(b, "7%"))
    assert ("a",) not in found(I.frequent_itemsets(b, "7.001%"))


def test_empty_basket_counts_in_n(spark):
    b = frame(spark, [["a"], []])
    assert found(I.frequent_itemsets(b, "50%")) == {("a",): 1}
    assert found(I.frequent_itemsets(b, "60%")) == {}
    levels = I.itemset_levels(I.frequent_itemsets(b, "60%"), 1).collect()
    assert [(r.length, r.candidates, r.frequent) for r in levels] == [(1, 1, 0)]


@pytest.mark.parametrize("engine", ["fpgrowth", "levelwise"])
def test_random_against_brute_force(spark, engine):
    rng = random.Random(7)
    for _ in range(4):
        baskets = [[x for x in "abcdef" if rng.random() < 0.5] for _ in range(17)]
        for share in ("1%", "30%", "100%"):
            got = found(I.frequent_itemsets(frame(spark, baskets), share, engine=engine))
            assert got == brute(baskets, share)


def test_exhaustive_matches_brute_force(spark):
    rng = random.Random(3)
    baskets = [[x for x in "abcde" if rng.random() < 0.6] for _ in range(25)]
    got = found(I.exhaustive_itemsets(frame(spark, baskets)))
    assert got == brute(baskets, "0.0001")


def test_code_point_order(spark):
    b = frame(spark, [["я", "е", "Ё"], ["я", "е"]])
    rows = I.order_itemsets(I.frequent_itemsets(b, "50%"), "lex").collect()
    items = [tuple(r["items"]) for r in rows]
    assert items == sorted(items)
    assert items[0] == ("Ё",)


def test_rules_exact(spark):
    b = frame(spark, [["a", "b"], ["a", "b"], ["a", "c"], ["b", "c"]])
    rules = R.order_rules(R.generate_rules(I.frequent_itemsets(b, "50%"), "60%")).collect()
    assert [r.rule for r in rules] == ["a → b", "b → a"]
    assert all(r.support == 0.5 and abs(r.confidence - 2 / 3) < 1e-12 for r in rules)
    lines = R.format_rules(R.generate_rules(I.frequent_itemsets(b, "50%"), "60%")).collect()
    assert all(R.CONFIDENCE_LABEL in r.line for r in lines)


def test_rule_length_cap_and_multi_item_consequents(spark):
    b = frame(spark, [["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["a"]])
    its = I.frequent_itemsets(b, "25%")
    capped = R.order_rules(R.generate_rules(its, "1%", max_total_length=2), "lex").collect()
    assert all(r.total_length <= 2 for r in capped)
    keys = [(r.antecedent, r.consequent) for r in capped]
    assert keys == sorted(keys)
    full = R.generate_rules(its, "1%").collect()
    assert len(full) == 12
    big = [r for r in full if r.total_length == 3]
    assert len(big) == 6 and sum(len(r.consequent) == 2 for r in big) == 3
    with pytest.raises(ValueError):
        R.generate_rules(its, "1%", max_total_length=1)


def test_exact_confidence_boundary(spark):
    # count 3 over antecedent 10 at 30 %: kept (decimal comparison)
    baskets = [["a", "b"]] * 3 + [["a"]] * 7
    its = I.frequent_itemsets(frame(spark, baskets), "10%")
    rules = {(tuple(r.antecedent), tuple(r.consequent)) for r in R.generate_rules(its, "30%").collect()}
    assert (("a",), ("b",)) in rules


def test_rule_counts_by_confidence_match_single_runs(spark):
    rng = random.Random(11)
    baskets = [[x for x in "abcdef" if rng.random() < 0.5] for _ in range(40)]
    its = I.frequent_itemsets(frame(spark, baskets), "5%")
    grid = ("20%", "50%", "80%")
    swept = {r.confidence: r.rules for r in R.rule_count_by_confidence(its, grid).collect()}
    assert swept == {c: R.generate_rules(its, c).count() for c in grid}


def test_read_baskets_cp1251(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_bytes("яйца,яйца,молоко\n\nяйца\n".encode("cp1251"))
    from quarry.sources.baskets import read_baskets
    b = read_baskets(spark, str(path))
    assert b.count() == 2
    got = found(I.frequent_itemsets(b, "50%"))
    assert got == {("яйца",): 2, ("молоко",): 1, ("молоко", "яйца"): 1}


def test_mining_reads_the_lines_once(spark, tmp_path, monkeypatch):
    """The search, the number of baskets and the distinct items all read the written baskets."""
    from quarry.plans import exports, mining
    folder = str(tmp_path)
    spark.createDataFrame([(i, f" B{i % 3} ") for i in range(6)], "p_partkey long, p_brand string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i // 3, i % 5) for i in range(30)], "l_orderkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    seen = []
    passed = mining.I.frequent_itemsets
    monkeypatch.setattr(mining.I, "frequent_itemsets", lambda b, *a, **k: seen.append(b) or passed(b, *a, **k))
    got = {r["items"]: r["count"] for r in exports.q_export_itemsets(spark, folder).collect()}
    baskets = [{f"B{i % 5 % 3}" for i in range(3 * b, 3 * b + 3)} for b in range(10)]
    assert got["B0"] == sum("B0" in b for b in baskets) and got["B0|B1"] == sum({"B0", "B1"} <= b for b in baskets)
    assert len(seen) == 1 and not any("lineitem" in f for f in seen[0].inputFiles())


def test_exhaustive_counts_equal_baskets_once(spark, monkeypatch):
    sizes = []
    written = I.cut_lineage
    monkeypatch.setattr(I, "cut_lineage", lambda f: sizes.append((t := written(f)).count()) or t)
    rows = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["b", "a"]) for i in range(50)], "basket_id long, items array<string>")
    assert {tuple(r["items"]): r["count"] for r in I.exhaustive_itemsets(rows).collect()} == {("a",): 50, ("b",): 50, ("a", "b"): 50}
    assert sizes and max(sizes) <= 4
