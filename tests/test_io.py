"""Readers and writers: records CSV, saved partitions / sweeps, sinks."""

import json

from quarry.operators import itemsets as I
from quarry.operators import rules as R
from quarry.sources import results, sinks
from quarry.sources.records import read_labelled


def test_read_labelled(spark, tmp_path):
    path = tmp_path / "adult.test"
    path.write_text("|1x3 Cross validator\n"
                    "25, Private, 226802, 11th, 7, Never-married, Machine-op-inspct, Own-child, Black, Male, 0, 0, 40, United-States, <=50K.\n"
                    "38, ?, 89814, HS-grad, 9, Married-civ-spouse, Farming-fishing, Husband, White, Male, 0, 0, 50, United-States, >50K.\n"
                    "1, 2, 3\n")
    df = read_labelled(spark, str(path))
    rows = df.orderBy("age").collect()
    assert [r.label for r in rows] == [0, 1]
    assert rows[1].workclass == "?" and rows[0].age == 25.0


def test_saved_partition_and_sweep(spark, tmp_path):
    (tmp_path / "p.csv").write_text("CustomerId,Age,Cluster\na,1,2\nb,3,1\n")
    part = results.read_partition(spark, str(tmp_path / "p.csv"))
    assert sorted((r.id, r.cluster) for r in part.collect()) == [("a", 2), ("b", 1)]
    (tmp_path / "s.json").write_text(json.dumps({"splits": [{"train_share": 0.6, "f1": 0.5},
                                                            {"train_share": 0.8, "f1": 0.62}]}))
    row = results.read_sweep_row(spark, str(tmp_path / "s.json"), "splits", "train_share", 0.8).collect()
    assert len(row) == 1 and row[0].f1 == 0.62


def test_sinks(spark, tmp_path):
    b = spark.createDataFrame([(0, ["a", "b"]), (1, ["a", "b"]), (2, ["a", "c"]), (3, ["b", "c"])],
                              "basket_id long, items array<string>")
    its = I.frequent_itemsets(b, "50%")
    sinks.write_itemsets(its, I.itemset_levels(its, 3), str(tmp_path / "it"), single_file=True)
    back = spark.read.json(str(tmp_path / "it" / "itemsets"))
    assert I.same_rows(back.selectExpr("items", "count"), its.selectExpr("items", "count"))
    rules = R.generate_rules(its, "60%")
    sinks.write_rules(rules, str(tmp_path / "rt"), fmt="text", single_file=True)
    text = spark.read.text(str(tmp_path / "rt")).collect()
    assert len(text) == 2 and "a → b" in text[0].value
    sinks.write_rules(R.generate_rules(its, "100%"), str(tmp_path / "none"), fmt="text")
    assert spark.read.text(str(tmp_path / "none")).first().value == R.NO_RULES


def test_report_without_rules_is_read_back_empty(spark, tmp_path):
    """Baskets of one item have no rules: the written file has no line to infer columns from."""
    from quarry.plans import exports
    folder = str(tmp_path)
    spark.createDataFrame([(i, f"T{i}") for i in range(3)], "p_partkey long, p_type string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(9)], "l_orderkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    found = exports.q_export_rules(spark, folder)
    assert found.columns == ["antecedent", "consequent", "rule", "total_length", "count", "support", "confidence"]
    assert found.count() == 0
