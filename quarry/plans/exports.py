"""Results written by the sinks and read back (SRC-1, SRC-4, SRC-5, SNK-1..SNK-6, O-1..O-4).

Every query writes what another one computes to a working folder of its own and returns what a
reader finds there, so the SQL of that result also holds for the file format.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import itemsets as I
from quarry.operators import quality as Q
from quarry.operators import rules as R
from quarry.operators.running import dense_index
from quarry.plans import classify as C
from quarry.plans import inputs as IN
from quarry.plans import mining as M
from quarry.session import tables_folder
from quarry.sources import sinks
from quarry.sources.baskets import read_baskets
from quarry.sources.points import CUSTOMER_FEATURES, customer_points
from quarry.sources.results import read_partition, read_sweep_row
from quarry.sources.tables import table


def _folder(spark) -> str:
    return f"{tables_folder(spark)}/export-{uuid.uuid4().hex}"


def q_csv_baskets(spark, folder):
    """SRC-1: baskets as CSV records whose items hold a line break and a quote."""
    path = _folder(spark)
    item = lambda x: F.concat(F.lit('"'), x, F.lit('\n""brand"" "'))
    rows = IN.order_baskets(spark, folder, "p_brand").orderBy("basket_id")
    rows.select(F.array_join(F.transform("items", item), ",").alias("value")).write.text(path)
    found = read_baskets(spark, path)
    return found.select("basket_id", F.array_join(F.transform("items", lambda x: F.replace(x, F.lit("\n"), F.lit("/"))), "|").alias("items"))


def _report(spark, folder):
    baskets, n, found = M._mined(spark, folder, "p_type")
    distinct = I.basket_items(baskets).select("item").distinct().count()
    path = _folder(spark)
    rules = R.generate_rules(found, "50%")
    sinks.write_rule_report(found, I.itemset_levels(found, distinct), rules, path, n, M.SUPPORT, "50%")
    return path, rules.schema


def q_export_itemsets(spark, folder):
    """SNK-1: itemsets of a written report with the report's basket count and threshold."""
    baskets, n, found = M._mined(spark, folder, "p_brand")
    path = _folder(spark)
    distinct = I.basket_items(baskets).select("item").distinct().count()
    sinks.write_itemsets(found, I.itemset_levels(found, distinct), path, "lex", transactions=n, threshold=M.SUPPORT)
    summary = spark.read.json(f"{path}/summary").first()
    return M._itemset_rows(spark.read.json(f"{path}/itemsets")).select(
        "*", F.lit(summary["transactions"]).cast("long").alias("transactions"), F.lit(summary["threshold"]).alias("threshold"))


def q_export_levels(spark, folder):
    path, _ = _report(spark, folder)
    return spark.read.json(f"{path}/levels").select("length", "candidates", "frequent")


def q_export_rules(spark, folder):
    """SNK-2: the rules of a written report."""
    path, schema = _report(spark, folder)
    return M._rule_rows(spark.read.schema(schema).json(f"{path}/rules"))  # no rules: a file without a line to infer it from


def q_export_partition(spark, folder):
    """SNK-3 and SRC-4: points with their cluster as CSV, read back as a partition."""
    path = _folder(spark)
    assign = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") + 1).alias("cluster"))
    sinks.write_assignments(customer_points(spark, folder), assign, path, CUSTOMER_FEATURES)
    return read_partition(spark, path).select(F.col("id").cast("long").alias("id"), "cluster")


def q_export_tree(spark, folder):
    """SNK-4: the node table of a tree."""
    model, test = C._fitted(spark, folder)
    path = _folder(spark)
    sinks.write_tree(model, Q.quality(model.predict(test, IN.LABEL), IN.LABEL, "prediction"), path)
    return C.node_rows(spark.read.schema(model.node_table(spark).schema).json(f"{path}/nodes"))


@dataclass
class _Exported:
    quality: DataFrame
    importances: DataFrame


def q_export_forest(spark, folder):
    """SNK-5: the importances of a forest."""
    path = _folder(spark)
    forest, test = C._exact_forest(spark, folder)
    result = _Exported(Q.quality(forest.predict(test, IN.KEY), IN.LABEL, "prediction"), C.ranked_importances(forest, spark))
    sinks.write_forest(result, {"n_estimators": C.EXACT["trees"]}, path)
    return spark.read.json(f"{path}/importances").select("feature", "importance", F.col("rank").cast("int").alias("rank"))


def q_export_sweep(spark, folder):
    """SNK-6: a sweep as CSV."""
    path = _folder(spark)
    sinks.write_sweep(M.q_support_levels(spark, folder), path)
    return spark.read.option("header", "true").schema("threshold string, minimum_count long, length long, candidates long, frequent long").csv(path)


def q_saved_sweep_row(spark, folder):
    """SRC-5: one row of a sweep saved as a JSON document."""
    path = _folder(spark)
    sweep = M.q_support_sweep(spark, folder).where(F.col("length") == 1)  # one row a threshold
    sinks.write_sweep(sweep.agg(F.collect_list(F.struct("threshold", "minimum_count", "total")).alias("sweep")), path, "json")
    return read_sweep_row(spark, path, "sweep", "threshold", "3%").select("threshold", "minimum_count", "total")


def q_itemset_order(spark, folder):
    """O-1, O-2: each itemset's place by support and by items."""
    found = M._mined(spark, folder, "p_brand")[2]
    by_support = dense_index(found, [F.desc("count"), F.asc("items")], "by_support")
    both = dense_index(by_support, ["items"], "by_items")
    return both.select(M.joined("items").alias("items"), F.col("by_support").cast("long").alias("by_support"), F.col("by_items").cast("long").alias("by_items"))


QUERIES = {
    "csv_baskets": q_csv_baskets,
    "export_itemsets": q_export_itemsets,
    "export_levels": q_export_levels,
    "export_rules": q_export_rules,
    "export_partition": q_export_partition,
    "export_tree": q_export_tree,
    "export_forest": q_export_forest,
    "export_sweep": q_export_sweep,
    "saved_sweep_row": q_saved_sweep_row,
    "itemset_order": q_itemset_order,
}

ORACLE = {
    "csv_baskets": f"""WITH pairs AS ({M._pairs('p_brand')})
SELECT row_number() OVER (ORDER BY basket_id) - 1 AS basket_id, array_to_string(list_sort(list(item || '/"brand"')), '|') AS items
FROM pairs GROUP BY pairs.basket_id""",
    "export_itemsets": f"""SELECT *, (SELECT count(*) FROM ({M._BASKETS})) AS transactions, '{M.SUPPORT}' AS threshold
FROM ({M._itemsets_sql('p_brand', '0.01')})""",
    "export_levels": M.ORACLE["itemset_levels"],
    "export_rules": M.ORACLE["association_rules"],
    "export_partition": "SELECT c_custkey AS id, c_nationkey::BIGINT + 1 AS cluster FROM customer",
    "export_tree": C.ORACLE["tree_nodes"],
    "export_forest": C.ORACLE["forest_importance"],
    "export_sweep": M.ORACLE["support_levels"],
    "saved_sweep_row": f"SELECT threshold, minimum_count, total FROM ({M.ORACLE['support_sweep']}) WHERE length = 1 AND threshold = '3%'",
    "itemset_order": f"""SELECT items, row_number() OVER (ORDER BY count DESC, string_split(items, '|')) AS by_support,
       row_number() OVER (ORDER BY string_split(items, '|')) AS by_items FROM ({M._itemsets_sql('p_brand', '0.01')})""",
}
