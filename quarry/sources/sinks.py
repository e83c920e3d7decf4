"""Writers (SNK-1..SNK-6).

All results are DataFrames written with Spark's writers (JSON lines, CSV with header,
text), one folder per result; ``single_file`` coalesces to one part only on request
(small, ordered reports), never by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.itemsets import order_itemsets
from quarry.operators.rules import NO_RULES, format_rules, order_rules


def _out(frame: DataFrame, single_file: bool) -> DataFrame:
    return frame.coalesce(1) if single_file else frame


def write_itemsets(itemsets: DataFrame, levels: DataFrame, path: str, order: str = "support",
                   single_file: bool = False, transactions: int | None = None, threshold: str | None = None) -> None:
    """SNK-1: itemsets (ordered) and level diagnostics as JSON lines; with ``transactions`` (the
    number of baskets) and ``threshold``, those and the order as one summary row too."""
    _out(order_itemsets(itemsets, order), single_file).write.mode("overwrite").json(f"{path}/itemsets")
    _out(levels.orderBy("length"), single_file).write.mode("overwrite").json(f"{path}/levels")
    if transactions is not None:
        summary = itemsets.sparkSession.createDataFrame([(transactions, threshold, order)], "transactions long, threshold string, order string")
        summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_rule_report(itemsets: DataFrame, levels: DataFrame, rules: DataFrame, path: str, transactions: int, support: str,
                      confidence: str, order: str = "support", single_file: bool = False) -> None:
    """SNK-2 in full: the itemsets and levels that the rules come from, the rules (ordered), and
    a summary row of the thresholds."""
    write_itemsets(itemsets, levels, path, order, single_file)
    write_rules(rules, f"{path}/rules", "json", order, single_file)
    summary = rules.sparkSession.createDataFrame([(transactions, support, confidence, order)],
                                                 "transactions long, support_threshold string, confidence_threshold string, order string")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_rules(rules: DataFrame, path: str, fmt: str = "json", order: str = "support",
                single_file: bool = False) -> None:
    """SNK-2: rules as JSON lines, or as the readable text listing (one line per rule;
    the fixed message when there is none)."""
    ordered = order_rules(rules, order)
    if fmt == "json":
        _out(ordered, single_file).write.mode("overwrite").json(path)
    elif fmt == "text":
        lines = format_rules(ordered).select("line")
        if lines.isEmpty():
            lines = rules.sparkSession.createDataFrame([(NO_RULES,)], "line string")
        _out(lines, single_file).write.mode("overwrite").text(path)
    else:
        raise ValueError("format must be json or text")


def write_assignments(points: DataFrame, assign: DataFrame, path: str, names, id_name: str = "CustomerId",
                      single_file: bool = False) -> None:
    """SNK-3: id, the coordinates as given (after noise, before scaling) and the 1-based
    cluster, as CSV with a header."""
    cols = [F.col("features")[i].alias(n) for i, n in enumerate(names)]
    rows = points.join(assign, "id").select(F.col("id").alias(id_name), *cols, F.col("cluster").alias("Cluster"))
    _out(rows.orderBy(id_name), single_file).write.mode("overwrite").option("header", "true").csv(path)


def write_tree(model, summary: DataFrame, path: str) -> None:
    """SNK-4: the node table and one summary row (criterion, sizes, quality)."""
    spark = summary.sparkSession
    model.node_table(spark).coalesce(1).write.mode("overwrite").json(f"{path}/nodes")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_forest(result, params: dict, path: str) -> None:
    """SNK-5: parameters + quality as one row, the top importances as rows."""
    q = result.quality
    row = q.select(*[F.lit(v).alias(k) for k, v in params.items()], "*")
    row.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    result.importances.coalesce(1).write.mode("overwrite").json(f"{path}/importances")


def write_sweep(frame: DataFrame, path: str, fmt: str = "csv") -> None:
    """SNK-6: one table per sweep."""
    writer = frame.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError("format must be csv or json")
