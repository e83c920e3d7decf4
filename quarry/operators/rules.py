"""Association rules A -> B from frequent itemsets (M-2, SO-1, SO-2, J-4, PF-5, F-7, X-2).

Every non-empty proper subset of a frequent itemset is an antecedent, so consequents
may hold several items (MLlib's ``associationRules`` only emits one-item consequents).
Confidence is compared exactly: ``count >= confidence * antecedent_count`` in decimal
arithmetic, i.e. "not below the threshold".
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.params import check_order, parse_share

RULE_SCHEMA = ("antecedent", "consequent", "rule", "total_length", "count", "support", "confidence")


def rule_text(antecedent, consequent):
    """F-7: ``A, B → C``."""
    return F.concat(F.concat_ws(", ", antecedent), F.lit(" → "), F.concat_ws(", ", consequent))


def candidate_rules(itemsets: DataFrame, max_total_length: int | None = None) -> DataFrame:
    """SO-2 + J-4: every (itemset, antecedent) with both counts, before the confidence filter."""
    if max_total_length is not None and max_total_length < 2:
        raise ValueError("a rule has two items or more: max_total_length must be at least 2")
    sets = itemsets.where(F.col("length") >= 2)
    if max_total_length is not None:
        sets = sets.where(F.col("length") <= max_total_length)
    masks = F.expr("sequence(1L, shiftleft(1L, length) - 2L)")
    split = (sets.select("items", "length", "count", "support", F.explode(masks).alias("_mask"))
             .select("*", F.expr("filter(items, (x, i) -> getbit(_mask, i) = 1)").alias("antecedent"))
             .withColumn("consequent", F.array_except("items", "antecedent")))
    ante = itemsets.select(F.col("items").alias("antecedent"), F.col("count").alias("antecedent_count"))
    return split.join(ante, "antecedent")


def exact_ratio(confidence) -> tuple[int, int]:
    """A confidence as a ratio of whole numbers below 10^18, so that products with counts
    stay inside 38 digits."""
    share = Fraction(parse_share(confidence))
    if share.denominator > 10 ** 18:
        raise ValueError("a confidence can have at most 18 decimals")
    return share.numerator, share.denominator


def _reaches(top: Column, bottom: Column) -> Column:
    """count / antecedent_count >= top / bottom, without division."""
    wide = "decimal(19,0)"
    return (F.col("count").cast(wide) * bottom.cast(wide)) >= (F.col("antecedent_count").cast(wide) * top.cast(wide))


def generate_rules(itemsets: DataFrame, confidence, max_total_length: int | None = None) -> DataFrame:
    """M-2: rules whose confidence is not below ``confidence`` (share or percent)."""
    top, bottom = exact_ratio(confidence)
    rules = candidate_rules(itemsets, max_total_length)
    return (rules.where(_reaches(F.lit(top), F.lit(bottom)))
            .select("antecedent", "consequent",
                    rule_text(F.col("antecedent"), F.col("consequent")).alias("rule"),
                    F.col("length").alias("total_length"), "count", "support",
                    (F.col("count") / F.col("antecedent_count")).alias("confidence")))


def order_rules(rules: DataFrame, order: str = "support") -> DataFrame:
    """O-3 / O-4."""
    check_order(order)
    if order == "support":
        return rules.orderBy(F.desc("support"), F.desc("confidence"), "antecedent", "consequent")
    return rules.orderBy("antecedent", "consequent")


# The report texts of the rule listing (support / confidence labels and
# the message for an empty listing), kept as the reference prints them.
SUPPORT_LABEL = "поддержка"
CONFIDENCE_LABEL = "достоверность"
NO_RULES = "Ассоциативные правила не найдены."


def percent4(x):
    """``{x:.4%}``: x * 100 with four decimals and a percent sign."""
    return F.format_string("%.4f%%", (x * F.lit(100.0)).cast("double"))


def format_rules(rules: DataFrame) -> DataFrame:
    """F-7: one readable line per rule (column ``line``)."""
    return rules.select(
        "*", F.concat(F.col("rule"), F.lit(f" | {SUPPORT_LABEL}: "), percent4(F.col("support")),
                      F.lit(f" | {CONFIDENCE_LABEL}: "), percent4(F.col("confidence"))).alias("line"))


def rule_count_by_confidence(itemsets: DataFrame, thresholds, max_total_length: int | None = None) -> DataFrame:
    """X-2 / A-7: rule counts for a confidence grid from one pass over the candidates.

    Rules are built once; the grid (bounded by its own length) is broadcast and each
    candidate is counted under every threshold it passes.
    """
    spark = itemsets.sparkSession
    grid = spark.createDataFrame([(str(t), *exact_ratio(t)) for t in thresholds],
                                 "confidence string, top long, bottom long")
    rules = candidate_rules(itemsets, max_total_length)
    passed = rules.join(F.broadcast(grid), _reaches(F.col("top"), F.col("bottom")), "inner")
    counted = passed.groupBy("confidence").agg(F.count(F.lit(1)).alias("rules"))
    return grid.select("confidence").join(counted, "confidence", "left").fillna(0, ["rules"])
