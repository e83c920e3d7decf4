"""Inputs derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.baskets import baskets_from_facts, clean_item
from quarry.sources.tables import table


def line_parts(spark: SparkSession, folder: str, *part_cols: str) -> DataFrame:
    """lineitem joined to part (shuffle join on partkey; AQE broadcasts part when small)."""
    part = table(spark, folder, "part").select("p_partkey", *part_cols)
    line = table(spark, folder, "lineitem")
    return line.join(part, line["l_partkey"] == part["p_partkey"])


def order_baskets(spark: SparkSession, folder: str, item: str = "p_brand") -> DataFrame:
    """Basket = order, item = a part attribute (cleaned a part, not a line)."""
    part = table(spark, folder, "part").select("p_partkey", clean_item(F.col(item).cast("string")).alias(item))
    line = table(spark, folder, "lineitem")
    facts = line.join(part, line["l_partkey"] == part["p_partkey"]).select("l_orderkey", item)
    return baskets_from_facts(facts, "l_orderkey", item, clean=False)


def joined(items):
    """Arrays are compared as '|'-joined strings (the oracle does the same)."""
    return F.concat_ws("|", items)


# Classification records (D6) from lineitem x part: 5 numeric and 4 categorical
# attributes, label = line value above 25,000; the row key is the natural line key.
NUMERIC = ("l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice")
CATEGORICAL = ("p_brand", "p_type", "l_returnflag", "l_linestatus")
LABEL = "label"
KEY = "row_key"
SEED = 42


def line_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_parts(spark, folder, "p_brand", "p_type", "p_size", "p_retailprice")
    key = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    value = F.col("l_quantity") * F.col("p_retailprice") * (F.lit(1.0) - F.col("l_discount"))
    return rows.select(key.alias(KEY), *[F.col(c).cast("double").alias(c) for c in NUMERIC],
                       *CATEGORICAL, (value > 25000).cast("int").alias(LABEL))
