"""Point sets (D11): ``id LONG`` + ``features ARRAY<DOUBLE>`` (+ named columns).

* ``customer_points``: 7 attributes per customer (0 where it has no orders) from customer x orders (account
  balance, order count, total / average / largest / smallest order value, distinct
  order priorities) -- the driver-table stand-in for the reference's customer file;
* ``embedding_points``: the embeddings table with its truth label;
* ``read_points``: a header CSV with an id column and numeric columns (SRC-3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import table

CUSTOMER_FEATURES = ("acctbal", "orders", "total", "average", "largest", "smallest", "priorities")


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    per = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("total"),
        F.avg("o_totalprice").alias("average"), F.max("o_totalprice").alias("largest"),
        F.min("o_totalprice").alias("smallest"),
        F.countDistinct("o_orderpriority").cast("double").alias("priorities"))
    cust = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"),
                                                  F.col("c_acctbal").cast("double").alias("acctbal"))
    # a customer without orders is a point too: no orders, every order value 0
    pts = cust.join(per, cust["id"] == per["o_custkey"], "left").drop("o_custkey").fillna(0.0, list(CUSTOMER_FEATURES[1:]))
    return pts.select("id", *CUSTOMER_FEATURES,
                      F.array(*[F.col(c) for c in CUSTOMER_FEATURES]).alias("features"))


def embedding_points(spark: SparkSession, folder: str) -> DataFrame:
    emb = table(spark, folder, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"),
                      F.col("label").cast("long").alias("label"))


def read_points(spark: SparkSession, path: str, id_col: str, columns) -> DataFrame:
    """SRC-3: header CSV (BOM tolerated); every listed column must parse to a finite
    number, checked with one aggregate."""
    raw = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    missing = [c for c in (id_col, *columns) if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    vals = raw.select(F.col(id_col).alias("id"), *[F.expr(f"try_cast(`{c}` as double)").alias(c) for c in columns])
    check_finite(vals.withColumn("features", F.array(*[F.col(c) for c in columns])))
    return vals.withColumn("features", F.array(*[F.col(c) for c in columns]))


def check_finite(points: DataFrame, dims: int | None = None) -> DataFrame:
    """PF-3: ``points`` if it has rows and every feature is a finite number (and every
    point has ``dims`` of them, if given), checked with one aggregate; else ValueError."""
    bad = points.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("features")).alias("least"), F.max(F.size("features")).alias("most"),
        F.count_if(F.col("features").isNull() | F.exists(
            "features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).alias("odd")).first()
    if bad["n"] == 0:
        raise ValueError("dataset is empty")
    if bad["odd"]:
        raise ValueError("features must be finite numbers")
    if bad["least"] != bad["most"] or dims not in (None, bad["least"]):
        raise ValueError("points must have the same number of features")
    return points
