"""Readers of saved results (SRC-4, SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_partition(spark: SparkSession, path: str, id_col: str = "CustomerId",
                   cluster_col: str = "Cluster") -> DataFrame:
    """SRC-4: saved cluster ids -> (id, cluster)."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(F.col(id_col).alias("id"), F.col(cluster_col).cast("long").alias("cluster"))


def read_sweep_row(spark: SparkSession, path: str, array_field: str, key: str, value) -> DataFrame:
    """SRC-5: a saved JSON summary; explode ``array_field`` and keep the row whose
    ``key`` equals ``value`` (e.g. the train-share 0.8 baseline)."""
    doc = spark.read.option("multiLine", "true").json(path)
    return doc.select(F.inline(array_field)).where(F.col(key) == F.lit(value))
