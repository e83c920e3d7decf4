"""Running totals inside groups that may be hot.

A window partitioned by the group alone puts a whole group into one task.  Here the rows are
range-partitioned by (group, order); each partition sums its part of every group; those few
sums (groups x partitions) give each part its offset; and the window then runs inside
(group, partition) only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def running_totals(frame: DataFrame, groups: list[str], order: str, sums: dict[str, str]) -> DataFrame:
    """Add, for each ``sums`` item column -> name, the total of the column over the group's rows
    up to and including this one by ``order`` (unique within a group)."""
    parts = cut_lineage(frame.orderBy(*groups, order).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy(*groups, "_part").agg(*[F.sum(c).alias(f"_t_{n}") for c, n in sums.items()])
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_part", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}")
                                                for n in sums.values()])
    inside = Window.partitionBy(*groups, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(offsets, [*groups, "_part"])
    for c, n in sums.items():
        out = out.withColumn(n, F.sum(c).over(inside) + F.col(f"_o_{n}"))
    return out.drop("_part", *[f"_o_{n}" for n in sums.values()])


def dense_index(frame: DataFrame, order: list, name: str) -> DataFrame:
    """Number rows 1..n in ``order`` without a single-partition window: sort (range
    partitioned), checkpoint, then add per-partition offsets (one row per partition)."""
    ordered = cut_lineage(frame.orderBy(*order).withColumn("_pid", F.spark_partition_id())
                          .withColumn("_mid", F.monotonically_increasing_id()))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_base"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ordered.join(F.broadcast(offsets.select("_pid", "_off", "_base")), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_base") + 1)
            .drop("_pid", "_mid", "_off", "_base"))
