"""Exact-size seeded row choice (W-3 stratified split, W-4 choice without replacement).

Rows are ordered by ``md5(seed:key)``; per group the ``quota`` first rows are chosen.
Doing that with ``row_number`` over a window partitioned by the group would put a
whole group (a class label holds about half the table) into one task, so the choice
is made in three distributed steps instead:

1. the top bits of the hash give a bucket; (group, bucket) counts are a map-side
   combined aggregate whose size is bounded by the bucket count;
2. running counts over buckets find, per group, the one boundary bucket where the
   quota is reached;
3. only the rows of the boundary bucket (about n / buckets of them, the hash is uniform) are
   ranked, which gives the last row chosen; every row is then compared with that one.

The input is read three times: for the counts, for the boundary buckets, for the flags.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

HASH_BITS = 60
BUCKET_BITS = 16  # only how finely hashes are counted: the rows chosen are the same for any number


def hash_key(key: Column, seed: int) -> Column:
    """md5 of ``seed:key`` as hex; its order equals the order of ``hash_value``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_value(hex_hash: Column) -> Column:
    """First 60 bits of the md5 as a non-negative LONG."""
    return F.conv(F.substring(hex_hash, 1, HASH_BITS // 4), 16, 10).cast("long")


def _same_groups(left: DataFrame, right: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, NULL being a group like any other."""
    renamed = right.select(*[F.col(c).alias(f"_g_{c}") if c in groups else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in groups:
        same = same & left[c].eqNullSafe(F.col(f"_g_{c}"))
    return left.join(renamed, same, how).drop(*[f"_g_{c}" for c in groups])


def _hashed(frame: DataFrame, key: str, seed: int) -> DataFrame:
    rows = frame.withColumn("_hx", hash_key(F.col(key), seed)).withColumn("_h", hash_value(F.col("_hx")))
    return rows.withColumn("_bucket", F.shiftright(F.col("_h"), HASH_BITS - BUCKET_BITS))


def hash_counts(frame: DataFrame, key: str, groups: list[str], seed: int) -> DataFrame:
    """(groups, _bucket, _cnt): rows by group and hash bucket, as a written table."""
    return cut_lineage(_hashed(frame, key, seed).groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_cnt")))


def choose_first(frame: DataFrame, key: str, groups: list[str], quotas: DataFrame,
                 seed: int, flag: str = "chosen", counts: DataFrame | None = None) -> DataFrame:
    """Flag the ``quota`` rows with the smallest ``md5(seed:key)`` in every group (all rows of a
    group that has fewer).

    ``quotas`` has the ``groups`` columns and ``quota``; its size is the number of
    groups (the caller guarantees it is small: labels, or one global group).  ``counts``: the
    ``hash_counts`` of the same frame, key and seed, if there already.
    """
    return choose_many(frame, key, groups, {flag: quotas}, seed, counts)


def choose_many(frame: DataFrame, key: str, groups: list[str], quotas: dict[str, DataFrame],
                seed: int, counts: DataFrame | None = None) -> DataFrame:
    """``choose_first`` for several quotas, flag name -> quotas, in the same three scans."""
    counts = counts if counts is not None else hash_counts(frame, key, groups, seed)
    rows = _hashed(frame, key, seed)
    running = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_cum", F.sum("_cnt").over(running))

    def boundary(flag):
        own = _same_groups(counts, F.broadcast(quotas[flag]), groups)
        return (own.where((F.col("_cum") >= F.col("quota")) & (F.col("_cum") - F.col("_cnt") < F.col("quota")))
                .select(*groups, F.lit(flag).alias("_flag"), F.col("_bucket").alias("_edge"), (F.col("quota") - F.col("_cum") + F.col("_cnt")).alias("_take")))
    boundaries = reduce(DataFrame.unionByName, [boundary(flag) for flag in quotas])
    order = F.struct("_h", "_hx", F.col(key).cast("string").alias("_k"))
    edge = _same_groups(rows.select(*groups, "_bucket", order.alias("_o")), F.broadcast(boundaries), groups).where(F.col("_bucket") == F.col("_edge"))
    within = Window.partitionBy("_flag", *groups).orderBy("_o")  # rows of one bucket
    last = cut_lineage(edge.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") == F.col("_take")).select(
        "_flag", *groups, F.col("_o").alias("_last")))
    for flag, own in quotas.items():
        limits = _same_groups(own, last.where(F.col("_flag") == flag), groups, "left").select(*groups, "quota", "_last")
        chosen = F.when(F.col("_last").isNotNull(), order <= F.col("_last")).otherwise(F.col("quota") > 0)
        rows = _same_groups(rows, F.broadcast(limits), groups).withColumn(flag, chosen).drop("quota", "_last")
    return rows.drop("_hx", "_h", "_bucket")


def largest_remainder(counts: dict, total: int) -> dict:
    """Split ``total`` over classes proportionally: floors, then the largest remainders
    (ties to the smaller class value, NULL last)."""
    n = sum(counts.values())
    exact = {c: v / n * total for c, v in counts.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    left = total - sum(quota.values())
    for c in sorted(exact, key=lambda c: (-(exact[c] - quota[c]), c is None, c if c is not None else 0))[:left]:
        quota[c] += 1
    return quota


def stratified_split(frame: DataFrame, key: str, label: str, train_share: float,
                     seed: int = 42) -> DataFrame:
    """W-3: adds ``is_train``; exactly ``floor(share * n)`` training rows, spread over
    the labels by largest remainder, chosen by seeded hash order."""
    return stratified_splits(frame, key, label, {"is_train": train_share}, seed)


def stratified_splits(frame: DataFrame, key: str, label: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """The ``stratified_split`` for several shares, flag name -> share, in the same scans."""
    shares = {flag: float(share) for flag, share in shares.items()}
    if not all(0 < share < 1 for share in shares.values()):
        raise ValueError("train share must be between 0 and 1")
    buckets = hash_counts(frame, key, [label], seed)
    counts = {r[label]: r["n"] for r in buckets.groupBy(label).agg(F.sum("_cnt").alias("n")).collect()}
    n = sum(counts.values())
    spark = frame.sparkSession
    quotas = {flag: spark.createDataFrame(list(largest_remainder(counts, math.floor(share * n)).items()),
                                          f"{label} {dict(frame.dtypes)[label]}, quota long")
              for flag, share in shares.items()}
    return choose_many(frame, key, [label], quotas, seed, buckets)


def exact_count(n: int, fraction: float) -> int:
    """round(n * fraction), half to even."""
    return round(n * float(fraction))


def choose_rows(frame: DataFrame, key: str, count: int, seed: int, flag: str = "chosen") -> DataFrame:
    """W-4: flag exactly ``count`` rows, seeded, without replacement."""
    spark = frame.sparkSession
    one = frame.withColumn("_g", F.lit(0))
    quotas = spark.createDataFrame([(0, int(count))], "_g int, quota long")
    return choose_first(one, key, ["_g"], quotas, seed, flag=flag).drop("_g")
