"""Array-of-double helpers (F-6, F-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: Column, b: Column) -> Column:
    diffs = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda s, v: s + v)


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean norm of a - b, inside codegen (no UDF)."""
    return F.sqrt(squared_distance(a, b))


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd, a zero sd scales by 1 (constant columns become 0)."""
    return (x - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
