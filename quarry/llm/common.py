"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kernels travel to the executors by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fold(column: Column, buckets: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``buckets``: a stable fold number."""
    return F.crc32(column.cast("string")) % F.lit(buckets)


def text_rows(batches: Iterator[pa.RecordBatch], key: str, text: str,
              rows_at_once: int = 512) -> Iterator[tuple[list, list[str]]]:
    """(keys, texts) of small slices of each Arrow batch; a null text is ''."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows_at_once):
            part = batch.slice(start, rows_at_once)
            yield (part.column(key).to_pylist(), [t or "" for t in part.column(text).to_pylist()])


def map_texts(docs: DataFrame, kernel: Callable, schema: str, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """Run ``kernel(batches)`` over (key, text) of ``docs`` only, whatever else it holds."""
    return docs.select(F.col(key), F.col(text).cast("string").alias(text)).mapInArrow(kernel, schema)


def batch_of(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int,
             key: str = "doc_id", text: str = "text") -> tuple[list[tuple[int, str]], dict[int, int]]:
    """A bounded training sample for a classifier, and the class counts of all rows that
    may be learned from.

    Rows in fold ``held_out`` (crc32 of the id modulo ``folds``) are never read.  The
    sample holds the ``per_class`` rows of each class with the smallest hash of their id,
    so it is the same whatever the partitioning.  Repeated ids count once, with the larger
    label; labels other than 0 and 1 and null ids are left out.
    """
    known = (labels.select(F.col(key), F.col(label).cast("int").alias("_y"))
             .where(F.col(key).isNotNull() & F.col("_y").isin(0, 1) & (fold(F.col(key), folds) != held_out))
             .groupBy(key).agg(F.max("_y").alias("_y")))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col(key), F.col(text).cast("string").alias("_t")).where(F.col(key).isNotNull())
    present = known.join(texts.select(key).distinct(), key, "left_semi")
    order = (F.xxhash64(key), F.col(key))
    picked = None
    for value in (0, 1):
        some = present.where(F.col("_y") == value).orderBy(*order).limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 * per_class ids: a proven bound for the broadcast and for the driver
    rows = (texts.join(F.broadcast(picked), key).groupBy(key)
            .agg(F.first("_y").alias("_y"), F.max(F.coalesce("_t", F.lit(""))).alias("_t")).collect())
    rows = sorted(((r[key], r["_y"], r["_t"]) for r in rows), key=lambda r: (str(r[0]),))
    return [(y, t) for _, y, t in rows], counts
