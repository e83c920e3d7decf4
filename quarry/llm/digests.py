"""SHA-256 over the ordered rows of a key, without gathering a key's rows.

A digest is sequential, but its input need not be held: consecutive rows are joined to
pieces of bounded size where the sort has put them, so a key with very many rows becomes a
few pieces in each of several tasks; the task that has a key's pieces reads them as a stream.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_CHARS = 1 << 20  # characters of a piece; a longer row is a piece of its own


def _pieces(limit: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("first", pa.int64()), ("data", pa.string())])
        key, first, held, size, fresh = None, None, [], 0, True
        done: list[tuple] = []
        for batch in batches:
            for k, o, t in zip(*(batch.column(c).to_pylist() for c in ("key", "ord", "data")), strict=True):
                if fresh or k != key or size + len(t) > limit:
                    if not fresh:
                        done.append((key, first, "".join(held)))
                    key, first, held, size, fresh = k, o, [], 0, False
                held.append(t)
                size += len(t)
            if len(done) > 1000 or sum(len(d[2]) for d in done) > limit:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema, strict=True)], schema=schema)
                done = []
        if not fresh:
            done.append((key, first, "".join(held)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema, strict=True)], schema=schema)
    return kernel


def _hashes(cut: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("sha256", pa.string())])
        key, h, done = None, None, []
        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if h is None or k != key:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256()
                    t = t[cut:]
                h.update(t.encode("utf-8"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], schema=schema)
                done = []
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([h.hexdigest()], pa.string())], schema=schema)
    return kernel


def joined_digest(rows: DataFrame, separator: str = "", piece: int = PIECE_CHARS) -> DataFrame:
    """(key, sha256): lowercase hex of the SHA-256 of ``data`` of each ``key``, in ascending
    ``ord`` (long), joined by ``separator``.  ``rows(key string, ord long, data string)``; a
    null key or text is not expected."""
    each = rows.select("key", "ord", F.concat(F.lit(separator), "data").alias("data"))
    laid = each.repartitionByRange("key", "ord").sortWithinPartitions("key", "ord")
    pieces = laid.mapInArrow(_pieces(piece), "key string, first long, data string")
    met = pieces.repartition("key").sortWithinPartitions("key", "first")
    return met.mapInArrow(_hashes(len(separator)), "key string, sha256 string")
