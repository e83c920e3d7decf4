"""Basket sources (D1: basket_id LONG, items ARRAY<STRING> distinct and sorted).

* ``baskets_from_facts`` builds baskets from any (key, item) fact table.
* ``read_baskets`` reads a headerless ragged CSV file, one basket per record.
"""

from __future__ import annotations

import codecs
import csv
import io
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.running import dense_index
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Python's str.strip() removes every Unicode whitespace character; Java's \s only
# covers ASCII, so separators (\p{Z}), NEL and the file/group/record/unit
# separators are added explicitly.  A UTF-8 byte-order mark is dropped as well.
_EDGE_SPACE = r"^[\s\p{Z}\x{85}\x{1c}-\x{1f}\x{feff}]+|[\s\p{Z}\x{85}\x{1c}-\x{1f}]+$"


def clean_item(item: Column) -> Column:
    """PF-1 for one item: strip Unicode whitespace at both ends."""
    return F.regexp_replace(item, _EDGE_SPACE, "")


def canonical_items(items: Column) -> Column:
    """PF-1 for an array: strip, drop blanks, distinct, sorted by code point."""
    stripped = F.transform(items, clean_item)
    kept = F.filter(stripped, lambda x: x.isNotNull() & (x != ""))
    return F.sort_array(F.array_distinct(kept))


def baskets_from_facts(facts: DataFrame, key: str, item: str, clean: bool = True) -> DataFrame:
    """SRC-6: one basket per key; (key, item) pairs are de-duplicated first.  ``clean=False``: the
    items are clean already (``clean_item``).

    The distinct runs as a map-side combined hash aggregate, so a hot key with a
    large share of the rows reaches the basket shuffle as at most one row per
    (key, item) and map task.
    """
    items = F.col(item).cast("string")
    pairs = (facts.select(F.col(key).cast("long").alias("basket_id"), (clean_item(items) if clean else items).alias("item"))
             .where(F.col("item").isNotNull() & (F.col("item") != ""))
             .distinct())
    return (pairs.groupBy("basket_id")
            .agg(F.sort_array(F.collect_list("item")).alias("items")))  # without nulls; array_sort compares by a lambda


def basket_items(baskets: DataFrame) -> DataFrame:
    """Long (vertical) form (basket_id, item) of a basket table."""
    return baskets.select("basket_id", F.explode("items").alias("item"))


def _is_utf8(spark: SparkSession, path: str) -> bool:
    lines = spark.read.text(path)
    return bool(lines.agg(F.coalesce(F.bool_and(F.is_valid_utf8("value")), F.lit(True))).first()[0])


# ------------------------------------------------------------------ records of a split file

def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, if one was (``inside``) or none was before it.

    A quote opens a field only at its beginning, and two quotes inside a quoted field are one
    quote, so counting quotes is not enough.
    """
    if not inside and '"' not in line:
        return False
    i = 0
    while True:
        if not inside:  # a field begins at i
            if line[i:i + 1] != '"':
                i = line.find(",", i) + 1
                if not i:
                    return False
                continue
            i += 1
        i = line.find('"', i)
        while i >= 0 and line[i + 1:i + 2] == '"':
            i = line.find('"', i + 2)
        if i < 0:
            return True
        i, inside = line.find(",", i + 1) + 1, False  # after its end a field has no more quotes
        if not i:
            return False


def line_ends(line: str) -> tuple[int, int]:
    """``open_after`` if none / if one was open before the line."""
    return int(open_after(line, False)), int(open_after(line, True))


def _located(batches, encoding: str):
    """((file, block), texts) of each run of lines of one split, in order; a byte-order mark at a
    line's begin is dropped."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, value = (batch.column(c) for c in ("file", "block", "value"))
        place, blocks = file.dictionary_encode().indices.to_numpy(), block.to_numpy()
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (blocks[1:] != blocks[:-1])])
        texts = [v.decode(encoding).removeprefix("\ufeff") for v in value.to_numpy(zero_copy_only=False)]
        for begin, end in zip(new, [*new[1:], len(texts)], strict=True):
            yield (file[begin].as_py(), block[begin].as_py()), texts[begin:end]


def _block_ends(encoding: str):
    """Per split: the open-field state after it and the records that begin in it, for either
    state before it."""
    def kernel(batches):
        key, closed, opened, begun_closed, begun_open, done = None, False, True, 0, 0, []
        for split, texts in _located(batches, encoding):
            if key != split:
                if key is not None:
                    done.append((*key, int(closed), int(opened), begun_closed, begun_open))
                key, closed, opened, begun_closed, begun_open = split, False, True, 0, 0
            for text in texts:
                begun_closed += not closed
                begun_open += not opened
                if closed == opened:  # the two have met: one state from here on
                    closed = opened = open_after(text, closed)
                else:
                    closed, opened = open_after(text, closed), open_after(text, opened)
        if key is not None:
            done.append((*key, int(closed), int(opened), begun_closed, begun_open))
        yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK_COLUMNS, d)) for d in done], schema=pa.schema(
            [("file", pa.string()), *((c, pa.int64()) for c in _BLOCK_COLUMNS[1:])]))
    return kernel


_BLOCK_COLUMNS = ["file", "block", "after_closed", "after_open", "begun_closed", "begun_open"]


def _records(encoding: str, starts: dict):
    """The records of each split: (record, part, open, text).  ``part`` is the split's number; a
    record that comes from or goes on to another split is ``open``."""
    schema = pa.schema([("record", pa.int64()), ("part", pa.int64()), ("open", pa.bool_()), ("text", pa.string())])

    def kernel(batches):
        key, held, done = None, [], []

        def close(number, part, is_open):
            done.append((number, part, is_open, "\n".join(held)))
            held.clear()

        def closed():
            columns = zip(*done) if done else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        state = number = part = 0
        whole = True  # the held record began in this split
        for split, texts in _located(batches, encoding):
            if key != split:
                if held:
                    close(number, part, True)
                key = split
                part, state, number = starts[key]
                number -= 1
                whole = not state
            for text in texts:
                if not state:
                    number += 1
                    whole = True
                held.append(text)
                state = open_after(text, bool(state))
                if not state:
                    close(number, part, not whole)
            if len(done) >= 5000:
                yield closed()
                done.clear()
        if held:
            close(number, part, True)
        yield closed()
    return kernel


def _fields(batches):
    schema = pa.schema([("record", pa.int64()), ("items", pa.list_(pa.string()))])
    for batch in batches:
        items = [[x for row in csv.reader(io.StringIO(text, newline="")) for x in row] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("record"), pa.array(items, schema.field("items").type)], schema=schema)


def read_records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(record, items): the fields of each CSV record, numbered from 0 in file order (files in
    name order); quoted fields may hold line breaks, also across file splits.

    One scan finds, per split, which state a split leaves for either state it may begin in;
    composing those few rows in order gives each split its state and first record number.  The
    second scan cuts records; only those that cross a split are put together by a shuffle.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    ends = lines.mapInArrow(_block_ends(encoding), "file string, " + ", ".join(f"{c} long" for c in _BLOCK_COLUMNS[1:])).collect()
    starts, state, number = {}, 0, 0
    for part, r in enumerate(sorted(ends, key=lambda r: (r["file"], r["block"]))):  # one row a file split
        state = state if r["block"] else 0
        starts[r["file"], r["block"]] = (part, state, number)
        number += r["begun_open"] if state else r["begun_closed"]
        state = r["after_open"] if state else r["after_closed"]
    cut = cut_lineage(lines.mapInArrow(_records(encoding, starts), "record long, part long, open boolean, text string"))
    crossing = cut.where("open").groupBy("record").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "\n").alias("text"))
    whole = cut.where("not open").select("record", "text").unionByName(crossing)
    return whole.mapInArrow(_fields, "record long, items array<string>")


def read_baskets(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    """SRC-1: headerless CSV, one basket per record, UTF-8 (BOM allowed) else Windows-1251.

    Items are stripped, blanks and duplicates dropped; records left empty are dropped.
    The basket id is the 0-based position of the basket among non-empty records of the
    file (files are read in name order).  Raises when no basket remains.
    """
    if encoding == "auto":
        encoding = "UTF-8" if _is_utf8(spark, path) else "windows-1251"
    codecs.lookup(encoding)  # an unknown encoding fails here, not in a task
    rows = read_records(spark, path, encoding).select("record", canonical_items(F.col("items")).alias("items")).where(F.size("items") > 0)
    result = cut_lineage(dense_index(rows, ["record"], "_n").select((F.col("_n") - 1).cast("long").alias("basket_id"), "items"))
    if result.isEmpty():
        raise ValueError("No basket has an item.")
    return result
