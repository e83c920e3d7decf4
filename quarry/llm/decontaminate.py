"""Benchmark decontamination: Wu-Manber multi-pattern search over words (operator 10).

Texts are lower-cased (A-Z) and cut into words; a pattern is a window of ``WINDOW``
consecutive words of a benchmark item (a shorter item is one pattern).  For every pattern
length m the searcher keeps, for each block of two words, how far the search may jump when
a window ends in that block (m - 1 if no pattern holds it); where the jump is 0, the
patterns that end in that block are compared word by word.  Most words of a text are thus
never looked at.

The benchmark is the stated query set: it goes to the tasks in blocks of at most
``block_bytes`` of text, every block meets every whole document, and what the blocks find
is merged by document, so neither the benchmark's nor a document's size is limited.

Defined cases: a null text or item has no words, hence no windows; an empty table finds
nothing (every document is returned with 0 hits); equal items are all reported; an item
without an id hits words but is not listed; repeated document rows are each reported.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batch_of, map_texts, text_rows
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
BLOCK_BYTES = 16 << 20
# Lower case for A-Z; words are runs of digits, letters and non-ASCII bytes.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class WuManber:
    """Patterns of one length over words: shift table, suffix buckets, direct comparison."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict[tuple, set]] = {}

    def add(self, pattern: tuple, owner) -> None:
        for end in range(self.block, self.length + 1):
            block = pattern[end - self.block:end]
            self.shift[block] = min(self.shift.get(block, self.length), self.length - end)
        self.bucket.setdefault(pattern[-self.block:], {}).setdefault(pattern, set()).add(owner)

    def find(self, words: list[bytes]):
        """(start, owners) of every occurrence."""
        m, far, shift, pairs = self.length, self.length - self.block + 1, self.shift.get, self.block == 2
        end, n = m, len(words)
        while end <= n:
            block = (words[end - 2], words[end - 1]) if pairs else (words[end - 1],)
            jump = shift(block, far)
            if jump == 0:
                owners = self.bucket[block].get(tuple(words[end - m:end]))
                if owners:
                    yield end - m, owners
                jump = 1
            end += jump


def build(items: list[tuple], window: int = WINDOW) -> list[WuManber]:
    searchers: dict[int, WuManber] = {}
    for owner, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            searchers.setdefault(size, WuManber(size)).add(tuple(words[at:at + size]), owner)
    return [searchers[k] for k in sorted(searchers)]


def search(words: list[bytes], searchers: list[WuManber]) -> tuple[list[tuple[int, int]], set]:
    """Merged hit spans (word positions, end exclusive) and the ids of the items found."""
    spans, owners = [], set()
    for s in searchers:
        for start, found in s.find(words):
            owners |= found
            spans.append((start, start + s.length))
    spans.sort()
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    owners.discard(None)
    return merged, owners


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)),
                     ("items", pa.list_(pa.string()))])
_DDL = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark's items, a bounded block at a time."""
    block, held = [], 0
    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        size = len((row["text"] or "").encode())
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((None if row["item_id"] is None else str(row["item_id"]), row["text"]))
        held += size
    if block:
        yield block


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document row: the merged word spans inside
    any occurrence of a benchmark window, and the sorted ids (as strings) of its items."""
    spark = docs.sparkSession
    found = None
    blocks = list(_blocks(benchmark, block_bytes)) if benchmark is not None else []
    if len(blocks) > 1:  # a row number per document row, so that blocks merge by row, not by id
        docs = cut_lineage(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
        ids = docs.select(F.col("_row"), F.col("doc_id").alias("_id"))
        docs = docs.select(F.col("_row").alias("doc_id"), "text")
    for block in blocks or [[]]:
        shared = spark.sparkContext.broadcast(build(block, window))  # at most block_bytes of text

        def kernel(batches, shared=shared):
            searchers = shared.value
            for keys, texts in text_rows(batches, "doc_id", "text"):
                words = [words_of(t) for t in texts]
                rows = [search(w, searchers) for w in words]
                yield batch_of(_SCHEMA, {
                    "doc_id": keys, "n_words": [len(w) for w in words],
                    "spans": [[{"start": a, "end": b} for a, b in s] for s, _ in rows],
                    "items": [sorted(o) for _, o in rows]})

        part = map_texts(docs, kernel, _DDL)
        found = part if found is None else found.unionByName(part)
    if len(blocks) <= 1:
        return found
    merged = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return (merged.join(ids, merged["doc_id"] == ids["_row"])
            .select(F.col("_id").alias("doc_id"), "n_words", _merge(F.col("spans")).alias("spans"), "items"))


def _merge(spans):
    """Sorted spans with those that touch made one."""
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1),
                          F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"]), joined) \
            .otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, step)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))
