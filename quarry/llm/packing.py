"""Harmonic packing of token sequences (operator 7).

A document's tokens are cut greedily into pieces of the lengths capacity // j: the largest
such length that is left, again and again.  Class j holds pieces of one length, and j of
them fill a sequence but for at most j - 1 tokens, so a sequence of a class takes a fixed
number of pieces and every worker fills its sequences without asking any other.

What a worker cannot complete (fewer than j pieces of a class) is handed on with its ids:
groups of up to ``merge`` workers complete those classes in a second pass, one task per
(group, class); a group has fewer workers for classes of short pieces, so that at most
TEAM_PIECES pieces meet.  What even a group cannot complete is laid
end to end and cut at powers of two, which need no padding.

Every id of every text lands in exactly one piece; the id ``end_id`` follows each text.

Defined cases: a null or empty text is its ``end_id`` alone; repeated rows and ids are
packed as they come; an empty table gives no pieces.  The pieces of a document row carry
the offset ``start`` within its ids, so its ids can be put together again.
"""

from __future__ import annotations

import json
import struct
import sys
import zlib
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batch_of, map_texts, text_rows
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY, END_ID, MERGE = 2048, 1, 64
TEAM_PIECES = 8192  # pieces that meet in one task of the second pass (a worker leaves fewer than capacity // length)
CACHE_WORDS = 800_000
SLOT, SECOND, TEAM_SLOT = 1 << 32, 1 << 62, 1 << 20  # sequence numbers of a worker; of the second pass

# Fixed values of the tokenizer file's format: its split pattern and its byte alphabet.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


class Encoder(dict):
    """Ids of a text, as little-endian unsigned 32-bit bytes, word by word.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words one after another; a word's ids are kept (at most CACHE_WORDS
    words).  Words go straight to the tokenizer's model after its lower case and split;
    anything unusual goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        split = spec["pre_tokenizer"].get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        # the short way is right only for this kind of tokenizer; any other takes the long one
        self.plain = split == _SPLIT.pattern and [n["type"] for n in spec["normalizer"].get("normalizers", [])] == \
            ["NFC", "Replace", "Lowercase"] and spec["model"]["type"] == "BPE"
        self.model, self.normalize = self.tokenizer.model, self.tokenizer.normalizer.normalize_str

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text, ids = word.decode(), []
        if text[-1] in ".," and text[:-1].isalpha():  # a letter and a sign are never one token
            out = self[word] = self[text[:-1].encode()] + self[word[-1:]]
            return out
        if "<|" in text or len(text) > 200:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            # up to U+024F a text is in NFC as it is, and lower case goes letter by letter
            text = text.lower() if max(text) < "\u0250" else self.normalize(text)
            for token in [text] if text.isalpha() else _SPLIT.findall(text):
                shown = token if token.isascii() and token.isalnum() else "".join(map(_BYTES.__getitem__, token.encode()))
                ids += [t.id for t in self.model.tokenize(shown)]
        out = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> bytes:
        if not self.plain:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        raw = text.encode()
        if b"<|" not in raw:  # special tokens are spelt in one case
            raw = raw.lower()
        words = raw.split()
        return b"".join(itemgetter(*words)(self) if len(words) > 1 else map(self.__getitem__, words))


def cuts(length: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document: each the largest capacity // j that is left."""
    out = [capacity] * (length // capacity)
    left = length % capacity
    while left:
        j = -(-capacity // left)  # the smallest j with capacity // j <= left
        while capacity // j > left:
            j += 1
        out.append(capacity // j)
        left -= capacity // j
    return out


_COLUMNS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
            ("worker", pa.int64()), ("ids", pa.binary())]
_SCHEMA = pa.schema(_COLUMNS)
_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "worker long, ids binary")
_OUT = [name for name, _ in _COLUMNS[:7]]


class _Fill:
    """Open sequences of one worker, by piece length."""

    def __init__(self, first_sequence: int, capacity: int):
        self.next, self.capacity = first_sequence, capacity
        self.open: dict[int, list] = {}
        self.done: list[tuple] = []

    def add(self, doc, start, ids: bytes, total) -> None:
        length = len(ids) // 4
        held = self.open.setdefault(length, [])
        held.append((doc, start, ids, total))
        if len(held) == self.capacity // length:
            self._close(held)
            self.open[length] = []

    def _close(self, held: list) -> None:
        at = 0
        for doc, start, ids, total in held:
            length = len(ids) // 4
            self.done.append((doc, start, length, zlib.crc32(ids), total, self.next, at, None, None))
            at += length
        self.next += 1

    def spill(self, worker) -> list[tuple]:
        """The pieces of sequences that are not full, with their ids."""
        return [(doc, start, len(ids) // 4, zlib.crc32(ids), total, None, None, worker, ids)
                for length in sorted(self.open) for doc, start, ids, total in self.open[length]]

    def finish(self) -> None:
        """Lay out what is open, end to end, in sequences whose lengths are powers of two."""
        rest = [piece for length in sorted(self.open, reverse=True) for piece in self.open[length]]
        left = sum(len(p[2]) // 4 for p in rest)
        room, at = 0, 0
        for doc, start, ids, total in rest:
            while ids:
                if room == 0:
                    room, at = min(self.capacity, 1 << (left.bit_length() - 1)), 0
                    size = room
                take = min(room, len(ids) // 4)
                part, ids = ids[:4 * take], ids[4 * take:]
                self.done.append((doc, start, take, zlib.crc32(part), total, self.next, at, None, None))
                start, at, room, left = start + take, at + take, room - take, left - take
                if at == size:
                    self.next += 1
        self.open = {}

    def flush(self):
        rows, self.done = self.done, []
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_COLUMNS)
    return batch_of(_SCHEMA, {name: list(c) for (name, _), c in zip(_COLUMNS, columns, strict=True)})


def _worker_kernel(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        # one encoder per Python worker, kept between its tasks
        store = sys.modules.setdefault("_packing_encoders", type(sys)("_packing_encoders")).__dict__
        encoder = store.get(path)
        if encoder is None:
            encoder = store[path] = Encoder(path)
        worker = TaskContext.get().partitionId()
        fill = _Fill(worker * SLOT, capacity)
        for keys, texts in text_rows(batches, "doc_id", "text", 128):
            for doc, text in zip(keys, texts, strict=True):
                ids = encoder.encode(text) + end
                total, start = len(ids) // 4, 0
                for length in cuts(total, capacity):
                    fill.add(doc, start, ids[4 * start:4 * (start + length)], total)
                    start += length
            yield _batch(fill.flush())
        yield _batch(fill.spill(worker))

    return run


def _group_kernel(capacity: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        group, length = int(key[0]), int(key[1])
        fill = _Fill(SECOND + (group * (capacity + 1) + length) * TEAM_SLOT, capacity)
        frame = frame.sort_values(["worker", "doc_id", "start", "ids_crc32"], kind="stable")
        for doc, start, ids, total in zip(frame["doc_id"], frame["start"], frame["ids"], frame["doc_tokens"], strict=True):
            fill.add(None if pd.isna(doc) else int(doc), int(start), bytes(ids), int(total))
        fill.finish()
        out = pd.DataFrame([r[:7] for r in fill.flush()], columns=_OUT)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, merge: int = MERGE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = cut_lineage(map_texts(docs, _worker_kernel(tokenizer, capacity, end_id), _DDL))
    full = pieces.where(F.col("sequence_id").isNotNull()).select(*_OUT)
    rest = (pieces.where(F.col("sequence_id").isNull())
            .withColumn("team", F.floor(F.col("worker") / F.greatest(F.lit(1), F.least(F.lit(merge), F.floor(
                F.lit(TEAM_PIECES / capacity) * F.col("length"))))))
            .groupBy("team", "length").applyInPandas(
                _group_kernel(capacity), ", ".join(f"{c} long" for c in _OUT)))
    return full.unionByName(rest)
