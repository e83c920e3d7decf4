import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import packing as P
from quarry.llm.queries import tokenizer_path
from tests.llm.conftest import ODD, frame

ODDER = dict(ODD) | {7: "it's DON'T we'LL 3.14 a<|endoftext|>b ...x", 8: "ΣΑΣ ſ K İ é", 9: "a\x1cb\x85c\x00d 日本 １２"}


def whole(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def check(docs, capacity=P.CAPACITY, **options):
    rows = P.pack(docs, tokenizer_path(), capacity=capacity, **options).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = np.array(whole(texts[doc]), "<u4"), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = used = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        used += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= 0.02 * used + capacity
    return rows


def test_tables(spark, small):
    check(small("documents"))


def test_odd_texts_and_small_capacity(spark):
    docs = frame(spark, ODDER).repartition(3)
    check(docs)
    check(docs, capacity=64, merge=2)


def test_cuts():
    for n in range(1, 5000):
        assert sum(P.cuts(n)) == n and all(c == P.CAPACITY // (P.CAPACITY // c) for c in P.cuts(n))


def test_empty_table(spark):
    assert P.pack(frame(spark, {}), tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", [t or "" for t in ODDER.values()])
def test_short_way_equals_tokenizer(text):
    e = P.Encoder(tokenizer_path())
    assert e.plain
    assert np.frombuffer(e.encode(text), "<u4").tolist() + [P.END_ID] == whole(text)
