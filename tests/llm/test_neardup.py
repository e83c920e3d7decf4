import random

import numpy as np
import pytest

from quarry.llm import neardup as N
from tests.llm.conftest import ODD, frame


def brute(texts, size=4):
    """Components by comparing all pairs of plain shingle sets."""
    sets = {}
    for i, t in texts.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, texts, **options):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           N.near_duplicates(frame(spark, texts), **options).collect()}
    assert got == brute(texts, options.get("size", 4))


def test_longer_shingles_against_all_pairs(spark, small):
    check(spark, {r["doc_id"]: r["text"] for r in small("documents").collect()}, size=5)


def test_tables_against_all_pairs(spark, small):
    texts = {r["doc_id"]: r["text"] for r in small("documents").collect()}
    check(spark, texts)


@pytest.mark.parametrize("rounds", [0, 3])
def test_copies_chains_and_odd_texts(spark, rounds):
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    base = [r.choice(words) for _ in range(200)]
    texts = dict(ODD)
    for i in range(10, 40):  # a chain: each differs a little from the one before
        base = list(base)
        base[r.randrange(200)] = r.choice(words)
        texts[i] = " ".join(base)
    for i in range(40, 60):
        texts[i] = texts[r.randrange(10, 40)].upper()
    for i in range(60, 80):  # a shared passage, but other texts
        texts[i] = " ".join(base[:60] + [r.choice(words) for _ in range(60)])
    check(spark, texts, rounds=rounds)


def test_empty_table_and_repeated_rows(spark):
    assert N.near_duplicates(frame(spark, {})).count() == 0
    docs = frame(spark, {1: "a b c d e", 2: "q r s t u"})
    rows = N.near_duplicates(docs.union(docs)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(1, 1), (2, 2)}


def test_posterior_bounds_keep_similar_pairs():
    needed = N.least_matches()
    r = np.random.default_rng(1)
    lost = 0
    for _ in range(2000):  # similarity exactly at the threshold
        same = r.random(N.HASHES) < 0.8
        a = r.integers(0, 255, N.HASHES).astype(np.uint8)
        b = np.where(same, a, a + 1).astype(np.uint8)
        lost += not N.survives(a.tobytes(), b.tobytes(), needed)
    assert lost <= 1
    a, b = (r.integers(0, 255, N.HASHES).astype(np.uint8).tobytes() for _ in range(2))
    assert not N.survives(a, b, needed)


def test_components_of_long_chain(spark):
    links = spark.range(1, 300).selectExpr("id as a", "id + 1 as b")
    assert {r["component"] for r in N.components(links).collect()} == {1}
