import hashlib
import random
import re

from pyspark.sql import functions as F

from quarry.llm import decontaminate as D
from tests.llm.conftest import ODD, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    out = {}
    for doc, text in texts.items():
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            v = words(t)
            size = min(window, len(v))
            for k in range(len(v) - size + 1 if v else 0):
                for at in range(len(w) - size + 1):
                    if w[at:at + size] == v[k:k + size]:
                        hit |= set(range(at, at + size))
                        found |= {str(item)} - {"None"}
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def run(spark, texts, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    rows = D.contamination(frame(spark, texts), bench, **options).collect()
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}


def test_tables_against_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in small("documents").limit(80).collect()}
    items = [(r["item_id"], r["text"]) for r in small("benchmark").collect()]
    for k, (i, t) in enumerate(items[:12]):  # plant some
        texts[1000 + k] = "lead in words " + t + " and out"
    assert run(spark, texts, items) == brute(texts, items)


def test_overlaps_short_items_and_blocks(spark):
    r = random.Random(5)
    w = ["aa", "b", "Cé", "d9"]
    texts = dict(ODD) | {i: "-".join(r.choice(w) for _ in range(r.randrange(60))) for i in range(10, 60)}
    items = [(i, " ".join(r.choice(w) for _ in range(r.randrange(1, 14)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, items[3][1]), (None, items[4][1])]
    expected = brute(texts, items)
    assert run(spark, texts, items) == expected
    assert run(spark, texts, items, block_bytes=40) == expected


def test_empty_tables(spark):
    assert run(spark, {}, [(1, "a b c")]) == {}
    assert run(spark, {1: "a b c"}, [])[1][:3] == (3, 0, 0)
