"""MinHash near-duplicates with sequential Bayesian verification (operator 8).

1. One pass over the texts: the set of word shingles of each document (64-bit hashes), its
   MinHash signature, the keys of its bands and a 128-bit digest of the set.  Documents with
   one digest are one *class* (exact copies of the set); its smallest id stands for it.
2. Classes that share a band key are candidates.  No bucket is turned into all its pairs:
   see `_links`.
3. A candidate's signatures are compared batch by batch.  After each batch the posterior
   of the Jaccard similarity given the matches so far (uniform prior) decides: if the
   probability that it reaches the threshold is below ``miss``, the pair is dropped.
4. Survivors are verified on the full sets: 100 * |A n B| >= 80 * |A u B|.
5. Components of the verified links, by minimum labels with pointer jumping.

At similarity 0.8 a pair shares none of the 40 bands of 7 values with probability 8e-5 (at
0.85: 2e-7); with ``miss`` this is the only way to lose a link, and copies never depend on it.

Defined cases: a null text, or one without words, has the empty set, links with nothing and
is its own component; with fewer words than a shingle the whole sequence is the one
shingle; rows that repeat an id are one document (their sets united) but are each reported
with their own ``n_shingles``; rows without an id are left out; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import sys
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batch_of, map_texts, text_rows
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
BANDS, ROWS = 40, 7
HASHES = BANDS * ROWS
BLOCK = 256  # rows of one side of a tile
BATCH = 40  # signature values compared between two decisions
MISS = 1e-6
PERCENT = 80
_U = np.uint64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _draws(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 32, n, dtype=np.uint32)


_A, _B = _draws(HASHES, 1) | np.uint32(1), _draws(HASHES, 2)
_random = np.random.default_rng(3)
_LETTER = _random.integers(1, 1 << 63, (64, 256)).astype(np.uint64).ravel()
_BAND = _random.integers(1, 1 << 63, HASHES).astype(np.uint64) | _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(length) - length
    at = np.arange(len(flat)) - np.repeat(first, length)
    value = _LETTER[(at & 63) << 8 | flat]
    if length.max() > 64:  # places repeat after 64 letters: tell the rounds apart
        value = _mix(value + (at >> 6).astype(np.uint64))
    word = _mix(np.add.reduceat(value, first) + length.astype(np.uint64))
    size = min(size, len(words))
    gram = word[:len(word) - size + 1] + _U(size)
    for k in range(1, size):
        gram = _mix(gram) * _U(0x9E3779B97F4A7C15) + word[k:len(word) - size + 1 + k]
    return np.unique(_mix(gram))


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values (HASHES of 32 bits) of a non-empty set."""
    low = (grams >> _U(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 1024):
        part = low[start:start + 1024, None] * _A + _B
        np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    mixed = _mix(values.astype(np.uint64) * _BAND).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return _mix(mixed + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                     ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
_DDL = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def _sketch_kernel(size: int):
    def kernel(batches):
        for keys, texts in text_rows(batches, "doc_id", "text", 256):
            rows = {"doc_id": keys, "n_shingles": [], "digest": [], "bands": [], "signature": []}
            for text in texts:
                grams = shingles(text, size)
                rows["n_shingles"].append(len(grams))
                some = len(grams) > 0
                values = signature(grams) if some else None
                rows["digest"].append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if some else None)
                rows["bands"].append(band_keys(values) if some else None)
                # 8 bits of each value to compare with: a chance match in 256 only keeps a pair longer
                rows["signature"].append(values.astype(np.uint8).tobytes() if some else None)
            yield batch_of(_SCHEMA, rows)
    return kernel


_SETS = pa.schema([("id", pa.int64()), ("grams", pa.list_(pa.int64()))])


def _sets_kernel(size: int):
    def kernel(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                grams = [shingles(t[0], size) if len(t) == 1 else np.unique(np.concatenate([shingles(x, size) for x in t]))
                         for t in part.column("texts").to_pylist()]
                yield batch_of(_SETS, {"id": part.column("id").to_pylist(), "grams": [g.view(np.int64) for g in grams]})
    return kernel


@lru_cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, matches below which a pair is dropped) after each batch.

    With a uniform prior, the posterior given m matches of n is Beta(m + 1, n - m + 1); the
    pair is dropped where P(similarity >= percent / 100) < ``miss``.
    """
    grid = (np.arange(20000) + 0.5) / 20000
    upper = grid >= percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(log - log.max())
            if mass[upper].sum() / mass.sum() >= miss:
                break
        out.append((n, m))
    return out


def survives(a: bytes, b: bytes, needed=None) -> bool:
    """Sequential test of two signatures."""
    same = np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)
    at = matches = 0
    for n, least in needed or least_matches():
        matches += int(same[at:n].sum())
        if matches < least:
            return False
        at = n
    return True


def _test_kernel(batches):
    for batch in batches:
        a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        keep = [survives(x, y) for x, y in zip(a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))],
                                         names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in ``links(a, b)``: component is the smallest id reachable.

    Each round gives every node the smallest label around it and then its label's label, so
    long chains shorten geometrically; a hot node only takes part in map-side combined
    minima.  Every round is a written table.
    """
    both = cut_lineage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.join(label.select(F.col("id").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        step = (label.join(near, "id").select("id", "label", F.least("label", "near").alias("low")))
        jump = step.select(F.col("id").alias("low"), F.col("low").alias("far"))
        after = cut_lineage(step.join(jump, "low").select(
            "id", F.least("low", "far").alias("label"), (F.least("low", "far") != F.col("label")).alias("moved")))
        if after.where("moved").isEmpty():
            return after.select("id", F.col("label").alias("component"))
        label = after.select("id", "label")


def _checked(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose signatures survive and whose full sets are similar:
    100 * |A n B| >= percent * |A u B|."""
    def side(table, value, end):
        return table.select(F.col("id").alias(end), F.col(value).alias(f"_{end}"))

    tested = cut_lineage(pairs.join(side(signatures, "signature", "a"), "a").join(side(signatures, "signature", "b"), "b")
                         .select("a", "b", F.col("_a").alias("sa"), F.col("_b").alias("sb")).mapInArrow(_test_kernel, "a long, b long"))
    both = F.size(F.array_intersect("_a", "_b"))
    close = 100 * F.least(F.size("_a"), F.size("_b")) >= percent * F.greatest(F.size("_a"), F.size("_b"))
    return cut_lineage(
        tested.join(side(sets, "grams", "a"), "a").join(side(sets, "grams", "b"), "b")
        .where(close & (100 * both >= percent * (F.size("_a") + F.size("_b") - both))).select("a", "b"))


_FACTS = ["id", "label", "signature", "grams"]


def _meet_kernel(pdf: pd.DataFrame) -> pd.DataFrame:
    """One tile: each asker against the members of other components.  Signatures are compared
    batch by batch for the whole tile at once, survivors exactly; one verified link per asker
    and component is enough."""
    x, y = pdf[pdf["asks"]], pdf[~pdf["asks"]]
    out = []
    if len(x) and len(y):
        theirs = np.frombuffer(b"".join(y["signature"]), np.uint8).reshape(len(y), HASHES)
        labels, ids, sets = y["label"].to_numpy(), y["id"].to_numpy(), list(y["grams"])
        size = np.array([len(g) for g in sets])
        for one in x.itertuples(index=False):
            mine, n = np.frombuffer(one.signature, np.uint8), len(one.grams)
            left = np.flatnonzero((labels != one.label) & (100 * np.minimum(size, n) >= PERCENT * np.maximum(size, n)))
            matches, at = np.zeros(len(left), np.int64), 0
            for stop, least in least_matches():
                matches += (theirs[left, at:stop] == mine[at:stop]).sum(axis=1)
                left, matches, at = left[matches >= least], matches[matches >= least], stop
            linked = set()
            for k in left[np.argsort(-matches, kind="stable")]:
                if labels[k] not in linked:
                    both = len(np.intersect1d(one.grams, sets[k], assume_unique=True))
                    if 100 * both >= PERCENT * (n + size[k] - both):
                        linked.add(labels[k])
                        out.append((min(one.id, ids[k]), max(one.id, ids[k])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _meet(askers: DataFrame, members: DataFrame, facts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verified links between ``askers(place, id)`` and ``members(place, id)`` of one place and
    of different components.

    Both sides of a place are dealt into blocks of about ``block`` rows; every pair of blocks
    is one task, so no task holds a whole place, and no pair is a row before it is verified.
    """
    def blocks(rows, name):
        return rows.groupBy("place").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("int").alias(name))

    both = blocks(askers, "nx").join(blocks(members, "ny"), "place")
    def dealt(rows, asks, own, other, mine, theirs):
        return (rows.join(both, "place").withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("place", "id", F.lit(asks).alias("asks"), "bx", "by"))
    rows = dealt(askers, True, "nx", "ny", "bx", "by").unionByName(dealt(members, False, "ny", "nx", "by", "bx"))
    return (rows.join(facts.select(*_FACTS), "id").groupBy("place", "bx", "by").applyInPandas(_meet_kernel, "a long, b long"))


def _links(bands: DataFrame, signatures: DataFrame, sets: DataFrame, rounds: int) -> DataFrame | None:
    """Verified links that decide about all components.

    First ``rounds`` leader rounds: each bucket has one leader (another one each time) which
    meets the members outside its component, so a round makes no more pairs than there are
    bucket rows.  Then the buckets whose members are still in several components: the members
    outside a bucket's largest component meet that whole component, and each other, in blocks
    (`_meet`).  So every two members of a bucket are either connected or were compared.
    """
    links = labels = None
    for turn in range(rounds + 1):
        rows = bands.withColumn("label", F.col("id")) if labels is None else bands.join(
            labels, "id", "left").select("band", "id", F.coalesce("component", "id").alias("label"))
        per_label = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
        mixed = per_label.groupBy("band").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("main"),
                                              F.min("label").alias("low"), F.max("label").alias("high")) \
            .where("low < high").select("band", (-F.col("main.l")).alias("main"))
        rows = cut_lineage(rows.join(cut_lineage(mixed), "band"))
        bands = rows.select("band", "id")  # a bucket in one component stays so
        if rows.isEmpty():
            break
        if turn < rounds:
            lead = cut_lineage(rows.groupBy("band").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "label")).alias("l")))
            pairs = cut_lineage(rows.join(lead, "band").where(F.col("label") != F.col("l.label")).select(
                F.least("id", F.col("l.id")).alias("a"), F.greatest("id", F.col("l.id")).alias("b")).distinct())
            found = _checked(pairs, signatures, sets)
        else:
            facts = signatures.join(sets, "id")
            facts = facts.withColumn("label", F.col("id")) if labels is None else facts.join(labels, "id", "left") \
                .withColumn("label", F.coalesce("component", "id"))
            facts = cut_lineage(facts.select(*_FACTS))
            outside = cut_lineage(rows.where(F.col("label") != F.col("main")))
            to_main = outside.select(F.col("main").alias("place"), "id").distinct()
            whole = facts.select(F.col("label").alias("place"), "id").join(to_main.select("place").distinct(), "place")
            found = cut_lineage(_meet(to_main, whole, facts))
            several = outside.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
            rest = cut_lineage(outside.join(cut_lineage(several.select("band")), "band").select(F.col("band").alias("place"), "id"))
            found = found.unionByName(cut_lineage(_meet(rest, rest, facts)))
        links = found if links is None else links.unionByName(found)
        if turn < rounds:
            labels = components(links)
    return links


def near_duplicates(docs: DataFrame, rounds: int = 2, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document row; shingles of ``size`` words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where(F.col("doc_id").isNotNull())
    sketches = cut_lineage(map_texts(docs, _sketch_kernel(size), _DDL))
    classes = cut_lineage(sketches.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id")))
    # the merge hints: these sides grow with the corpus and are never broadcast
    own = (sketches.join(classes.hint("merge"), (F.col("doc_id") == F.col("id")) & (sketches["digest"] == classes["digest"]), "left_semi")
           .select(F.col("doc_id").alias("id"), "bands", "signature"))
    bands = own.select("id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("band")
    bands = cut_lineage(bands.join(shared.hint("merge"), "band").distinct())
    alike = cut_lineage(bands.select("id").distinct())
    signatures = cut_lineage(own.join(alike.hint("merge"), "id", "left_semi").select("id", "signature").dropDuplicates(["id"]))
    sets = cut_lineage(docs.withColumnRenamed("doc_id", "id").join(alike.hint("merge"), "id", "left_semi")
                       .groupBy("id").agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("texts"))
                       .mapInArrow(_sets_kernel(size), "id long, grams array<bigint>"))
    links = _links(bands, signatures, sets, rounds)
    with_class = sketches.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    if links is None:
        with_class = with_class.withColumn("component", F.lit(None).cast("long"))
    else:
        with_class = with_class.join(components(links), "id", "left")
    return with_class.select("doc_id", "n_shingles", F.coalesce("component", "id", "doc_id").alias("component_id")) \
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
