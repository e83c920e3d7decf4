"""Toxicity: a bidirectional gated recurrent network with attention pooling (operator 4).

Runs of letters over 64 bytes (scripts without blanks) are cut into overlapping words, so all
bytes count.  A text is cut into overlapping windows of ``WINDOW`` words (``STRIDE`` apart, the last one
reaching the end).  Each word enters as a word vector (words that occur in 3 to
12 training texts or more, by the sample's size; one shared vector for all others) beside the mean vector of its hashed
character trigrams.  Two gated recurrent layers read the window in both directions, an
attention layer pools their states, and a logistic unit scores the pooled state.  A text's
score is that of its most toxic window, so the whole text counts at any length.

Only texts carry labels, so a text's loss reaches its windows in proportion to the soft
maximum of their scores.  Forward and backward passes are numpy; the fit runs on at most
``per_class`` labelled rows of each class and the model's size is fixed by its parameters.
A fifth of the sample is kept out of the fit for the logistic curve.

Defined cases: a null or empty text has no windows and scores 0; without labels of both
classes every text with a word scores the share of label 1; repeated rows are scored row by
row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import fold, labelled
from quarry.llm.nbsvm import _LETTER, logistic_curve

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
WINDOW, STRIDE = 64, 48
WORD_DIM = CHAR_DIM = HIDDEN = ATTENTION = 8
VOCABULARY, MIN_DOCS, CHAR_BUCKETS = 4_000, (3, 12), 4096
PIECE = 400_000
LONGEST = 64  # bytes of a word
OVERLAP = 16  # bytes that neighbouring words cut from a longer run share
# Lower case for A-Z; a word is a run of letters, digits and non-ASCII bytes.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Spaces and punctuation beyond ASCII end a word too (code points, and the same as UTF-8).
_MARKS = ("\xa0\xa1\xa7\xab\xb6\xb7\xbb\xbf\u060c\u061b\u061f\u06d4\u0964\u0965\u2000-\u200b\u2010-\u2029\u202f-\u205f"
          "\u3000-\u3004\u3008-\u3020\u3030\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65")
_BREAK = re.compile(rb"\xc2[\xa0\xa1\xa7\xab\xb6\xb7\xbb\xbf]|\xd8[\x8c\x9b\x9f]|\xdb\x94|\xe0\xa5[\xa4\xa5]"
                    rb"|\xe2\x80[\x80-\x8b\x90-\xa9\xaf-\xbf]|\xe2\x81[\x80-\x9f]|\xe3\x80[\x80-\x84\x88-\xa0\xb0]"
                    rb"|\xef\xbc[\x81-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]")


# ------------------------------------------------------------------ inputs

def cut_runs(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (start, end) runs with those of over LONGEST bytes cut into words of at most that
    many, at code points; the next word begins OVERLAP bytes or so before the last one's end."""
    long = np.flatnonzero(end - start > LONGEST)
    if not len(long):
        return start, end
    starts, ends, done = [], [], 0
    for i in long:
        starts.append(start[done:i])
        ends.append(end[done:i])
        low, last, own = int(start[i]), int(end[i]), ([], [])
        while True:
            high = min(low + LONGEST, last)
            while high < last and a[high] & 0xC0 == 0x80:
                high -= 1
            own[0].append(low)
            own[1].append(high)
            if high == last:
                break
            low = high - OVERLAP
            while a[low] & 0xC0 == 0x80:
                low += 1
        starts.append(np.array(own[0]))
        ends.append(np.array(own[1]))
        done = i + 1
    return np.concatenate([*starts, start[done:]]), np.concatenate([*ends, end[done:]])


class Words:
    """The words of a few texts: ``of`` numbers each word of the run within ``hashes``."""

    def __init__(self, texts: list[bytes]):
        texts = [t if t.isascii() else _BREAK.sub(lambda m: b" " * len(m[0]), t) for t in texts]
        a = np.frombuffer(b" ".join(t.translate(_TABLE) for t in texts) + b" ", np.uint8)
        gap = a == 32
        start, end = cut_runs(a, np.flatnonzero(~gap & np.r_[True, gap[:-1]]), np.flatnonzero(gap & np.r_[False, ~gap[:-1]]))
        bound = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.per_text = np.diff(np.searchsorted(start, bound))
        if not len(start):
            self.hashes, self.of, self.grams, self.owner = (np.zeros(0, np.uint64), np.zeros(0, np.int64),
                                                            np.zeros(0, np.int64), np.zeros(0, np.int64))
            return
        # the bytes of all words, those that two words share once in each
        length = end - start
        spot = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        whole = np.add.reduceat(_LETTER[(spot & 31) << 8 | a[spot + np.repeat(start, length)]], np.cumsum(length) - length)
        self.hashes, first, self.of = np.unique(whole, return_index=True, return_inverse=True)
        # character trigrams of each different word, with its ends marked by spaces around it
        length, start = length[first], start[first]
        self.owner, edge = np.repeat(np.arange(len(first)), length), np.cumsum(length)
        spot = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
        b = a.astype(np.uint32)
        before, after = b[spot - 1], b[spot + 1]
        before[edge - length] = after[edge - 1] = 32
        gram = (before << 16) | (b[spot] << 8) | after
        self.grams = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)  # 12 bits: CHAR_BUCKETS

    def numbers(self, vocabulary: np.ndarray) -> np.ndarray:
        """Place of each different word in the sorted vocabulary plus 1, or 0."""
        if not len(vocabulary):
            return np.zeros(len(self.hashes), np.int64)
        at = np.minimum(np.searchsorted(vocabulary, self.hashes), len(vocabulary) - 1)
        return np.where(vocabulary[at] == self.hashes, at + 1, 0)


def windows(n: int) -> np.ndarray:
    """First words of the windows over ``n`` words."""
    if n == 0:
        return np.zeros(0, np.int64)
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def window_matrix(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number of each place, whether the place is filled, text of each window)."""
    total, starts, text, ends = 0, [], [], []
    for i, n in enumerate(words.per_text):
        s = windows(int(n))
        starts.append(s + total)
        ends.append(np.full(len(s), total + n))
        text.append(np.full(len(s), i))
        total += int(n)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    if not len(start):
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), bool), np.zeros(0, np.int64)
    at = start[:, None] + np.arange(WINDOW)
    filled = at < np.concatenate(ends)[:, None]
    return words.of[np.minimum(at, total - 1)], filled, np.concatenate(text)


# ------------------------------------------------------------------ network

def new_model(vocabulary: np.ndarray, seed: int = 11) -> dict:
    r = np.random.default_rng(seed)
    size, inputs = HIDDEN, WORD_DIM + CHAR_DIM
    m = {"word": r.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIM)), "char": r.normal(0, 0.3, (CHAR_BUCKETS, CHAR_DIM)),
         "attend": r.normal(0, 0.3, (2 * size, ATTENTION)), "attend_bias": np.zeros(ATTENTION),
         "query": r.normal(0, 0.5, ATTENTION), "out": r.normal(0, 0.3, 2 * size), "out_bias": np.zeros(1)}
    for side in "fb":
        m |= {f"x{side}": r.normal(0, 0.3, (inputs, 3 * size)), f"h{side}": r.normal(0, 0.3, (size, 3 * size)),
              f"c{side}": np.r_[np.ones(size), np.zeros(2 * size)]}
    return {k: v.astype(np.float32) for k, v in m.items()} | {"vocabulary": vocabulary}


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def embed(words: Words, m: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input vector of each different word, its vocabulary number and trigram count."""
    number = words.numbers(m["vocabulary"])
    count = np.bincount(words.owner, minlength=len(number)).astype(np.float32)[:, None]
    chars = np.zeros((len(number), CHAR_DIM), np.float32)
    if len(words.owner):
        first = np.flatnonzero(np.r_[True, words.owner[1:] != words.owner[:-1]])
        chars = np.add.reduceat(m["char"][words.grams], first, axis=0) / count
    return np.concatenate([m["word"][number], chars], axis=1), number, count


def _run(projected, recurrent, places, filled, keep: bool):
    """One direction; ``places``/``filled`` are (step, window)."""
    size = recurrent.shape[0]
    h = np.zeros((places.shape[1], size), np.float32)
    states, cache = np.empty((len(places), places.shape[1], size), np.float32), []
    for t in range(len(places)):
        x, u = projected[places[t]], h @ recurrent
        gates = _sigmoid(x[:, :2 * size] + u[:, :2 * size])
        z, r = gates[:, :size], gates[:, size:]
        new = np.tanh(x[:, 2 * size:] + r * u[:, 2 * size:])
        on = filled[t][:, None]
        nxt = np.where(on, new + z * (h - new), h)
        if keep:
            cache.append((h, z, r, new, u[:, 2 * size:], on))
        h = states[t] = nxt
    return states, cache


def forward(m: dict, words: Words, places, filled, keep: bool = False):
    """Logit of each window (and what the backward pass needs)."""
    x, number, count = embed(words, m)
    steps, on = np.ascontiguousarray(places.T), np.ascontiguousarray(filled.T)
    f, f_cache = _run(x @ m["xf"] + m["cf"], m["hf"], steps, on, keep)
    b, b_cache = _run(x @ m["xb"] + m["cb"], m["hb"], steps[::-1], on[::-1], keep)
    states = np.concatenate([f, b[::-1]], axis=2)
    inner = np.tanh(states @ m["attend"] + m["attend_bias"])
    weight = np.where(on, inner @ m["query"], -1e9)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = (weight[:, :, None] * states).sum(0)
    logit = pooled @ m["out"] + m["out_bias"][0]
    return (logit, (x, number, count, steps, on, f_cache, b_cache, states, inner, weight, pooled)) if keep else logit


def _run_back(d_states, cache, recurrent, places, rows: int):
    """Gradients of one direction: of the projected inputs (per different word), of the
    recurrent matrix and of the bias."""
    size = recurrent.shape[0]
    d_h = np.zeros_like(d_states[0])
    d_rec, d_x = np.zeros_like(recurrent), np.empty((len(places), places.shape[1], 3 * size), np.float32)
    for t in range(len(places) - 1, -1, -1):
        h, z, r, new, u_new, on = cache[t]
        d = d_h + d_states[t]
        live = np.where(on, d, 0)
        d_new = live * (1 - z) * (1 - new * new)
        d_z = live * (h - new) * z * (1 - z)
        d_r = d_new * u_new * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_x[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_rec += h.T @ d_u
        d_h = np.where(on, d * z, d) + d_u @ recurrent.T
    flat, owner = d_x.reshape(-1, 3 * size), places.reshape(-1)
    order = np.argsort(owner, kind="stable")
    first = np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1]])
    per_word = np.zeros((rows, 3 * size), np.float32)
    per_word[owner[order][first]] = np.add.reduceat(flat[order], first, axis=0)
    return per_word, d_rec, flat.sum(0)


def backward(m: dict, words: Words, saved, d_logit: np.ndarray) -> dict:
    x, number, count, steps, on, f_cache, b_cache, states, inner, weight, pooled = saved
    g = {"out": pooled.T @ d_logit, "out_bias": np.array([d_logit.sum()])}
    d_pooled = d_logit[:, None] * m["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = (states * d_pooled).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    g["query"] = np.einsum("tn,tna->a", d_score, inner)
    d_inner = d_score[:, :, None] * m["query"] * (1 - inner * inner)
    flat = d_inner.reshape(-1, d_inner.shape[2])
    g["attend"], g["attend_bias"] = states.reshape(-1, states.shape[2]).T @ flat, flat.sum(0)
    d_states = d_states + d_inner @ m["attend"].T
    size = m["hf"].shape[0]
    d_input = np.zeros_like(x)
    for side, cache, own, places in (("f", f_cache, d_states[:, :, :size], steps),
                                     ("b", b_cache, d_states[::-1, :, size:], steps[::-1])):
        per_word, g[f"h{side}"], g[f"c{side}"] = _run_back(own, cache, m[f"h{side}"], places, len(x))
        g[f"x{side}"] = x.T @ per_word
        d_input += per_word @ m[f"x{side}"].T
    g["word"] = _sum_rows(number, d_input[:, :WORD_DIM], len(m["word"]))
    g["char"] = _sum_rows(words.grams, (d_input[:, WORD_DIM:] / np.maximum(count, 1))[words.owner], len(m["char"]))
    return g


def _sum_rows(owner: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each owner 0..size-1."""
    return np.stack([np.bincount(owner, column, size) for column in rows.T], axis=1)


# ------------------------------------------------------------------ training

def learn_vocabulary(texts: list[bytes]) -> np.ndarray:
    """Sorted hashes of the commonest words that occur in enough texts (see MIN_DOCS)."""
    least = int(np.clip(len(texts) / 150, *MIN_DOCS))
    seen = [Words([t]).hashes for t in texts]
    value, count = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0))
    order = np.lexsort((value, -count))[:VOCABULARY]
    return np.sort(value[order[count[order] >= least]])


def fit(sample: list[tuple[int, str]], counts: dict[int, int], steps: int = 400, batch: int = 32, rate: float = 0.01,
        longest: int = 8, decay: float = 3.0, seed: int = 11) -> dict:
    """Model from (label, text) rows; ``counts``: class counts of all labelled rows.

    The network learns from the sampled texts of at most ``longest`` windows (there a
    text's label says most about each window); the curve sees sampled texts of any length.
    """
    total = sum(counts.values())
    if len({y for y, _ in sample}) < 2:
        return {"share": float(counts.get(1, 0) / total) if total else 0.5}
    texts, y = [t.encode() for _, t in sample], np.array([y for y, _ in sample])
    kept_out = np.arange(len(y)) % 5 == 4
    short = np.array([len(windows(int(Words([t]).per_text[0]))) <= longest for t in texts])
    train = np.flatnonzero(~kept_out & short)
    if len(set(y[train])) < 2:
        train = np.flatnonzero(~kept_out) if len(set(y[~kept_out])) == 2 else np.arange(len(y))
    m = new_model(learn_vocabulary([texts[i] for i in train]), seed)
    random = np.random.default_rng(seed)
    names = [k for k in m if k != "vocabulary"]
    first, second, step = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0), 0
    share = float(y[train].mean())
    m["out_bias"][0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    rounds = max(1, len(train) // batch)
    epochs = -(-steps // rounds)
    for epoch in range(epochs):
        sharpness = 1 + 5 * epoch / epochs
        for chunk in np.array_split(random.permutation(train), rounds):
            words = Words([texts[i] for i in chunk])
            places, filled, text = window_matrix(words)
            if not len(text):
                continue
            logit, saved = forward(m, words, places, filled, keep=True)
            d = np.zeros(len(logit), np.float32)
            edge = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            top = np.repeat(np.maximum.reduceat(logit, edge), np.diff(np.r_[edge, len(text)]))
            soft = np.exp(sharpness * (logit - top))
            soft /= np.repeat(np.add.reduceat(soft, edge), np.diff(np.r_[edge, len(text)]))
            level = np.repeat(np.add.reduceat(soft * logit, edge), np.diff(np.r_[edge, len(text)]))
            d[:] = soft * (_sigmoid(level) - y[chunk][text]) / len(chunk)
            grads, step = backward(m, words, saved, d), step + 1
            for k in names:
                g = grads[k].astype(np.float32)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                now = rate * (0.5 if epoch >= epochs * 2 // 3 else 1.0)
                if k in ("word", "char"):
                    m[k] *= 1 - decay * now
                m[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
    held = np.flatnonzero(kept_out)
    margin, label = best_logits([texts[i] for i in held], m), y[held]
    real = np.isfinite(margin)
    slope, offset = logistic_curve(margin[real], label[real]) if len(set(label[real])) == 2 else (1.0, 0.0)
    if slope <= 0:
        slope, offset = 1.0, 0.0
    drawn = np.bincount(y, minlength=2)
    offset += float(np.log(counts[1] / counts[0]) - np.log(drawn[1] / drawn[0]))
    return m | {"slope": slope, "offset": offset}


# ------------------------------------------------------------------ scoring

def parts(raw: bytes, size: int = PIECE, overlap: int = 2048):
    """A long text in parts that share ``overlap`` bytes and begin and end at white space, or at
    code points where ``overlap`` bytes hold none."""
    if len(raw) <= size:
        yield raw
        return
    at = 0
    while at < len(raw):
        end = far = min(at + size, len(raw))
        while end < len(raw) and end < far + overlap and raw[end] != 32 and raw[end] != 10:
            end += 1
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        begin = max(at - overlap, 0)
        begin = raw.rfind(b" ", max(begin - overlap, 0), begin) + 1 or begin
        while begin < at and raw[begin] & 0xC0 == 0x80:
            begin += 1
        yield raw[begin:end]
        at = end


def best_logits(texts: list[bytes], m: dict) -> np.ndarray:
    """Highest window logit of each text; -inf without words."""
    out = np.full(len(texts), -np.inf)
    group, owner, held = [], [], 0
    def flush():
        words = Words(group)
        places, filled, text = window_matrix(words)
        if len(text):
            np.maximum.at(out, np.array(owner)[text], forward(m, words, places, filled))
    for i, raw in enumerate(texts):
        for part in parts(raw):
            if held and held + len(part) > PIECE:
                flush()
                group, owner, held = [], [], 0
            group.append(part)
            owner.append(i)
            held += len(part)
    if group:
        flush()
    return out


def score(text: Column, model: dict, spark: SparkSession) -> Column:
    """P(toxic) of every whole text; the model's size is bounded by its parameters."""
    if "share" in model:
        return F.when(F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]|[{_MARKS}]", "")) > 0,
                      F.lit(model["share"])).otherwise(0.0)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        own, out = shared.value, []
        for start in range(0, len(texts), 256):
            x = best_logits([(t or "").encode() for t in texts.iloc[start:start + 256]], own)
            out.append(np.where(np.isfinite(x), 1 / (1 + np.exp(-np.clip(own["slope"] * np.where(np.isfinite(x), x, 0)
                                                                         + own["offset"], -500, 500))), 0.0))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return probability(text)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 2000, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (score >= threshold)."""
    sample, counts = labelled(docs, labels, "toxic", FOLDS, HELD_OUT, per_class)
    p = score(F.col("text").cast("string"), fit(sample, counts), docs.sparkSession)
    return (docs.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)))
            .withColumn("score", p).withColumn("predicted", (F.col("score") >= threshold).cast("int")))
