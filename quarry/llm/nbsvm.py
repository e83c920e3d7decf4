"""Quality classifier: Naive Bayes support vectors (operator 3).

A text becomes a set of hashed n-gram indicators: word 1- and 2-grams, and 1- to 4-grams
of word shapes (runs of lower case, capitals, digits and each other sign; a word equal to
the one before it is marked).  Each indicator is scaled by the log ratio of its smoothed
class counts, the vector is divided by the root of its size, and a linear model with
squared hinge loss is fitted by dual coordinate descent.  Margins of two cross-fitted
halves give the logistic curve that turns a margin into a probability; its offset is
moved to the class shares of all labelled rows.

The model has ``2 ** bits`` weights (a proven bound for what is sent to the executors) and
is fitted on at most ``per_class`` labelled rows of each class; every whole text is scored,
in pieces of ``PIECE`` bytes, so memory doesn't grow with a text's length.

Defined cases: a null or empty text has no indicators and gets the curve's value at the
bias; without labels of both classes every score is the share of label 1 (0.5 without any);
repeated rows are scored row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import fold, labelled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
BITS = 18
PIECE = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_KIND = np.zeros(256, np.uint16)  # white space 0, letters (and non-ASCII) 1, capitals 2, digits 3 ...
_KIND[~_SPACE] = 4 + np.arange(250) % 60  # ... each other sign its own class (control bytes share some)
_KIND[33:48] = np.arange(4, 19)
_KIND[58:65] = np.arange(19, 26)
_KIND[91:97] = np.arange(26, 32)
_KIND[123:127] = np.arange(32, 36)
_KIND[97:123] = _KIND[128:256] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_random = np.random.default_rng(5)
#: Random 64-bit value of a byte at a place in its word (places repeat after 32).
_LETTER = _random.integers(1, 1 << 63, (32, 256)).astype(np.uint64)
_LETTER[:, _SPACE] = 0
_LETTER = _LETTER.ravel()
#: Random value of a change from one class of byte to another; 0 where nothing starts.
_TURN = _random.integers(1, 1 << 63, (64, 64)).astype(np.uint64)
_TURN[:, 0] = 0
_TURN[np.arange(64), np.arange(64)] = 0
_TURN = _TURN.ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and of every word's shape."""
    a = np.frombuffer(raw.strip(b" \t\n\x0b\x0c\r"), np.uint8)
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    kind = _KIND[a]
    before = np.empty_like(kind)
    before[0], before[1:] = 0, kind[:-1]
    start = np.flatnonzero((kind > 0) & (before == 0))
    at = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
    words = np.add.reduceat(_LETTER[(at & 31) << 8 | a], start)
    shapes = np.add.reduceat(_TURN[before << 6 | kind], start)
    return words, shapes


def pieces(raw: bytes, size: int = PIECE):
    """Parts of about ``size`` bytes that end where a word ends."""
    at = 0
    while len(raw) - at > size:
        end = at + size
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def indicators(text: str, bits: int = BITS, scratch: np.ndarray | None = None) -> np.ndarray:
    """Distinct indicator numbers of a whole text."""
    place = np.zeros(1 << bits, np.int64) if scratch is None else scratch
    down, found = _U(64 - bits), []
    kept_words, kept_shapes = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for part in pieces(text.encode()):
        w, s = _word_hashes(part)
        words, token = np.r_[kept_words, w], np.r_[kept_shapes, s]
        if not len(w):
            continue
        echo = np.flatnonzero(words[1:] == words[:-1]) + 1
        gram = marked = token * _U(0x9E3779B97F4A7C15)
        marked[echo] += _U(0x5BD1E9955BD1E995)
        grams = [words * _U(0xFF51AFD7ED558CCD), (words[:-1] * _U(0xC4CEB9FE1A85EC53) + words[1:]) * _U(0x2127599BF4325C37),
                 marked * _U(0x880355F21E6D1965)]
        for _ in range(3):
            gram = (gram[:-1] * _U(0xD6E8FEB86659FD93) + marked[len(marked) - len(gram) + 1:]) * _U(0xE7037ED1A0B428DB)
            grams.append(gram)
        all_grams = (np.concatenate(grams) >> down).astype(np.int64)
        own = np.arange(len(all_grams))
        place[all_grams] = own  # the last writer of each number stands for it
        found.append(all_grams[place[all_grams] == own])
        kept_words, kept_shapes = words[-4:], token[-4:]
    if not found:
        return np.zeros(0, np.int64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, dims: int, smoothing: float = 1.0) -> np.ndarray:
    """log of (share of class-1 rows with the indicator) / (share of class-0 rows)."""
    counts = np.full((2, dims), smoothing)
    for idx, label in zip(rows, y, strict=True):
        counts[label, idx] += 1
    return np.log(counts[1] / (np.sum(y == 1) + 2 * smoothing)) - np.log(counts[0] / (np.sum(y == 0) + 2 * smoothing))


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 12,
                 seed: int = 7) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge linear model by dual coordinate descent.

    Row i is ``scale[rows[i]] / sqrt(len(rows[i]))`` plus a constant 1 for the bias.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    values = [scale[r] / np.sqrt(max(len(r), 1)) for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    w, bias, alpha, slack = np.zeros(len(scale)), 0.0, np.zeros(len(rows)), 1.0 / (2.0 * c)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0 + alpha[i] * slack
            new = max(alpha[i] - gradient / (square[i] + slack), 0.0)
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, steps: int = 100, ridge: float = 0.05) -> tuple[float, float]:
    """Platt's (slope, offset): damped Newton steps on smoothed targets; ``ridge`` bounds
    the slope where the classes don't overlap."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(a, b):
        x = a * margin + b
        return float((np.logaddexp(0, x) - target * x).sum() + ridge * a * a / 2)

    now = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(now[0] * margin + now[1], -500, 500)))
        g, h = np.array([((p - target) * margin).sum() + ridge * now[0], (p - target).sum()]), p * (1 - p) + 1e-9
        step = np.linalg.solve([[(h * margin * margin).sum() + ridge, (h * margin).sum()], [(h * margin).sum(), h.sum()]], g)
        size, before = 1.0, loss(*now)
        while size > 1e-6 and loss(*(now - size * step)) > before:
            size /= 2
        now = now - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return float(now[0]), float(now[1])


def fit(sample: list[tuple[int, str]], counts: dict[int, int], bits: int = BITS) -> dict:
    """Model from (label, text) rows; ``counts``: class counts of all labelled rows."""
    total = sum(counts.values())
    if len({y for y, _ in sample}) < 2:
        share = counts.get(1, 0) / total if total else 0.5
        return {"weights": None, "share": float(share), "bits": bits}
    scratch = np.zeros(1 << bits, np.int64)
    rows, y = [indicators(t, bits, scratch) for _, t in sample], np.array([y for y, _ in sample])
    margin = np.zeros(len(rows))
    half = np.arange(len(rows)) % 2
    for part in (0, 1):  # each half is scored by a model that has not seen it
        train = [i for i in range(len(rows)) if half[i] != part]
        ratio = log_count_ratio([rows[i] for i in train], y[train], 1 << bits)
        w, b = dual_descent([rows[i] for i in train], ratio, y[train])
        for i in np.flatnonzero(half == part):
            margin[i] = (w * ratio)[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + b
    slope, offset = logistic_curve(margin, y)
    if slope <= 0:
        slope, offset = 1.0, 0.0
    ratio = log_count_ratio(rows, y, 1 << bits)
    w, b = dual_descent(rows, ratio, y)
    drawn = np.bincount(y, minlength=2)
    offset += float(np.log(counts[1] / counts[0]) - np.log(drawn[1] / drawn[0]))
    return {"weights": (w * ratio).astype(np.float32), "bias": float(b), "slope": slope, "offset": offset, "bits": bits}


def margin_of(text: str, model: dict, scratch: np.ndarray) -> float:
    found = indicators(text, model["bits"], scratch)
    return float(model["weights"][found].sum(dtype=np.float64)) / max(len(found), 1) ** 0.5 + model["bias"]


def score(text: Column, model: dict, spark: SparkSession) -> Column:
    """P(label 1) of every whole text; the model (2 ** bits floats) goes out as a broadcast."""
    if model["weights"] is None:
        return F.lit(model["share"])
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        own = shared.value
        scratch = np.zeros(1 << own["bits"], np.int64)
        x = np.array([margin_of(t or "", own, scratch) for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(own["slope"] * x + own["offset"], -500, 500))))

    return probability(text)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 3000, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (score >= threshold)."""
    sample, counts = labelled(docs, labels, "quality", FOLDS, HELD_OUT, per_class)
    p = score(F.col("text").cast("string"), fit(sample, counts), docs.sparkSession)
    return (docs.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)))
            .withColumn("score", p).withColumn("predicted", (F.col("score") >= threshold).cast("int")))
