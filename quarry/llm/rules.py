"""Quality rules as weak supervision (operator 2).

Each rule looks at a few statistics of the whole text and votes *good*, votes *bad* or
abstains.  No rule decides alone: expectation-maximisation over the vote patterns of all
documents that pass the fixed base test estimates, without labels, how often each rule casts
each vote on good and on bad ones, and the posterior probability of *good* replaces an
all-must-pass filter.  (Over all documents the bad class would be the short and empty ones,
which the base test removes anyway, and no rule would be left to tell the others apart.)

A vote pattern has one of 3^R values, so the table of pattern counts that EM works on is
bounded whatever the corpus (EM runs on the driver on at most 3^R rows); the statistics
are one map over the texts and the posterior is one column expression.

Defined cases: where no document passes the base test the posterior is that of the starting
rates; a null or empty text has no words, hence ``base_failed`` and not kept;
repeated rows and ids are judged row by row; an empty table gives an empty result;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batch_of, map_texts, text_rows
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SIGN_SET = frozenset(_SIGNS)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
         "n_stops", "n_shouts", "n_distinct", "n_echo", "n_bare", "n_signs")
STATS_SCHEMA = pa.schema([("doc_id", pa.int64()), *((s, pa.int64()) for s in STATS)])
STATS_DDL = "doc_id long, " + ", ".join(f"{s} long" for s in STATS)

# (name, statistic, good when, bad when): between the two a rule abstains.
RULES = (
    ("word_length", lambda c: c.word_chars / c.n_words, (2.5, 12.0), (1.8, 20.0)),
    ("symbols", lambda c: c.n_symbols / c.n_words, (None, 0.03), (None, 0.15)),
    ("repeated_windows", lambda c: c.n_repeat_words / c.n_words, (None, 0.15), (None, 0.35)),
    ("repeated_lines", lambda c: c.n_dup_lines / c.n_lines, (None, 0.2), (None, 0.4)),
    ("capitals", lambda c: c.n_upper / c.word_chars, (None, 0.12), (None, 0.35)),
    ("sentences", lambda c: c.n_stops / c.n_words, (0.015, 0.6), (0.002, 0.95)),
    ("shouting", lambda c: c.n_shouts / c.n_words, (None, 0.05), (None, 0.25)),
    ("variety", lambda c: F.log(c.n_distinct + 1.0) / F.log(c.n_words + 1.0), (0.72, None), (0.6, None)),
    ("echo", lambda c: c.n_echo / c.n_words, (None, 0.05), (None, 0.2)),
    ("bare_signs", lambda c: c.n_bare / c.n_words, (None, 0.08), (None, 0.2)),
    ("signs", lambda c: c.n_signs / c.word_chars, (None, 0.09), (None, 0.13)),
)


def repeat_words(ids: np.ndarray, size: int) -> int:
    """Words inside a 3-word window that occurs twice or more; ``ids`` number the words
    0..size-1."""
    if len(ids) < 4:
        return 0
    pair = ids[:-2] * size + ids[1:-1]
    if size >= 2_000_000:  # keep the key inside 64 bits
        _, pair = np.unique(pair, return_inverse=True)
    _, which, count = np.unique(pair * size + ids[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    hit = np.zeros(len(ids), bool)
    for shift in range(3):
        hit[shift:len(ids) - 2 + shift] |= again
    return int(hit.sum())


def text_stats(text: str) -> list[int]:
    raw = text.encode()
    words = raw.split()  # bytes split on exactly the ASCII white space of SPACES
    n = len(words)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
            repeat_words(ids, len(index)), lines, upper,
            sum(w.endswith((b".", b"?", b"!", b":", b";")) for w in words), text.count("!"), len(index),
            int((ids[1:] == ids[:-1]).sum()),
            sum(not w.translate(None, _SIGNS) for w in words if w[0] in _SIGN_SET), len(raw) - len(raw.translate(None, _SIGNS))]


def _stats_kernel(batches):
    for keys, texts in text_rows(batches, "doc_id", "text"):
        rows = [text_stats(t) for t in texts]
        yield batch_of(STATS_SCHEMA, {"doc_id": keys, **{s: [r[i] for r in rows] for i, s in enumerate(STATS)}})


def statistics(docs: DataFrame) -> DataFrame:
    """One row of whole-text statistics per document row."""
    return map_texts(docs, _stats_kernel, STATS_DDL)


def _vote(value: Column, good: tuple, bad: tuple) -> Column:
    """1 good, 2 bad, 0 abstain (also where the statistic is undefined)."""
    def inside(span):
        low, high = span
        test = F.lit(True)
        if low is not None:
            test = test & (value >= low)
        if high is not None:
            test = test & (value <= high)
        return test
    return F.when(inside(good), 1).when(~inside(bad), 2).otherwise(0)


class _Columns:
    def __getattr__(self, name):
        return F.col(name).cast("double")


def votes(stats: DataFrame, rules=RULES) -> DataFrame:
    """Add ``pattern``: one digit per rule (0 abstain, 1 good, 2 bad)."""
    columns = _Columns()
    digits = [F.when(F.col("n_words") > 0, _vote(rule(columns), good, bad)).otherwise(0).cast("string")
              for _, rule, good, bad in rules]
    return stats.withColumn("pattern", F.concat(*digits))


def _starting_rates(rules: int) -> np.ndarray:
    """rate[rule, class (bad, good), vote]: rules better than chance."""
    return np.tile(np.array([[0.34, 0.33, 0.33], [0.2, 0.78, 0.02]]), (rules, 1, 1))


def fit_votes(patterns: list[tuple[str, int]], rounds: int = 200, prior_good: float = 0.8,
              smoothing: float = 1.0) -> tuple[float, np.ndarray]:
    """EM for two hidden classes: returns (P(good), table[rule, class, vote]).

    Starts from rules that are better than chance and whose bad votes are the rarer and
    stronger ones; the start only names the two classes, the counts then set the values.
    """
    rules = len(patterns[0][0]) if patterns else 0
    shape = _starting_rates(rules)
    if not patterns:
        return prior_good, shape
    patterns = sorted(patterns)
    digits = np.array([[int(d) for d in p] for p, _ in patterns])
    weight = np.array([n for _, n in patterns], float)
    prior = prior_good
    for _ in range(rounds):
        post = _posterior(digits, prior, shape)
        old = prior
        prior = float((weight * post).sum() + smoothing) / (weight.sum() + 2 * smoothing)
        for vote in range(3):
            cast = digits == vote
            shape[:, 1, vote] = ((weight * post)[:, None] * cast).sum(0) + smoothing
            shape[:, 0, vote] = ((weight * (1 - post))[:, None] * cast).sum(0) + smoothing
        shape /= shape.sum(2, keepdims=True)
        if abs(prior - old) < 1e-10:
            break
    if shape[:, 0, 2].sum() < shape[:, 1, 2].sum():  # the bad class is the one that gets the bad votes
        prior, shape = 1 - prior, shape[:, ::-1].copy()
    return prior, shape


def _posterior(digits: np.ndarray, prior: float, shape: np.ndarray) -> np.ndarray:
    rule = np.arange(digits.shape[1])
    log_odds = np.log(shape[rule, 1, digits] / shape[rule, 0, digits]).sum(1) + math.log(prior / (1 - prior))
    return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def quality(docs: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """Statistics, ``base_failed``, posterior ``quality`` and ``kept`` per document row."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    table = cut_lineage(votes(statistics(docs), rules).withColumn("base_failed", failed))
    # at most 3^len(rules) rows
    counted = [(r["pattern"], r["n"]) for r in table.where(~F.col("base_failed")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()]
    prior, shape = fit_votes(counted) if counted else (0.8, _starting_rates(len(rules)))
    log_odds = F.lit(math.log(prior / (1 - prior)))
    for i in range(len(rules)):
        weight = [float(math.log(shape[i, 1, v] / shape[i, 0, v])) for v in range(3)]
        digit = F.substring("pattern", i + 1, 1)
        log_odds = log_odds + F.when(digit == "1", weight[1]).when(digit == "2", weight[2]).otherwise(weight[0])
    return (table.withColumn("quality", 1 / (1 + F.exp(-log_odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
