import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import nbsvm, rules, toxicity
from tests.llm.conftest import ODD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = set()
    for k in range(len(w) - 2):
        if windows[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def prose(r, n, words):
    return " ".join(r.choice(words) + ("." if r.random() < 0.1 else "") for _ in range(n)).capitalize()


def corpus(seed=1, n=240):
    r = random.Random(seed)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 9))) for _ in range(500)]
    texts, quality, toxic = {}, {}, {}
    for i in range(n):
        text = prose(r, r.randrange(60, 300), words)
        quality[i], toxic[i] = int(i % 4 != 0), int(i % 3 == 0)
        if i % 4 == 0:
            kind = i // 4 % 3
            text = (" ".join(f"{w}!!" for w in text.upper().split()) if kind == 0 else " ".join([r.choice(words)] * 150)
                    if kind == 1 else " | ".join(text.split()))
        if toxic[i]:
            parts = text.split(" ")
            for bad in ("blorg", "zwack", "grompf"):
                parts.insert(r.randrange(len(parts)), bad)
            text = " ".join(parts)
        texts[i] = text
    return texts, quality, toxic


def test_statistics_against_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in small("documents").collect()} | {k + 10_000: v for k, v in ODD.items()}
    texts |= {20_000: "a b c a b c a b c\nx\nx\n\n \n \nx", 20_001: "w w w w", 20_002: "a b a b a b"}
    got = {r["doc_id"]: r for r in rules.quality(frame(spark, texts)).collect()}
    for doc, text in texts.items():
        want = brute_stats(text)
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, doc
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_votes_find_the_bad_rows_without_labels(spark):
    texts, quality, _ = corpus()
    rows = rules.quality(frame(spark, texts)).collect()
    wrong = sum(r["kept"] != bool(quality[r["doc_id"]]) for r in rows)
    assert wrong <= 0.02 * len(rows)


def brute_em(patterns, rounds=200):
    """EM by plain loops over {pattern: count}: posterior of each pattern."""
    n_rules = len(next(iter(patterns)))
    rate = [[[0.34, 0.33, 0.33], [0.2, 0.78, 0.02]] for _ in range(n_rules)]
    prior = 0.8
    for _ in range(rounds + 1):
        post = {}
        for p in patterns:
            good, bad = prior, 1 - prior
            for r, v in enumerate(p):
                good, bad = good * rate[r][1][int(v)], bad * rate[r][0][int(v)]
            post[p] = good / (good + bad)
        total = sum(patterns.values())
        new = (sum(n * post[p] for p, n in patterns.items()) + 1) / (total + 2)
        for r in range(n_rules):
            for c in (0, 1):
                mass = [1 + sum(n * (post[p] if c else 1 - post[p]) for p, n in patterns.items() if p[r] == str(v)) for v in range(3)]
                rate[r][c] = [m / sum(mass) for m in mass]
        prior, old = new, prior
        if abs(prior - old) < 1e-10:
            break
    out = {}
    for p in patterns:
        good, bad = prior, 1 - prior
        for r, v in enumerate(p):
            good, bad = good * rate[r][1][int(v)], bad * rate[r][0][int(v)]
        out[p] = good / (good + bad)
    return out


def test_posterior_against_a_plain_em(spark, small):
    rows = rules.quality(small("documents")).collect()
    passing = [r for r in rows if not r["base_failed"]]
    want = brute_em(Counter(r["pattern"] for r in passing))
    for r in passing:
        assert abs(r["quality"] - want[r["pattern"]]) < 1e-6 and r["kept"] == (r["quality"] >= 0.5)


def test_votes_decide_beyond_the_base(spark, small):
    """Of the labelled rows that pass the base test, the bad ones go and the good ones stay."""
    labels = {r["doc_id"]: r["quality"] for r in small("labels").collect()}
    rows = [r for r in rules.quality(small("documents")).collect() if not r["base_failed"]]
    bad, good = ([r["kept"] for r in rows if labels.get(r["doc_id"]) == q] for q in (0, 1))
    assert bad and not any(bad) and sum(good) >= 0.98 * len(good)


def test_rules_on_few_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.quality(empty).collect() == []
    rows = rules.quality(frame(spark, {1: None, 2: "", 3: "short"})).collect()  # none passes the base test
    assert len(rows) == 3 and not any(r["kept"] for r in rows) and all(r["base_failed"] for r in rows)


def test_em_recovers_accuracies():
    r = np.random.default_rng(2)
    good = r.random(20000) < 0.8
    votes = np.where(good[:, None], r.choice(3, (20000, 6), p=[0.2, 0.77, 0.03]), r.choice(3, (20000, 6), p=[0.2, 0.2, 0.6]))
    prior, shape = rules.fit_votes(list(Counter("".join(map(str, v)) for v in votes).items()))
    assert abs(prior - 0.8) < 0.02 and np.abs(shape[:, 0] - [0.2, 0.2, 0.6]).max() < 0.05
    assert rules.fit_votes([])[1].shape[0] == 0


def accuracy(frame_, truth, column="predicted"):
    rows = [r for r in frame_.collect() if r["doc_id"] in truth]
    held = [r for r in rows if r["held_out"]]
    return sum(r[column] == truth[r["doc_id"]] for r in held) / len(held)


def test_classifiers_on_held_out_rows(spark):
    # the network needs some hundreds of labelled texts
    for classify, which, rows in ((nbsvm.classify, 1, 240), (toxicity.classify, 2, 900)):
        made = corpus(n=rows)
        texts, truth = made[0] | {5000 + k: v for k, v in ODD.items()}, made[which]
        labels = spark.createDataFrame([(i, made[1][i], made[2][i]) for i in made[0]], "doc_id long, quality int, toxic int")
        labels = labels.union(labels.limit(5)).withColumn("text", F.lit("y"))
        found = classify(frame(spark, texts), labels).cache()
        assert found.count() == len(texts)
        assert all(0 <= r["score"] <= 1 for r in found.collect())
        assert accuracy(found, truth) >= 0.9


def test_classifiers_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for classify in (nbsvm.classify, toxicity.classify):
        assert classify(frame(spark, {}), labels).count() == 0
        assert classify(frame(spark, {1: "a", 2: None}), labels).count() == 2


def test_indicators_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(f"w{i % 97} X{i % 13}!" for i in range(5000))
    whole, cut = set(nbsvm.indicators(text)), nbsvm.pieces
    monkeypatch.setattr(nbsvm, "pieces", lambda raw: cut(raw, 1000))
    assert len(list(cut(text.encode(), 1000))) > 20 and set(nbsvm.indicators(text)) == whole


def test_toxic_phrase_late_in_an_unspaced_run():
    r = random.Random(5)
    rows = []
    for i in range(900):
        run = [chr(r.randrange(0x4E00, 0x4E80)) for _ in range(r.randrange(60, 120))]
        if i % 3 == 0:
            at = r.randrange(25, len(run))  # beyond byte 64
            run[at:at] = "蠢货滚开蠢货滚开"
        rows.append((int(i % 3 == 0), "".join(run)))
    model = toxicity.fit(rows[:600], {0: 400, 1: 200})
    logit = model["slope"] * toxicity.best_logits([t.encode() for _, t in rows[600:]], model) + model["offset"]
    assert np.mean((logit > 0) == [y == 1 for y, _ in rows[600:]]) >= 0.9


def test_all_bytes_of_long_runs_stand_in_words():
    texts = ["字é\U0001f642" * 400, "x" * 1000, "a b " + "ы" * 100 + " c", "第一句。第二句！「三」", "", "y" * 64]
    words = toxicity.Words([t.encode() for t in texts])
    a = np.frombuffer(" ".join(texts).encode() + b" ", np.uint8)
    gap = a == 32
    start, end = toxicity.cut_runs(a, np.flatnonzero(~gap & np.r_[True, gap[:-1]]), np.flatnonzero(gap & np.r_[False, ~gap[:-1]]))
    seen = np.zeros(len(a), bool)
    for low, high in zip(start, end):
        a[low:high].tobytes().decode()
        seen[low:high] = True
        assert high - low <= toxicity.LONGEST
    assert (seen == ~gap).all() and list(words.per_text[[3, 4, 5]]) == [3, 0, 1]
    raw = ("字" * 300 + "\n").encode() * 40
    cut = list(toxicity.parts(raw, 5000, 500))
    assert max(map(len, cut)) <= 6600 and all(p.decode() for p in cut)
    assert sum(map(len, cut)) >= len(raw) and raw.endswith(cut[-1])


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    texts = [b"alpha beta gamma delta " * 5, b"beta epsilon zeta"]
    m = toxicity.new_model(toxicity.learn_vocabulary(texts * 3))
    m = {k: v.astype(np.float64) if v.dtype == np.float32 else v for k, v in m.items()}
    words = toxicity.Words(texts)
    places, filled, _ = toxicity.window_matrix(words)
    pick = r.normal(size=len(places))
    _, saved = toxicity.forward(m, words, places, filled, keep=True)
    grads = toxicity.backward(m, words, saved, pick)
    for name in ("out", "query", "attend", "hf", "hb", "xf", "xb", "cf", "cb", "word", "char"):
        flat = np.argmax(np.abs(grads[name]))
        at = np.unravel_index(flat, m[name].shape)
        step, value = 1e-3, m[name][at]
        m[name][at] = value + step
        up = (toxicity.forward(m, words, places, filled) * pick).sum()
        m[name][at] = value - step
        down = (toxicity.forward(m, words, places, filled) * pick).sum()
        m[name][at] = value
        assert abs((up - down) / (2 * step) - grads[name][at]) <= 0.02 * abs(grads[name][at]) + 1e-4, name
