"""Reply trees and the prefix trie against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, prefix_trie
from quarry.llm.queries import op11_chat_format, op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", "\\", "\\\\n", "</s>", "[INST] ok [/INST]", "a\\</s>b", " <</SYS>>", "[ROLE] x\ny [/ROLE]", "<s><s>", "\n", "[/INST", "ends in \\", "é\U0001f642 [INST]"]


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def saved(folder, spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "node", "own", "run", "n_convs", "score", "key"):  # clashing names
        table = table.withColumn(name, F.lit("x"))
    table.write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


# ------------------------------------------------------------------ chat formatting

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_chats(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        learned = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), sha(learned)))
    return out


def test_chat_query_keeps_all_turns(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, 0, 1, 1, 2, 7]), rng.choice(["user", "assistant", "system", None, "tool\n[ROLE]", "a\\"]), rng.choice([*NASTY, None]))
            for c in range(40) for _ in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still")]
    rows += [(5000, t % 40, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(700)]  # ties, and a third of all rows
    rows += [rows[0]] * 3
    got = {r["conv_id"]: r for r in op11_chat_format(spark, saved(tmp_path, spark, rows)).collect()}
    said = "</s>[INST] ok [/INST]"
    for c, *want in brute_chats([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]):
        r = got.pop(c)
        assert [r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]] == want, c
    assert not got


def test_chat_of_an_empty_table(spark, tmp_path):
    assert [r["conv_id"] for r in op11_chat_format(spark, saved(tmp_path, spark, [])).collect()] == [-7]


def brute_paths(messages, keep):
    parent = {n: p for _, n, p, *_ in messages}
    score, tree = {n: s for _, n, _, _, _, s in messages}, {n: t for t, n, *_ in messages}
    leaves = {}
    for n in parent:
        if n not in parent.values():
            path, at = [], n
            while at in parent:
                path.append(at)
                at = parent[at]
            leaves.setdefault(tree[n], []).append((-sum(score[x] or 0.0 for x in path) / len(path), -len(path), n, path[::-1]))
    return {t: [x[3] for x in sorted(found)[:keep]] for t, found in leaves.items()}


@pytest.mark.parametrize("keep", [1, 3])
def test_branches_against_brute_force(spark, keep):
    rng = random.Random(keep)
    messages, node = [], 0
    for tree in range(12):
        own = []
        for _ in range(rng.choice([1, 4, 30])):
            messages.append((tree, node, rng.choice(own[-3:]) if own else None, rng.choice(["user", "assistant"]), rng.choice(NASTY), rng.choice([0.0, 0.5, 1.0, None])))
            own.append(node)
            node += 1
    for k in range(300):  # a long chain, and a bushy root
        messages.append((50, 1000 + k, 1000 + k - 1 if k else None, "user", f"m{k}", 1.0))
        messages.append((51, 2000 + k, 2000 if k else None, "user", f"m{k}", k / 7))
    messages.append((52, 9000, 8999, "assistant", "answers what is not there", 0.0))
    frame = spark.createDataFrame(messages, "tree long, node long, parent long, role string, text string, score double")
    want = brute_paths(messages, keep)
    paths = {}
    for r in chat.chosen_paths(frame, keep, spread=4).collect():
        paths.setdefault(r["tree"], {}).setdefault(r["leaf"], []).append((r["place"], r["node"]))
    assert {t: sorted([n for _, n in sorted(p)] for p in found.values()) for t, found in paths.items()} == {t: sorted(p) for t, p in want.items()}
    text = {n: (r, x) for _, n, _, r, x, _ in messages}
    pieces = {}
    for p in chat.format_chats(frame, keep, piece=60).collect():
        pieces.setdefault(p["leaf"], []).append(p)
    for branches in want.values():
        for path in branches:
            own = sorted(pieces[path[-1]], key=lambda p: p["place"])
            assert own[0]["text"].startswith("<s>") and not any(p["text"].startswith("<s>") for p in own[1:])
            assert [t for p in own for t in chat.parsed(p["text"])] == [text[n] for n in path]
            masked = [chat.plain(p["text"][s["start"]:s["end"]]) for p in own for s in p["loss"]]
            assert masked == [text[n][1] for n in path if text[n][0] == "assistant"]
    back = {r["leaf"]: r["n_turns"] for r in chat.read_back(chat.format_chats(frame, keep, piece=60)).collect()}
    assert back == {p[-1]: len(p) for found in want.values() for p in found}


def test_a_piece_that_is_not_by_the_template_is_refused():
    for text in ("<s>hello", "<s>[INST] a </s>", "<s>[INST] a", "<s>[INST] a[/INST]"):
        with pytest.raises(ValueError):
            list(chat.parsed(text))


# ------------------------------------------------------------------ prefix trie

def brute_trie(sequences):
    """Nodes of {conv: [(turn, words), ...]} by grouping every prefix."""
    nodes = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(t for t, _ in turns[:d]), {"convs": [], "words": turns[d - 1][1] if d else 0, "kids": set()})["convs"].append(c)
            if d:
                nodes[tuple(t for t, _ in turns[:d - 1])]["kids"].add(turns[d - 1][0])

    def below(p):
        n = nodes[p]
        saved, leaves = (len(n["convs"]) - 1) * n["words"], 0 if n["kids"] else 1
        for k in n["kids"]:
            s, x = below((*p, k))
            saved, leaves = saved + s, leaves + x
        return saved, leaves

    out = []
    for p, n in nodes.items():
        saved, leaves = below(p)
        ends = ",".join(str(c) for c in sorted(c for c in n["convs"] if len(sequences[c]) == len(p)))
        out.append((min(n["convs"]), len(p), min(nodes[p[:-1]]["convs"]) if p else None, len(n["convs"]), len(n["kids"]), leaves, saved, sha(ends)))
    return sorted(out, key=str)


def trie_of(spark, sequences, **options):
    rows = [(c, [(hashlib.md5(t.encode()).hexdigest(), w) for t, w in turns]) for c, turns in sequences.items()]
    frame = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:string,words:long>>")
    return sorted((tuple(r) for r in prefix_trie.trie(frame, **options).collect()), key=str)


@pytest.mark.parametrize("seed,partitions,fan", [(1, 1, 256), (2, 9, 2), (3, 23, 3)])
def test_trie_against_brute_force(spark, seed, partitions, fan):
    rng = random.Random(seed)
    words = {t: rng.randint(0, 9) for t in "abcd"}
    sequences = {c: [(t, words[t]) for t in rng.choices("abcd", weights=(6, 2, 1, 1), k=rng.choice([0, 1, 2, 3, 5, 8]))] for c in range(-5, 150)}
    long = [("a", words["a"])] * 60
    sequences |= {1000 + c: long for c in range(80)} | {2000: long + [("b", words["b"])], 2001: long[:40]}  # copies, an extension, a prefix
    assert trie_of(spark, sequences, partitions=partitions, fan=fan) == brute_trie(sequences)


@pytest.mark.parametrize("sequences", [{}, {7: []}, {7: [], 9: []}, {3: [("x", 2)]}, {3: [("x", 2)], 1: [("x", 2)], 2: [("y", 1)]}])
def test_small_tries(spark, sequences):
    assert trie_of(spark, sequences, partitions=3, fan=2) == brute_trie(sequences)


def test_forests_merge_to_the_same_nodes_wherever_they_are_cut():
    rng = random.Random(11)
    digest = {t: hashlib.md5(t.encode()).hexdigest() for t in "abc"}
    for _ in range(60):
        keys = sorted({"".join(digest[t] for t in rng.choices("abc", k=rng.randint(0, 5))) for _ in range(12)})

        def forest_nodes(cuts):
            parts, nodes = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True) if a < b], []
            rest = []
            for i, part in enumerate(parts):
                ends = [parts[i - 1][-1] if i else None, *part, parts[i + 1][0] if i + 1 < len(parts) else None]
                lcps = [-1 if a is None or b is None else prefix_trie.shared(a, b) for a, b in zip(ends, ends[1:])]
                forest = prefix_trie.Forest([dict(own=k, words=[1] * 9, lcp=lcps[j], rcp=lcps[j + 1], kd=len(k) // 32, nch=0, n=1, mn=keys.index(k), leaves=0, saved=0)
                                             for j, k in enumerate(part)])
                rest += forest.merge()
                nodes += forest.nodes
                assert len(parts) == 1 or len(rest) <= 12 * len(parts)
            if rest:
                last = prefix_trie.Forest(rest)
                assert last.merge() == []
                nodes += last.nodes
            return sorted(nodes, key=str)

        whole = forest_nodes([])
        assert forest_nodes(sorted(rng.sample(range(len(keys)), min(4, len(keys))))) == whole


def test_trie_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["one two", "x y \t z", None, ""])) for c in [*range(0, 47), 60, 63, 99]
            for t in rng.choice([[0], [0, 1, 2], [None, 3, 5, 8, 9]])]
    rows += [(None, 0, "user", "left out")]
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            n = len([w for w in (x or "").replace("\t", " ").split(" ") if w])
            own.setdefault(c, []).append((t is not None, t or 0, (r or "", x or ""), n))
    own = {c: [(turn, n) for _, _, turn, n in sorted(v, key=lambda y: y[:2])] for c, v in own.items()}
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    assert sorted((tuple(r) for r in op13_prefix_trie(spark, saved(tmp_path, spark, rows)).collect()), key=str) == brute_trie(want)
