"""Prefix trie of conversations: union-find over the LCPs of sorted neighbours.

Conversations are sorted by their turns, so every trie node covers a run of neighbours, and
the depth at which two neighbours part (their LCP) is an edge between them.  Edges are taken
in descending depth; joining the components of an edge's ends makes (or widens) the branching
node at that depth, and closes the unary chains that lead from it to the two components.

* **Keys.**  A turn is the MD5 of its role and text; a conversation's key is its digests one
  after another, so keys sort like the turn sequences (in digest order).  Equal keys are one
  row with a count: a group of identical conversations, whatever its size, is one leaf.
* **Forests.**  Keys are range-partitioned.  Each partition joins its own edges; what lies
  inside is emitted as finished nodes.  Components whose node can reach over a partition's
  border (LCP with the neighbour there at least the node's depth) stay open: at most two a
  depth, with their sums.  These contracted forests are merged, ``FAN`` neighbouring ones a
  task, round after round until one is left; every round emits the nodes that it closes.
* **Sums.**  A component carries its conversations, smallest id, leaves, and saved words; they
  add up at every merge, so no subtree is walked.

No task holds more than a partition's distinct keys or ``FAN`` contracted forests.  Texts
stay where they are read: only (turn, digest, words) is shuffled.  The turns of one
conversation are one row of about 50 bytes a turn, which bounds the length of a conversation
that can be handled (tens of millions of turns), not the number of conversations.

Defined results: a null role or text is empty; turns are ordered with null first, repeated
turn numbers by digest; rows without a conv_id take no part; an empty table has no nodes;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.digests import joined_digest
from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEX = 32  # characters of a turn's digest in a key
FAN = 256  # contracted forests that one task merges
WORD = r"[^\x20\x09-\x0D]+"

_STATE = "run long, seq long, lcp int, rcp int, own string, words array<long>, kd int, nch long, n long, mn long, leaves long, saved long"
_NODE = "depth int, n_convs long, n_children long, n_leaves long, saved_tokens long, at string, up string"
_KERNEL = f"closed boolean, {_STATE}, {_NODE}"
_COLUMNS = [c.split()[0] for c in _KERNEL.split(", ")]


# ------------------------------------------------------------------ conversations to keys

def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns in order as (digest, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    lists = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def regrouped(lists: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation c behind the first h turns of conversation c - c % every, without its
    own first h; h = crc32(c) % (most + 1).  At most ``every`` conversations ask for one."""
    own = lists.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
                       (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int").alias("h"))
    heads = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    none = F.slice("turns", 1, 0)
    kept = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), kept).alias("turns"))


# ------------------------------------------------------------------ union-find over LCP edges

def shared(a: str, b: str) -> int:
    """Turns that two keys have in common at their front."""
    low, high = 0, min(len(a), len(b)) // HEX
    if a[:high * HEX] == b[:high * HEX]:
        return high
    while high - low > 1:  # a[:low] equal, a[:high] not
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid * HEX] == b[:mid * HEX] else (low, mid)
    return low


def _name(key: str, depth: int) -> str:
    return hashlib.md5(key[:depth * HEX].encode()).hexdigest()


class Forest:
    """Components of neighbouring keys; ``items`` are dicts with the columns of _STATE."""

    def __init__(self, items: list[dict]):
        self.items, self.nodes = items, []
        self.top = list(range(len(items)))  # union-find over places

    def root(self, i: int) -> int:
        while self.top[i] != i:
            self.top[i] = self.top[self.top[i]]
            i = self.top[i]
        return i

    def lift(self, x: dict, depth: int) -> None:
        """Close the chain of nodes from x's pending node up to depth + 1; the node at
        ``depth`` is then pending, with that chain as its child."""
        if x["kd"] <= depth:
            return
        x["leaves"] = x["leaves"] or 1  # a pending node without children is a leaf
        for d in range(x["kd"], depth, -1):
            if d:
                x["saved"] += (x["n"] - 1) * x["words"][d - 1]
            self.nodes.append((d, x["n"], x["mn"], x["nch"] if d == x["kd"] else 1, x["leaves"], x["saved"],
                               _name(x["own"], d) if d == x["kd"] else None, _name(x["own"], depth) if d == depth + 1 and d else None))
        x["kd"], x["nch"] = depth, 1

    def join(self, left: int, depth: int) -> int:
        """Join the component that ends at place ``left`` with the next one, at ``depth``."""
        a, b = self.root(left), self.root(left + 1)
        x, y = self.items[a], self.items[b]
        self.lift(x, depth)
        self.lift(y, depth)
        for c in ("nch", "n", "leaves", "saved"):
            x[c] += y[c]
        x["mn"], x["rcp"] = min(x["mn"], y["mn"]), y["rcp"]
        self.top[b] = a
        return a

    def merge(self) -> list[dict]:
        """Join edges in descending depth; returns the components that stay open.

        An edge must wait if a neighbouring edge that is deeper has to wait, or leads over the
        border of the items: its component's pending node is then not whole yet.  Waiting edges
        are ever shallower from the borders inwards, so at most one a depth and border is left.
        """
        items = self.items
        levels: dict[int, list[int]] = {}
        for i in range(len(items) - 1):
            levels.setdefault(items[i]["rcp"], []).append(i)
        for depth in sorted(levels, reverse=True):
            for i in levels[depth]:
                if self.items[self.root(i)]["lcp"] <= depth and self.items[self.root(i + 1)]["rcp"] <= depth:
                    self.join(i, depth)
        left = [items[i] for i in range(len(items)) if self.root(i) == i]
        if len(left) == 1 and left[0]["lcp"] < 0 and left[0]["rcp"] < 0:  # nothing beyond: the root is whole
            self.lift(left[0], -1)
            return []
        return left


def _result(run: int, forest: Forest, left: list[dict]) -> pd.DataFrame:
    blank = [None] * (len(_COLUMNS) - 1)
    node_at = _COLUMNS.index("depth")
    rows = []
    for d, n, mn, children, leaves, saved, at, up in forest.nodes:
        row = [True, *blank]
        row[_COLUMNS.index("mn")] = mn
        row[node_at:] = [d, n, children, leaves, saved, at, up]
        rows.append(row)
    for seq, x in enumerate(left):
        state = [run, seq, x["lcp"], x["rcp"], x["own"][:x["kd"] * HEX], x["words"][:x["kd"]], *(x[c] for c in ("kd", "nch", "n", "mn", "leaves", "saved"))]
        rows.append([False, *state, *[None] * (len(_COLUMNS) - node_at)])
    return pd.DataFrame(rows, columns=_COLUMNS, dtype=object)


def _first_forest(keys: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
    """Edges between the keys of one partition; its borders' edges come from ``bounds``."""
    if keys.empty:
        return pd.DataFrame(columns=_COLUMNS, dtype=object)
    keys = keys.sort_values("own")
    before, after = bounds["before"].iloc[0], bounds["after"].iloc[0]
    own = keys["own"].tolist()
    edges = [shared(a, b) for a, b in zip(own, own[1:])]
    edges = [-1 if before is None else shared(before, own[0]), *edges, -1 if after is None else shared(own[-1], after)]
    items = [dict(own=k, words=[int(w) for w in words], lcp=edges[i], rcp=edges[i + 1], kd=len(k) // HEX, nch=0, n=int(n), mn=int(mn), leaves=0, saved=0)
             for i, (k, words, n, mn) in enumerate(zip(own, keys["words"], keys["n"], keys["mn"], strict=True))]
    forest = Forest(items)
    return _result(int(keys["run"].iloc[0]), forest, forest.merge())


def _next_forest(open_: pd.DataFrame) -> pd.DataFrame:
    """The contracted forests of neighbouring partitions, merged across their borders."""
    items = []
    for r in open_.sort_values(["part", "seq"]).to_dict("records"):
        items.append({c: int(r[c]) for c in ("lcp", "rcp", "kd", "nch", "n", "mn", "leaves", "saved")}
                     | {"own": r["own"], "words": [int(w) for w in r["words"]]})
    forest = Forest(items)
    return _result(int(open_["run"].iloc[0]), forest, forest.merge())


def trie(sequences: DataFrame, fan: int = FAN, partitions: int | None = None) -> DataFrame:
    """The nodes of ``sequences(conv_id, turns array<struct<digest, words>>)``, one row each:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    (see the module).  ``partitions``: of the sorted keys (the session's by default)."""
    own = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    each = cut_lineage(sequences.select("conv_id", own.alias("own"), F.transform("turns", lambda t: t["words"]).alias("words")))
    keys = each.groupBy("own", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("mn"))
    ranged = keys.repartitionByRange(partitions, "own") if partitions else keys.repartitionByRange("own")
    laid = cut_lineage(ranged.withColumn("run", F.spark_partition_id().cast("long")))
    ends = cut_lineage(laid.groupBy("run").agg(F.min("own").alias("first"), F.max("own").alias("last")))
    # one row a partition: the neighbours of each partition's first and last key
    order = Window.orderBy("run")
    bounds = ends.select("run", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    out = cut_lineage(laid.groupBy("run").cogroup(bounds.groupBy("run")).applyInPandas(_first_forest, _KERNEL))
    tables = [out]
    runs = (ends.agg(F.max("run")).first()[0] or 0) + 1
    while runs > 1:
        rest = out.where(~F.col("closed")).withColumn("part", F.col("run")).withColumn("run", F.floor(F.col("run") / fan).cast("long"))
        out = cut_lineage(rest.groupBy("run").applyInPandas(_next_forest, _KERNEL))
        tables.append(out)
        runs = -(-runs // fan)
    found = reduce(DataFrame.unionByName, tables).where("closed").select(
        F.col("mn").alias("conv_id"), "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "at", "up")
    # a chain's first node hangs from the last node of the chain above; the others from the node before, which has the same members
    last = found.where(F.col("at").isNotNull()).select(F.col("at").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    inside = found.where(F.col("up").isNull()).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    nodes = inside.unionByName(found.where(F.col("up").isNotNull()).join(last, "up"))
    members = joined_digest(each.select(F.md5("own").alias("key"), F.col("conv_id").alias("ord"), F.col("conv_id").cast("string").alias("data")), ",")
    empty = F.sha2(F.lit(""), 256)
    ending = nodes.where(F.col("at").isNotNull()).join(members.withColumnRenamed("key", "at"), "at", "left").withColumn("sha256", F.coalesce("sha256", empty))
    nodes = ending.unionByName(nodes.where(F.col("at").isNull()).withColumn("sha256", empty))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.col("sha256").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of regrouped ``conversations(conv_id, turn, role, text)``."""
    return trie(regrouped(cut_lineage(turn_lists(conversations))), **options)
