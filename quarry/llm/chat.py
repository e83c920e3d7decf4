"""Chat formatting of reply trees.

A conversation is a tree of messages; training wants root-to-leaf paths as single dialogues.

* **Paths by iterative self-joins.**  Each message points to the message it answers.  Round i
  joins the pointer table with itself, so pointers reach 2^i replies up, and adds up depth and
  score on the way: log2(depth) joins, whatever the number of messages.  The chosen leaves
  then walk down the same tables, largest step first; each ancestor is met exactly once.
* **Ranking.**  A branch (leaf) scores the mean of its messages' scores; in each tree the
  first ``keep`` branches by score, then depth, then smaller leaf are formatted.
* **Template.**  ``<s>``, then per turn ``[INST] text [/INST]`` (user), ``<<SYS>> text
  <</SYS>>`` (system), `` text </s>`` (assistant) or ``[ROLE] role\ntext [/ROLE]`` (any other).
  Control strings and backslashes inside a text get a backslash before them (so does a line
  break inside a role), which is undone by removing it; template markers never follow a
  backslash and texts stand between blanks, so no text can end or begin a turn.
* **Loss mask.**  The spans of the assistant's texts, in code points of a piece.

A formatted conversation is a list of pieces (whole turns, up to ``PIECE_CHARS`` unless one
turn is longer): a conversation with very many turns is never held by one task, neither when
it is written nor when it is read back, which goes turn by turn.

Defined results: a null text or role is empty; rows of a conversation are ordered by turn
(null first), then role, then text, so repeated rows stay, side by side; rows without a
conv_id are one conversation without an id; a message whose parent is not there is a root;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_CHARS = 1 << 20
START = "<s>"
OPEN = {"user": "[INST] ", "assistant": " ", "system": "<<SYS>> "}
CLOSE = {"user": " [/INST]", "assistant": " </s>", "system": " <</SYS>>"}
OTHER = ("[ROLE] ", " [/ROLE]")
CONTROL = r"\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]"
MARK = re.compile(r"\\.|" + CONTROL.split("|", 1)[1], re.S)  # an escaped character or a marker
ESCAPED = re.compile(r"\\(.)", re.S)


# ------------------------------------------------------------------ messages and paths

def replies(conversations: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text) of linear conversations: each row answers the
    one before it.  Rows are numbered by a range-partitioned sort, so a conversation may span
    partitions; only its part in each is known to one row."""
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = ["tree", "turn", "role", "text"]
    laid = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("node", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    parts = laid.groupBy("tree", "part").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    before = F.lag("last").over(Window.partitionBy("tree").orderBy("part"))  # one row a partition that the tree spans
    heads = parts.select(F.col("first").alias("node"), before.alias("before"))
    return laid.join(heads.withColumn("head", F.lit(True)), "node", "left").select(
        "tree", "node", F.when(F.col("head"), F.col("before")).otherwise(F.col("node") - 1).alias("parent"), "role", "text")


def pointer_tables(messages: DataFrame) -> list[DataFrame]:
    """Tables i = 0, 1, ... of (node, up, hops, total): the message 2^i replies above (null
    beyond the root), the replies gone up and the scores of the messages passed, itself
    included.  The last has no pointer left: its hops are depths, its totals whole branches."""
    known = messages.select(F.col("node").alias("up"), F.lit(1).cast("long").alias("hops"))
    answers = messages.where(F.col("parent").isNotNull()).join(known, messages["parent"] == known["up"], "left")
    roots = messages.where(F.col("parent").isNull()).withColumn("up", F.lit(None).cast("long")).withColumn("hops", F.lit(0).cast("long"))
    step = cut_lineage(answers.unionByName(roots).select("node", "up", F.coalesce("hops", F.lit(0).cast("long")).alias("hops"), F.col("score").alias("total")))
    tables = [step]
    while not step.where(F.col("up").isNotNull()).isEmpty():
        going = step.where(F.col("up").isNotNull())
        above = step.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("hops").alias("_hops"), F.col("total").alias("_total"))
        went = going.join(above, "up").select("node", F.col("_up").alias("up"), (F.col("hops") + F.col("_hops")).alias("hops"),
                                              (F.col("total") + F.col("_total")).alias("total"))
        step = cut_lineage(went.unionByName(step.where(F.col("up").isNull())))
        tables.append(step)
    return tables


def chosen_paths(messages: DataFrame, keep: int = 1, spread: int = 64) -> DataFrame:
    """(tree, leaf, node, place): the messages of each tree's ``keep`` best branches.

    ``messages(tree, node long, parent long, score double)``; a null score counts as 0.
    Branches are ranked in ``spread`` parts of a tree first, then among the parts' best, so a
    tree with very many branches is not one task's.
    """
    scored = cut_lineage(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    tables = pointer_tables(scored)
    inner = scored.where(F.col("parent").isNotNull()).select(F.col("parent").alias("node")).distinct()
    leaves = scored.select("tree", "node").join(inner, "node", "left_anti").join(tables[-1].select("node", "hops", "total"), "node")
    order = [F.desc(F.col("total") / (F.col("hops") + 1)), F.desc("hops"), "node"]
    part = F.pmod(F.xxhash64("node"), F.lit(spread))
    for by in (["tree", "_part"], ["tree"]):
        leaves = leaves.withColumn("_part", part) if "_part" in by else leaves
        leaves = leaves.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= keep)
    walk = cut_lineage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.col("hops").alias("place")))
    steps = [t.where(F.col("up").isNotNull()).select("node", "up") for t in tables[:-1]]
    for i in reversed(range(len(steps))):  # from the largest step: every distance is met once
        far = walk.join(steps[i], "node").select("tree", "leaf", F.col("up").alias("node"), (F.col("place") - 2 ** i).alias("place"))
        walk = cut_lineage(walk.unionByName(far))
    return walk


# ------------------------------------------------------------------ template

def formatted_turn(role: Column, text: Column) -> Column:
    """One turn by the template (without the start marker)."""
    escaped = lambda c: F.regexp_replace(c, f"({CONTROL})", r"\\$1")
    other = F.concat(F.lit(OTHER[0]), F.regexp_replace(escaped(role), "(\n)", r"\\$1"), F.lit("\n"), escaped(text), F.lit(OTHER[1]))
    out = other
    for r in OPEN:
        out = F.when(role == r, F.concat(F.lit(OPEN[r]), escaped(text), F.lit(CLOSE[r]))).otherwise(out)
    return out


_PIECE = "tree long, leaf long, place long, turns long, text string, loss array<struct<start:long,end:long>>"


def _gather(limit: int):
    schema = pa.schema([("tree", pa.int64()), ("leaf", pa.int64()), ("place", pa.int64()), ("turns", pa.int64()), ("text", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, texts, size, turns, place, loss, done = None, [], 0, 0, 0, [], []

        def close():
            done.append({"tree": key[0], "leaf": key[1], "place": place, "turns": turns, "text": "".join(texts), "loss": loss})

        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["tree"], row["leaf"]) or size + len(row["turn"]) > limit:
                    if key is not None:
                        close()
                    key, texts, size, turns, place, loss = (row["tree"], row["leaf"]), [], 0, 0, row["place"], []
                text = (START if row["place"] == 0 else "") + row["turn"]
                if row["role"] == "assistant":
                    begin = size + len(text) - len(row["turn"]) + len(OPEN["assistant"])
                    loss.append({"start": begin, "end": size + len(text) - len(CLOSE["assistant"])})
                texts.append(text)
                size += len(text)
                turns += 1
            if sum(len(d["text"]) for d in done) > limit or len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done.clear()
        if key is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    return kernel


def format_chats(messages: DataFrame, keep: int = 1, piece: int = PIECE_CHARS) -> DataFrame:
    """The chosen branches of reply trees as text: (tree, leaf, place, turns, text, loss), one
    row a piece, in order of ``place`` (of its first turn).

    ``messages(tree long, node long, parent long, role, text[, score double])``.
    """
    scored = messages if "score" in messages.columns else messages.withColumn("score", F.lit(0.0))
    paths = chosen_paths(scored, keep)
    said = messages.select("node", "role", formatted_turn(F.col("role"), F.col("text")).alias("turn"))
    order = ["tree", "leaf", "place"]
    turns = paths.join(said, "node").select(*order, "role", "turn")
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_gather(piece), _PIECE)


# ------------------------------------------------------------------ reading back

def plain(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a piece; ValueError if it is not by the template."""
    at = len(START) if text.startswith(START) else 0
    while at < len(text):
        role = next((r for r, o in OPEN.items() if text.startswith(o, at)), None)
        opener, closer = (OPEN[role], CLOSE[role]) if role else OTHER
        if not text.startswith(opener, at):
            raise ValueError(f"no turn begins at {at}")
        begin = at + len(opener)
        end = next((m for m in MARK.finditer(text, begin) if m[0][0] != "\\"), None)
        if end is None or " " + end[0] != closer or text[end.start() - 1] != " ":
            raise ValueError(f"the turn at {at} does not end as it began")
        body = text[begin:end.start() - 1]
        if role is None:
            cut = next(m for m in re.finditer(r"\\.|\n", body, re.S) if m[0] == "\n").start()
            yield plain(body[:cut]), plain(body[cut + 1:])
        else:
            yield role, plain(body)
        at = end.end()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.int64()), ("leaf", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    key, state, done = None, None, []

    def close():
        n, turns, chars, loss, size = state
        done.append({"tree": key[0], "leaf": key[1], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                     "loss_sha256": loss.hexdigest(), "formatted_chars": size})

    for batch in batches:
        for row in batch.to_pylist():
            if key != (row["tree"], row["leaf"]):
                if key is not None:
                    close()
                key, state = (row["tree"], row["leaf"]), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parsed(row["text"]):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in row["loss"]:
                learned = plain(row["text"][span["start"]:span["end"]])
                state[2] += len(learned)
                state[3].update(learned.encode())
            state[4] += len(row["text"])
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done.clear()
    if key is not None:
        close()
        yield pa.RecordBatch.from_pylist(done, schema=schema)


def read_back(pieces: DataFrame) -> DataFrame:
    """(tree, leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each
    formatted conversation, parsed from its pieces alone."""
    met = pieces.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "place")
    return met.mapInArrow(_digests, "tree long, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
