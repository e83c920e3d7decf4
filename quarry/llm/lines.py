"""Line dedup: winnowing over line hashes (operator 5).

A text is cut into *lines*: at line breaks and, because prose holds long lines, also where
`fold` matches (before words with certain first letters), so that the same passage is cut
alike wherever it stands in a line.  Lines are hashed; ``RUN`` consecutive lines form a
window.  Each window is guarded by the smallest hash of two neighbouring lines in it
(winnowing), so a run of ``RUN`` or more lines that occurs twice shares a fingerprint for
certain, and only about a third of the positions are fingerprints.

Fingerprints that occur once are dropped (a map-side combined count and a join).  Where one
occurs again, the match is extended both ways over the windows that it guards: windows are
compared by two independent hashes (64 and 32 bits) with their first occurrence by (document,
position), and a document's later windows are put together to maximal runs.  A run of ``min_words`` or more words is
deleted.  In plain terms: a line goes if it lies in a run of at least RUN lines and
min_words words each of whose windows occurred earlier.

Only hashes and positions are shuffled before the last join; hot lines meet in map-side
combined minima and in joins whose other side has one row per key.

Defined cases: null texts stay null, empty ones stay empty; a text shorter than RUN lines is
kept; of repeated ids each row counts with its own text, and the deletions found for an
id are made in all its rows; rows with a null id are kept as they are; an empty table gives an
empty result.  Other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

RUN = 5
MIN_WORDS = 25
SEED = 5
BLANKS = " \n\t\r"
FOLD = r"(?<=\n)(?!\n)|(?<=\s)(?=[A-ZÀ-Þab])"
# The same cuts, and the blanks before each taken away, for texts without form feeds and vertical
# tabs.  Most characters fail the first test, while FOLD looks behind every one of them; runs of
# blanks are read from their start only, so that long ones take linear work.
GAPS = (r"(?=[ \n\t\r])(?:[ \t\r](?=[A-ZÀ-Þab])|\n(?!\n)|[ \n\t\r](?=[ \n\t\r])(?<![ \t\r][ \n\t\r])"
        r"[ \n\t\r]+?(?:(?=[A-ZÀ-Þab])|(?<=\n)(?!\n)))")


def cut(text: Column) -> Column:
    """The lines of a text, with the white space after each; joined they are the text."""
    return F.split(F.coalesce(text, F.lit("")), FOLD, -1)


def _bare(lines: Column) -> Column:
    """The pieces between GAPS; only the last can still end in blanks."""
    return F.concat(F.slice(lines, F.lit(1), F.size(lines) - 1), F.array(F.rtrim(F.element_at(lines, -1), F.lit(BLANKS))))


def stripped(docs: DataFrame) -> DataFrame:
    """(doc_id, u): the lines of each text without the blanks after each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    odd = text.contains("\f") | text.contains("\x0b")
    split = docs.select("doc_id", F.when(odd, cut(text)).otherwise(F.split(text, GAPS, -1)).alias("u"), odd.alias("o"))
    return split.select("doc_id", F.when(F.col("o"), F.transform("u", lambda u: F.rtrim(u, F.lit(BLANKS))))
                        .otherwise(_bare(F.col("u"))).alias("u"))


def _pairs(a: Column, b: Column, shift: int, size: Column, step) -> Column:
    """step(a[i], b[i + shift]) for the first ``size`` places."""
    size = F.greatest(size, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(shift + 1), size), step)


def _part(values: Column, first: Column, end: Column) -> Column:
    """values[first .. end - 1] (places from 1).  Unlike ``slice``, which copies the whole array
    each time, this only touches the part."""
    return F.when(end > first, F.transform(F.sequence(first, F.greatest(end - 1, first)), lambda i: F.element_at(values, i))) \
        .otherwise(F.slice(F.array(F.element_at(values, 1)), 1, 0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print, start, windows): each selected fingerprint with the hashes of the
    windows that it guards, the first of which begins at line ``start``."""
    cuts = stripped(docs.where(F.col("doc_id").isNotNull()))
    hashed = cuts.select("doc_id", F.transform("u", lambda u: F.xxhash64(u)).alias("h"),
                         F.transform("u", lambda u: F.xxhash64(F.lit(SEED), u)).alias("c"))
    # RUN = 5 lines hold 4 neighbouring pairs g: m is the least of them, w names the 5 lines
    # by 64 bits (two pairs and the last line) and, from line hashes of another seed, by 32 more
    pairs = hashed.select("doc_id", "h", "c", _pairs(F.col("h"), F.col("h"), 1, F.size("h") - 1, lambda a, b: F.xxhash64(a, b)).alias("g"))
    halves = pairs.select("doc_id", "h", "c", "g", _pairs(F.col("g"), F.col("g"), 1, F.size("g") - 1, lambda a, b: F.least(a, b)).alias("m2"))
    rows = halves.select("doc_id", _pairs(F.col("m2"), F.col("m2"), 2, F.size("m2") - 2, lambda a, b: F.least(a, b)).alias("m"),
                         F.when(F.size("h") >= RUN, F.transform(F.sequence(F.lit(0), F.greatest(F.size("h") - RUN, F.lit(0))), lambda i: F.struct(
                             F.xxhash64(F.lit(SEED), F.get(F.col("g"), i), F.get(F.col("g"), i + 2), F.get(F.col("h"), i + RUN - 1)).alias("a"),
                             F.hash(*[F.get(F.col("c"), i + k) for k in range(RUN)]).alias("b")))).alias("w"))
    # a fingerprint guards the windows from one change of the least pair to the next (no rows
    # are filtered here: a filter would move down to the scan with all these expressions)
    first = rows.select("doc_id", "m", "w", F.when(F.size("m") > 0, F.filter(
        F.sequence(F.lit(1), F.greatest(F.size("m"), F.lit(1))),
        lambda i: (i == 1) | (F.element_at("m", i) != F.element_at("m", F.greatest(i - 1, F.lit(1)))))).alias("s"))
    some = first.select("doc_id", F.explode(F.zip_with(
        "s", F.concat(F.slice("s", F.lit(2), F.greatest(F.size("s") - 1, F.lit(0))), F.array(F.size("m") + 1)), lambda a, b: F.struct(
            F.element_at("m", a).alias("print"), (a - 1).alias("start"), _part(F.col("w"), a, b).alias("windows")))).alias("x"))
    return some.select("doc_id", "x.*")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, starts): the sorted first lines of a document's windows that occurred earlier."""
    prints = cut_lineage(fingerprints(docs))
    # a fingerprint counts twice where it guards equal windows (a line repeated on the spot)
    twice = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), 2).otherwise(1)
    again = cut_lineage(prints.groupBy("print").agg(F.sum(twice).alias("n")).where("n > 1").select("print"))
    windows = cut_lineage(prints.join(again, "print").select(
        "doc_id", "print", "start", F.posexplode("windows").alias("k", "w")).select(
        "print", "w", "doc_id", (F.col("start") + F.col("k")).alias("at")))
    # both joins meet written tables: an aggregate right below a join would keep its hot keys whole
    first = cut_lineage(windows.groupBy("print", "w").agg(
        F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("print", "w", "first"))
    later = windows.join(first, ["print", "w"]).where(F.struct("doc_id", "at") != F.col("first"))
    return later.groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias("_starts"))


def runs(starts: Column, run: int = RUN) -> Column:
    """Maximal (start, end) line runs covered by windows of ``run`` lines at sorted starts."""
    empty = F.expr("named_struct('done', cast(array() as array<struct<start:int,end:int>>), 'start', -1, 'end', -1)")

    def step(acc, at):
        closed = F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))
        return F.when(at <= acc["end"], F.struct(acc["done"].alias("done"), acc["start"].alias("start"),
                                                 (at + run).alias("end"))) \
            .otherwise(F.struct(F.when(acc["end"] >= 0, closed).otherwise(acc["done"]).alias("done"), at.alias("start"),
                                (at + run).alias("end")))

    def finish(acc):
        return F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))

    return F.aggregate(starts, empty, step, finish)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``, and one last column: the deleted
    (start, end) line runs, named ``line_runs`` (with an underscore more for each such name that
    ``docs`` has already).  Every row stays."""
    out = "line_runs"
    while out.lower() in {c.lower() for c in docs.columns}:
        out += "_"
    found = repeated_lines(docs)
    # the whole row is one column until the end, so that its names cannot clash with these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(found, F.col("row.doc_id") == F.col("doc_id"), "left").select("row", "_starts")
    lined = joined.select("row", "_starts", F.when(F.col("_starts").isNotNull(), cut(F.col("row.text"))).alias("_lines"))
    ranged = lined.select("row", "_lines", F.when(F.col("_starts").isNotNull(), runs(F.col("_starts"))).alias("_runs"))
    # a line ends in white space, so the words of joined lines are theirs
    counted = ranged.select("row", "_lines", F.filter("_runs", lambda r: F.regexp_count(
        F.array_join(_part(F.col("_lines"), r["start"] + 1, r["end"] + 1), ""), F.lit(r"\S+")) >= min_words).alias("_gone"))
    # the kept parts lie between the deleted runs
    begins = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda r: r["end"]))
    ends = F.concat(F.transform("_gone", lambda r: r["start"]), F.array(F.size("_lines")))
    kept = F.array_join(F.zip_with(begins, ends, lambda a, b: F.array_join(_part(F.col("_lines"), a + 1, b + 1), "")), "")
    text = F.when(F.coalesce(F.size("_gone"), F.lit(0)) > 0, kept).otherwise(F.col("row.text"))
    return counted.select(*[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns],
                          F.coalesce("_gone", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias(out))
