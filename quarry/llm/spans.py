"""Positions of pattern matches as column expressions (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCHES = "array<struct<start:bigint,end:bigint,text:string,before:string,after:string>>"
CONTEXT = 24  # characters before a match that are kept with it


def matches(text: Column, pattern: str, when: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: code-point start, end (exclusive),
    matched text, and what stands before (up to ``CONTEXT`` characters) and after it (2), in
    order.

    The texts of the matches and the texts between them come from the same left-to-right
    search, so their lengths give the positions.  They are added up block by block, about
    sqrt(n) blocks of sqrt(n) matches: appending copies an array, so one growing array of n
    matches would cost n^2.  ``when``: a cheap test without which no match is possible.

    ``pattern`` must not repeat a group of varying length unless the repeat is possessive:
    the regular expression engine takes a frame of the stack for each round of such a loop.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    follows = F.zip_with(F.slice(gaps, F.lit(2), F.size(found)), F.slice(found, F.lit(2), F.size(found)),
                         lambda gap, hit: F.substring(F.concat(gap, F.coalesce(hit, F.lit(""))), 1, 2))
    pairs = F.arrays_zip(found.alias("hit"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), follows.alias("after"))
    none = F.expr(f"cast(array() as {MATCHES})")

    def one_block(p, size, number, at):
        def step(acc, pair):
            begin = acc["at"] + F.length(pair["gap"])
            end = begin + F.length(pair["hit"])
            before = F.right(F.concat(acc["tail"], F.right(pair["gap"], F.lit(CONTEXT))), F.lit(CONTEXT))
            one = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("text"), before.alias("before"), pair["after"].alias("after"))
            tail = F.right(F.concat(before, F.right(pair["hit"], F.lit(CONTEXT))), F.lit(CONTEXT))
            return F.struct(end.alias("at"), tail.alias("tail"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(F.slice(p, number * size + 1, size), F.struct(at["at"].alias("at"), at["tail"].alias("tail"), none.alias("out")), step)

    def placed(p):  # p is bound once: the search is not run again for each block
        size = F.greatest(F.ceil(F.sqrt(F.size(p))), F.lit(1)).cast("int")
        blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(p) / size) - 1, F.lit(0)).cast("int"))
        start = F.expr(f"cast(array() as array<struct<at:bigint,tail:string,out:{MATCHES}>>)")
        first = F.expr("named_struct('at', 0L, 'tail', '')")

        def after(acc):
            last = F.try_element_at(acc, F.lit(-1))
            return F.coalesce(F.when(last.isNotNull(), F.struct(last["at"].alias("at"), last["tail"].alias("tail"))), first)

        done = F.aggregate(blocks, start, lambda acc, b: F.concat(acc, F.array(one_block(p, size, b, after(acc)))))
        return F.flatten(F.transform(done, lambda d: d["out"]))

    some = F.regexp_like(text, F.lit(pattern))
    if when is not None:
        some = when & some
    return F.when(some, F.element_at(F.transform(F.array(pairs), placed), 1)).otherwise(none)


def tagged(found: Column, kind: str, rank: int) -> Column:
    """(start, rank, end, kind) of each match; sorts by start, then kind as ranked."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
                                                 F.lit(kind).alias("kind")))


def listing(spans: Column) -> Column:
    """kind:start:end of tagged spans by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                               s["end"].cast("string"))), ",")
