"""Frequent itemsets over baskets (M-1, A-1..A-6, J-1..J-3, X-1).

Result schema (D3): ``items ARRAY<STRING>`` (sorted by code point), ``length INT``,
``count LONG``, ``support DOUBLE`` (= count / N, N counting every basket handed in,
empty ones too).  The minimum count is the exact ceiling of ``support * N``.

Two engines give the same answer:

* ``fpgrowth`` (default): MLlib's parallel FP-growth.  Its ``minSupport`` is a float,
  so it is passed as ``(m - 0.5) / N``: FP-growth takes ``ceil(minSupport * N)`` = m.
* ``levelwise``: Apriori as DataFrame joins: candidates by prefix join of the
  (k-1)-sets, pruning by a semi join on all (k-1)-subsets, counting by extending each
  basket's occurrences of frequent (k-1)-sets with the basket's larger items.
"""

from __future__ import annotations

from math import comb

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.params import check_order, min_count
from quarry.sources.baskets import basket_items
from quarry.session import cut_lineage


def basket_count(baskets: DataFrame) -> int:
    n = baskets.count()
    if n == 0:
        raise ValueError("there are no baskets to mine")
    return n


def item_support(baskets: DataFrame, n: int | None = None) -> DataFrame:
    """A-1: (item, count, support) for every item that occurs."""
    n = n if n is not None else basket_count(baskets)
    return (basket_items(baskets).groupBy("item").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("support", F.col("count") / F.lit(float(n))))


def basket_profile(baskets: DataFrame) -> DataFrame:
    """A-5: baskets, distinct items, mean and max basket length."""
    stats = baskets.agg(F.count(F.lit(1)).alias("baskets"),
                        F.avg(F.size("items")).alias("mean_length"),
                        F.max(F.size("items")).alias("max_length"))
    items = basket_items(baskets).agg(F.countDistinct("item").alias("unique_items"))
    one = F.lit(0).alias("_one")
    return stats.select("*", one).join(items.select("*", one), "_one").drop("_one")


def _finish(itemsets: DataFrame, n: int) -> DataFrame:
    return itemsets.select(
        F.col("items"), F.size("items").alias("length"), F.col("count").cast("long").alias("count"),
        (F.col("count") / F.lit(float(n))).alias("support"))


def frequent_itemsets(baskets: DataFrame, support, engine: str = "fpgrowth",
                      n: int | None = None) -> DataFrame:
    """M-1: every itemset whose count reaches ``ceil(support * N)``."""
    n = n if n is not None else basket_count(baskets)
    m = min_count(support, n)
    if engine == "fpgrowth":
        model = FPGrowth(itemsCol="items", minSupport=(m - 0.5) / n, minConfidence=1.0).fit(
            baskets.select("items"))
        found = model.freqItemsets.select(F.array_sort("items").alias("items"),
                                          F.col("freq").alias("count"))
        # the model's itemsets are a lazy result: written once, whatever reads them next
        return cut_lineage(_finish(found, n))
    if engine == "levelwise":
        return _finish(_levelwise(baskets, m), n)
    raise ValueError("engine must be 'fpgrowth' or 'levelwise'")


def _drop_one_subsets(frame: DataFrame, items: str = "items") -> DataFrame:
    """Every (k-1)-subset of each k-set, one row per dropped position."""
    return (frame.select("*", F.explode(F.sequence(F.lit(0), F.size(items) - 1)).alias("_drop"))
            .withColumn("_sub", F.filter(items, lambda x, i: i != F.col("_drop"))))


def candidates(level: DataFrame, k: int) -> DataFrame:
    """J-1 + J-2: k-candidates from frequent (k-1)-sets ``level(items)``, k >= 3.

    Pairs of (k-1)-sets with an equal (k-2)-prefix and a smaller last item are
    joined on the prefix (an equi-join; the pair count is the candidate count the
    algorithm reports, i.e. output-sized), then kept when all their (k-1)-subsets
    are frequent.
    """
    if k < 3:
        raise ValueError("level 2 candidates are all pairs of frequent items; count them in closed form")
    keyed = level.select(F.slice("items", 1, k - 2).alias("prefix"),
                         F.element_at("items", -1).alias("last"), "items")
    left, right = keyed.alias("l"), keyed.alias("r")
    joined = left.join(right, (F.col("l.prefix") == F.col("r.prefix")) & (F.col("l.last") < F.col("r.last")))
    cand = joined.select(F.concat(F.col("l.items"), F.array(F.col("r.last"))).alias("items"))
    # Subsets dropping one of the last two items are the joined parents themselves.
    subs = _drop_one_subsets(cand).where(F.col("_drop") < k - 2)
    ok = (subs.join(level.select(F.col("items").alias("_sub")), "_sub", "left_semi")
          .groupBy("items").agg(F.count(F.lit(1)).alias("_hits"))
          .where(F.col("_hits") == k - 2).select("items"))
    return ok


def _levelwise(baskets: DataFrame, m: int) -> DataFrame:
    pairs = basket_items(baskets)
    ones = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= m)
    ones = cut_lineage(ones)
    found = [ones.select(F.array("item").alias("items"), "count")]
    occ = cut_lineage(pairs.join(ones.select("item"), "item", "left_semi")
                      .select("basket_id", F.array("item").alias("items")))
    level = found[0].select("items")
    k = 2
    while not level.isEmpty():
        frequent_items = pairs.join(ones.select("item"), "item", "left_semi")
        ext = (occ.join(frequent_items, "basket_id")
               .where(F.col("item") > F.element_at("items", -1))
               .select("basket_id", F.concat("items", F.array("item")).alias("items")))
        if k >= 3:
            ext = ext.join(candidates(level, k), "items", "left_semi")
        ext = cut_lineage(ext)  # read for the counts and again for the occurrences
        counts = ext.groupBy("items").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= m)
        counts = cut_lineage(counts)
        found.append(counts)
        occ = cut_lineage(ext.join(counts.select("items"), "items", "left_semi"))
        level = counts.select("items")
        k += 1
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def weakest_subsets(itemsets: DataFrame) -> DataFrame:
    """(items, length, least): every set of 3 items or more all of whose subsets by one item are
    among ``itemsets(items, length, count)``, with the least count of those subsets.

    A level-wise search at a minimum count m meets exactly the sets with least >= m as its
    candidates, so one table serves every threshold, and all lengths are joined at once: on
    the length and the common front, then with the counts of the other subsets.
    """
    known = itemsets.where(F.col("length") >= 2)
    keyed = known.select("length", F.expr("slice(items, 1, length - 1)").alias("front"), F.element_at("items", -1).alias("last"), "items", "count")
    left, right = keyed.alias("l"), keyed.alias("r")
    pairs = left.join(right, (F.col("l.length") == F.col("r.length")) & (F.col("l.front") == F.col("r.front")) & (F.col("l.last") < F.col("r.last"))).select(
        F.concat(F.col("l.items"), F.array(F.col("r.last"))).alias("items"), F.least(F.col("l.count"), F.col("r.count")).alias("parents"))
    # a set without one of its last two items is one of the two parents
    subsets = _drop_one_subsets(pairs).where(F.col("_drop") < F.size("items") - 2)
    found = subsets.join(known.select(F.col("items").alias("_sub"), "count"), "_sub")
    return (found.groupBy("items").agg(F.count(F.lit(1)).alias("_hits"), F.least(F.min("count"), F.min("parents")).alias("least"))
            .where(F.col("_hits") == F.size("items") - 2).select("items", F.size("items").alias("length"), "least"))


def support_levels(itemsets: DataFrame, distinct_items: int, minimums: dict) -> DataFrame:
    """A-3 for many thresholds at once: (threshold, minimum_count, length, candidates, frequent)
    per level, as a level-wise search at each minimum count reports.

    ``itemsets`` hold all sets down to the least of ``minimums`` (threshold -> count).  Level 1
    candidates are all distinct items; level 2 candidates are all pairs of frequent items; the
    others come from ``weakest_subsets``.  The level after the last non-empty one is reported
    with 0 frequent sets.
    """
    spark = itemsets.sparkSession
    grid = F.broadcast(spark.createDataFrame([(str(t), int(m)) for t, m in minimums.items()], "threshold string, minimum_count long"))

    def per_level(frame, count, name):  # (length, count) pairs first, then thresholds
        few = frame.groupBy("length", F.col(count).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
        return few.join(grid, F.col("_c") >= F.col("minimum_count")).groupBy("threshold", "length").agg(F.sum("_n").alias(name))

    frequent = {(r["threshold"], r["length"]): r["n"] for r in per_level(itemsets, "count", "n").collect()}  # thresholds x lengths
    candidates = {(r["threshold"], r["length"]): r["n"] for r in per_level(weakest_subsets(itemsets), "least", "n").collect()}
    rows = []
    for t, m in minimums.items():
        t, k = str(t), 1
        while k == 1 or frequent.get((t, k - 1), 0) > 0:
            cands = distinct_items if k == 1 else comb(frequent[t, 1], 2) if k == 2 else candidates.get((t, k), 0)
            rows.append((t, int(m), k, cands, frequent.get((t, k), 0)))
            k += 1
    return spark.createDataFrame(rows, "threshold string, minimum_count long, length long, candidates long, frequent long")


def itemset_levels(itemsets: DataFrame, distinct_items: int) -> DataFrame:
    """A-3: (length, candidates, frequent) per level of the search that found ``itemsets``."""
    return support_levels(itemsets, distinct_items, {"all": 0}).select("length", "candidates", "frequent")


def itemset_length_hist(itemsets: DataFrame) -> DataFrame:
    """A-4: number of frequent itemsets per length."""
    return itemsets.groupBy("length").agg(F.count(F.lit(1)).alias("itemsets"))


def exhaustive_itemsets(baskets: DataFrame, max_length: int | None = None) -> DataFrame:
    """A-6: count every non-empty sub-combination of every basket (verification path).

    Subsets grow one item per level, up to ``max_length`` (default: the longest basket),
    each by the basket's larger items only, so a basket of any width can be read and a
    level never holds more than its own subsets.  Equal baskets are one row with their number,
    and each level is a written table.
    """
    equal = baskets.where(F.size("items") > 0).groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(equal.select(F.array_sort("items").alias("basket"), "n"))
    longest = rows.agg(F.max(F.size("basket"))).first()[0] or 0
    level = rows.select("basket", "n", F.posexplode("basket").alias("last", "item")).select(
        "basket", "n", "last", F.array("item").alias("items"))
    found = None
    for k in range(1, min(longest, max_length or longest) + 1):
        level = cut_lineage(level)
        counts = level.groupBy("items").agg(F.sum("n").alias("count"))
        found = counts if found is None else found.unionByName(counts)
        later = F.expr("transform(sequence(last + 1, size(basket) - 1), i -> struct(i as last, basket[i] as item))")
        level = (level.where(F.col("last") < F.size("basket") - 1).select("basket", "n", "items", F.explode(later).alias("_next"))
                 .select("basket", "n", F.col("_next.last").alias("last"), F.concat("items", F.array("_next.item")).alias("items")))
    return found if found is not None else rows.select(F.col("basket").alias("items"), F.lit(0).cast("long").alias("count"))


def order_itemsets(itemsets: DataFrame, order: str = "support") -> DataFrame:
    """O-1 / O-2: support descending then lex, or lex."""
    check_order(order)
    if order == "support":
        return itemsets.orderBy(F.desc("count"), F.asc("items"))
    return itemsets.orderBy("items")


def support_sweep(itemsets: DataFrame, n: int, thresholds) -> DataFrame:
    """X-1: mine once at the lowest threshold, then filter per threshold.

    Returns (threshold, minimum_count, total, length, frequent): one row per non-empty
    length, and for a threshold that finds nothing one row with total 0 and no length.
    """
    spark = itemsets.sparkSession
    grid = spark.createDataFrame([(str(t), min_count(t, n)) for t in thresholds],
                                 "threshold string, minimum_count long")
    kept = itemsets.join(F.broadcast(grid), itemsets["count"] >= grid["minimum_count"])
    by_length = kept.groupBy("threshold", "length").agg(F.count(F.lit(1)).alias("frequent"))
    totals = by_length.groupBy("threshold").agg(F.sum("frequent").alias("total"))
    return (grid.join(totals, "threshold", "left").join(by_length, "threshold", "left")
            .select("threshold", "minimum_count", F.coalesce("total", F.lit(0)).alias("total"), "length",
                    F.coalesce("frequent", F.lit(0)).alias("frequent")))


def same_rows(first: DataFrame, second: DataFrame) -> bool:
    """SO-3: two result sets are equal as multisets (``exceptAll`` both ways)."""
    return first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def contains(itemset, items):
    """SO-4: ``itemset`` is a subset of ``items`` (array columns)."""
    return F.size(F.array_except(itemset, items)) == 0
