"""Itemset and rule queries (SRC-6, A-1..A-7, M-1, M-2, F-7, X-1, X-2) and their oracles.

Baskets are orders, items a part attribute (``p_brand``: 25 values, or ``p_type``:
6 values whose frequent itemsets reach length 6).  The SQL oracles do not repeat the
Spark algorithm: they count every sub-combination of every basket (brute force) and
filter, so FP-growth, the level-wise engine and the rule builder are each checked
against an independent computation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import itemsets as I
from quarry.params import min_count
from quarry.operators import rules as R
from quarry.plans.inputs import joined, order_baskets
from quarry.session import cut_lineage

# The published grids of the sweeps.
SUPPORT = "1%"
SWEEP = ("1%", "3%", "5%", "10%", "15%")
CONFIDENCE_GRID = ("20%", "25%", "30%", "35%", "40%", "45%", "50%")


def _mined(spark, folder, item, support=SUPPORT, engine="fpgrowth"):
    baskets = cut_lineage(order_baskets(spark, folder, item))  # read for their number, by each pass of the search and for its items
    n = I.basket_count(baskets)
    return baskets, n, I.frequent_itemsets(baskets, support, engine=engine, n=n)


def _itemset_rows(found):
    return found.select(joined("items").alias("items"), F.col("length").cast("long").alias("length"),
                        F.col("count").cast("long").alias("count"), "support")


def q_baskets(spark, folder):
    b = order_baskets(spark, folder, "p_brand")
    return b.select("basket_id", joined("items").alias("items"),
                    F.size("items").cast("long").alias("n_items"))


def q_basket_profile(spark, folder):
    return I.basket_profile(order_baskets(spark, folder, "p_brand")).select(
        F.col("baskets").cast("long").alias("baskets"),
        F.col("unique_items").cast("long").alias("unique_items"),
        "mean_length", F.col("max_length").cast("long").alias("max_length"))


def q_item_support(spark, folder):
    return I.item_support(order_baskets(spark, folder, "p_brand")).select(
        "item", F.col("count").cast("long").alias("count"), "support")


def q_frequent_itemsets(spark, folder):
    return _itemset_rows(_mined(spark, folder, "p_brand")[2])


def q_frequent_itemsets_levelwise(spark, folder):
    return _itemset_rows(_mined(spark, folder, "p_brand", engine="levelwise")[2])


def q_frequent_itemsets_long(spark, folder):
    return _itemset_rows(_mined(spark, folder, "p_type")[2])


def q_itemsets_exhaustive(spark, folder):
    counted = I.exhaustive_itemsets(order_baskets(spark, folder, "p_brand"))
    return counted.select(joined("items").alias("items"), F.size("items").cast("long").alias("length"),
                          F.col("count").cast("long").alias("count"))


def q_itemset_levels(spark, folder):
    baskets, _, found = _mined(spark, folder, "p_type")
    distinct = I.basket_items(baskets).select("item").distinct().count()
    return I.itemset_levels(found, distinct)


def q_itemset_length_hist(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return I.itemset_length_hist(found).select(F.col("length").cast("long").alias("length"),
                                               F.col("itemsets").cast("long").alias("itemsets"))


def q_support_sweep(spark, folder):
    baskets, n, found = _mined(spark, folder, "p_brand", support=SWEEP[0])
    return I.support_sweep(found, n, SWEEP).select(
        "threshold", "minimum_count", F.col("total").cast("long").alias("total"), F.col("length").cast("long").alias("length"),
        F.col("frequent").cast("long").alias("frequent"))


def q_support_levels(spark, folder):
    baskets, n, found = _mined(spark, folder, "p_brand", support=SWEEP[0])
    distinct = I.basket_items(baskets).select("item").distinct().count()
    return I.support_levels(found, distinct, {t: min_count(t, n) for t in SWEEP})


def _rule_rows(rules):
    return rules.select(joined("antecedent").alias("antecedent"), joined("consequent").alias("consequent"),
                        "rule", F.col("total_length").cast("long").alias("total_length"),
                        F.col("count").cast("long").alias("count"), "support", "confidence")


def q_association_rules(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return _rule_rows(R.generate_rules(found, "50%"))


def q_association_rules_25(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return _rule_rows(R.generate_rules(found, "25%"))


def q_association_rules_capped(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return _rule_rows(R.generate_rules(found, "30%", max_total_length=3))


def q_association_rules_brand(spark, folder):
    found = _mined(spark, folder, "p_brand")[2]
    return _rule_rows(R.generate_rules(found, "12%"))


def q_rule_count_by_confidence(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return R.rule_count_by_confidence(found, CONFIDENCE_GRID).select(
        "confidence", F.col("rules").cast("long").alias("rules"))


def q_rule_text(spark, folder):
    found = _mined(spark, folder, "p_type")[2]
    return R.format_rules(R.generate_rules(found, "50%")).select("rule", "line")


def flagship(spark, folder):
    """Itemsets -> rules, the reference's main path (used by ``entry``)."""
    return q_association_rules(spark, folder)


QUERIES = {
    "baskets": q_baskets,
    "basket_profile": q_basket_profile,
    "item_support": q_item_support,
    "frequent_itemsets": q_frequent_itemsets,
    "frequent_itemsets_levelwise": q_frequent_itemsets_levelwise,
    "frequent_itemsets_long": q_frequent_itemsets_long,
    "itemsets_exhaustive": q_itemsets_exhaustive,
    "itemset_levels": q_itemset_levels,
    "itemset_length_hist": q_itemset_length_hist,
    "support_sweep": q_support_sweep,
    "support_levels": q_support_levels,
    "association_rules": q_association_rules,
    "association_rules_25": q_association_rules_25,
    "association_rules_capped": q_association_rules_capped,
    "association_rules_brand": q_association_rules_brand,
    "rule_count_by_confidence": q_rule_count_by_confidence,
    "rule_text": q_rule_text,
}

# ---------------------------------------------------------------- SQL oracles

def _pairs(item):
    return (f"SELECT DISTINCT l.l_orderkey AS basket_id, trim(p.{item}) AS item "
            f"FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey "
            f"WHERE p.{item} IS NOT NULL AND trim(p.{item}) <> ''")


def _frequent_cte(item, share):
    """CTEs b (baskets), n (count), f (frequent sets s, cnt) by brute-force subset counting."""
    return f"""
pairs AS ({_pairs(item)}),
b AS (SELECT basket_id, list_sort(list(item)) AS items FROM pairs GROUP BY basket_id),
n AS (SELECT count(*) AS n FROM b),
masks AS (SELECT items, unnest(range(1, (1 << len(items))::BIGINT)) AS m FROM b),
subs AS (SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS s FROM masks),
allc AS (SELECT s, count(*) AS cnt FROM subs GROUP BY s),
f AS (SELECT s, cnt FROM allc, n WHERE cnt >= ceil(n.n * {share}))"""


def _itemsets_sql(item, share):
    return f"""WITH {_frequent_cte(item, share)}
SELECT array_to_string(s, '|') AS items, len(s)::BIGINT AS length, cnt::BIGINT AS count,
       cnt / n.n AS support
FROM f, n"""


def _levels_sql(item, share):
    return f"""WITH {_frequent_cte(item, share)},
cand AS (
  SELECT len(a.s) + 1 AS k, list_concat(a.s, [b.s[len(b.s)]]) AS c
  FROM f a JOIN f b ON len(a.s) = len(b.s) AND len(a.s) >= 2
   AND list_slice(a.s, 1, len(a.s) - 1) = list_slice(b.s, 1, len(b.s) - 1)
   AND a.s[len(a.s)] < b.s[len(b.s)]),
drops AS (SELECT k, c, unnest(range(1, k + 1)) AS d FROM cand),
checks AS (SELECT k, c, list_filter(c, lambda x, i: i <> d) AS sub FROM drops),
pruned AS (SELECT checks.k, checks.c FROM checks JOIN f ON f.s = checks.sub
           GROUP BY checks.k, checks.c HAVING count(*) = checks.k),
f1 AS (SELECT count(*) AS f1 FROM f WHERE len(s) = 1),
lv AS (SELECT unnest(range(2, (SELECT coalesce(max(len(s)), 0) FROM f) + 2)) AS k)
SELECT 1::BIGINT AS length, (SELECT count(DISTINCT item) FROM pairs)::BIGINT AS candidates,
       (SELECT f1 FROM f1)::BIGINT AS frequent
UNION ALL
SELECT lv.k::BIGINT AS length,
       (CASE WHEN lv.k = 2 THEN (SELECT f1 * (f1 - 1) / 2 FROM f1)
             ELSE (SELECT count(*) FROM pruned WHERE pruned.k = lv.k) END)::BIGINT AS candidates,
       (SELECT count(*) FROM f WHERE len(s) = lv.k)::BIGINT AS frequent
FROM lv"""


def _rules_sql(item, share, confidence, max_len=None):
    cap = f" AND len(s) <= {max_len}" if max_len else ""
    return f"""WITH {_frequent_cte(item, share)},
rm AS (SELECT s, cnt, unnest(range(1, (1 << len(s)) - 1)) AS m FROM f WHERE len(s) >= 2{cap}),
r AS (SELECT s, cnt, list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a FROM rm),
rr AS (SELECT r.s, r.cnt, r.a, list_filter(r.s, lambda x: NOT list_contains(r.a, x)) AS c,
              fa.cnt AS acnt
       FROM r JOIN f fa ON fa.s = r.a
       WHERE r.cnt::DECIMAL(38, 10) >= fa.cnt * {confidence})
SELECT array_to_string(a, '|') AS antecedent, array_to_string(c, '|') AS consequent,
       array_to_string(a, ', ') || ' → ' || array_to_string(c, ', ') AS rule,
       len(s)::BIGINT AS total_length, cnt::BIGINT AS count, cnt / n.n AS support,
       cnt / acnt AS confidence
FROM rr, n"""


_BASKETS = f"SELECT DISTINCT basket_id FROM ({_pairs('p_brand')})"
ORACLE = {
    "baskets": f"""WITH pairs AS ({_pairs('p_brand')})
SELECT basket_id, array_to_string(list_sort(list(item)), '|') AS items, count(*)::BIGINT AS n_items
FROM pairs GROUP BY basket_id""",
    "basket_profile": f"""WITH pairs AS ({_pairs('p_brand')}),
b AS (SELECT basket_id, count(*) AS len FROM pairs GROUP BY basket_id)
SELECT count(*)::BIGINT AS baskets, (SELECT count(DISTINCT item) FROM pairs)::BIGINT AS unique_items,
       avg(len) AS mean_length, max(len)::BIGINT AS max_length FROM b""",
    "item_support": f"""WITH pairs AS ({_pairs('p_brand')}),
n AS (SELECT count(DISTINCT basket_id) AS n FROM pairs)
SELECT item, count(*)::BIGINT AS count, count(*) / any_value(n.n) AS support
FROM pairs, n GROUP BY item""",
    "frequent_itemsets": _itemsets_sql("p_brand", "0.01"),
    "frequent_itemsets_levelwise": _itemsets_sql("p_brand", "0.01"),
    "frequent_itemsets_long": _itemsets_sql("p_type", "0.01"),
    "itemsets_exhaustive": f"""WITH {_frequent_cte('p_brand', '0.01')}
SELECT array_to_string(s, '|') AS items, len(s)::BIGINT AS length, cnt::BIGINT AS count FROM allc""",
    "itemset_levels": _levels_sql("p_type", "0.01"),
    "support_levels": " UNION ALL ".join(
        f"SELECT '{t}' AS threshold, (SELECT ceil(count(*) * {int(t[:-1]) / 100})::BIGINT FROM ({_BASKETS})) AS minimum_count, * "
        f"FROM ({_levels_sql('p_brand', str(int(t[:-1]) / 100))})" for t in SWEEP),
    "itemset_length_hist": f"""WITH {_frequent_cte('p_type', '0.01')}
SELECT len(s)::BIGINT AS length, count(*)::BIGINT AS itemsets FROM f GROUP BY len(s)""",
    "support_sweep": f"""WITH {_frequent_cte('p_brand', '0.01')},
grid(threshold, share) AS (VALUES ('1%', 0.01), ('3%', 0.03), ('5%', 0.05), ('10%', 0.10), ('15%', 0.15)),
g AS (SELECT threshold, ceil(n.n * share)::BIGINT AS minimum_count FROM grid, n)
SELECT threshold, minimum_count, sum(count(f.cnt)) OVER (PARTITION BY threshold)::BIGINT AS total,
       len(s)::BIGINT AS length, count(f.cnt)::BIGINT AS frequent
FROM g LEFT JOIN f ON f.cnt >= g.minimum_count GROUP BY threshold, minimum_count, len(s)""",
    "association_rules": _rules_sql("p_type", "0.01", "0.5"),
    "association_rules_25": _rules_sql("p_type", "0.01", "0.25"),
    "association_rules_capped": _rules_sql("p_type", "0.01", "0.3", max_len=3),
    "association_rules_brand": _rules_sql("p_brand", "0.01", "0.12"),
    "rule_count_by_confidence": f"""WITH {_frequent_cte('p_type', '0.01')},
rm AS (SELECT s, cnt, unnest(range(1, (1 << len(s)) - 1)) AS m FROM f WHERE len(s) >= 2),
r AS (SELECT s, cnt, list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a FROM rm),
rr AS (SELECT r.cnt, fa.cnt AS acnt FROM r JOIN f fa ON fa.s = r.a),
grid(confidence, share) AS (VALUES ('20%', 0.20), ('25%', 0.25), ('30%', 0.30), ('35%', 0.35),
                                   ('40%', 0.40), ('45%', 0.45), ('50%', 0.50))
SELECT confidence, count(rr.cnt)::BIGINT AS rules
FROM grid LEFT JOIN rr ON rr.cnt::DECIMAL(38, 10) >= rr.acnt * grid.share GROUP BY confidence""",
    "rule_text": f"""WITH rules AS ({_rules_sql('p_type', '0.01', '0.5')})
SELECT rule, rule || ' | поддержка: ' || printf('%.4f%%', support * 100)
            || ' | достоверность: ' || printf('%.4f%%', confidence * 100) AS line
FROM rules""",
}
