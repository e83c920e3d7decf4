"""Classification queries (W-3, M-3..M-9, A-10..A-12, F-2..F-5, X-3..X-5) and oracles.

Records are lineitem x part lines (see ``inputs.line_records``); train/test come from
the exact stratified split (share 0.8, seed 42) unless a sweep says otherwise.
"""

from __future__ import annotations


from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import encode as E
from quarry.operators import forest as RF
from quarry.operators import forest_exact as FX
from quarry.operators import quality as Q
from quarry.operators import split as S
from quarry.operators import tree as T
from quarry.plans import inputs as IN
from quarry.plans.tree_sql import NODES as TREE_NODES
from quarry.plans.tree_sql import forest_ctes, tree_ctes
from quarry.session import cut_lineage

# The published grids of the sweeps.
SHARE = 0.8
SHARES = (0.6, 0.7, 0.8, 0.9)
CRITERIA = ("information_gain", "gain_ratio", "gini")
FOREST_SIZES = (50, 60, 70, 80, 90, 100)


def _split(spark, folder, share=SHARE):
    return S.stratified_split(IN.line_records(spark, folder), IN.KEY, IN.LABEL, share, IN.SEED)


def _train_test(spark, folder, share=SHARE, keyed=True):
    sp = _split(spark, folder, share)
    sp = cut_lineage(sp if keyed else sp.drop(IN.KEY))  # read for training and again for testing
    return sp.where("is_train").drop("is_train"), sp.where("not is_train").drop("is_train")


def _root(spark, folder):
    train, _ = _train_test(spark, folder)
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    rows = T.prepare(train, enc, IN.LABEL).withColumn("node_id", F.lit(1).cast("long"))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("long").alias("p")).first()
    nodes = spark.createDataFrame([(1, stats["n"], stats["p"])], "node_id long, n long, p long")
    return enc, rows, nodes


def _fitted(spark, folder, keyed=False):
    train, test = _train_test(spark, folder, keyed=keyed)  # a model needs no key, the longest column
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    return T.fit_tree(train, enc, IN.LABEL), test


def _feature_name(enc):
    nums = F.element_at(F.array(*[F.lit(c) for c in enc.numeric]), F.col("idx") + 1)
    cats = F.element_at(F.array(*[F.lit(c) for c in enc.categorical]), F.col("idx") + 1)
    return F.when(F.col("kind") == "num", nums).otherwise(F.concat(cats, F.lit("="), F.col("category")))


def q_stratified_split(spark, folder):
    return _split(spark, folder).select(IN.KEY, F.col(IN.LABEL).cast("int").alias("label"), "is_train")


def q_one_hot(spark, folder):
    train, test = _train_test(spark, folder)
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    return enc.coordinates(test, IN.KEY)


def q_quantile_thresholds(spark, folder):
    enc, rows, _ = _root(spark, folder)
    thr = T.quantile_thresholds(rows, 32)
    names = F.element_at(F.array(*[F.lit(c) for c in enc.numeric]), F.col("fidx") + 1)
    return thr.select(names.alias("feature"), F.round("threshold", 9).alias("threshold"))


def q_split_scores(spark, folder):
    enc, rows, nodes = _root(spark, folder)
    cands = T.numeric_candidates(rows, 32).unionByName(T.category_candidates(rows, nodes, enc))
    score = {c: T.split_score(c, F.col("lc"), F.col("lp"), F.col("n"), F.col("p")) for c in CRITERIA}
    return cands.select(_feature_name(enc).alias("feature"), F.round("threshold", 9).alias("threshold"),
                        F.col("lc").cast("long").alias("left_count"),
                        F.col("lp").cast("long").alias("left_positive"),
                        *[F.round(score[c], 9).alias(c) for c in CRITERIA]).distinct()


def _best_root(criterion):
    def run(spark, folder):
        enc, rows, nodes = _root(spark, folder)
        best = T.best_splits(rows, nodes, enc, criterion, 120, 32)
        return best.select(_feature_name(enc).alias("feature"), F.round("threshold", 9).alias("threshold"),
                           F.round("score", 9).alias("score"))
    return run


def q_classification_quality(spark, folder):
    recs = IN.line_parts(spark, folder, "p_retailprice")
    value = F.col("l_quantity") * F.col("p_retailprice")
    rows = recs.select((value * (F.lit(1.0) - F.col("l_discount")) > 25000).cast("int").alias("actual"),
                       (value > 25000).cast("int").alias("predicted"))
    return Q.quality(rows, "actual", "predicted")


def q_tree_nodes(spark, folder):
    model, _ = _fitted(spark, folder)
    return node_rows(model.node_table(spark))


def node_rows(nodes):
    return nodes.withColumn("parent_id", F.coalesce("parent_id", F.lit(0))) \
        .withColumn("threshold", F.round("threshold", 9)).withColumn("score", F.round("score", 9))


def q_tree_predict(spark, folder):
    model, test = _fitted(spark, folder, keyed=True)
    return model.predict(test, IN.LABEL).select(IN.KEY, IN.LABEL, "node_id", "prediction")


def q_tree_quality(spark, folder):
    model, test = _fitted(spark, folder)
    return Q.quality(model.predict(test, IN.LABEL), IN.LABEL, "prediction")


def _tree_row(spark, model, test, **grid):
    qual = Q.quality(model.predict(test, IN.LABEL), IN.LABEL, "prediction")
    cols = [F.lit(v).alias(k) for k, v in grid.items()]
    return qual.select(*cols, F.lit(len(model.nodes)).cast("long").alias("nodes"), "*")


def q_criterion_sweep(spark, folder):
    train, test = _train_test(spark, folder, keyed=False)
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    out = None
    for c in CRITERIA:
        row = _tree_row(spark, T.fit_tree(train, enc, IN.LABEL, c), test, criterion=c)
        out = row if out is None else out.unionByName(row)
    return out


def q_train_share_sweep(spark, folder):
    flags = {f"is_train_{i}": share for i, share in enumerate(SHARES)}
    splits = cut_lineage(S.stratified_splits(IN.line_records(spark, folder), IN.KEY, IN.LABEL, flags, IN.SEED).drop(IN.KEY))
    out = None
    for flag, share in flags.items():
        train, test = (splits.where(side).drop(*flags) for side in (F.col(flag), ~F.col(flag)))
        enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
        model = T.fit_tree(train, enc, IN.LABEL)
        train_count = model.nodes[0]["count"] if model.nodes else 0
        row = _tree_row(spark, model, test, train_share=share).withColumn(
            "train_count", F.lit(train_count).cast("long")).withColumn("test_count", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
        out = row if out is None else out.unionByName(row)
    return out


def _forest(spark, folder, trees):
    return _small(spark, RF.fit_forest(*_train_test(spark, folder), IN.NUMERIC, IN.CATEGORICAL, IN.LABEL, n_estimators=trees))


def _small(spark, res):
    """Quality (1 row) and top importances (15 rows) as small local frames; the fitted
    model itself is released so repeated sweeps do not pile models up in the driver."""
    quality = spark.createDataFrame(res.quality.collect(), res.quality.schema)
    importances = spark.createDataFrame(res.importances.collect(), res.importances.schema)
    return quality, importances


def q_random_forest_quality(spark, folder):
    return _forest(spark, folder, 100)[0]


def q_feature_importance(spark, folder):
    return _forest(spark, folder, 100)[1]


# A small forest for the queries that SQL follows step by step.
EXACT = {"trees": 6, "max_depth": 4, "min_leaf": 40}


def _exact_forest(spark, folder):
    train, test = _train_test(spark, folder)
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    return FX.grow_forest(train, IN.KEY, enc, IN.LABEL, seed=IN.SEED, **EXACT), test


def q_forest_predict(spark, folder):
    forest, test = _exact_forest(spark, folder)
    return forest.predict(test, IN.KEY).select(IN.KEY, IN.LABEL, F.round("probability", 9).alias("probability"), "prediction")


def q_forest_quality(spark, folder):
    forest, test = _exact_forest(spark, folder)
    return Q.quality(forest.predict(test, IN.KEY), IN.LABEL, "prediction")


def q_forest_importance(spark, folder):
    return ranked_importances(_exact_forest(spark, folder)[0], spark)


def ranked_importances(forest, spark):
    ranked = F.row_number().over(Window.orderBy(F.desc(F.round("importance", 9)), "feature"))  # one row a feature
    return forest.importances(spark).select("feature", F.round("importance", 9).alias("importance"), ranked.alias("rank")).where(
        F.col("rank") <= RF.TOP_FEATURES)


def q_forest_size_sweep(spark, folder):
    """X-5: one tree as the baseline, then a forest of each size; with the train and test
    counts and each forest's most important feature."""
    train, test = _train_test(spark, folder)
    sizes = [F.lit(f.count()).cast("long").alias(name) for name, f in (("train_count", train), ("test_count", test))]
    enc = E.fit_encoder(train, IN.NUMERIC, IN.CATEGORICAL)
    single = T.fit_tree(train, enc, IN.LABEL, "gini")
    out = Q.quality(single.predict(test, IN.LABEL), IN.LABEL, "prediction").select(
        F.lit("single_tree").alias("model"), F.lit(1).alias("n_estimators"), *sizes, "*",
        F.lit(single.nodes[0]["feature"] if single.nodes else None).cast("string").alias("top_feature"))
    forests = RF.fit_forests(train, test, IN.NUMERIC, IN.CATEGORICAL, IN.LABEL, FOREST_SIZES)
    for trees, forest in zip(FOREST_SIZES, forests, strict=True):
        quality, importances = _small(spark, forest)
        top = importances.orderBy("rank").first()
        out = out.unionByName(quality.select(F.lit("forest").alias("model"), F.lit(trees).alias("n_estimators"), *sizes, "*",
                                             F.lit(top["feature"] if top else None).cast("string").alias("top_feature")))
    return out


QUERIES = {
    "stratified_split": q_stratified_split,
    "one_hot": q_one_hot,
    "quantile_thresholds": q_quantile_thresholds,
    "split_scores": q_split_scores,
    "best_split_gini": _best_root("gini"),
    "best_split_info_gain": _best_root("information_gain"),
    "best_split_gain_ratio": _best_root("gain_ratio"),
    "classification_quality": q_classification_quality,
    "tree_nodes": q_tree_nodes,
    "tree_predict": q_tree_predict,
    "tree_quality": q_tree_quality,
    "criterion_sweep": q_criterion_sweep,
    "train_share_sweep": q_train_share_sweep,
    "random_forest_quality": q_random_forest_quality,
    "feature_importance": q_feature_importance,
    "forest_size_sweep": q_forest_size_sweep,
    "forest_predict": q_forest_predict,
    "forest_quality": q_forest_quality,
    "forest_importance": q_forest_importance,
}

# ---------------------------------------------------------------- SQL oracles

_RECORDS = """recs AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
         l_quantity::DOUBLE AS l_quantity, l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax,
         p_size::DOUBLE AS p_size, p_retailprice::DOUBLE AS p_retailprice,
         p_brand, p_type, l_returnflag, l_linestatus,
         (l_quantity * p_retailprice * (1 - l_discount) > 25000)::INT AS label
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_SPLIT = _RECORDS + """,
cls AS (SELECT label, count(*) AS cnt FROM recs GROUP BY label),
tot AS (SELECT sum(cnt) AS n, floor(0.8::DOUBLE * sum(cnt)) AS n_train FROM cls),
q0 AS (SELECT label, cnt / n * n_train AS x, floor(cnt / n * n_train) AS fl FROM cls, tot),
rest AS (SELECT (SELECT n_train FROM tot) - sum(fl) AS r FROM q0),
quota AS (SELECT label, fl + CASE WHEN row_number() OVER (ORDER BY x - fl DESC, label) <= (SELECT r FROM rest)
                                 THEN 1 ELSE 0 END AS quota FROM q0),
split AS (SELECT recs.*, row_number() OVER (PARTITION BY recs.label ORDER BY md5('42:' || row_key)) <= quota.quota
                 AS is_train
          FROM recs JOIN quota ON recs.label = quota.label),
train AS (SELECT * FROM split WHERE is_train),
test AS (SELECT * FROM split WHERE NOT is_train)"""

_NUMERIC_LONG = """nl AS (
  SELECT 'l_quantity' AS feature, 0 AS fidx, l_quantity AS value, label FROM train UNION ALL
  SELECT 'l_discount', 1, l_discount, label FROM train UNION ALL
  SELECT 'l_tax', 2, l_tax, label FROM train UNION ALL
  SELECT 'p_size', 3, p_size, label FROM train UNION ALL
  SELECT 'p_retailprice', 4, p_retailprice, label FROM train)"""

_CATEGORY_LONG = """cl AS (
  SELECT 'p_brand' AS col, 0 AS cidx, p_brand AS category, label, row_key FROM train UNION ALL
  SELECT 'p_type', 1, p_type, label, row_key FROM train UNION ALL
  SELECT 'l_returnflag', 2, l_returnflag, label, row_key FROM train UNION ALL
  SELECT 'l_linestatus', 3, l_linestatus, label, row_key FROM train)"""

# numpy's linear quantile at probability i * (1 / 33): pos = (n - 1) * q, interpolate
# between ranks floor(pos) and floor(pos) + 1 (from b downwards when gamma >= 0.5).
_THRESHOLDS = """ranked AS (SELECT feature, fidx, value, label,
                  row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS rk,
                  count(*) OVER (PARTITION BY feature) AS n FROM nl),
probs AS (SELECT i, i * (1.0::DOUBLE / 33) AS q FROM range(1, 33) t(i)),
targets AS (SELECT DISTINCT feature, fidx, n, i, (n - 1) * q AS pos FROM (SELECT DISTINCT feature, fidx, n FROM ranked), probs),
ends AS (SELECT t.feature, t.fidx, t.i, t.pos,
                (SELECT value FROM ranked r WHERE r.feature = t.feature AND r.rk = floor(t.pos)) AS a,
                (SELECT value FROM ranked r WHERE r.feature = t.feature AND r.rk = least(floor(t.pos) + 1, t.n - 1)) AS b
         FROM targets t),
thr AS (SELECT DISTINCT feature, fidx,
               CASE WHEN pos - floor(pos) >= 0.5 THEN b - (b - a) * (1 - (pos - floor(pos)))
                    ELSE a + (b - a) * (pos - floor(pos)) END AS threshold FROM ends)"""

_ENTROPY = ("(-(CASE WHEN {p} > 0 THEN {p} * log2({p}) ELSE 0 END) "
            "- (CASE WHEN 1 - {p} > 0 THEN (1 - {p}) * log2(1 - {p}) ELSE 0 END))")
_GINI = "(2 * {p} * (1 - {p}))"


def _share(pos, total):
    return f"(CASE WHEN ({total}) > 0 THEN ({pos})::DOUBLE / ({total}) ELSE 0 END)"


def _score_sql(criterion):
    imp = _GINI if criterion == "gini" else _ENTROPY
    parent = imp.format(p=_share("p", "n"))
    left = imp.format(p=_share("lp", "lc"))
    right = imp.format(p=_share("p - lp", "n - lc"))
    score = f"({parent} - (lc * {left} + (n - lc) * {right}) / n)"
    if criterion == "gain_ratio":
        si = _ENTROPY.format(p=_share("lc", "n"))
        score = f"(CASE WHEN {si} > 0 THEN {score} / {si} ELSE 0 END)"
    return score


_CANDIDATES = _SPLIT + ",\n" + _NUMERIC_LONG + ",\n" + _CATEGORY_LONG + ",\n" + _THRESHOLDS + """,
node AS (SELECT count(*) AS n, sum(label) AS p FROM train),
vocab AS (SELECT cidx, category, col, 5 + coalesce((SELECT count(DISTINCT category) FROM cl c2 WHERE c2.cidx < c1.cidx), 0)
                 + (dense_rank() OVER (PARTITION BY cidx ORDER BY category)) - 1 AS feature_idx
          FROM (SELECT DISTINCT cidx, col, category FROM cl) c1),
numc AS (SELECT t.feature, t.fidx AS feature_idx, t.threshold,
                count(*) FILTER (WHERE nl.value <= t.threshold) AS lc,
                coalesce(sum(nl.label) FILTER (WHERE nl.value <= t.threshold), 0) AS lp
         FROM thr t JOIN nl ON nl.fidx = t.fidx GROUP BY t.feature, t.fidx, t.threshold),
catc AS (SELECT v.col || '=' || v.category AS feature, v.feature_idx, 0.5 AS threshold,
                (SELECT n FROM node) - count(*) AS lc, (SELECT p FROM node) - sum(cl.label) AS lp
         FROM cl JOIN vocab v ON cl.cidx = v.cidx AND cl.category = v.category
         GROUP BY v.col, v.category, v.feature_idx HAVING count(*) < (SELECT n FROM node)),
cands AS (SELECT c.*, node.n, node.p FROM (SELECT * FROM numc UNION ALL SELECT * FROM catc) c, node)"""


def _best_sql(criterion):
    return f"""WITH {_CANDIDATES},
scored AS (SELECT feature, feature_idx, threshold, {_score_sql(criterion)} AS score FROM cands
           WHERE lc >= 120 AND n - lc >= 120),
per_feature AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature_idx ORDER BY score DESC, threshold) AS rn
                               FROM scored) WHERE rn = 1)
SELECT feature, round(threshold, 9) AS threshold, round(score, 9) AS score
FROM per_feature WHERE score > 1e-6 ORDER BY round(score, 12) DESC, feature_idx LIMIT 1"""


ORACLE = {
    "stratified_split": f"WITH {_SPLIT} SELECT row_key, label, is_train FROM split",
    "one_hot": f"""WITH {_SPLIT},
{_CATEGORY_LONG},
vocab AS (SELECT cidx, category, col, 5 + coalesce((SELECT count(DISTINCT category) FROM cl c2 WHERE c2.cidx < c1.cidx), 0)
                 + (dense_rank() OVER (PARTITION BY cidx ORDER BY category)) - 1 AS feature_idx
          FROM (SELECT DISTINCT cidx, col, category FROM cl) c1),
tl AS (SELECT row_key, 0 AS cidx, p_brand AS category FROM test UNION ALL
       SELECT row_key, 1, p_type FROM test UNION ALL
       SELECT row_key, 2, l_returnflag FROM test UNION ALL
       SELECT row_key, 3, l_linestatus FROM test)
SELECT row_key, 0::BIGINT AS feature_idx, 'l_quantity' AS feature, l_quantity AS value FROM test UNION ALL
SELECT row_key, 1::BIGINT, 'l_discount', l_discount FROM test UNION ALL
SELECT row_key, 2::BIGINT, 'l_tax', l_tax FROM test UNION ALL
SELECT row_key, 3::BIGINT, 'p_size', p_size FROM test UNION ALL
SELECT row_key, 4::BIGINT, 'p_retailprice', p_retailprice FROM test UNION ALL
SELECT tl.row_key, v.feature_idx::BIGINT, v.col || '=' || v.category, 1.0::DOUBLE
FROM tl JOIN vocab v ON tl.cidx = v.cidx AND tl.category = v.category""",
    "quantile_thresholds": f"""WITH {_SPLIT},
{_NUMERIC_LONG},
{_THRESHOLDS}
SELECT DISTINCT feature, round(threshold, 9) AS threshold FROM thr""",
    "split_scores": f"""WITH {_CANDIDATES}
SELECT feature, round(threshold, 9) AS threshold, lc::BIGINT AS left_count, lp::BIGINT AS left_positive,
       round({_score_sql('information_gain')}, 9) AS information_gain,
       round({_score_sql('gain_ratio')}, 9) AS gain_ratio,
       round({_score_sql('gini')}, 9) AS gini
FROM cands""",
    "best_split_gini": _best_sql("gini"),
    "best_split_info_gain": _best_sql("information_gain"),
    "best_split_gain_ratio": _best_sql("gain_ratio"),
    "classification_quality": """WITH r AS (
  SELECT (l_quantity * p_retailprice * (1 - l_discount) > 25000)::INT AS a,
         (l_quantity * p_retailprice > 25000)::INT AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT count(*) FILTER (WHERE a = 1 AND p = 1) AS tp, count(*) FILTER (WHERE a = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE a = 1 AND p = 0) AS fn, count(*) FILTER (WHERE a = 0 AND p = 0) AS tn FROM r)
SELECT tp, fp, fn, tn,
       CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn)::DOUBLE / (tp + fp + fn + tn) ELSE 0 END AS accuracy,
       CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision,
       CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0 END AS f1
FROM c""",
}


def _tree_oracles() -> dict[str, str]:
    def ctes(criterion="gini", share=SHARE):
        return tree_ctes(_SPLIT.replace("0.8::DOUBLE", f"{share}::DOUBLE"), _score_sql(criterion))

    def scores(name, values, one):
        return " UNION ALL ".join(f"(WITH {one(v)} SELECT {v!r} AS {name}, (SELECT count(*) FROM tree) AS nodes, quality.*{{more}} FROM quality)"
                                  for v in values)
    counts = ", (SELECT n FROM tree WHERE node_id = 1) AS train_count, tp + fp + fn + tn AS test_count"
    return {
        "tree_nodes": f"WITH {ctes()} {TREE_NODES}",
        "tree_predict": f"WITH {ctes()} SELECT row_key, label, node_id, prediction FROM routed",
        "tree_quality": f"WITH {ctes()} SELECT * FROM quality",
        "criterion_sweep": scores("criterion", CRITERIA, lambda c: ctes(c)).replace("{more}", ""),
        "train_share_sweep": scores("train_share", SHARES, lambda v: ctes(share=v)).replace("{more}", counts),
    }


def _forest_oracles() -> dict[str, str]:
    width = "5 + (SELECT count(*) FROM vocab)"
    ctes = forest_ctes(_SPLIT, _score_sql("gini"), EXACT["trees"], EXACT["max_depth"], EXACT["min_leaf"],
                       f"floor(sqrt({width}))", width, IN.SEED, FX.CUMULATIVE)
    return {
        "forest_predict": f"WITH {ctes} SELECT row_key, label, round(probability, 9) AS probability, prediction FROM routed",
        "forest_quality": f"WITH {ctes} SELECT * FROM quality",
        "forest_importance": f"""WITH {ctes} SELECT feature, round(importance, 9) AS importance,
       (row_number() OVER (ORDER BY round(importance, 9) DESC, feature))::INT AS rank FROM importance QUALIFY rank <= {RF.TOP_FEATURES}""",
    }


ORACLE |= _tree_oracles() | _forest_oracles()
