"""Clustering queries (M-10..M-20, A-13..A-22, X-6..X-8) and their oracles.

Partitioning and hierarchical clustering run on standardised customer points
(7 attributes from customer x orders); the measures with an SQL oracle are also run
on the embeddings grouped by their given label, where DuckDB can check them by brute
force.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import euclidean
from quarry.operators import evaluate as EV
from quarry.operators import linkage as LK
from quarry.operators import partition as PT
from quarry.operators import scale as SC
from quarry.session import cut_lineage
from quarry.sources.points import CUSTOMER_FEATURES, customer_points, embedding_points
from quarry.sources.tables import table

DIMS = len(CUSTOMER_FEATURES)
SEED = 42
K = 5
# The published grid of the sweeps.
NOISE = (0.0, 0.01, 0.03, 0.05, 0.10)
KS = tuple(range(3, 10))


def _long(frame, value="value"):
    names = F.array(*[F.lit(c) for c in CUSTOMER_FEATURES])
    return frame.select("*", F.posexplode("features").alias("_j", value)).withColumn(
        "feature", F.element_at(names, F.col("_j") + 1)).drop("_j", "features")


def _scaled(spark, folder, noise=0.0):
    raw = customer_points(spark, folder).select("id", "features")
    stats = SC.column_stats(raw, DIMS)
    pts = SC.add_noise(raw, noise, DIMS, SEED) if noise else raw.withColumn("changed", F.lit(False))
    return SC.standardize(pts, stats)


def q_standardize(spark, folder):
    z = _scaled(spark, folder).drop("changed")
    return _long(z, "z").select("id", "feature", F.round("z", 9).alias("z"))


def q_add_noise(spark, folder):
    raw = customer_points(spark, folder).select("id", "features")
    noisy = SC.add_noise(raw, 0.10, DIMS, SEED)
    return _long(noisy).select("id", "changed", "feature", F.round("value", 9).alias("value"))


def q_pca2(spark, folder):
    pts = _scaled(spark, folder)
    return SC.project_pca2(pts, SC.fit_pca2(pts)).select("id", F.round("pc1", 7).alias("pc1"), F.round("pc2", 7).alias("pc2"))


def _points(spark, folder):
    """The standardised points as a written table, for fits that read them again and again."""
    return cut_lineage(_scaled(spark, folder).select("id", "features"))


def q_kmeans(spark, folder):
    return PT.kmeans(_scaled(spark, folder), K, SEED)[0]


def q_kmedoids(spark, folder):
    return PT.kmedoids(_points(spark, folder), K, SEED)[0].select("id", "cluster")


def _embedded(spark, folder):
    return embedding_points(spark, folder).withColumnRenamed("label", "cluster")


def q_medoid_update(spark, folder):
    med = EV.medoids(_embedded(spark, folder))
    return med.select("cluster", "id", F.round("dist_sum", 9).alias("dist_sum"))


def q_cluster_error(spark, folder):
    pts = _embedded(spark, folder)
    med = EV.medoids(pts).join(pts.select("id", F.col("features").alias("rep")), "id").select("cluster", "rep")
    err = EV.representative_error(pts, med)
    return err.select(F.round("error", 9).alias("error"), F.round("objective", 6).alias("objective"))


def q_mean_centroid_error(spark, folder):
    return EV.mean_centroid_error(_embedded(spark, folder)).select(F.round("error", 9).alias("error"))


def q_silhouette(spark, folder):
    return EV.silhouette(_embedded(spark, folder)).select(F.round("silhouette", 9).alias("silhouette"))


def q_adjusted_rand(spark, folder):
    cust = table(spark, folder, "customer")
    first = cust.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("cluster"))
    second = cust.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("cluster"))
    return EV.adjusted_rand(first, second).select(F.round("ari", 9).alias("ari"))


def q_group_spread(spark, folder):
    ev = table(spark, folder, "events")
    out = EV.group_spread(ev, "event_type", "value")
    return out.select("event_type", "n", F.round("median", 9).alias("median"), "minimum", "maximum")


def _tree(spark, folder, method):
    return LK.fit_hierarchy(_points(spark, folder), method)


def _rounded(merges):
    return merges.select("step", "left", "right", F.round("height", 9).alias("height"), "size")


def _linkage(method):
    def run(spark, folder):
        return _rounded(_tree(spark, folder, method))
    return run


def q_cut_tree(spark, folder):
    pts = _scaled(spark, folder)
    return LK.cut_tree(pts.select("id"), _tree(spark, folder, "ward"), K)


def q_cluster_sizes(spark, folder):
    return EV.cluster_sizes(q_cut_tree(spark, folder))


def q_last_merges(spark, folder):
    return _rounded(LK.last_merges(_tree(spark, folder, "ward"), 35))


def q_baseline_errors(spark, folder):
    pts = _points(spark, folder)
    rows = None
    for name, assign in (("kmeans", PT.kmeans(pts, K, SEED)[0]), ("kmedoids", PT.kmedoids(pts, K, SEED)[0])):
        err = EV.mean_centroid_error(pts.join(assign.select("id", "cluster"), "id"))
        row = err.select(F.lit(name).alias("algorithm"), F.lit(K).alias("k"), F.round("error", 9).alias("error"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _keyed_errors(labelled):
    """Mean distance to the cluster centroid per ``key``, for many partitions at once."""
    long = labelled.select("key", "cluster", F.posexplode("features").alias("j", "x"))
    means = long.groupBy("key", "cluster", "j").agg(F.avg("x").alias("m")).groupBy("key", "cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", "m"))), lambda s: s["m"]).alias("rep"))
    return labelled.join(means, ["key", "cluster"]).groupBy("key").agg(
        F.avg(euclidean(F.col("features"), F.col("rep"))).alias("error"))


def q_linkage_sweep(spark, folder):
    """X-7: every linkage cut at every k; all cuts are measured in one aggregate."""
    pts = _points(spark, folder)
    n = pts.count()
    base = {"kmeans": PT.kmeans(pts, K, SEED)[0], "kmedoids": PT.kmedoids(pts, K, SEED)[0].select("id", "cluster")}
    base = {name: cut_lineage(frame) for name, frame in base.items()}
    stacked, at_k = None, {}
    for method in LK.METHODS:
        cuts = LK.cut_many(pts.select("id"), LK.fit_hierarchy(pts, method), KS, n)
        for k in KS:
            part = cuts[k].select(F.lit(method).alias("method"), F.lit(k).alias("k"), "id", "cluster")
            stacked = part if stacked is None else stacked.unionByName(part)
    stacked = cut_lineage(stacked)
    keyed = stacked.withColumn("key", F.concat_ws(":", "method", "k")).join(pts, "id")
    errors = {r["key"]: r["error"] for r in _keyed_errors(keyed).collect()}  # one row per cell
    at_k = stacked.where(F.col("k") == K)
    others = reduce(DataFrame.unionByName, [f.select(F.lit(name).alias("base"), "id", F.col("cluster").alias("c2")) for name, f in base.items()])
    both = at_k.join(others, "id").select("method", "base", F.col("cluster").alias("c1"), "c2")
    aris = {(r["method"], r["base"]): r["ari"] for r in EV.adjusted_rand_by(both, ["method", "base"]).collect()}
    rows = []
    for method in LK.METHODS:
        sil = EV.silhouette(at_k.where(F.col("method") == method).select("id", "cluster").join(pts, "id")).first()["silhouette"]
        at = (sil, aris[method, "kmeans"], aris[method, "kmedoids"])
        rows += [(method, k, errors[f"{method}:{k}"], *(at if k == K else (None, None, None))) for k in KS]
    out = spark.createDataFrame(rows, "method string, k int, mean_centroid_error double, silhouette_k5 double, "
                                      "ari_vs_kmeans_k5 double, ari_vs_kmedoids_k5 double")
    return out.select("method", "k", *[F.round(c, 9).alias(c) for c in out.columns[2:]])


def q_clustering_sweep(spark, folder):
    """X-6: k-means and k-medoids on every (noise, k) cell.  All runs of all cells advance
    together: one aggregate an iteration for k-means, one set of jobs a round for k-medoids."""
    raw = cut_lineage(customer_points(spark, folder).select("id", "features"))
    stats = cut_lineage(SC.column_stats(raw, DIMS))
    noisy = []
    for cell, level in enumerate(NOISE):
        pts = SC.add_noise(raw, level, DIMS, SEED) if level else raw.withColumn("changed", F.lit(False))
        noisy.append(SC.standardize(pts, stats).select(F.lit(cell).alias("noise"), "id", "features", "changed"))
    noisy = cut_lineage(reduce(DataFrame.unionByName, noisy))
    changed = {r["noise"]: r["n"] for r in noisy.groupBy("noise").agg(F.count_if("changed").alias("n")).collect()}
    fits = PT.kmeans_runs(noisy.select(F.col("noise").alias("cell"), "id", "features"), {c: KS for c in range(len(NOISE))}, SEED)
    rows = [("kmeans", NOISE[c], k, changed[c], error, cost) for (c, k), (_, cost, error, _) in fits.items()]
    grid = {c * 100 + k: (c, k) for c in range(len(NOISE)) for k in KS}  # a cell of the k-medoids runs
    _, _, costs = PT.kmedoids_runs(noisy.select(F.col("noise").alias("cell"), "id", "features"), {g: k for g, (_, k) in grid.items()},
                                   4, SEED, source={g: c for g, (c, _) in grid.items()})
    for r in costs.collect():
        c, k = grid[r["cell"]]
        rows.append(("kmedoids", NOISE[c], k, changed[c], r["error"], r["objective"]))
    return spark.createDataFrame(rows, "algorithm string, noise_fraction double, k int, changed_objects long, "
                                       "mean_euclidean_error double, algorithm_objective double").select(
        "algorithm", "noise_fraction", "k", "changed_objects", F.round("mean_euclidean_error", 9).alias("mean_euclidean_error"),
        F.round("algorithm_objective", 6).alias("algorithm_objective"))


QUERIES = {
    "standardize": q_standardize,
    "add_noise": q_add_noise,
    "pca2": q_pca2,
    "kmeans": q_kmeans,
    "kmedoids": q_kmedoids,
    "medoid_update": q_medoid_update,
    "cluster_error": q_cluster_error,
    "mean_centroid_error": q_mean_centroid_error,
    "silhouette": q_silhouette,
    "adjusted_rand": q_adjusted_rand,
    "group_spread": q_group_spread,
    "linkage_single": _linkage("single"),
    "linkage_complete": _linkage("complete"),
    "linkage_average": _linkage("average"),
    "linkage_ward": _linkage("ward"),
    "cut_tree": q_cut_tree,
    "cluster_sizes": q_cluster_sizes,
    "last_merges": q_last_merges,
    "baseline_errors": q_baseline_errors,
    "linkage_sweep": q_linkage_sweep,
    "clustering_sweep": q_clustering_sweep,
}

# ---------------------------------------------------------------- SQL oracles

_POINTS = """per AS (SELECT o_custkey, count(*)::DOUBLE AS orders, sum(o_totalprice) AS total,
                   avg(o_totalprice) AS average, max(o_totalprice) AS largest, min(o_totalprice) AS smallest,
                   count(DISTINCT o_orderpriority)::DOUBLE AS priorities
            FROM orders GROUP BY o_custkey),
pts AS (SELECT c_custkey AS id, c_acctbal::DOUBLE AS acctbal, coalesce(orders, 0) AS orders, coalesce(total, 0) AS total,
               coalesce(average, 0) AS average, coalesce(largest, 0) AS largest, coalesce(smallest, 0) AS smallest,
               coalesce(priorities, 0) AS priorities
        FROM customer LEFT JOIN per ON c_custkey = o_custkey),
lng AS (SELECT id, 0 AS j, 'acctbal' AS feature, acctbal AS x FROM pts UNION ALL
        SELECT id, 1, 'orders', orders FROM pts UNION ALL
        SELECT id, 2, 'total', total FROM pts UNION ALL
        SELECT id, 3, 'average', average FROM pts UNION ALL
        SELECT id, 4, 'largest', largest FROM pts UNION ALL
        SELECT id, 5, 'smallest', smallest FROM pts UNION ALL
        SELECT id, 6, 'priorities', priorities FROM pts),
st AS (SELECT j, avg(x) AS m, stddev_pop(x) AS s FROM lng GROUP BY j)"""


def _u(tag_sql):
    """uniform(42, id, tag) as in quarry.functions.draws."""
    return (f"((('0x' || substr(md5('42:' || id || ':' || {tag_sql}), 1, 13))::BIGINT)::DOUBLE + 0.5) "
            f"/ 4503599627370496.0")


_EMB = """e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f, label FROM embeddings),
pairs AS (SELECT a.id, a.label, b.id AS oid, b.label AS olabel, list_distance(a.f, b.f) AS d
          FROM e a, e b)"""

_MEDOIDS = _EMB + """,
own AS (SELECT id, label, sum(d) AS ds FROM pairs WHERE olabel = label GROUP BY id, label),
med AS (SELECT label, arg_min(id, (ds, id)) AS id, min(ds) AS ds FROM own GROUP BY label)"""

# Points as lists of z-scores, by id.
_Z = _POINTS + """,
z AS (SELECT id, list((x - m) / CASE WHEN s = 0 THEN 1 ELSE s END ORDER BY j) AS f FROM lng JOIN st USING (j) GROUP BY id)"""


def _pair_merges(reduce_sql, dist, m):
    """Agglomeration over the table of all cluster pairs (d, number of point pairs n): in each
    round all mutually nearest clusters merge; ``near`` has every round's neighbours."""
    near = f"SELECT round, a, arg_min(b, ({dist}, b)) AS b, min({dist}) AS h, any_value(na) AS na FROM {{}} GROUP BY round, a"
    cur = f"cur_{m}"
    return f"""{cur} AS (SELECT 0 AS round, x.id AS a, y.id AS b, list_distance(x.f, y.f) AS d, 1::BIGINT AS n, 1::BIGINT AS na FROM z x JOIN z y ON x.id <> y.id
  UNION ALL
  SELECT * FROM (WITH near AS ({near.format(cur)}),
    pair AS (SELECT x.a AS l, y.a AS r, x.na + y.na AS size FROM near x JOIN near y ON y.a = x.b AND x.a = y.b WHERE x.a < y.a),
    moved AS (SELECT l AS c, l AS t, size FROM pair UNION ALL SELECT r, l, size FROM pair)
    SELECT round + 1, coalesce(p.t, a) AS a, coalesce(q.t, b) AS b, {reduce_sql} AS d, sum(n)::BIGINT AS n, any_value(coalesce(p.size, na)) AS na
    FROM {cur} LEFT JOIN moved p ON p.c = a LEFT JOIN moved q ON q.c = b
    WHERE coalesce(p.t, a) <> coalesce(q.t, b) GROUP BY round, coalesce(p.t, a), coalesce(q.t, b))),
near_{m} AS ({near.format(cur)}),
merges_{m} AS (SELECT x.round, x.a AS l, y.a AS r, x.h, x.na + y.na AS size FROM near_{m} x JOIN near_{m} y ON x.round = y.round AND y.a = x.b AND x.a = y.b WHERE x.a < y.a)"""


# Ward's clusters by centroid and size; neighbours are measured anew in each round.
_WARD_NEAR = """SELECT x.round, x.a, arg_min(y.a, (sqrt(2.0 * x.n * y.n / (x.n + y.n)) * list_distance(x.f, y.f), y.a)) AS b,
       min(sqrt(2.0 * x.n * y.n / (x.n + y.n)) * list_distance(x.f, y.f)) AS h, any_value(x.n) AS n, any_value(x.f) AS f
FROM {0} x JOIN {0} y ON x.round = y.round AND x.a <> y.a GROUP BY x.round, x.a"""
_WARD = f"""cur_ward AS (SELECT 0 AS round, id AS a, f, 1::BIGINT AS n FROM z
  UNION ALL
  SELECT * FROM (WITH near AS ({_WARD_NEAR.format('cur_ward')})
    SELECT x.round + 1, x.a, CASE WHEN y.b = x.a THEN list_transform(list_zip(x.f, y.f), lambda p: (p[1] * x.n + p[2] * y.n) / (x.n + y.n)) ELSE x.f END,
           CASE WHEN y.b = x.a THEN x.n + y.n ELSE x.n END
    FROM near x JOIN near y ON y.a = x.b WHERE NOT (y.b = x.a AND x.a > y.a))),
near_ward AS ({_WARD_NEAR.format('cur_ward')}),
merges_ward AS (SELECT x.round, x.a AS l, y.a AS r, x.h, x.n + y.n AS size FROM near_ward x JOIN near_ward y ON x.round = y.round AND y.a = x.b AND x.a = y.b WHERE x.a < y.a)"""
_STEPS = """SELECT row_number() OVER (ORDER BY h, round, l) AS step, l AS "left", r AS "right", round(h, 9) AS height, size FROM merges_{}"""
_MERGES = {"single": _pair_merges("min(d)", "d", "single"), "complete": _pair_merges("max(d)", "d", "complete"),
           "average": _pair_merges("sum(d)", "d / n", "average"), "ward": _WARD}


def _cut(k):
    """Clusters of Ward's tree after all but the last k - 1 merges, numbered by smallest id."""
    return f"""{_Z},
{_WARD},
steps AS ({_STEPS.format('ward')}),
up AS (SELECT id, id AS top FROM z UNION ALL SELECT up.id, steps."left" FROM up JOIN steps ON steps."right" = up.top
       WHERE steps.step <= (SELECT count(*) FROM z) - {k}),
cut AS (SELECT id, dense_rank() OVER (ORDER BY min(top)) AS cluster FROM up GROUP BY id)"""


# Lloyd's iterations, as many as any run needs; a run at its fixed point stays there.
_MEAN = "[" + ", ".join(f"avg(f[{j + 1}])" for j in range(DIMS)) + "]"
_KMEANS = f"""cen AS (SELECT 0 AS i, start, row_number() OVER (PARTITION BY start ORDER BY md5('{SEED}:' || start || ':' || id)) AS q, f
        FROM z, range(10) t(start) QUALIFY row_number() OVER (PARTITION BY start ORDER BY md5('{SEED}:' || start || ':' || id)) <= {K}
  UNION ALL
  SELECT i + 1, start, q, {_MEAN} FROM (
    SELECT i, start, id, any_value(z.f) AS f, arg_min(q, (list_distance(z.f, cen.f), q)) AS q FROM cen, z WHERE i < 120 GROUP BY i, start, id)
  GROUP BY i, start, q),
near_mean AS (SELECT start, id, arg_min(q, (list_distance(z.f, cen.f), q)) AS q, min(list_distance(z.f, cen.f)) AS d
           FROM cen, z WHERE i = 120 GROUP BY start, id),
best_mean AS (SELECT arg_min(start, (round(c, 9), start)) AS start FROM (SELECT start, sum(d * d) AS c FROM near_mean GROUP BY start)),
kmeans AS (SELECT id, dense_rank() OVER (ORDER BY first) AS cluster
           FROM (SELECT id, min(id) OVER (PARTITION BY q) AS first FROM near_mean JOIN best_mean USING (start)))"""

# k-medoids: nearest medoid, then each cluster's member with the least distance sum.
_KMEDOIDS = f"""far AS MATERIALIZED (SELECT x.id, y.id AS o, list_distance(x.f, y.f) AS d FROM z x, z y),
med AS (SELECT 0 AS i, run, row_number() OVER (PARTITION BY run ORDER BY md5('{SEED}:' || run || ':' || id)) AS q, id
        FROM z, range(4) t(run) QUALIFY row_number() OVER (PARTITION BY run ORDER BY md5('{SEED}:' || run || ':' || id)) <= {K}
  UNION ALL
  SELECT * FROM (WITH own AS (SELECT i, run, far.id, arg_min(q, (d, q)) AS q FROM med JOIN far ON far.o = med.id WHERE i < 40 GROUP BY i, run, far.id),
    total AS (SELECT x.i, x.run, x.q, x.id, sum(d) AS s FROM own x JOIN own y ON x.run = y.run AND x.q = y.q JOIN far ON far.id = x.id AND far.o = y.id
              GROUP BY x.i, x.run, x.q, x.id)
    SELECT i + 1, run, q, arg_min(id, (s, id)) FROM total GROUP BY i, run, q)),
placed AS (SELECT run, far.id, arg_min(q, (d, q)) AS q, min(d) AS d FROM med JOIN far ON far.o = med.id WHERE i = 40 GROUP BY run, far.id),
best AS (SELECT arg_min(run, (c, run)) AS run FROM (SELECT run, sum(d) AS c FROM placed GROUP BY run)),
kmedoids AS (SELECT id, dense_rank() OVER (ORDER BY first) AS cluster
             FROM (SELECT id, min(id) OVER (PARTITION BY q) AS first FROM placed JOIN best USING (run)))"""

# Every cut of every tree, measured against its centroids and the two partitionings.
_STACKED = " UNION ALL ".join(f"SELECT '{m}' AS method, * FROM ({_STEPS.format(m)})" for m in _MERGES)
_CENTROID_ERROR = """mean AS (SELECT {0}, i, avg(f[i]) AS m FROM {1} JOIN z USING (id), range(1, {2}) t(i) GROUP BY {0}, i),
err AS (SELECT {3}, avg(e) AS error FROM (SELECT {0}, id, sqrt(sum((f[i] - m) ** 2)) AS e FROM {1} JOIN z USING (id) JOIN mean USING ({0}) GROUP BY {0}, id) GROUP BY {3})"""
_BASELINE = f"""WITH RECURSIVE {_Z}, {_KMEANS}, {_KMEDOIDS},
base AS (SELECT 'kmeans' AS algorithm, * FROM kmeans UNION ALL SELECT 'kmedoids', * FROM kmedoids),
{_CENTROID_ERROR.format('algorithm, cluster', 'base', DIMS + 1, 'algorithm')}
SELECT algorithm, {K}::INT AS k, round(error, 9) AS error FROM err"""
_LINKAGE_SWEEP = f"""WITH RECURSIVE {_Z}, {", ".join(_MERGES.values())}, {_KMEANS}, {_KMEDOIDS},
steps AS MATERIALIZED ({_STACKED}),
up AS (SELECT method, k, id, id AS top FROM z, (SELECT DISTINCT method FROM steps), range({KS[0]}, {KS[-1] + 1}) t(k)
       UNION ALL SELECT up.method, k, id, steps."left" FROM up JOIN steps ON steps.method = up.method AND steps."right" = up.top
       WHERE steps.step <= (SELECT count(*) FROM z) - k),
cut AS MATERIALIZED (SELECT method, k, id, min(top) AS cluster FROM up GROUP BY method, k, id),
{_CENTROID_ERROR.format('method, k, cluster', 'cut', DIMS + 1, 'method, k')},
five AS (SELECT method, id, cluster FROM cut WHERE k = {K}),
sums AS (SELECT x.method, x.id, x.cluster = y.cluster AS own, y.cluster, sum(far.d) AS s, count(*) AS c
         FROM five x JOIN far ON far.id = x.id JOIN five y ON y.id = far.o AND y.method = x.method GROUP BY x.method, x.id, x.cluster = y.cluster, y.cluster),
ab AS (SELECT method, id, max(c) FILTER (own) - 1 AS mates, max(CASE WHEN c > 1 THEN s / (c - 1) END) FILTER (own) AS a, min(s / c) FILTER (NOT own) AS b
       FROM sums GROUP BY method, id),
sil AS (SELECT method, avg(CASE WHEN mates = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS sil FROM ab GROUP BY method),
base AS (SELECT 'kmeans' AS base, id, cluster AS c2 FROM kmeans UNION ALL SELECT 'kmedoids', id, cluster FROM kmedoids),
cont AS (SELECT method, base, cluster AS c1, c2, count(*)::HUGEINT AS nij FROM five JOIN base USING (id) GROUP BY method, base, cluster, c2),
sq AS (SELECT method, base, sum(nij) AS n, sum(nij * nij) AS sq FROM cont GROUP BY method, base),
ra AS (SELECT method, base, sum(a * a) AS sa FROM (SELECT method, base, sum(nij) AS a FROM cont GROUP BY method, base, c1) GROUP BY method, base),
cb AS (SELECT method, base, sum(b * b) AS sb FROM (SELECT method, base, sum(nij) AS b FROM cont GROUP BY method, base, c2) GROUP BY method, base),
pc AS (SELECT method, base, sq - n AS tp, sb - sq AS fp, sa - sq AS fn, n * n - (sb - sq) - (sa - sq) - sq AS tn FROM sq JOIN ra USING (method, base) JOIN cb USING (method, base)),
ari AS (SELECT method, base, CASE WHEN fn = 0 AND fp = 0 THEN 1.0 ELSE 2.0 * (tp * tn - fn * fp)::DOUBLE / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))::DOUBLE END AS ari FROM pc)
SELECT method, k::INT AS k, round(error, 9) AS mean_centroid_error, CASE WHEN k = {K} THEN round(sil, 9) END AS silhouette_k5,
       CASE WHEN k = {K} THEN round(x.ari, 9) END AS ari_vs_kmeans_k5, CASE WHEN k = {K} THEN round(y.ari, 9) END AS ari_vs_kmedoids_k5
FROM err JOIN sil USING (method) JOIN ari x USING (method) JOIN ari y USING (method) WHERE x.base = 'kmeans' AND y.base = 'kmedoids'"""


# Principal components by power iteration on the covariance, the second one on what the first leaves.
_ROW = "list_transform({0}, lambda r: list_inner_product(r, v))"
_STEP = "SELECT i + 1, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w))) FROM (SELECT i, " + _ROW + " AS w FROM {1}, {2}) WHERE i < 3000"
_SIGNED = "list_transform(v, lambda x: x * CASE WHEN list_max(v) < -list_min(v) THEN -1 ELSE 1 END)"
_PCA = f"""WITH RECURSIVE {_Z},
c AS (SELECT a AS i, b AS j, covar_samp(f[a], f[b]) AS c FROM z, range(1, {DIMS + 1}) s(a), range(1, {DIMS + 1}) t(b) GROUP BY a, b),
m1 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM c GROUP BY i)),
p1 AS (SELECT 0 AS i, list_transform(range({DIMS}), lambda x: 1.0::DOUBLE + x / 10) AS v UNION ALL {_STEP.format('m', 'p1', 'm1')}),
v1 AS MATERIALIZED (SELECT v, list_inner_product(v, {_ROW.format('m')}) AS l FROM p1, m1 WHERE i = 3000),
m2 AS MATERIALIZED (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * v[i] * v[j])) AS m FROM m1, v1),
p2 AS (SELECT 0 AS i, list_transform(range({DIMS}), lambda x: 1.0::DOUBLE - x / 3) AS v UNION ALL {_STEP.format('m', 'p2', 'm2')}),
load AS (SELECT (SELECT {_SIGNED} FROM v1) AS a, (SELECT {_SIGNED} FROM p2 WHERE i = 3000) AS b)
SELECT id, round(list_inner_product(f, a), 7) AS pc1, round(list_inner_product(f, b), 7) AS pc2 FROM z, load"""


ORACLE = {
    "pca2": _PCA,
    "baseline_errors": _BASELINE,
    "linkage_sweep": _LINKAGE_SWEEP,
    **{f"linkage_{m}": f"WITH RECURSIVE {_Z}, {sql} {_STEPS.format(m)}" for m, sql in _MERGES.items()},
    "last_merges": f"WITH RECURSIVE {_Z}, {_WARD} {_STEPS.format('ward')} QUALIFY row_number() OVER (ORDER BY h DESC, round DESC, l DESC) <= 35",
    "cut_tree": f"WITH RECURSIVE {_cut(K)} SELECT id, cluster FROM cut",
    "cluster_sizes": f"WITH RECURSIVE {_cut(K)} SELECT cluster, count(*) AS size FROM cut GROUP BY cluster",
    "kmeans": f"WITH RECURSIVE {_Z}, {_KMEANS} SELECT id, cluster FROM kmeans",
    "kmedoids": f"WITH RECURSIVE {_Z}, {_KMEDOIDS} SELECT id, cluster FROM kmedoids",
    "standardize": f"""WITH {_POINTS}
SELECT id, feature, round((x - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 9) AS z FROM lng JOIN st USING (j)""",
    "add_noise": f"""WITH {_POINTS},
n AS (SELECT count(*) AS n FROM pts),
pick AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id)) <= (SELECT round_even(n * 0.1, 0) FROM n) AS changed
         FROM pts),
m AS (SELECT id, 1 + floor({_u("'cols'")} * 7) AS m FROM pts),
rk AS (SELECT id, j, row_number() OVER (PARTITION BY id ORDER BY md5('42:' || id || ':col:' || j)) - 1 AS r FROM lng),
z AS (SELECT id, j, sqrt(-2.0 * ln({_u("'g1:z:' || j")})) * cos(2.0 * pi() * {_u("'g2:z:' || j")}) AS g FROM lng)
SELECT lng.id, pick.changed, lng.feature,
       round(CASE WHEN pick.changed AND rk.r < m.m THEN lng.x + 0.5 * st.s * z.g ELSE lng.x END, 9) AS value
FROM lng JOIN pick USING (id) JOIN m USING (id) JOIN rk USING (id, j) JOIN z USING (id, j) JOIN st USING (j)""",
    "medoid_update": f"""WITH {_MEDOIDS}
SELECT label::BIGINT AS cluster, id, round(ds, 9) AS dist_sum FROM med""",
    "cluster_error": f"""WITH {_MEDOIDS},
r AS (SELECT e.id, list_distance(e.f, m.f) AS d FROM e JOIN med USING (label) JOIN e m ON m.id = med.id)
SELECT round(avg(d), 9) AS error, round(sum(d), 6) AS objective FROM r""",
    "mean_centroid_error": """WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f, label FROM embeddings),
dims AS (SELECT id, label, i, f[i] AS x FROM (SELECT id, label, f, unnest(range(1, len(f) + 1)) AS i FROM e)),
cent AS (SELECT label, i, avg(x) AS m FROM dims GROUP BY label, i),
dist AS (SELECT d.id, sqrt(sum((d.x - c.m) * (d.x - c.m))) AS dist FROM dims d JOIN cent c USING (label, i)
         GROUP BY d.id)
SELECT round(avg(dist), 9) AS error FROM dist""",
    "silhouette": f"""WITH {_EMB},
s AS (SELECT id, label, olabel, sum(d) AS ds, count(*) AS c FROM pairs GROUP BY id, label, olabel),
own AS (SELECT id, c - 1 AS mates, CASE WHEN c > 1 THEN ds / (c - 1) END AS a FROM s WHERE olabel = label),
nb AS (SELECT id, min(ds / c) AS b FROM s WHERE olabel <> label GROUP BY id)
SELECT round(avg(CASE WHEN mates = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS silhouette
FROM own JOIN nb USING (id)""",
    "adjusted_rand": """WITH cont AS (SELECT c_nationkey, c_mktsegment, count(*)::HUGEINT AS nij FROM customer
                     GROUP BY c_nationkey, c_mktsegment),
t AS (SELECT sum(nij) AS n, sum(nij * nij) AS sq FROM cont),
ra AS (SELECT sum(a * a) AS sa FROM (SELECT sum(nij) AS a FROM cont GROUP BY c_nationkey)),
cb AS (SELECT sum(b * b) AS sb FROM (SELECT sum(nij) AS b FROM cont GROUP BY c_mktsegment)),
pc AS (SELECT sq - n AS tp, sb - sq AS fp, sa - sq AS fn, n * n - (sb - sq) - (sa - sq) - sq AS tn FROM t, ra, cb)
SELECT round(CASE WHEN fn = 0 AND fp = 0 THEN 1.0
                  ELSE 2.0 * (tp * tn - fn * fp)::DOUBLE / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))::DOUBLE END, 9)
       AS ari FROM pc""",
    "group_spread": """SELECT event_type, count(*)::BIGINT AS n, round(quantile_cont(value, 0.5), 9) AS median,
       min(value) AS minimum, max(value) AS maximum FROM events GROUP BY event_type""",
}
