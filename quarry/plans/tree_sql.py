"""DuckDB oracle of a whole classification tree: one group of CTEs per depth.

Written from the definition of the tree, row by row: every depth ranks the rows' own values,
interpolates the quantiles, counts both sides of every candidate and routes the rows.
"""

from __future__ import annotations

NUMERIC = ("l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice")
CATEGORICAL = ("p_brand", "p_type", "l_returnflag", "l_linestatus")
BINS, MIN_LEAF, MAX_DEPTH = 32, 120, 6


def _values(source: str, columns, tag: str) -> str:
    return " UNION ALL ".join(f"SELECT node_id, {i} AS {tag}, {c} AS value, label, w FROM {source}" for i, c in enumerate(columns))


def _column(columns, tag: str) -> str:
    return "CASE " + tag + "".join(f" WHEN {i} THEN {c}" for i, c in enumerate(columns)) + " END"


def _names(columns, tag: str) -> str:
    return "CASE " + tag + "".join(f" WHEN {i} THEN '{c}'" for i, c in enumerate(columns)) + " END"


def _route(rows: str, depth: int, trees: int = 1) -> str:
    """The rows one level down; rows of a leaf stay where they are.  A node's number is its heap
    number times ``trees`` plus its tree."""
    left = f"CASE WHEN s.kind = 'num' THEN {_column(NUMERIC, 's.idx')} <= s.threshold " \
           f"ELSE {_column(CATEGORICAL, 's.idx')} IS DISTINCT FROM s.category END"
    return f"""SELECT r.* EXCLUDE (node_id), CASE WHEN s.node_id IS NULL THEN r.node_id
       ELSE (2 * (r.node_id // {trees}) + CASE WHEN {left} THEN 0 ELSE 1 END) * {trees} + r.node_id % {trees} END AS node_id
FROM {rows} r LEFT JOIN s{depth} s ON s.node_id = r.node_id"""


def _level(d: int, score: str, trees: int, max_depth: int, min_leaf: int, subset: str) -> str:
    step = 1.0 / (BINS + 1)
    chosen = f"SEMI JOIN ({subset.format(d=d)}) a USING (node_id, feature_idx)" if subset else ""
    return f"""
n{d} AS MATERIALIZED (SELECT node_id, sum(w)::BIGINT AS n, sum(w * label)::BIGINT AS p FROM r{d} WHERE node_id // {trees} >= {1 << d} GROUP BY node_id),
o{d} AS MATERIALIZED (SELECT r.* FROM r{d} r JOIN n{d} USING (node_id) WHERE p > 0 AND p < n AND n >= {2 * min_leaf} AND {d} < {max_depth}),
v{d} AS MATERIALIZED (SELECT node_id, fidx, value, sum(w) AS c, sum(w * label) AS vp FROM ({_values(f'o{d}', NUMERIC, 'fidx')})
  GROUP BY node_id, fidx, value),
k{d} AS MATERIALIZED (SELECT *, sum(c) OVER run AS cum, sum(vp) OVER run AS cump, min(value) OVER al AS lo, max(value) OVER al AS hi,
  bool_and(value IN (0, 1)) OVER al AS flag, sum(c) OVER al AS n, sum(vp) OVER al AS p FROM v{d}
  WINDOW run AS (PARTITION BY node_id, fidx ORDER BY value), al AS (PARTITION BY node_id, fidx)),
pos{d} AS (SELECT DISTINCT node_id, fidx, n, p, (n - 1) * (i * {step!r}::DOUBLE) AS pos
  FROM k{d}, (SELECT unnest(range(1, {BINS + 1})) AS i) WHERE lo < hi AND NOT flag),
end{d} AS (SELECT q.*, a.value AS a, b.value AS b FROM pos{d} q
  JOIN k{d} a ON a.node_id = q.node_id AND a.fidx = q.fidx AND floor(pos) >= a.cum - a.c AND floor(pos) < a.cum
  JOIN k{d} b ON b.node_id = q.node_id AND b.fidx = q.fidx AND least(floor(pos) + 1, q.n - 1) >= b.cum - b.c
             AND least(floor(pos) + 1, q.n - 1) < b.cum),
t{d} AS (SELECT DISTINCT node_id, fidx, n, p, CASE WHEN pos - floor(pos) >= 0.5 THEN b - (b - a) * (1 - (pos - floor(pos)))
  ELSE a + (b - a) * (pos - floor(pos)) END AS threshold FROM end{d}
  UNION SELECT DISTINCT node_id, fidx, n, p, 0.5 FROM k{d} WHERE lo < hi AND flag),
c{d} AS (SELECT t.node_id, 'num' AS kind, t.fidx AS idx, NULL::VARCHAR AS category, t.fidx AS feature_idx, threshold,
    max(cum) AS lc, max(cump) AS lp, any_value(t.n) AS n, any_value(t.p) AS p
  FROM t{d} t JOIN k{d} k ON k.node_id = t.node_id AND k.fidx = t.fidx AND k.value <= threshold GROUP BY t.node_id, t.fidx, threshold
  UNION ALL
  SELECT x.node_id, 'cat', x.cidx, x.category, w.feature_idx, 0.5, n.n - x.rc, n.p - x.rp, n.n, n.p
  FROM (SELECT node_id, cidx, value AS category, sum(w) AS rc, sum(w * label) AS rp FROM ({_values(f'o{d}', CATEGORICAL, 'cidx')})
        GROUP BY node_id, cidx, value) x JOIN n{d} n USING (node_id) JOIN vocab w ON w.cidx = x.cidx AND w.category = x.category
  WHERE x.rc < n.n),
f{d} AS (SELECT *, row_number() OVER (PARTITION BY node_id, feature_idx ORDER BY score DESC, threshold) AS rn
  FROM (SELECT *, {score} AS score FROM c{d} {chosen} WHERE lc >= {min_leaf} AND n - lc >= {min_leaf})),
s{d} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY round(score, 12) DESC, feature_idx) AS best
  FROM f{d} WHERE rn = 1 AND score > 1e-6) WHERE best = 1),
r{d + 1} AS MATERIALIZED ({_route(f'r{d}', d, trees)}),"""


def _grown(split: str, score: str, trees: int = 1, max_depth: int = MAX_DEPTH, min_leaf: int = MIN_LEAF, subset: str = "",
           draw: str = "1::BIGINT") -> str:
    """CTEs up to ``tree`` (the nodes of all trees) and ``test_last`` (test rows at their leaves).

    ``draw``: how often a training row counts in tree t; ``subset``: (node_id, feature_idx) that
    the nodes of n{d} may split on.
    """
    offsets, seen = [], []
    for i, c in enumerate(CATEGORICAL):
        before = " + ".join(seen) or "0"
        offsets.append(f"SELECT {i} AS cidx, category, {len(NUMERIC)} + {before} + row_number() OVER (ORDER BY category) - 1 AS feature_idx "
                       f"FROM (SELECT DISTINCT {c} AS category FROM train)")
        seen.append(f"(SELECT count(DISTINCT {c}) FROM train)")
    nodes = " UNION ALL ".join(
        f"SELECT n.node_id, {d} AS depth, n.n, n.p, s.kind, s.idx, s.category, s.threshold, s.score, s.feature_idx FROM n{d} n LEFT JOIN "
        + (f"s{d} s USING (node_id)" if d < max_depth else "(SELECT * FROM s0 WHERE false) s USING (node_id)")
        for d in range(max_depth + 1))
    levels = "".join(_level(d, score, trees, max_depth, min_leaf, subset) for d in range(max_depth))
    walk = f"test0 AS (SELECT test.*, t + {trees} AS node_id FROM test, range({trees}) t(t)),"
    for d in range(max_depth):
        walk += f"\ntest{d + 1} AS ({_route(f'test{d}', d, trees)}),"
    return f"""{split},
vocab AS MATERIALIZED ({' UNION ALL '.join(offsets)}),
r0 AS MATERIALIZED (SELECT * FROM (SELECT train.*, t + {trees} AS node_id, {draw} AS w FROM train, range({trees}) t(t)) WHERE w > 0),{levels}
n{max_depth} AS (SELECT node_id, sum(w)::BIGINT AS n, sum(w * label)::BIGINT AS p FROM r{max_depth} WHERE node_id // {trees} >= {1 << max_depth} GROUP BY node_id),
tree AS MATERIALIZED ({nodes}),
{walk}
test_last AS (SELECT * FROM test{max_depth})"""


_QUALITY = """quality AS (SELECT *, CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn)::DOUBLE / (tp + fp + fn + tn) ELSE 0 END AS accuracy,
    CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0 END AS f1
  FROM (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM routed))"""


def tree_ctes(split: str, score: str) -> str:
    """CTEs up to ``tree`` (the node table), ``routed`` (test rows at their leaves) and quality.

    ``split`` ends with the CTEs train and test; ``score`` is an expression over lc, lp, n, p.
    """
    return f"""{_grown(split, score)},
routed AS (SELECT t.row_key, t.label, t.node_id, (2 * tree.p >= tree.n)::INT AS prediction
           FROM test_last t JOIN tree ON tree.node_id = t.node_id),
{_QUALITY}"""


def forest_ctes(split: str, score: str, trees: int, max_depth: int, min_leaf: int, count: int, width: int, seed: int, cumulative) -> str:
    """The same for a forest: bootstrap by one md5 draw a row and tree, ``count`` of ``width``
    features a node by md5; ``routed`` has one row a test row, ``importance`` one a feature."""
    u = f"(((('0x' || substr(md5('{seed}:' || row_key || ':tree:' || t), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)"
    draw = "(" + " + ".join(f"({u} > {c!r}::DOUBLE)::BIGINT" for c in cumulative) + ")"
    subset = (f"SELECT node_id, f AS feature_idx FROM (SELECT node_id, f, row_number() OVER (PARTITION BY node_id "
              f"ORDER BY md5('{seed}:' || node_id || ':' || f)) AS r FROM n{{d}}, range({width}) t(f)) WHERE r <= {count}")
    names = " UNION ALL ".join([f"SELECT {i} AS feature_idx, '{c}' AS feature" for i, c in enumerate(NUMERIC)])
    return f"""{_grown(split, score, trees, max_depth, min_leaf, subset, draw)},
routed AS (SELECT row_key, any_value(label) AS label, sum(tree.p / tree.n) / {trees} AS probability,
                  (sum(tree.p / tree.n) / {trees} > 0.5 + 1e-12)::INT AS prediction
           FROM test_last t JOIN tree USING (node_id) GROUP BY row_key),
{_QUALITY},
gain AS (SELECT node_id % {trees} AS t, feature_idx, sum(n * score) AS g FROM tree WHERE kind IS NOT NULL GROUP BY 1, 2),
importance AS (SELECT feature, sum(g / whole) / (SELECT count(DISTINCT t) FROM gain) AS importance
  FROM (SELECT *, sum(g) OVER (PARTITION BY t) AS whole FROM gain) JOIN ({names} UNION ALL SELECT feature_idx, ({_names(CATEGORICAL, 'cidx')}) || '=' || category
  FROM vocab) USING (feature_idx) GROUP BY feature)"""


NODES = f"""SELECT node_id, node_id // 2 AS parent_id, depth, n AS count, p::BIGINT AS positive,
       (2 * p >= n)::INT AS prediction,
       CASE WHEN kind = 'num' THEN {_names(NUMERIC, 'idx')} WHEN kind = 'cat' THEN ({_names(CATEGORICAL, 'idx')}) || '=' || category END AS feature,
       round(threshold, 9) AS threshold, round(score, 9) AS score FROM tree"""
