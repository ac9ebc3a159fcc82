"""DuckDB SQL of a small boosted fit: two-level trees over bins of equal width, no sampling, and
what is read off them: scores, errors by round, Shapley values of paths with up to two splits."""

from __future__ import annotations

from retailcast.contract import FEATURE_ORDER

#: The fit that the model queries and this SQL share.
SMALL = {"max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1, "reg_lambda": 1.0}
ROUNDS, BINS, BITS = 3, 16, 16
_L2, _RATE = SMALL["reg_lambda"], SMALL["learning_rate"]


def doubles(kind: str = "DOUBLE") -> str:
    """The feature list, each value passed through ``kind``."""
    return "[" + ", ".join(f"CAST(CAST({c} AS {kind}) AS DOUBLE)" for c in FEATURE_ORDER) + "]"


def _gain(gl: str, hl: str, g: str, h: str) -> str:
    gr, hr = f"({g} - {gl})", f"({h} - {hl})"
    return f"({gl} * {gl} / ({hl} + {_L2}::DOUBLE) + {gr} * {gr} / ({hr} + {_L2}::DOUBLE) - {g} * {g} / ({h} + {_L2}::DOUBLE))"


def _best(name: str, rows: str) -> str:
    """The best split of each node of ``rows`` (node, f, b, g): node, f, b, gain, gl, hl, g, h."""
    return f"""{name}h AS (SELECT node, f, b, CAST(sum(g) AS DOUBLE) / {2**BITS}::DOUBLE AS g, CAST(count(*) AS DOUBLE) AS h FROM {rows} GROUP BY node, f, b),
{name}c AS (SELECT node, f, b, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER t AS gt, sum(h) OVER t AS ht FROM {name}h
  WINDOW w AS (PARTITION BY node, f ORDER BY b), t AS (PARTITION BY node, f)),
{name} AS (SELECT *, {_gain('gl', 'hl', 'gt', 'ht')} AS gain FROM {name}c WHERE hl >= 1 AND ht - hl >= 1
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY {_gain('gl', 'hl', 'gt', 'ht')} DESC, f, b) = 1 AND gain > 1e-6)"""


def _value(g: str, h: str) -> str:
    return f"(-{_RATE}::DOUBLE * {g} / ({h} + {_L2}::DOUBLE))"


def _round(r: int) -> str:
    def node(i: str, split: str, g: str, h: str) -> str:
        return (f"SELECT {r + 1} AS t, {i} AS id, {split}.f AS f, {split}.b AS b, {split}.gain AS gain, {g} AS g, {h} AS h")
    return f""",
r{r} AS (SELECT 0 AS node, rid, f, b, floor((pred - y) * {2**BITS}::DOUBLE + 0.5) AS g FROM gb JOIN p{r} USING (rid)),
{_best(f'a{r}', f'r{r}')},
s{r} AS (SELECT r.rid, CASE WHEN r.b <= a.b THEN 1 ELSE 2 END AS node FROM r{r} r JOIN a{r} a ON r.f = a.f),
q{r} AS (SELECT s.node, r.rid, r.f, r.b, r.g FROM r{r} r JOIN s{r} s USING (rid)),
{_best(f'd{r}', f'q{r}')},
z{r} AS (SELECT CASE WHEN q.b <= d.b THEN 2 * q.node + 1 ELSE 2 * q.node + 2 END AS id, q.rid FROM q{r} q JOIN d{r} d ON q.node = d.node AND q.f = d.f),
u{r} AS (SELECT CAST(sum(g) AS DOUBLE) / {2**BITS}::DOUBLE AS g, CAST(count(*) AS DOUBLE) AS h FROM r{r} WHERE f = 0),
n{r} AS (
  {node('0', 'a', 'u.g', 'u.h')} FROM u{r} u LEFT JOIN a{r} a ON true
  UNION ALL {node('1', 'd', 'a.gl', 'a.hl')} FROM a{r} a LEFT JOIN d{r} d ON d.node = 1
  UNION ALL {node('2', 'd', 'a.gt - a.gl', 'a.ht - a.hl')} FROM a{r} a LEFT JOIN d{r} d ON d.node = 2
  UNION ALL SELECT {r + 1}, 2 * node + 1, NULL, NULL, NULL, gl, hl FROM d{r}
  UNION ALL SELECT {r + 1}, 2 * node + 2, NULL, NULL, NULL, gt - gl, ht - hl FROM d{r}),
p{r + 1} AS (SELECT p.rid, p.y, p.pred + {_value('n.g', 'n.h')} AS pred FROM p{r} p
  LEFT JOIN s{r} s USING (rid) LEFT JOIN z{r} z USING (rid) JOIN n{r} n ON n.id = coalesce(z.id, s.node, 0))"""


FIT_CTE = f"""
gt AS (SELECT record_id AS rid, CAST(units_sold AS DOUBLE) AS y, {doubles()} AS x FROM scored WHERE split_type = 'train'),
gl AS (SELECT rid, y, unnest(range({len(FEATURE_ORDER)})) AS f, unnest(x) AS v FROM gt),
gc AS (SELECT f, list(lo + (hi - lo) * (2 * j + 1) / {2 * BINS} ORDER BY j) AS e FROM (SELECT f, min(v) AS lo, max(v) AS hi FROM gl GROUP BY f), range({BINS}) r(j) WHERE hi > lo GROUP BY f),
gb AS (SELECT rid, gl.f, coalesce(CAST(list_sum(list_transform(e, lambda c: CASE WHEN c < v THEN 1 ELSE 0 END)) AS INTEGER), 0) AS b FROM gl LEFT JOIN gc ON gl.f = gc.f),
p0 AS (SELECT rid, y, (SELECT avg(y) FROM gt) AS pred FROM gt)""" + "".join(_round(r) for r in range(ROUNDS)) + f""",
nodes AS (
  SELECT 0 AS "treeID", 0 AS id, -1 AS "leftChild", -1 AS "rightChild", -1 AS "featureIndex", CAST(NULL AS DOUBLE) AS threshold, false AS missing_left,
    (SELECT avg(y) FROM gt) AS prediction, 0.0::DOUBLE AS gain, (SELECT count(*) FROM gt) AS "rawCount", 1.0::DOUBLE AS tree_weight
  UNION ALL SELECT CAST(t AS INTEGER), CAST(id AS INTEGER), CAST(CASE WHEN n.f IS NULL THEN -1 ELSE 2 * id + 1 END AS INTEGER),
    CAST(CASE WHEN n.f IS NULL THEN -1 ELSE 2 * id + 2 END AS INTEGER), CAST(coalesce(n.f, -1) AS INTEGER), gc.e[n.b + 1], false,
    {_value('g', 'h')}, coalesce(gain, 0), CAST(h AS BIGINT), 1.0::DOUBLE
  FROM ({' UNION ALL '.join(f'SELECT * FROM n{r}' for r in range(ROUNDS))}) n LEFT JOIN gc ON gc.f = n.f)"""


def walk_cte(rows: str, kind: str = "DOUBLE") -> str:
    """walked(rid, t, v): the value of the leaf that each row of ``rows`` (with record_id) reaches in
    each tree; predicted(rid, prediction): the model's output."""
    def child(n: str) -> str:
        return f'CASE WHEN x.x[{n}."featureIndex" + 1] <= {n}.threshold THEN {n}."leftChild" ELSE {n}."rightChild" END'
    total = "(SELECT prediction FROM nodes WHERE \"treeID\" = 0)" + "".join(f" + max(CASE WHEN t = {r + 1} THEN v END)" for r in range(ROUNDS))
    return f"""
xs AS (SELECT record_id AS rid, {doubles(kind)} AS x FROM {rows}),
walked AS (SELECT x.rid, a."treeID" AS t, coalesce(c.prediction, b.prediction, a.prediction) AS v FROM xs x JOIN nodes a ON a.id = 0 AND a."treeID" > 0
  LEFT JOIN nodes b ON b."treeID" = a."treeID" AND a."featureIndex" >= 0 AND b.id = {child('a')}
  LEFT JOIN nodes c ON c."treeID" = a."treeID" AND b."featureIndex" >= 0 AND c.id = {child('b')}),
predicted AS (SELECT rid, {total} AS prediction FROM walked GROUP BY rid)"""


#: Contributions by row and feature: of each path to a leaf, by the share of rows that pass a split without and with the row's value.
SHAP_CTE = """
paths AS (
  SELECT a."treeID" AS t, a."featureIndex" AS f0, a.threshold AS c0, b.id = a."leftChild" AS l0, b."rawCount" / a."rawCount"::DOUBLE AS z0,
    CASE WHEN c.id IS NOT NULL THEN b."featureIndex" END AS f1, b.threshold AS c1, c.id = b."leftChild" AS l1, c."rawCount" / b."rawCount"::DOUBLE AS z1,
    coalesce(c.prediction, b.prediction) AS v, coalesce(c."rawCount", b."rawCount") / a."rawCount"::DOUBLE AS share
  FROM nodes a JOIN nodes b ON a."treeID" = b."treeID" AND a.id = 0 AND b.id IN (a."leftChild", a."rightChild")
  LEFT JOIN nodes c ON c."treeID" = b."treeID" AND c.id IN (b."leftChild", b."rightChild") AND b."featureIndex" >= 0 WHERE a."featureIndex" >= 0),
passed AS (SELECT rid, p.*, CAST((x.x[f0 + 1] <= c0) = l0 AS DOUBLE) AS o0, CAST((x.x[f1 + 1] <= c1) = l1 AS DOUBLE) AS o1 FROM xs x, paths p),
parts AS (
  SELECT rid, f0 AS f, CASE WHEN f1 IS NULL THEN (o0 - z0) * v WHEN f1 = f0 THEN (o0 * o1 - z0 * z1) * v ELSE (o0 - z0) * (z1 + o1) / 2 * v END AS phi FROM passed
  UNION ALL SELECT rid, f1, (o1 - z1) * (z0 + o0) / 2 * v FROM passed WHERE f1 IS NOT NULL AND f1 <> f0),
phis AS (SELECT rid, f, sum(phi) AS phi FROM parts GROUP BY rid, f),
base AS (SELECT (SELECT sum(prediction) FROM nodes WHERE "treeID" = 0) + coalesce((SELECT sum(v * share) FROM paths), 0) AS v),
names AS (SELECT unnest(range(""" + str(len(FEATURE_ORDER)) + """)) AS f, unnest([""" + ", ".join(f"'{c}'" for c in FEATURE_ORDER) + """]) AS feature),
importance AS (SELECT feature, coalesce(sum(abs(phi)), 0) / (SELECT count(*) FROM xs) AS mean_abs_shap FROM names LEFT JOIN phis USING (f) GROUP BY feature)"""
