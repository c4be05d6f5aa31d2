"""Graphs of tables, spans, roles and models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import graph as g
from ..plans import lineage as li
from ..plans import traces as t
from . import query

UNIT = "'T' || lpad(CAST({0} AS VARCHAR), 6, '0')"
EDGE = """edge AS (SELECT DISTINCT user_id AS n, user_id // 2 AS p FROM events WHERE user_id >= 16
  UNION SELECT DISTINCT user_id, user_id // 4 FROM events WHERE user_id >= 32),
node AS (SELECT DISTINCT user_id AS n FROM events UNION SELECT p FROM edge)"""


def unit(column: str) -> str:
    return UNIT.format(column)


def table_edges(spark, sf):
    return g.edges(b.graph(spark, sf), kinds=["MAINTAINED"])


@query("graph_edges", f"""
WITH {EDGE} SELECT {unit('n')} AS child, {unit('p')} AS parent, 'MAINTAINED' AS kind FROM edge
UNION ALL SELECT DISTINCT {unit('user_id')}, 'BASE_' || user_id, 'TABLE' FROM events WHERE user_id < 16""")
def _(spark, sf):
    return g.edges(b.graph(spark, sf))


@query("direct_neighbours", f"""
WITH {EDGE} SELECT {unit('p')} AS node, 'upstream' AS side FROM edge WHERE n = 40 UNION ALL SELECT {unit('n')}, 'downstream' FROM edge WHERE p = 40""")
def _(spark, sf):
    e = table_edges(spark, sf)
    return g.neighbours(e, "T000040", "upstream").withColumn("side", F.lit("upstream")).unionByName(
        g.neighbours(e, "T000040", "downstream").withColumn("side", F.lit("downstream")))


@query("downstream_closure", f"""
WITH RECURSIVE {EDGE}, walk(n, d) AS (SELECT 9::BIGINT, 0 UNION SELECT edge.n, d + 1 FROM walk JOIN edge ON p = walk.n)
SELECT {unit('n')} AS node, min(d) AS depth FROM walk GROUP BY n""")
def _(spark, sf):
    start = b.nodes(spark, sf).where("node = 'T000009'")
    return g.closure(table_edges(spark, sf), start, "downstream")


@query("upstream_of_leaves", f"""
WITH RECURSIVE {EDGE}, walk(n, d) AS (SELECT n, 0 FROM node WHERE n NOT IN (SELECT p FROM edge) UNION SELECT edge.p, d + 1 FROM walk JOIN edge ON edge.n = walk.n)
SELECT {unit('n')} AS node, min(d) AS depth FROM walk GROUP BY n""")
def _(spark, sf):
    edges = table_edges(spark, sf)
    leaves = b.nodes(spark, sf).join(edges.select(F.col("parent").alias("node")), "node", "left_anti")
    return g.closure(edges, leaves, "upstream")


@query("connected_components", f"""
WITH RECURSIVE {EDGE}, pairs AS (SELECT n AS a, p AS z FROM edge UNION SELECT p, n FROM edge),
reach(n, r) AS (SELECT n, n FROM node UNION SELECT z, r FROM reach JOIN pairs ON a = reach.n)
SELECT {unit('n')} AS node, {unit('min(r)')} AS component FROM reach GROUP BY n""")
def _(spark, sf):
    return g.components(table_edges(spark, sf), b.nodes(spark, sf))


@query("connected_to_one_table", f"""
WITH RECURSIVE {EDGE}, pairs AS (SELECT n AS a, p AS z FROM edge UNION SELECT p, n FROM edge),
reach(n) AS (SELECT 9::BIGINT UNION SELECT z FROM reach JOIN pairs ON a = reach.n) SELECT {unit('n')} AS node FROM reach""")
def _(spark, sf):
    return li.connected_to(table_edges(spark, sf), b.nodes(spark, sf), "T000009")


@query("graph_depths", f"""
WITH RECURSIVE {EDGE}, walk(n, d) AS (SELECT n, 0 FROM node WHERE n NOT IN (SELECT n FROM edge) UNION SELECT edge.n, d + 1 FROM walk JOIN edge ON p = walk.n)
SELECT {unit('n')} AS node, CAST(max(d) AS BIGINT) AS depth FROM walk GROUP BY n""")
def _(spark, sf):
    return g.depths(table_edges(spark, sf), b.nodes(spark, sf))


OBJECTS = """obj AS (SELECT user_id AS n, CASE WHEN max(value) > 300 THEN 'MAINTAINED' WHEN max(value) > 190 THEN 'VIEW' WHEN max(value) > 180 THEN 'EXTERNAL TABLE' ELSE 'TABLE' END AS kind
  FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'error') <= count(*) / 3)"""


@query("types_behind_views", f"""
WITH RECURSIVE {EDGE}, {OBJECTS}, walk(v, n, d) AS (
  SELECT obj.n, p, 1 FROM obj JOIN edge ON edge.n = obj.n WHERE kind = 'VIEW'
  UNION SELECT v, edge.p, d + 1 FROM walk JOIN obj ON obj.n = walk.n AND kind = 'VIEW' JOIN edge ON edge.n = walk.n)
SELECT {unit('v')} AS view, CAST(max(d) AS BIGINT) AS levels,
  CASE WHEN bool_or(coalesce(kind IN ('MAINTAINED', 'EXTERNAL TABLE'), false)) THEN 'BLOCKER' WHEN bool_or(kind IS NULL) THEN 'UNKNOWN' ELSE 'OK' END AS verdict
FROM walk LEFT JOIN obj USING (n) GROUP BY v""")
def _(spark, sf):
    return li.trace_types(b.objects(spark, sf), b.reads(spark, sf))


# --- spans -----------------------------------------------------------------------

SPAN = """sp AS (SELECT user_id AS n, CAST(ts AS DATE) AS day, date_trunc('second', min(ts)) AS s, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS work,
  CASE WHEN count(*) FILTER (event_type = 'error') > count(*) FILTER (event_type = 'signup') THEN 'FAILED'
    WHEN count(*) FILTER (event_type = 'signup') > 0 THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state,
  count(*) FILTER (event_type = 'signup') AS idle, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1, 2),
span AS (SELECT *, 'S' || n || '@' || day AS span_id, CASE WHEN state = 'SKIPPED' THEN 0 ELSE work END AS dur,
  CASE WHEN state = 'FAILED' THEN 'QUERY_FAILURE' WHEN state = 'SKIPPED' THEN
    CASE WHEN idle > 1 THEN 'NOT_EFFECTIVE_TICK_TO_REFRESH' WHEN bad > 0 THEN 'UPSTREAM_FAILURE' ELSE 'UPSTREAM_SKIP' END END AS reason FROM sp),
link AS (SELECT span_id, n, day, n // 2 AS p FROM span WHERE n >= 16 UNION ALL SELECT span_id, n, day, n // 4 FROM span WHERE n >= 32),
dep AS (SELECT link.span_id AS child, span.span_id AS parent FROM link JOIN span ON span.n = link.p AND span.day = link.day)"""


@query("spans_of_one_cycle", f"""
WITH {SPAN} SELECT span_id, {unit('n')} AS name, state, dur AS duration_sec FROM span WHERE day = DATE '2024-01-10'""")
def _(spark, sf):
    return t.cycle(b.spans(spark, sf), dt.datetime(2024, 1, 10)).select("span_id", "name", "state", "duration_sec")


@query("nearest_spans", f"""
WITH {SPAN} SELECT span_id, state FROM span WHERE n = 9 AND s BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY s DESC, span_id LIMIT 5""")
def _(spark, sf):
    return t.nearest(b.spans(spark, sf), "T000009", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20)).select("span_id", "state")


@query("span_upstream", f"""
WITH {SPAN} SELECT child AS span_id, {unit('n')} AS upstream_name, state AS upstream_state, reason AS upstream_reason FROM dep JOIN span ON span.span_id = parent""")
def _(spark, sf):
    return t.upstream(b.spans(spark, sf))


@query("unresolved_span_links", f"""
WITH {SPAN} SELECT span_id, 'S' || p || '@' || day AS missing FROM link WHERE (p, day) NOT IN (SELECT (n, day) FROM span)""")
def _(spark, sf):
    return t.unresolved(b.spans(spark, sf))


@query("affected_by_failures", f"""
WITH RECURSIVE {SPAN}, walk(x, d) AS (SELECT span_id, 0 FROM span WHERE state = 'FAILED' UNION SELECT child, d + 1 FROM walk JOIN dep ON parent = x),
near AS (SELECT x, min(d) AS depth FROM walk GROUP BY 1)
SELECT span_id, depth, {unit('n')} AS name, state, reason AS state_reason FROM near JOIN span ON span_id = x WHERE depth > 0""")
def _(spark, sf):
    spans = b.spans(spark, sf)
    return t.affected(spans, spans.where("state = 'FAILED'"))


@query("root_causes", f"""
WITH RECURSIVE {SPAN}, walk(x, r) AS (SELECT span_id, span_id FROM span WHERE state = 'FAILED'
  UNION SELECT child, r FROM walk JOIN dep ON parent = x JOIN span ON span_id = child AND state = 'SKIPPED')
SELECT span_id, state, min(r) AS root_cause FROM span LEFT JOIN walk ON x = span_id WHERE state <> 'SUCCEEDED' GROUP BY 1, 2""")
def _(spark, sf):
    return t.root_causes(b.spans(spark, sf))


@query("skip_reason_priority", f"""
WITH {SPAN} SELECT child AS span_id, CASE WHEN bool_or(state = 'FAILED' OR reason = 'UPSTREAM_FAILURE') THEN 'UPSTREAM_FAILURE' ELSE 'UPSTREAM_SKIP' END AS skip_reason
FROM dep JOIN span ON span.span_id = parent WHERE state <> 'SUCCEEDED' GROUP BY 1""")
def _(spark, sf):
    return t.skip_reason(b.spans(spark, sf))


@query("slowest_spans", f"WITH {SPAN} SELECT span_id, dur AS duration_sec FROM span WHERE state = 'SUCCEEDED' ORDER BY dur DESC, span_id LIMIT 10")
def _(spark, sf):
    return t.slowest(b.spans(spark, sf)).select("span_id", "duration_sec")


PATHS = f"""WITH RECURSIVE {SPAN}, walk(x, total) AS (SELECT span_id, dur FROM span UNION SELECT child, CAST(total + dur AS BIGINT) FROM walk JOIN dep ON parent = x JOIN span ON span_id = child),
best AS (SELECT x AS span_id, max(total) AS total FROM walk GROUP BY 1)"""


@query("span_path_totals", f"{PATHS} SELECT span_id AS node, total FROM best")
def _(spark, sf):
    return t.path_totals(b.spans(spark, sf)).select("node", "total")


@query("critical_path_per_cycle", f"""{PATHS} SELECT 'C@' || day AS trace_id, span_id, total FROM best JOIN span USING (span_id)
QUALIFY row_number() OVER (PARTITION BY day ORDER BY total DESC, span_id) = 1""")
def _(spark, sf):
    return t.critical_ends(b.spans(spark, sf))


@query("critical_path_rows", f"""{PATHS},
via AS (SELECT child AS x, first(parent ORDER BY b.total DESC, parent) AS p FROM dep JOIN best b ON b.span_id = parent
  WHERE b.total > 0 GROUP BY 1),
ends AS (SELECT 'C@' || day AS trace_id, span_id FROM best JOIN span USING (span_id)
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY total DESC, span_id) = 1),
path(trace_id, x, back) AS (SELECT trace_id, span_id, 0::BIGINT FROM ends UNION ALL SELECT trace_id, p, back + 1 FROM path JOIN via USING (x))
SELECT trace_id, max(back) OVER (PARTITION BY trace_id) - back AS step, x AS span_id, total FROM path JOIN best ON best.span_id = x""")
def _(spark, sf):
    return t.critical_paths(b.spans(spark, sf))


@query("timeline_rows", f"""
WITH {SPAN} SELECT 'C@' || day AS trace_id, span_id, {unit('n')} || ' [' || state || CASE WHEN state = 'SKIPPED' THEN ' — ' || reason ELSE '' END || ']' AS label,
  CASE state WHEN 'SUCCEEDED' THEN 'done' WHEN 'SKIPPED' THEN 'active' ELSE 'crit' END AS style, s AS bar_start,
  s + to_seconds(CASE WHEN dur = 0 THEN 1 ELSE dur END) AS bar_end FROM span""")
def _(spark, sf):
    return t.timeline(b.spans(spark, sf))


# --- grants ------------------------------------------------------------------------

GRANTS = """ship AS (SELECT s_name, n_name, r_name, p_brand, l_returnflag, l_quantity FROM lineitem JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
member AS (SELECT s_name AS who, n_name AS role FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION SELECT s_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
given AS (SELECT DISTINCT CASE WHEN l_quantity = 49 THEN r_name ELSE n_name END AS role, p_brand AS obj FROM ship WHERE l_returnflag = 'R' AND l_quantity >= 45 AND l_quantity <> 50),
eff AS (SELECT DISTINCT who, obj FROM member JOIN given USING (role))"""


@query("effective_grants", f"WITH {GRANTS} SELECT who AS user, obj AS object, 'SELECT' AS privilege FROM eff")
def _(spark, sf):
    return li.effective_grants(b.role_members(spark, sf), b.role_hierarchy(spark, sf), b.grants(spark, sf))


@query("missing_privileges", f"""
WITH {GRANTS} SELECT DISTINCT s_name AS user, p_brand AS object, 'SELECT' AS privilege FROM ship
WHERE l_returnflag = 'A' AND NOT EXISTS (SELECT 1 FROM eff WHERE who = s_name AND obj = p_brand)""")
def _(spark, sf):
    effective = li.effective_grants(b.role_members(spark, sf), b.role_hierarchy(spark, sf), b.grants(spark, sf))
    return li.missing_grants(b.required_grants(spark, sf), effective)


@query("effective_grants_of_deep_roles", f"""
WITH RECURSIVE up(r, a) AS (SELECT c_custkey, c_custkey FROM customer
  UNION SELECT r, a // 2 FROM up JOIN (SELECT DISTINCT user_id FROM events WHERE user_id >= 2) ON user_id = a)
SELECT DISTINCT c_name AS user, event_type || '_' || (user_id % 7) AS object, 'SELECT' AS privilege
FROM customer JOIN up ON r = c_custkey JOIN events ON user_id = a WHERE value > 200 AND event_type <> 'error'""")
def _(spark, sf):
    return li.effective_grants_of_tree(b.deep_members(spark, sf), b.deep_hierarchy(spark, sf), b.deep_grants(spark, sf))


# --- models and tasks ----------------------------------------------------------------

CONSTRUCTS = f"""con AS (SELECT DISTINCT {unit('user_id')} AS name,
  CASE event_type WHEN 'view' THEN 'GROUP BY' WHEN 'click' THEN 'INNER JOIN' WHEN 'purchase' THEN 'ROW_NUMBER' WHEN 'signup' THEN 'PIVOT' ELSE 'ROLLUP' END AS construct,
  CASE event_type WHEN 'signup' THEN 3 WHEN 'purchase' THEN 2 WHEN 'error' THEN 2 ELSE 1 END AS rank FROM events WHERE value > 200)"""


@query("model_classification", f"""
WITH {CONSTRUCTS} SELECT name, CASE max(rank) WHEN 3 THEN 'SKIP' WHEN 2 THEN 'FULL' ELSE 'INCREMENTAL' END AS mode,
  CASE max(rank) WHEN 3 THEN 'PIVOT' WHEN 2 THEN max(construct) FILTER (rank = 2) END AS reason FROM con GROUP BY 1""")
def _(spark, sf):
    return li.classify_models(b.constructs(spark, sf))


@query("derived_model_keys", f"""
WITH {CONSTRUCTS} SELECT name, CASE WHEN bool_or(construct = 'ROW_NUMBER') THEN 'id' ELSE 'day,region' END AS key_columns FROM con
GROUP BY 1 HAVING NOT bool_or(construct = 'ROLLUP') AND bool_or(construct IN ('GROUP BY', 'ROW_NUMBER'))""")
def _(spark, sf):
    return li.derived_keys(b.constructs(spark, sf)).withColumn("key_columns", F.array_join("key_columns", ","))


PER = """per AS (SELECT user_id AS n, max(value) AS top, count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'click') AS c,
  count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'signup') AS s, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1)"""


@query("refresh_mode_propagation", f"""
WITH RECURSIVE {EDGE}, {PER}, hit(n) AS (
  SELECT edge.n FROM per JOIN edge ON edge.p = per.n WHERE per.c > per.v AND NOT per.p > per.s AND NOT top > 300
  UNION SELECT edge.n FROM hit JOIN per ON per.n = hit.n AND NOT per.p > per.s AND NOT top > 300 JOIN edge ON edge.p = hit.n)
SELECT {unit('n')} AS name, CASE WHEN c > v THEN 'FULL' ELSE 'INCREMENTAL' END AS mode,
  CASE WHEN c > v OR n IN (SELECT n FROM hit) THEN 'FULL' ELSE 'INCREMENTAL' END AS final_mode,
  CASE WHEN NOT c > v AND n IN (SELECT n FROM hit) THEN 'UPSTREAM_USES_FULL_REFRESH' END AS reason FROM per""")
def _(spark, sf):
    return li.propagate_mode(b.models(spark, sf), b.reads(spark, sf))


@query("columns_affected", f"""
WITH RECURSIVE seen AS (SELECT user_id AS n, event_type AS c, max(value) AS top FROM events GROUP BY 1, 2),
parents AS (SELECT n, c, top, CASE WHEN n < 16 THEN 'BASE_' || n ELSE {unit('(n // 2)')} END AS near FROM seen),
edge AS (SELECT {unit('n')} AS name, c, near AS input, c AS ic FROM parents
  UNION SELECT {unit('n')}, c, {unit('(n // 4)')}, 'view' FROM parents WHERE n >= 32 AND c = 'error'
  UNION SELECT {unit('n')}, '*', near, c FROM parents WHERE top > 200
  UNION SELECT {unit('p.n')}, p.c, {unit('p.n')}, '*' FROM parents p WHERE n IN (SELECT n FROM parents WHERE top > 200)),
walk(gn, gc, name, c) AS (SELECT DISTINCT input, ic, input, ic FROM edge WHERE input LIKE 'BASE%' AND ic IN ('view', 'click')
  UNION SELECT gn, gc, edge.name, edge.c FROM walk JOIN edge ON input = walk.name AND ic = walk.c)
SELECT gn AS dropped_name, gc AS dropped_column, name, CASE WHEN c <> '*' THEN c END AS column FROM walk WHERE NOT (name = gn AND c = gc)""")
def _(spark, sf):
    return li.columns_affected(b.projections(spark, sf), b.dropped_columns(spark, sf))


@query("definition_changes", f"""
WITH ver AS (SELECT {unit('user_id')} AS name, date_trunc('week', ts) AS w, CAST(max(value) > 150 AS VARCHAR) AS i, CAST(count(*) % 3 AS VARCHAR) AS q FROM events GROUP BY 1, 2),
x AS (SELECT *, lag(i) OVER u AS pi, lag(q) OVER u AS pq FROM ver WINDOW u AS (PARTITION BY name ORDER BY w))
SELECT name, w AS valid_from, i <> pi AS inputs_changed, q <> pq AS query_changed FROM x WHERE pi IS NOT NULL AND (i <> pi OR q <> pq)""")
def _(spark, sf):
    versions = b.table(spark, sf, "events").groupBy(
        b._unit(F.col("user_id")).alias("name"), F.date_trunc("week", "ts").cast("timestamp_ntz").alias("valid_from")).agg(
        (F.max("value") > 150).cast("string").alias("inputs_text"), (F.count(F.lit(1)) % 3).cast("string").alias("query_text"))
    return li.definition_changes(versions)


@query("tasks_to_tables", f"""
WITH {EDGE}, {PER} SELECT {unit('n')} AS name, n < 16 AS is_root,
  CASE WHEN n IN (SELECT p FROM edge) THEN 'DOWNSTREAM' ELSE CAST(floor(top) AS BIGINT) || ' seconds' END AS target_lag FROM per""")
def _(spark, sf):
    return li.tasks_to_tables(b.tasks(spark, sf))
