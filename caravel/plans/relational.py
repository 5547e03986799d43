"""Relational plans: one entry an operator of the dialect's query language, as Spark SQL with its DuckDB counterpart.

``PLANS[name]`` is (Spark SQL, DuckDB SQL); where one text serves both it stands once.  Ranks, lengths and date parts
are cast to BIGINT and floating sums rounded, as the two engines differ in widths and in the order of additions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def use_tables(spark: SparkSession, sf_dir: str, text: str) -> None:
    """Temporary views for the tables that a text names; the scans prune columns and take the filters."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", text, re.IGNORECASE):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


PLANS: dict[str, tuple[str, str]] = {}


def plan(name: str, spark: str, duck: str | None = None) -> None:
    PLANS[name] = (spark, duck if duck is not None else spark)


# projection, filter, predicates, expressions
plan("view_filter_project", "SELECT c_custkey AS id, c_name AS nome FROM customer WHERE c_mktsegment = 'BUILDING'")
plan("distinct_segments", "SELECT DISTINCT c_mktsegment AS segment FROM customer")
plan("comma_join", "SELECT n.n_name AS nation, r.r_name AS region FROM nation n, region r WHERE n.n_regionkey = r.r_regionkey")
plan("boolean_logic", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_totalprice > 200000) AND NOT o_orderpriority = '1-URGENT'")
plan("comparisons", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 49 AND l_discount <> 0.05 AND l_tax < 0.04 AND l_extendedprice <= 60000")
plan("null_tests", "SELECT c.c_custkey, CASE WHEN o.o_orderkey IS NULL THEN 1 ELSE 0 END AS no_order FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_totalprice > 250000 WHERE o.o_orderkey IS NULL OR o.o_orderkey IS NOT NULL")
plan("float_tests", "SELECT event_id, isnan(value) AS is_nan, (value = double('Infinity')) AS is_inf FROM events", "SELECT event_id, isnan(value) AS is_nan, isinf(value) AND value > 0 AS is_inf FROM events")
plan("in_list", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 3) AND l_returnflag NOT IN ('N')")
plan("between_in", "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice NOT BETWEEN 1000 AND 1500")
plan("like_escape", "SELECT p_partkey, p_type LIKE '%A%' AS has_a, p_name NOT LIKE 'p%' AS not_p, '10%' LIKE '10!%' ESCAPE '!' AS pct FROM part")
plan("case_when", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'part' END AS state, CASE WHEN o_totalprice > 200000 THEN 2 WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS band FROM orders")
plan("arithmetic", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) + l_tax - 1, 4) AS net, l_linenumber % 3 AS m, -l_linenumber AS neg, power(l_linenumber, 2) AS sq FROM lineitem")
plan("int_division", "SELECT l_orderkey, l_linenumber, cast(l_orderkey div 7 AS bigint) AS q, cast(-l_linenumber div 2 AS bigint) AS h FROM lineitem", "SELECT l_orderkey, l_linenumber, l_orderkey // 7 AS q, cast(trunc(-l_linenumber / 2) AS bigint) AS h FROM lineitem")
plan("concatenation", "SELECT s_suppkey, s_name || '/' || cast(s_nationkey AS string) AS tag, s_name || NULL AS nothing FROM supplier", "SELECT s_suppkey, s_name || '/' || cast(s_nationkey AS varchar) AS tag, cast(s_name || NULL AS varchar) AS nothing FROM supplier")
plan("collation", "SELECT c_custkey FROM customer WHERE c_mktsegment COLLATE UTF8_LCASE = 'building'", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building'")
plan("interval_arithmetic", "SELECT o_orderkey, o_orderdate + INTERVAL '3' DAY AS due, cast(datediff(o_orderdate + INTERVAL '1' MONTH, o_orderdate) AS bigint) AS days FROM orders", "SELECT o_orderkey, o_orderdate + INTERVAL 3 DAY AS due, datediff('day', o_orderdate, o_orderdate + INTERVAL 1 MONTH) AS days FROM orders")
plan("time_zones", "SELECT event_id, cast(from_utc_timestamp(ts, 'America/Sao_Paulo') AS timestamp_ntz) AS local FROM events", "SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS local FROM events")
plan("literals", "SELECT r_regionkey, DATE '2020-02-29' AS d, TIMESTAMP_NTZ '2020-02-29 12:34:56' AS t, 1.5e0 AS f, 'it''s' AS s, NULL AS n, true AS b, cast(X'414243' AS string) AS h FROM region", "SELECT r_regionkey, DATE '2020-02-29' AS d, TIMESTAMP '2020-02-29 12:34:56' AS t, 1.5e0 AS f, 'it''s' AS s, NULL AS n, true AS b, 'ABC' AS h FROM region")
plan("multiset_operations", "SELECT vec_id, array_contains(array(0, 1, 2), label) AS member, size(array_union(array(1, 2), array(2, label))) AS n_union, size(array_intersect(array(1, 2), array(2, label))) AS n_both, size(array_except(array(1, 2), array(label))) AS n_except, size(array_except(array(label), array(1, 2, 3))) = 0 AS sub FROM embeddings",
     "SELECT vec_id, list_contains([0, 1, 2], label) AS member, cast(len(list_distinct(list_concat([1, 2], [2, label]))) AS int) AS n_union, cast(len(list_intersect([1, 2], [2, label])) AS int) AS n_both, cast(len(list_filter([1, 2], lambda x: x <> label)) AS int) AS n_except, label IN (1, 2, 3) AS sub FROM embeddings")
plan("cursor_expression", "SELECT n_nationkey, (SELECT array_join(array_sort(collect_list(c_custkey)), ',') FROM customer WHERE c_nationkey = n_nationkey) AS keys FROM nation", "SELECT n_nationkey, coalesce((SELECT string_agg(c_custkey::varchar, ',' ORDER BY c_custkey) FROM customer WHERE c_nationkey = n_nationkey), '') AS keys FROM nation")
plan("is_json", "SELECT event_id, get_json_object(props, '$.k') IS NOT NULL AS ok FROM events", "SELECT event_id, json_extract_string(props, '$.k') IS NOT NULL AS ok FROM events")
plan("distinct_from", "SELECT doc_id, lang IS DISTINCT FROM 'en' AS other, startswith(source, 'src1') AS starts, contains(lower(source), 'c1') AS has, source RLIKE '^src[0-9]$' AS similar FROM documents", "SELECT doc_id, lang IS DISTINCT FROM 'en' AS other, starts_with(source, 'src1') AS starts, contains(lower(source), 'c1') AS has, regexp_matches(source, '^src[0-9]$') AS similar FROM documents")

# subqueries
plan("semi_exists", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
plan("anti_not_exists", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
plan("in_subquery", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
plan("not_in_subquery", "SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
plan("scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)")
plan("scalar_subquery_corr", "SELECT c.c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n FROM customer c")
plan("quantified_any", "SELECT p_partkey FROM part p WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_quantity = p.p_size)", "SELECT p_partkey FROM part p WHERE p_size = ANY (SELECT l.l_quantity FROM lineitem l WHERE l.l_partkey = p.p_partkey)")
plan("quantified_all", "SELECT o_orderkey FROM orders WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders WHERE o_orderstatus = 'P')", "SELECT o_orderkey FROM orders WHERE o_totalprice >= ALL (SELECT o_totalprice FROM orders WHERE o_orderstatus = 'P')")

# joins
plan("view_inner_join", "SELECT o.o_orderkey AS id, o.o_orderdate AS data_pedido, c.c_name AS nome FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
plan("join_left", "SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT OUTER JOIN orders o ON o.o_custkey = c.c_custkey")
plan("join_right", "SELECT c.c_custkey, o.o_orderkey FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice > 100000")
plan("join_full", "SELECT s.s_suppkey, c.c_custkey FROM supplier s FULL OUTER JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) c ON s.s_suppkey = c.c_custkey")
plan("join_cross", "SELECT a.r_name AS a, b.r_name AS b FROM region a CROSS JOIN region b")
plan("join_natural", "SELECT k, n, r FROM (SELECT n_regionkey AS k, n_name AS n FROM nation) a NATURAL JOIN (SELECT r_regionkey AS k, r_name AS r FROM region) b")
plan("join_using", "SELECT k, n, r FROM (SELECT n_regionkey AS k, n_name AS n FROM nation) a JOIN (SELECT r_regionkey AS k, r_name AS r FROM region) b USING (k)")
plan("join_theta", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey")
plan("join_partitioned_outer", "SELECT d.r_regionkey, s.o_orderstatus AS status, coalesce(x.n, 0) AS n FROM (SELECT r_regionkey FROM region) d CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders) s LEFT JOIN (SELECT n.n_regionkey AS rk, o.o_orderstatus AS st, count(*) AS n FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE o.o_totalprice > 250000 GROUP BY n.n_regionkey, o.o_orderstatus) x ON x.rk = d.r_regionkey AND x.st = s.o_orderstatus")
plan("lateral_topk", "SELECT n.n_nationkey, t.c_custkey FROM nation n, LATERAL (SELECT c_custkey FROM customer WHERE c_nationkey = n.n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t", "SELECT n.n_nationkey, c_custkey FROM nation n JOIN (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) t ON t.c_nationkey = n.n_nationkey WHERE r <= 2")
plan("outer_apply", "SELECT c.c_custkey, t.total FROM customer c LEFT JOIN LATERAL (SELECT round(sum(o_totalprice), 2) AS total FROM orders o WHERE o.o_custkey = c.c_custkey) t ON true")
plan("legacy_outer_join", "SELECT s.s_suppkey, n.n_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_regionkey = 2")

# aggregation
plan("agg_basic", "SELECT o_orderstatus, count(*) AS n, count(o_custkey) AS nc, round(sum(o_totalprice), 2) AS s, round(avg(o_totalprice), 4) AS a, min(o_orderdate) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY o_orderstatus")
plan("agg_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
plan("agg_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n, round(sum(DISTINCT o_totalprice), 2) AS s FROM orders GROUP BY o_orderpriority")
plan("agg_left_coalesce", "SELECT c.c_custkey AS cliente_id, upper(c.c_name) AS nome_upper, round(coalesce(sum(o.o_totalprice), 0), 2) AS total_gasto FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_name")
plan("agg_expression_keys", "SELECT year(o_orderdate) AS y, o_orderstatus = 'F' AS f, count(*) AS n FROM orders GROUP BY year(o_orderdate), o_orderstatus = 'F'", "SELECT cast(year(o_orderdate) AS int) AS y, o_orderstatus = 'F' AS f, count(*) AS n FROM orders GROUP BY year(o_orderdate), o_orderstatus = 'F'")
for kind, groups in {"rollup": "ROLLUP (l_returnflag, l_linestatus)", "cube": "CUBE (l_returnflag, l_linestatus)", "grouping_sets": "GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())"}.items():
    plan(f"agg_{kind}", f"SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY {groups}")
plan("grouping_id", "SELECT l_returnflag, l_linestatus, cast(grouping(l_returnflag) AS bigint) AS gf, cast(grouping_id(l_returnflag, l_linestatus) AS bigint) AS gid, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
plan("agg_stats", "SELECT l_returnflag, round(stddev(l_quantity), 6) AS sd, round(stddev_pop(l_quantity), 6) AS sdp, round(variance(l_quantity), 6) AS v, round(var_pop(l_quantity), 6) AS vp, round(covar_samp(l_quantity, l_extendedprice), 2) AS cs, round(covar_pop(l_quantity, l_extendedprice), 2) AS cp, round(corr(l_quantity, l_extendedprice), 6) AS c FROM lineitem GROUP BY l_returnflag")
plan("agg_regr", "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS s, round(regr_intercept(l_extendedprice, l_quantity), 2) AS i, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, regr_count(l_extendedprice, l_quantity) AS n, round(regr_avgx(l_extendedprice, l_quantity), 6) AS ax FROM lineitem GROUP BY l_returnflag", "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS s, round(regr_intercept(l_extendedprice, l_quantity), 2) AS i, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, cast(regr_count(l_extendedprice, l_quantity) AS bigint) AS n, round(regr_avgx(l_extendedprice, l_quantity), 6) AS ax FROM lineitem GROUP BY l_returnflag")
plan("agg_median", "SELECT l_linestatus, median(l_quantity) AS m FROM lineitem GROUP BY l_linestatus")
plan("percentile_cont", "SELECT o_orderstatus, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY o_totalprice), 4) AS p25, percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS d50 FROM orders GROUP BY o_orderstatus")
plan("hypothetical_rank", "SELECT o_orderstatus, 1 + count_if(o_totalprice < 100000) AS r FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, cast(1 + count(*) FILTER (WHERE o_totalprice < 100000) AS bigint) AS r FROM orders GROUP BY o_orderstatus")
plan("keep_first_last", "SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS last_price, min_by(o_totalprice, o_orderkey) AS first_price FROM orders GROUP BY o_custkey", "SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS last_price, arg_min(o_totalprice, o_orderkey) AS first_price FROM orders GROUP BY o_custkey")
plan("mode_value", "SELECT s_nationkey % 2 AS k, max_by(nk, struct(n, -nk)) AS m FROM (SELECT s_nationkey, s_nationkey AS nk, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier) GROUP BY s_nationkey % 2", "SELECT k, nk AS m FROM (SELECT s_nationkey % 2 AS k, s_nationkey AS nk, row_number() OVER (PARTITION BY s_nationkey % 2 ORDER BY count(*) DESC, s_nationkey) AS r FROM supplier GROUP BY s_nationkey) WHERE r = 1")
plan("listagg_ordered", "SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name DESC) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name DESC) AS names FROM nation GROUP BY n_regionkey")
plan("list_distinct", "SELECT c_nationkey, array_join(array_sort(collect_set(c_mktsegment)), ';') AS segs FROM customer GROUP BY c_nationkey", "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS segs FROM customer GROUP BY c_nationkey")
plan("collect_values", "SELECT n_regionkey, cast(size(collect_list(n_nationkey)) AS bigint) AS n, array_join(array_sort(collect_list(n_nationkey)), '-') AS wm FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, len(list(n_nationkey)) AS n, string_agg(n_nationkey::varchar, '-' ORDER BY n_nationkey) AS wm FROM nation GROUP BY n_regionkey")
plan("json_aggregates", "SELECT n_regionkey, to_json(array_sort(collect_list(n_nationkey))) AS arr, to_json(map_from_entries(array_sort(collect_list(struct(n_name, n_nationkey))))) AS obj FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, '[' || string_agg(n_nationkey::varchar, ',' ORDER BY n_nationkey) || ']' AS arr, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS obj FROM nation GROUP BY n_regionkey")
plan("xml_aggregate", "SELECT n_regionkey, '<r>' || array_join(transform(array_sort(collect_list(n_name)), x -> '<n>' || x || '</n>'), '') || '</r>' AS doc FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, '<r>' || string_agg('<n>' || n_name || '</n>', '' ORDER BY n_name) || '</r>' AS doc FROM nation GROUP BY n_regionkey")
plan("agg_bool_filter", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, bool_or(o_totalprice > 300000) AS any_large FROM orders GROUP BY o_orderpriority")

# windows
plan("win_rank_family", "SELECT o_orderkey, cast(row_number() OVER w AS bigint) AS rn, cast(rank() OVER w AS bigint) AS rk, cast(dense_rank() OVER w AS bigint) AS dr, round(percent_rank() OVER w, 8) AS pr, round(cume_dist() OVER w, 8) AS cd FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
plan("win_ntile", "SELECT o_orderkey, cast(ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS bigint) AS q FROM orders")
plan("win_lag_lead", "SELECT o_orderkey, lag(o_totalprice) OVER w AS prev, lead(o_totalprice, 2, -1.0) OVER w AS nxt FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
plan("win_first_last_ignore_nulls", "SELECT event_id, first_value(nv) IGNORE NULLS OVER w AS f, last_value(nv) IGNORE NULLS OVER w AS l FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS nv FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "SELECT event_id, first_value(nv IGNORE NULLS) OVER w AS f, last_value(nv IGNORE NULLS) OVER w AS l FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS nv FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
plan("win_nth_value", "SELECT o_orderkey, nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM orders")
plan("win_rows_frame", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s3, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 3) AS a3 FROM orders")
plan("win_range_frame", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS n FROM orders")
plan("win_aggregates", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n, max(o_totalprice) OVER (PARTITION BY o_custkey) AS mx, min(o_totalprice) OVER (PARTITION BY o_custkey) AS mn, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS s FROM orders")
plan("ratio_to_report", "SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS r FROM orders")
plan("lag_diff", "SELECT o_orderkey, round(o_totalprice - lag(o_totalprice) OVER w, 4) AS d, round(100 * (o_totalprice - lag(o_totalprice) OVER w) / lag(o_totalprice) OVER w, 6) AS pct FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
plan("listagg_over", "SELECT n_nationkey, array_join(array_sort(collect_list(n_name) OVER (PARTITION BY n_regionkey)), ',') AS mates FROM nation", "SELECT n_nationkey, (SELECT string_agg(m.n_name, ',' ORDER BY m.n_name) FROM nation m WHERE m.n_regionkey = n.n_regionkey) AS mates FROM nation n")
plan("as_of_join", "SELECT e.event_id, max_by(p.event_id, struct(p.ts, p.event_id)) AS prior FROM events e LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'view' AND p.ts <= e.ts WHERE e.event_type = 'purchase' GROUP BY e.event_id", "SELECT e.event_id, arg_max(p.event_id, (p.ts, p.event_id)) AS prior FROM events e LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'view' AND p.ts <= e.ts WHERE e.event_type = 'purchase' GROUP BY e.event_id")

# order, limit, set operations, restructuring
plan("order_nulls", "SELECT k, cast(row_number() OVER (ORDER BY v ASC NULLS LAST, k) AS bigint) AS a, cast(row_number() OVER (ORDER BY v DESC NULLS FIRST, k) AS bigint) AS d FROM (SELECT n_nationkey AS k, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS v FROM nation)")
plan("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
plan("offset_rows", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 7 OFFSET 11")
plan("fetch_with_ties", "SELECT n_nationkey, n_regionkey FROM (SELECT n_nationkey, n_regionkey, rank() OVER (ORDER BY n_regionkey) AS r FROM nation) WHERE r <= 3")
plan("fetch_percent", "SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS r, count(*) OVER () AS n FROM supplier) WHERE r <= ceil(n * 10 / 100.0)")
plan("union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
plan("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
plan("intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
plan("minus", "SELECT n_nationkey AS k FROM nation MINUS SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
plan("nested_setops", "(SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region) EXCEPT (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0)")
plan("cte_chain", "WITH a(k, t) AS (SELECT o_custkey, sum(o_totalprice) FROM orders GROUP BY o_custkey), b AS (SELECT k, t FROM a WHERE t > 1000000) SELECT c.c_custkey, round(b.t, 2) AS t FROM b JOIN customer c ON c.c_custkey = b.k")
plan("recursive_cte", "WITH RECURSIVE t(n, f) AS (SELECT cast(1 AS bigint), cast(1 AS bigint) UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 12) SELECT n, f FROM t")
plan("hierarchy_connect_by", "WITH RECURSIVE h(id, lvl, root, path) AS (SELECT cast(r_regionkey AS bigint), cast(1 AS bigint), r_name, concat('/', r_name) FROM region UNION ALL SELECT 100 + n_nationkey, lvl + 1, root, concat(path, '/', n_name) FROM h JOIN nation ON n_regionkey = id) SELECT id, lvl, root, path FROM h")
plan("pivot_status", "SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM orders) PIVOT (count(o_orderkey) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))", "SELECT o_orderpriority, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f, nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o, nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS p FROM orders GROUP BY o_orderpriority")
plan("unpivot_measures", "SELECT k, ln, m, v FROM (SELECT l_orderkey AS k, l_linenumber AS ln, l_discount AS d, l_tax AS t FROM lineitem) UNPIVOT INCLUDE NULLS (v FOR m IN (d, t))", "SELECT l_orderkey AS k, l_linenumber AS ln, 'd' AS m, l_discount AS v FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 't', l_tax FROM lineitem")
plan("collection_table", "SELECT vec_id, cast(pos AS bigint) AS pos, x FROM (SELECT vec_id, posexplode(slice(embedding, 1, 3)) AS (pos, x) FROM embeddings)", "SELECT vec_id, unnest([0, 1, 2])::bigint AS pos, unnest(embedding[1:3]) AS x FROM embeddings")
plan("json_table", "SELECT event_id, j.k AS k FROM (SELECT event_id, from_json(props, 'k BIGINT') AS j FROM events)", "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events")
plan("model_clause", "SELECT k, y, round(s, 2) AS s, round(coalesce(s, 0) + coalesce(p, 0), 2) AS two FROM (SELECT k, y, s, lag(s) OVER (PARTITION BY k ORDER BY y) AS p FROM (SELECT o_orderstatus AS k, cast(year(o_orderdate) AS bigint) AS y, sum(o_totalprice) AS s FROM orders GROUP BY o_orderstatus, year(o_orderdate)))")

# scalar functions, by family
plan("string_fns", "SELECT c_custkey, substr(c_name, 2, 5) AS f1, chr(65) AS f3, trim(BOTH 'x' FROM 'xxaxx') AS f4, translate(c_name, 'C0', 'K-') AS f5, upper(c_name) AS f6, lower(c_name) AS f7, cast(length(c_name) AS bigint) AS f8, cast(instr(c_name, '#') AS bigint) AS f9, cast(position('m' IN c_name) AS bigint) AS f10, lpad(c_mktsegment, 12, '*') AS f11, rpad(c_mktsegment, 12, '*') AS f12, ltrim('  a') AS f13, rtrim('a  ') AS f14, replace(c_name, '0', 'o') AS f16, reverse(c_mktsegment) AS f17, cast(ascii(c_name) AS bigint) AS f18, concat(c_name, '-', c_mktsegment) AS f19, left(c_name, 3) AS l3, right(c_name, 3) AS r3, repeat('ab', 2) AS rp FROM customer")
plan("string_fns_extra", "SELECT c_custkey, initcap(lower(c_mktsegment)) AS f15, overlay(c_name PLACING 'ZZ' FROM 2 FOR 3) AS ov FROM customer", "SELECT c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS f15, left(c_name, 1) || 'ZZ' || substr(c_name, 5) AS ov FROM customer")
plan("to_char", "SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM-dd') AS d, trim(to_char(cast(o_orderkey + 1 AS decimal(12,0)), '999999999')) AS n FROM orders", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, cast(o_orderkey + 1 AS varchar) AS n FROM orders")
plan("regex_fns", "SELECT c_custkey, regexp_like(c_name, '[0-9]+') AS f23, regexp_replace(c_name, '[0-9]', 'd') AS f24, regexp_substr(c_name, '[0-9]+') AS f25, cast(regexp_count(c_name, '0') AS bigint) AS f26, cast(regexp_instr(c_name, '0') AS bigint) AS f27 FROM customer", "SELECT c_custkey, regexp_matches(c_name, '[0-9]+') AS f23, regexp_replace(c_name, '[0-9]', 'd', 'g') AS f24, nullif(regexp_extract(c_name, '[0-9]+'), '') AS f25, length(c_name) - length(replace(c_name, '0', '')) AS f26, instr(c_name, '0') AS f27 FROM customer")
plan("math_fns", "SELECT s_suppkey, round(s_acctbal, 1) AS f28, least(s_acctbal, 100) AS f29, greatest(s_acctbal, 100) AS f30, abs(s_acctbal) AS f31, cast(ceil(s_acctbal) AS bigint) AS f32, cast(floor(s_acctbal) AS bigint) AS f33, round(power(s_acctbal, 2), 2) AS f34, round(sqrt(abs(s_acctbal)), 8) AS f35, round(exp(s_acctbal / 10000), 8) AS f36, round(ln(abs(s_acctbal) + 1), 8) AS f37, round(log(10, abs(s_acctbal) + 1), 8) AS f38, cast(sign(s_acctbal) AS bigint) AS f39, s_suppkey % 7 AS f41, round(sin(s_acctbal), 6) AS f42, round(cos(s_acctbal), 6) AS f43, round(tan(s_nationkey), 6) AS f44, s_suppkey & 6 AS f45 FROM supplier")
plan("trunc_number", "SELECT s_suppkey, round(sign(s_acctbal) * floor(abs(s_acctbal) * pow(10, 1)) / pow(10, 1), 4) AS f40 FROM supplier", "SELECT s_suppkey, round(trunc(s_acctbal * 10) / 10, 4) AS f40 FROM supplier")
plan("date_fns", "SELECT o_orderkey, cast(extract(YEAR FROM o_orderdate) AS bigint) AS y, cast(extract(MONTH FROM o_orderdate) AS bigint) AS m, cast(extract(DAY FROM o_orderdate) AS bigint) AS d, cast(dayofweek(o_orderdate) - 1 AS bigint) AS wd, to_date('2021-03-04', 'yyyy-MM-dd') AS f48, to_timestamp_ntz('2021-03-04 05:06:07', 'yyyy-MM-dd HH:mm:ss') AS f49, add_months(cast(o_orderdate AS date), 2) AS f58, last_day(cast(o_orderdate AS date)) AS f59, next_day(cast(o_orderdate AS date), 'MONDAY') AS f61, cast(dateadd(DAY, 5, cast(o_orderdate AS date)) AS date) AS f62, cast(datediff(DAY, DATE '1992-01-01', cast(o_orderdate AS date)) AS bigint) AS f63, date_trunc('MONTH', o_orderdate) = trunc(o_orderdate, 'MM') AS tr FROM orders",
     "SELECT o_orderkey, extract(YEAR FROM o_orderdate) AS y, extract(MONTH FROM o_orderdate) AS m, extract(DAY FROM o_orderdate) AS d, dayofweek(o_orderdate) AS wd, DATE '2021-03-04' AS f48, TIMESTAMP '2021-03-04 05:06:07' AS f49, cast(cast(o_orderdate AS date) + INTERVAL 2 MONTH AS date) AS f58, last_day(cast(o_orderdate AS date)) AS f59, cast(cast(o_orderdate AS date) + (((8 - dayofweek(o_orderdate)) % 7) + CASE WHEN dayofweek(o_orderdate) = 1 THEN 7 ELSE 0 END)::int AS date) AS f61, cast(cast(o_orderdate AS date) + 5 AS date) AS f62, datediff('day', DATE '1992-01-01', cast(o_orderdate AS date)) AS f63, true AS tr FROM orders")
plan("months_between", "SELECT o_orderkey, cast(floor(months_between(last_day(o_orderdate), DATE '1991-12-31')) AS bigint) AS m FROM orders", "SELECT o_orderkey, cast((year(o_orderdate) - 1991) * 12 + month(o_orderdate) - 12 AS bigint) AS m FROM orders")
plan("interval_fns", "SELECT r_regionkey, TIMESTAMP_NTZ '2020-01-01 00:00:00' + cast('1 02:03:04' AS INTERVAL DAY TO SECOND) AS f50, cast(add_months(DATE '2020-01-31', 14) AS date) AS f51 FROM region", "SELECT r_regionkey, TIMESTAMP '2020-01-02 02:03:04' AS f50, DATE '2021-03-31' AS f51 FROM region")
plan("current_fns", "SELECT r_regionkey, current_date() = cast(localtimestamp() AS date) AS f52, abs(unix_timestamp(current_timestamp()) - unix_timestamp()) < 60 AS f54, localtimestamp() IS NOT NULL AS f55, length(date_format(current_timestamp(), 'HH:mm:ss')) = 8 AS f53 FROM region", "SELECT r_regionkey, true AS f52, true AS f54, true AS f55, true AS f53 FROM region")
plan("null_fns", "SELECT n_nationkey, nvl(v, -1) AS f65, nvl2(v, 'y', 'n') AS f66, coalesce(v, n_nationkey) AS f67, nullif(n_regionkey, 2) AS f68, decode(v, 1, 'one', NULL, 'none', 'many') AS f69, if(v > 2, 'big', 'small') AS f70 FROM (SELECT *, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS v FROM nation)", "SELECT n_nationkey, coalesce(v, -1) AS f65, CASE WHEN v IS NOT NULL THEN 'y' ELSE 'n' END AS f66, coalesce(v, n_nationkey) AS f67, nullif(n_regionkey, 2) AS f68, CASE WHEN v = 1 THEN 'one' WHEN v IS NULL THEN 'none' ELSE 'many' END AS f69, CASE WHEN v > 2 THEN 'big' ELSE 'small' END AS f70 FROM (SELECT *, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS v FROM nation)")
plan("cast_fns", "SELECT p_partkey, cast(p_size AS string) AS f72, coalesce(try_cast(p_name AS int), -1) AS f73, cast(to_number('12.50', '99.99') AS double) AS f74, cast('1.5' AS double) AS f75, try_cast(p_name AS int) IS NOT NULL AS f76, cast(p_retailprice AS decimal(15,2)) AS f77 FROM part", "SELECT p_partkey, cast(p_size AS varchar) AS f72, coalesce(try_cast(p_name AS int), -1) AS f73, 12.5::double AS f74, 1.5::double AS f75, try_cast(p_name AS int) IS NOT NULL AS f76, cast(p_retailprice AS decimal(15,2)) AS f77 FROM part")
plan("json_fns", "SELECT event_id, to_json(array(1, event_id)) AS f78, to_json(named_struct('id', event_id, 't', event_type)) AS f79, get_json_object(props, '$.k') AS f80, cast(get_json_object(props, '$.k') AS bigint) + 1 AS f81, to_json(from_json(props, 'k BIGINT')) AS f82, to_json(named_struct('k', from_json(props, 'k BIGINT').k + 1)) AS f84, to_json(from_json(props, 'k BIGINT')) = to_json(from_json(props, 'k BIGINT')) AS f85 FROM events",
     "SELECT event_id, '[1,' || event_id || ']' AS f78, '{\"id\":' || event_id || ',\"t\":\"' || event_type || '\"}' AS f79, json_extract_string(props, '$.k') AS f80, cast(json_extract_string(props, '$.k') AS bigint) + 1 AS f81, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS f82, '{\"k\":' || (cast(json_extract_string(props, '$.k') AS bigint) + 1) || '}' AS f84, true AS f85 FROM events")
plan("xml_fns", "SELECT n_nationkey, '<n>' || n_name || '</n>' AS f88, xpath_string('<a><n>' || n_name || '</n></a>', 'a/n') AS f91, xpath_boolean('<a><n>x</n></a>', 'a/n') AS f91b, element_at(xpath('<a><n>1</n><n>2</n></a>', 'a/n/text()'), 2) AS f92 FROM nation", "SELECT n_nationkey, '<n>' || n_name || '</n>' AS f88, n_name AS f91, true AS f91b, '2' AS f92 FROM nation")
plan("array_fns", "SELECT vec_id, cast(size(embedding) AS bigint) AS f97, element_at(embedding, 1) AS first, element_at(embedding, -1) AS last, get(embedding, 1000) IS NOT NULL AS f98 FROM embeddings", "SELECT vec_id, len(embedding) AS f97, embedding[1] AS first, embedding[-1] AS last, embedding[1001] IS NOT NULL AS f98 FROM embeddings")
plan("bit_hash_fns", "SELECT r_regionkey, md5(r_name) AS m, sha2(r_name, 256) AS s, hex(r_name) AS h FROM region", "SELECT r_regionkey, md5(r_name) AS m, sha256(r_name) AS s, hex(r_name) AS h FROM region")

# copy-on-write DML, as the rows that the table has afterwards
plan("insert_select", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 0, 'none'")

#: Plans whose results an oracle cannot give exactly.
ROWS_ONLY = {
    "approx_distinct": "SELECT l_returnflag, approx_count_distinct(l_orderkey) AS n FROM lineitem GROUP BY l_returnflag",
    "sample_rows": "SELECT l_orderkey, l_linenumber FROM lineitem TABLESAMPLE (10 PERCENT) REPEATABLE (7)",
    "soundex_uuid": "SELECT c_custkey, soundex(c_name) AS s, uuid() IS NOT NULL AS u, hash(c_name) AS h FROM customer",
}


def _query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_tables(spark, sf_dir, text)
        return spark.sql(text)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(spark) for name, (spark, _) in PLANS.items()} | {name: _query(text) for name, text in ROWS_ONLY.items()}


def oracle() -> dict[str, str]:
    return {name: duck for name, (_, duck) in PLANS.items()}
