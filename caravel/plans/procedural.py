"""Plans through the translator, the row hooks, copy-on-write DML, the loader, the catalog and event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog.extract import Catalog
from ..dialect import translate
from ..dialect.parser import parse_script
from ..operators import constraints, dml
from ..operators.sequences import Sequences
from ..operators.triggers import apply_hooks, compile_trigger
from ..sources.loader import Report, from_parquet, load, sanitized, tables_of
from ..streaming import windows
from .relational import use_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plan(name: str, run: Query, oracle: str | None = None) -> None:
    QUERIES[name] = run
    if oracle:
        ORACLE[name] = oracle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_three(spark: SparkSession, sf_dir: str) -> Report:
    """A load of three tables and one whose source is not there; rows are counted, not written."""
    frames = {n: table(spark, sf_dir, n) for n in ("nation", "region", "customer")}
    tables = [*tables_of(frames), *tables_of({"absent": frames["nation"]})]
    return load(spark, tables, from_parquet(spark, sf_dir), lambda t, df: df.count())


def legacy(text: str, integers: tuple[str, ...] = (), **values: str) -> Query:
    """A script of the dialect whose last object or query gives the rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_tables(spark, sf_dir, text)
        df = None
        for t in translate(text, integers, values):
            if t.sql:
                df = spark.sql(t.sql)
                df = spark.table(t.name) if t.kind == "VIEW" else df
        return df

    return run


# views and queries in the dialect
plan("legacy_view_summary", legacy("""
    CREATE OR ALTER VIEW VW_RESUMO AS
    SELECT C.C_CUSTKEY AS CLIENTE_ID, UPPER(C.C_NAME) AS NOME_UPPER, COALESCE(SUM(O.O_TOTALPRICE), 0) AS TOTAL_GASTO
    FROM CUSTOMER C LEFT JOIN ORDERS O ON O.O_CUSTKEY = C.C_CUSTKEY GROUP BY C.C_CUSTKEY, C.C_NAME;
    SELECT FIRST 10 CLIENTE_ID AS cliente_id, NOME_UPPER AS nome_upper, ROUND(TOTAL_GASTO, 2) AS total_gasto FROM VW_RESUMO ORDER BY TOTAL_GASTO DESC, CLIENTE_ID;"""),
     "SELECT c_custkey AS cliente_id, upper(c_name) AS nome_upper, round(coalesce(sum(o_totalprice), 0), 2) AS total_gasto FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name ORDER BY coalesce(sum(o_totalprice), 0) DESC, cliente_id LIMIT 10")
plan("first_skip", legacy("SELECT FIRST 10 SKIP 20 o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey"), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20")
plan("rows_to", legacy("SELECT o_orderkey FROM orders ORDER BY o_orderkey ROWS 3 TO 9"), "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 7 OFFSET 2")
plan("skip_only", legacy("SELECT SKIP 20 n_nationkey FROM nation ORDER BY n_nationkey"), "SELECT n_nationkey FROM nation ORDER BY n_nationkey OFFSET 20")
plan("system_table", legacy("SELECT 1 + 1 AS two, UPPER('a') AS a FROM RDB$DATABASE"), "SELECT 2 AS two, 'A' AS a")
plan("legacy_int_division", legacy("SELECT l_orderkey, l_linenumber, CAST(l_orderkey / 7 AS BIGINT) AS q, l_quantity / 2 AS h FROM lineitem", ("l_orderkey", "l_linenumber")), "SELECT l_orderkey, l_linenumber, l_orderkey // 7 AS q, l_quantity / 2 AS h FROM lineitem")
plan("starting_containing", legacy("SELECT c_custkey, IIF(c_acctbal > 0, 'pos', 'neg') AS sign FROM customer WHERE c_name STARTING WITH 'Cust' AND c_mktsegment CONTAINING 'build' AND c_custkey ^= 3"), "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'pos' ELSE 'neg' END AS sign FROM customer WHERE starts_with(c_name, 'Cust') AND contains(lower(c_mktsegment), 'build') AND c_custkey <> 3")
plan("legacy_with_ties", legacy("SELECT n_nationkey, n_regionkey FROM nation ORDER BY n_regionkey FETCH FIRST 3 ROWS WITH TIES"), "SELECT n_nationkey, n_regionkey FROM (SELECT *, rank() OVER (ORDER BY n_regionkey) AS r FROM nation) WHERE r <= 3")
plan("legacy_extract_weekday", legacy("SELECT o_orderkey, CAST(EXTRACT(WEEKDAY FROM o_orderdate) AS BIGINT) AS wd, TRUNC(o_totalprice, 1) AS t FROM orders"), "SELECT o_orderkey, dayofweek(o_orderdate) AS wd, trunc(o_totalprice * 10) / 10 AS t FROM orders")
plan("legacy_quantified", legacy("SELECT s_suppkey FROM supplier WHERE s_acctbal > ALL (SELECT c_acctbal / 2 FROM customer WHERE c_nationkey = 3) AND s_nationkey = ANY (SELECT FIRST 20 n_nationkey FROM nation ORDER BY n_nationkey)"), "SELECT s_suppkey FROM supplier WHERE s_acctbal > (SELECT max(c_acctbal) / 2 FROM customer WHERE c_nationkey = 3) AND s_nationkey < 20")
plan("legacy_singular", legacy("SELECT r_name FROM region WHERE SINGULAR (SELECT 1 FROM nation WHERE n_nationkey = 7 AND n_nationkey > 0)"), "SELECT r_name FROM region")
plan("legacy_connect_by", (lambda spark, d: (spark.sql("SELECT n_nationkey AS id, CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey DIV 3 END AS boss FROM parquet.`" + d + "/nation.parquet`").createOrReplaceTempView("emp"), legacy("SELECT id, level FROM emp WHERE id <> 5 START WITH boss IS NULL CONNECT BY PRIOR id = boss")(spark, d))[1]), "WITH RECURSIVE e AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey // 3 END AS boss FROM nation), h AS (SELECT id, 1 AS level FROM e WHERE boss IS NULL UNION ALL SELECT e.id, level + 1 FROM h JOIN e ON e.boss = h.id) SELECT id, level FROM h WHERE id <> 5")
plan("bind_variables", lambda spark, d: (use_tables(spark, d, "orders"), spark.sql("SELECT o_orderkey FROM orders WHERE o_totalprice > :low AND o_orderstatus = :st", args={"low": 150000, "st": "F"}))[1], "SELECT o_orderkey FROM orders WHERE o_totalprice > 150000 AND o_orderstatus = 'F'")

# constructs that Spark SQL writes otherwise
plan("legacy_formats", legacy("SELECT o_orderkey, TO_CHAR(o_orderdate, 'DD/MM/YYYY') AS d, TO_CHAR(o_orderdate, 'YYYY-DDD') AS j, TO_DATE(TO_CHAR(o_orderdate, 'YYYYMMDD'), 'YYYYMMDD') AS back, TO_CHAR(CAST(o_orderkey + 1 AS NUMERIC(12,0)), 'FM999999999') AS n FROM orders"), "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS d, strftime(o_orderdate, '%Y-%j') AS j, cast(o_orderdate AS date) AS back, cast(o_orderkey + 1 AS varchar) AS n FROM orders")
plan("legacy_marked_join", legacy("SELECT s.s_suppkey, n.n_name, r.r_name FROM supplier s, nation n, region r WHERE s.s_nationkey = n.n_nationkey(+) AND n.n_regionkey(+) = 2 AND n.n_regionkey = r.r_regionkey(+) AND s.s_acctbal BETWEEN 0 AND 5000"), "SELECT s.s_suppkey, n.n_name, r.r_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_regionkey = 2 LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE s.s_acctbal BETWEEN 0 AND 5000")
plan("legacy_keep", legacy("SELECT o_custkey, MAX(o_totalprice) KEEP (DENSE_RANK LAST ORDER BY o_orderdate) AS newest, MIN(o_totalprice) KEEP (DENSE_RANK FIRST ORDER BY o_orderdate) AS oldest FROM orders GROUP BY o_custkey"), "SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderdate = d1) AS newest, min(o_totalprice) FILTER (WHERE o_orderdate = d0) AS oldest FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS d1, min(o_orderdate) OVER (PARTITION BY o_custkey) AS d0 FROM orders) GROUP BY o_custkey")
plan("legacy_hypothetical_rank", legacy("SELECT o_orderstatus, RANK(100000) WITHIN GROUP (ORDER BY o_totalprice) AS r, DENSE_RANK(50) WITHIN GROUP (ORDER BY o_custkey DESC) AS dr FROM orders GROUP BY o_orderstatus"), "SELECT o_orderstatus, 1 + count(*) FILTER (WHERE o_totalprice < 100000) AS r, 1 + count(DISTINCT o_custkey) FILTER (WHERE o_custkey > 50) AS dr FROM orders GROUP BY o_orderstatus")
plan("legacy_apply", legacy("SELECT c.c_custkey, t.biggest FROM customer c OUTER APPLY (SELECT FIRST 1 o_totalprice AS biggest FROM orders o WHERE o.o_custkey = c.c_custkey ORDER BY o_totalprice DESC) t"), "SELECT c_custkey, max(o_totalprice) AS biggest FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
plan("legacy_multiset", legacy("SELECT vec_id, label MEMBER OF array(0, 1, 2) AS m, array(label, label) SUBMULTISET OF array(1, 1, 2) AS s, array_join(array(1, 1, 2) MULTISET EXCEPT array(1), ',') AS e, array_join(array(1, 1) MULTISET UNION DISTINCT array(2), ',') AS u FROM embeddings"), "SELECT vec_id, label IN (0, 1, 2) AS m, label = 1 AS s, '1,2' AS e, '1,2' AS u FROM embeddings")
plan("legacy_cursor_expression", legacy("SELECT n_nationkey, SIZE(CURSOR(SELECT c_custkey FROM customer WHERE c_nationkey = n_nationkey)) AS n FROM nation"), "SELECT n_nationkey, cast(count(c_custkey) AS int) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey")
plan("legacy_float_json_tests", legacy("SELECT event_id FROM events WHERE value IS NOT NAN AND NOT value IS INFINITE AND props IS JSON"), "SELECT event_id FROM events WHERE NOT isnan(value) AND NOT isinf(value) AND json_valid(props)")
plan("legacy_conversions", legacy("SELECT p_partkey, CAST(p_name AS INTEGER DEFAULT -1 ON CONVERSION ERROR) AS c, VALIDATE_CONVERSION(p_name AS INTEGER) AS v, TO_BINARY_DOUBLE('1.5') AS d, TIMESTAMP_NTZ '2020-01-01 00:00:00' + TO_DSINTERVAL('1 02:03:04') AS t FROM part"), "SELECT p_partkey, coalesce(try_cast(p_name AS int), -1) AS c, CASE WHEN try_cast(p_name AS int) IS NULL THEN 0 ELSE 1 END AS v, 1.5::double AS d, TIMESTAMP '2020-01-02 02:03:04' AS t FROM part")
plan("legacy_json", legacy("SELECT event_id, JSON_OBJECT('id' VALUE event_id, KEY 't' VALUE event_type) AS o, JSON_ARRAY(1, event_type, NULL) AS a, JSON_QUERY(props, '$.k') AS q, JSON_EXISTS(props, '$.zz') AS e FROM events"), "SELECT event_id, '{\"id\":' || event_id || ',\"t\":\"' || event_type || '\"}' AS o, '[1,\"' || event_type || '\"]' AS a, json_extract_string(props, '$.k') AS q, false AS e FROM events")
plan("legacy_json_table", legacy("SELECT e.event_id, j.k, j.n FROM events e, JSON_TABLE(e.props, '$' COLUMNS (k BIGINT PATH '$.k', n FOR ORDINALITY)) j"), "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k, 1 AS n FROM events")
plan("legacy_json_xml_aggregates", legacy('SELECT n_regionkey, JSON_ARRAYAGG(n_nationkey ORDER BY n_nationkey DESC) AS arr, XMLELEMENT("r", XMLAGG(XMLELEMENT("n", n_name) ORDER BY n_name)) AS doc, array_join(COLLECT(n_name ORDER BY n_name), \',\') AS names FROM nation GROUP BY n_regionkey'), "SELECT n_regionkey, '[' || string_agg(n_nationkey::varchar, ',' ORDER BY n_nationkey DESC) || ']' AS arr, '<r>' || string_agg('<n>' || n_name || '</n>', '' ORDER BY n_name) || '</r>' AS doc, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
plan("legacy_xml", legacy('SELECT n_nationkey, XMLFOREST(n_name AS "n", n_nationkey AS "k") AS f, XMLELEMENT("a", XMLATTRIBUTES(n_nationkey AS "id"), n_name || \'<&\') AS e, XMLPI(NAME "p", \'x\') AS i, XMLSERIALIZE(CONTENT XMLPARSE(CONTENT \'<a/>\' WELLFORMED) AS VARCHAR(10)) AS s FROM nation'), "SELECT n_nationkey, '<n>' || n_name || '</n><k>' || n_nationkey || '</k>' AS f, '<a id=\"' || n_nationkey || '\">' || n_name || '&lt;&amp;</a>' AS e, '<?p x?>' AS i, '<a/>' AS s FROM nation")
plan("legacy_lag_diff", legacy("SELECT o_orderkey, ROUND(LAG_DIFF(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 4) AS d FROM orders"), "SELECT o_orderkey, round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 4) AS d FROM orders")

# procedures
plan("proc_suspend_loop", legacy("""
    CREATE PROCEDURE P RETURNS (id BIGINT, nome VARCHAR(100)) AS
    BEGIN FOR SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 INTO :id, :nome DO BEGIN SUSPEND; END END"""),
     "SELECT c_custkey AS id, c_name AS nome FROM customer WHERE c_acctbal > 0")
plan("proc_filter_suspend", legacy("""
    CREATE PROCEDURE P RETURNS (k BIGINT, twice DOUBLE PRECISION) AS DECLARE VARIABLE price DOUBLE PRECISION;
    BEGIN FOR SELECT o_orderkey, o_totalprice FROM orders INTO :k, :price DO BEGIN twice = price * 2; IF (twice > 400000) THEN SUSPEND; END END"""),
     "SELECT o_orderkey AS k, o_totalprice * 2 AS twice FROM orders WHERE o_totalprice * 2 > 400000")
plan("proc_running_total", legacy("""
    CREATE PROCEDURE P RETURNS (k BIGINT, total BIGINT) AS DECLARE VARIABLE v BIGINT;
    BEGIN total = 0; FOR SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey INTO :k, :v DO BEGIN total = total + v; SUSPEND; END END"""),
     "SELECT o_orderkey AS k, cast(sum(o_custkey) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS bigint) AS total FROM orders")
plan("proc_singleton_preserve", legacy("""
    CREATE PROCEDURE P RETURNS (a INTEGER, b INTEGER) AS
    BEGIN a = 7; b = 7; SELECT n_nationkey FROM nation WHERE n_nationkey = -1 INTO :a; SELECT n_regionkey FROM nation WHERE n_nationkey = 3 INTO :b; SUSPEND; END"""),
     "SELECT 7 AS a, n_regionkey AS b FROM nation WHERE n_nationkey = 3")
plan("proc_while_leave", legacy("""
    CREATE PROCEDURE P RETURNS (i INTEGER) AS
    BEGIN i = 0; WHILE (i < 10) DO BEGIN i = i + 1; IF (i = 5) THEN LEAVE; END SUSPEND; END"""),
     "SELECT 5 AS i")
plan("proc_case_exit_handler", legacy("""
    CREATE PROCEDURE P RETURNS (state VARCHAR(20)) AS DECLARE VARIABLE n INTEGER = 3;
    BEGIN state = CASE WHEN n > 2 THEN 'many' ELSE 'few' END; IF (n > 100) THEN EXCEPTION TOO_MANY 'more than ' || n; SUSPEND; EXIT; state = 'unreached'; SUSPEND; END"""),
     "SELECT 'many' AS state")
plan("table_function", lambda spark, d: (use_tables(spark, d, "customer"), spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION caravel_rich(low DOUBLE) RETURNS TABLE (id BIGINT, bal DOUBLE) RETURN SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > low"), spark.sql("SELECT id, bal FROM caravel_rich(9000.0D)"))[2], "SELECT c_custkey AS id, c_acctbal AS bal FROM customer WHERE c_acctbal > 9000")


# sequences, triggers
def trigger_before_insert_seq(spark: SparkSession, d: str) -> DataFrame:
    hook = compile_trigger(parse_script("CREATE TRIGGER BI FOR CUSTOMER BEFORE INSERT AS BEGIN IF (NEW.ID IS NULL) THEN NEW.ID = GEN_ID(GEN_C, 1); NEW.NAME = UPPER(NEW.NAME); END")[0])
    rows = table(spark, d, "customer").select(F.struct(F.lit(None).cast("long").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("src")).alias("new"))
    out, _ = apply_hooks(rows, [hook], "INSERT", "BEFORE", Sequences({"gen_c": 100}), ["new.src"])
    return out.select("new.id", "new.name", "new.src")


plan("trigger_before_insert_seq", trigger_before_insert_seq, "SELECT 100 + row_number() OVER (ORDER BY c_custkey) AS id, upper(c_name) AS name, c_custkey AS src FROM customer")


def trigger_after_delete_audit(spark: SparkSession, d: str) -> DataFrame:
    hook = compile_trigger(parse_script("CREATE TRIGGER AD FOR ORDERS AFTER DELETE AS BEGIN IF (OLD.O_TOTALPRICE > 300000) THEN INSERT INTO AUDIT_LOG (TABELA, REGISTRO_ID) VALUES ('ORDERS', OLD.O_ORDERKEY); END")[0])
    gone = table(spark, d, "orders").where("o_orderstatus = 'F'")
    _, side = apply_hooks(gone.select(F.struct(*gone.columns).alias("old")), [hook], "DELETE", "AFTER")
    return side["audit_log"][0]


plan("trigger_after_delete_audit", trigger_after_delete_audit, "SELECT 'ORDERS' AS tabela, o_orderkey AS registro_id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000")


def trigger_before_update(spark: SparkSession, d: str) -> DataFrame:
    hook = compile_trigger(parse_script("CREATE TRIGGER BU FOR CUSTOMER BEFORE UPDATE AS BEGIN IF (NEW.C_ACCTBAL <> OLD.C_ACCTBAL) THEN NEW.C_MKTSEGMENT = 'CHANGED'; ELSE NEW.C_MKTSEGMENT = OLD.C_MKTSEGMENT || '!'; END")[0])
    c = table(spark, d, "customer")
    new = dml.update(c, {"c_acctbal": "c_acctbal + 1"}, "c_custkey % 2 = 0")
    old = F.struct(*[F.col(f"o.{x}") for x in c.columns]).alias("old")
    rows = new.alias("n").join(c.alias("o"), "c_custkey").select(F.struct(F.col("c_custkey"), *[F.col(f"n.{x}") for x in c.columns[1:]]).alias("new"), old)
    out, _ = apply_hooks(rows, [hook], "UPDATE", "BEFORE")
    return out.select("new.c_custkey", "new.c_mktsegment")


plan("trigger_before_update", trigger_before_update, "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CHANGED' ELSE c_mktsegment || '!' END AS c_mktsegment FROM customer")
plan("sequence_sync", lambda spark, d: spark.createDataFrame([("gen_orders", Sequences().synchronise("gen_orders", table(spark, d, "orders"), "o_orderkey")), ("gen_none", Sequences().synchronise("gen_none", table(spark, d, "orders").where("false"), "o_orderkey"))], "name string, last_value long"), "SELECT 'gen_orders' AS name, max(o_orderkey) AS last_value FROM orders UNION ALL SELECT 'gen_none', 1")


def sequence_steps(spark: SparkSession, d: str) -> DataFrame:
    s = Sequences({"g": 10})
    return spark.createDataFrame([("next", s.advance("g")), ("current", s.advance("g", 0)), ("by_five", s.advance("g", 5))], "step string, value long")


plan("sequence_steps", sequence_steps, "SELECT 'next' AS step, 11::bigint AS value UNION ALL SELECT 'current', 11 UNION ALL SELECT 'by_five', 16")

# copy-on-write DML
plan("update_cow", lambda spark, d: dml.update(table(spark, d, "customer"), {"c_acctbal": "c_acctbal * 2", "c_mktsegment": "lower(c_mktsegment)"}, "c_acctbal < 0").select("c_custkey", "c_acctbal", "c_mktsegment"), "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer")
plan("delete_cow", lambda spark, d: dml.delete(table(spark, d, "customer"), "c_acctbal < 1000").select("c_custkey"), "SELECT c_custkey FROM customer WHERE NOT c_acctbal < 1000")


def merge_cow(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "supplier").selectExpr("s_suppkey AS k", "s_acctbal AS v")
    s = table(spark, d, "customer").selectExpr("c_custkey + 50 AS k", "c_acctbal AS v").where("k < 160")
    return dml.merge(t, s, ["k"], matched={"v": "t.v + s.v"}, delete_when="s.v < 0", not_matched={"k": "s.k", "v": "s.v"})


plan("merge_cow", merge_cow, "WITH t AS (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier), s AS (SELECT c_custkey + 50 AS k, c_acctbal AS v FROM customer WHERE c_custkey + 50 < 160) SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NULL THEN s.v WHEN s.k IS NULL THEN t.v ELSE t.v + s.v END AS v FROM t FULL JOIN s ON t.k = s.k WHERE NOT coalesce(t.k IS NOT NULL AND s.v < 0, false)")


def update_or_insert(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "nation").selectExpr("n_nationkey AS k", "n_name AS v")
    s = spark.range(20, 30).selectExpr("cast(id AS int) AS k", "concat('new', id) AS v")
    return dml.update_or_insert(t, s, ["k"])


plan("update_or_insert", update_or_insert, "SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 20 UNION ALL SELECT i::int, 'new' || i FROM range(20, 30) t(i)")


def multi_insert(spark: SparkSession, d: str) -> DataFrame:
    parts = dml.multi_insert(table(spark, d, "orders"), [("o_totalprice > 200000", "large", {"k": "o_orderkey", "t": "'large'"}), ("o_totalprice > 100000", "middle", {"k": "o_orderkey", "t": "'middle'"}), ("true", "rest", {"k": "o_orderkey", "t": "'rest'"})], first=True)
    return parts["large"].union(parts["middle"]).union(parts["rest"])


plan("multi_insert", multi_insert, "SELECT o_orderkey AS k, CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'rest' END AS t FROM orders")

# constraints and loads
plan("uk_violations", lambda spark, d: constraints.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"]), "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
plan("fk_violations", lambda spark, d: constraints.missing_references(table(spark, d, "lineitem"), ["l_orderkey"], table(spark, d, "orders").where("o_totalprice < 200000"), ["o_orderkey"]), "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 200000)")
plan("check_violations", lambda spark, d: constraints.failed_check(table(spark, d, "customer"), "c_acctbal >= 0").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
plan("nul_sanitize", lambda spark, d: sanitized(table(spark, d, "customer").selectExpr("c_custkey", "concat(c_name, char(0), 'x') AS name", "c_acctbal")), "SELECT c_custkey, c_name || 'x' AS name, c_acctbal FROM customer")
plan("load_report", lambda spark, d: load_three(spark, d).summary(spark), "SELECT 3::bigint AS loaded, 1::bigint AS failed, cast((SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + (SELECT count(*) FROM customer) AS bigint) AS rows")


# the catalog, from rows that stand for a source's
def sample_catalog(spark: SparkSession) -> Catalog:
    make = spark.createDataFrame
    return Catalog.of({
        "relations": make([("CLIENTES  ", 0, None, None), ("ORDERS ", 0, None, None), ("VW_A", 0, b"x", "SELECT ID FROM CLIENTES"), ("RDB$X", 1, None, None)], "RELATION_NAME string, SYSTEM_FLAG int, VIEW_BLR binary, VIEW_SOURCE string"),
        "relation_fields": make([("CLIENTES", "ID ", "RDB$1", 1, None, 0), ("CLIENTES", "NOME", "RDB$2", None, "DEFAULT 'N/A'", 1), ("CLIENTES", "STATUS", "DOM_STATUS", None, None, 2), ("ORDERS", "ID", "RDB$1", 1, None, 0), ("ORDERS", "COMPANY_ID", "RDB$1", None, None, 1), ("ORDERS", "CLIENTE_ID", "RDB$1", None, None, 2), ("VW_A", "ID", "RDB$1", None, None, 0)], "RELATION_NAME string, FIELD_NAME string, FIELD_SOURCE string, NULL_FLAG int, DEFAULT_SOURCE string, FIELD_POSITION int"),
        "fields": make([("RDB$1", 8, 0, 4, None, 0, None, None, None, 0), ("RDB$2", 37, None, 100, None, 0, None, None, None, 0), ("DOM_STATUS", 37, None, 10, None, 0, 1, "DEFAULT 'A'", "CHECK (VALUE IN ('A', 'B'))", 0)], "FIELD_NAME string, FIELD_TYPE int, FIELD_SUB_TYPE int, FIELD_LENGTH int, FIELD_PRECISION int, FIELD_SCALE int, NULL_FLAG int, DEFAULT_SOURCE string, VALIDATION_SOURCE string, SYSTEM_FLAG int"),
        "relation_constraints": make([("PK_CLIENTES", "PRIMARY KEY", "CLIENTES", "PK_CLIENTES"), ("PK_ORDERS", "PRIMARY KEY", "ORDERS", "PK_ORDERS"), ("FK_O_C", "FOREIGN KEY", "ORDERS", "FK_O_C")], "CONSTRAINT_NAME string, CONSTRAINT_TYPE string, RELATION_NAME string, INDEX_NAME string"),
        "ref_constraints": make([("FK_O_C", "PK_CLIENTES")], "CONSTRAINT_NAME string, CONST_NAME_UQ string"),
        "indices": make([("PK_CLIENTES", "CLIENTES", 1, 0), ("PK_ORDERS", "ORDERS", 1, 0), ("FK_O_C", "ORDERS", 0, 0), ("IX_NOME", "CLIENTES", 0, 1)], "INDEX_NAME string, RELATION_NAME string, UNIQUE_FLAG int, INDEX_INACTIVE int"),
        "index_segments": make([("PK_CLIENTES", "ID", 0), ("PK_ORDERS", "COMPANY_ID", 1), ("PK_ORDERS", "ID", 0), ("FK_O_C", "CLIENTE_ID", 0), ("IX_NOME", "NOME", 0)], "INDEX_NAME string, FIELD_NAME string, FIELD_POSITION int"),
        "triggers": make([("BI_CLIENTES", "CLIENTES", 1, "AS BEGIN IF (NEW.ID IS NULL) THEN NEW.ID = GEN_ID(GEN_CLIENTES_ID, 1); END", 0), ("BI_ORDERS", "ORDERS", 1, "AS BEGIN -- NEW.ID = GEN_ID(OLD_GEN, 1)\n NEW.ID = NEXT VALUE FOR GEN_ORDERS; END", 0)], "TRIGGER_NAME string, RELATION_NAME string, TRIGGER_TYPE int, TRIGGER_SOURCE string, SYSTEM_FLAG int"),
        "procedures": make([("SP_A", "BEGIN FOR SELECT ID FROM CLIENTES WHERE ID > :P_MIN INTO :ID DO SUSPEND; END", 0)], "PROCEDURE_NAME string, PROCEDURE_SOURCE string, SYSTEM_FLAG int"),
        "procedure_parameters": make([("SP_A", "P_MIN", 0, 0, "RDB$1"), ("SP_A", "ID", 1, 0, "RDB$1")], "PROCEDURE_NAME string, PARAMETER_NAME string, PARAMETER_TYPE int, PARAMETER_NUMBER int, FIELD_SOURCE string"),
    })


plan("catalog_columns_join", lambda spark, d: sample_catalog(spark).columns().select("relation_name", "column", "nullable", "domain"), "SELECT * FROM (VALUES ('CLIENTES', 'ID', false, NULL), ('CLIENTES', 'NOME', true, NULL), ('CLIENTES', 'STATUS', false, 'DOM_STATUS'), ('ORDERS', 'ID', false, NULL), ('ORDERS', 'COMPANY_ID', true, NULL), ('ORDERS', 'CLIENTE_ID', true, NULL), ('VW_A', 'ID', true, NULL)) t(relation_name, \"column\", nullable, domain)")
plan("catalog_fk_pairs", lambda spark, d: sample_catalog(spark).foreign_keys().select("relation_name", "name", "referenced", F.transform("pairs", lambda x: F.concat_ws(":", x["local"], x["ref"])).getItem(0).alias("pair")), "SELECT 'ORDERS' AS relation_name, 'FK_O_C' AS name, 'CLIENTES' AS referenced, 'CLIENTE_ID:ID' AS pair")
plan("catalog_keys", lambda spark, d: sample_catalog(spark).unique_keys().select("relation_name", "name", "primary", F.array_join("columns", ",").alias("cols")), "SELECT * FROM (VALUES ('CLIENTES', 'PK_CLIENTES', true, 'ID'), ('ORDERS', 'PK_ORDERS', true, 'ID,COMPANY_ID')) t(relation_name, name, \"primary\", cols)")
plan("catalog_indexes", lambda spark, d: sample_catalog(spark).secondary_indexes().select("relation_name", "name", "unique", "active", F.array_join("columns", ",").alias("cols")), "SELECT * FROM (VALUES ('ORDERS', 'FK_O_C', false, true, 'CLIENTE_ID'), ('CLIENTES', 'IX_NOME', false, false, 'NOME')) t(relation_name, name, \"unique\", active, cols)")
plan("catalog_sequences", lambda spark, d: sample_catalog(spark).sequence_bindings(), "SELECT * FROM (VALUES ('CLIENTES', 'ID', 'GEN_CLIENTES_ID'), ('ORDERS', 'ID', 'GEN_ORDERS')) t(relation_name, \"column\", sequence)")

# extras: event-time windows
plan("tumbling_events", lambda spark, d: windows.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], F.count("*").alias("n")).select(F.unix_timestamp("window_start").alias("start"), "event_type", "n"), "SELECT epoch(date_trunc('hour', ts))::bigint AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
plan("sliding_events", lambda spark, d: windows.sliding(table(spark, d, "events"), "ts", "2 hours", "1 hour", ["event_type"], F.count("*").alias("n")).select(F.unix_timestamp("window_start").alias("start"), "event_type", "n"), "SELECT (epoch(date_trunc('hour', ts)) - 3600 * k)::bigint AS start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) t(k) GROUP BY ALL")
plan("session_events", lambda spark, d: windows.sessions(table(spark, d, "events"), "ts", "30 minutes", ["user_id"], F.count("*").alias("n")).select(F.unix_timestamp("window_start").alias("start"), "user_id", "n"), "SELECT floor(epoch(min(ts)))::bigint AS start, user_id, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, g")
