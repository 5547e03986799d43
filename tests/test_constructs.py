"""Constructs with a translation of their own, and errors for those without one."""

import pytest

from caravel.dialect import DialectError, translate_query
from caravel.dialect.interpreter import Interpreter
from caravel.dialect.parser import If, While, parse_script
from caravel.dialect.translate import translate
from caravel.engine import Engine


@pytest.mark.parametrize("text", [
    "SELECT a FROM t AS OF TIMESTAMP '2020-01-01 00:00:00'",
    "SELECT a FROM t ORDER SIBLINGS BY a",
    "UPDATE t SET a = (SELECT 1 FROM u WHERE CURRENT OF c)",
    "DELETE FROM t WHERE CURRENT OF c",
    "SELECT a FROM t MODEL DIMENSION BY (k) MEASURES (v) RULES (v[1] = 2)",
    "WITH q (a) AS (SELECT 1 FROM t) CYCLE a SET c TO 'Y' DEFAULT 'N' SELECT a FROM q",
    "SELECT JSON_EQUAL(a, b) FROM t",
    "WITH q (a) AS (SELECT 1 FROM t) SEARCH DEPTH FIRST BY a SET o SELECT a FROM q",
    "SELECT a FROM t PARTITION BY (k) RIGHT OUTER JOIN u ON t.a = u.a",
    "SELECT PREDICTION(m, a) FROM t",
    "SELECT XMLTABLE('/a') FROM t",
    "SELECT SUM(a) KEEP (DENSE_RANK FIRST ORDER BY b) FROM t",
    "SELECT TO_CHAR(a, 'YYYY-XX') FROM t",
    "SELECT TO_CHAR(a, f) FROM t",
    "SELECT a FROM t WHERE b(+) = 1",
    "SELECT 1 FROM t, u WHERE t.a(+) = u.a(+)",
])
def test_what_has_no_translation_is_an_error(text):
    with pytest.raises(DialectError):
        translate_query(text)


def rows(spark, text, name, *given):
    engine = Engine(spark)
    procs = {p.name.lower(): p for p in parse_script(text)}
    engine.procedures.update(procs)
    return list(Interpreter(engine).call(procs[name], list(given)))


LOOPS = """
CREATE PROCEDURE counted (n INTEGER) RETURNS (total INTEGER, kind VARCHAR(10)) AS
BEGIN
  total = 0;
  FOR i IN 1..n LOOP
    CONTINUE WHEN MOD(i, 2) = 0;
    total = total + i;
  END LOOP;
  FOR j IN REVERSE 1..3 LOOP
    EXIT WHEN j = 1;
    total = total * 10 + j;
  END LOOP;
  LOOP
    total = total + 1;
    IF (total > 1000) THEN EXIT;
  END LOOP;
  CASE MOD(total, 2) WHEN 0 THEN kind = 'even'; WHEN 1 THEN kind = 'odd'; ELSE kind = 'none'; END CASE;
END;
"""


def test_loops_and_cases_interpreted(spark):
    # 1 + 3 + 5 = 9, then 93, 932, then up to 1001
    assert rows(spark, LOOPS, "counted", 5) == [{"total": 1001, "kind": "odd"}]


def test_loops_and_cases_as_a_script(spark):
    made = translate(LOOPS, values={"n": "5"})
    got = spark.sql(made[-1].sql).collect()[0]
    assert (got["total"], got["kind"]) == (1001, "odd")


def test_functions_return_and_end(spark):
    text = "CREATE FUNCTION twice (n INTEGER) RETURNS INTEGER AS BEGIN IF (n > 10) THEN RETURN 0; RETURN n * 2; END;"
    assert rows(spark, text, "twice", 4) == [{"result": 8}]
    assert rows(spark, text, "twice", 11) == [{"result": 0}]


def test_searched_case_without_match_does_nothing():
    (p,) = parse_script("CREATE PROCEDURE p AS DECLARE a INTEGER; BEGIN CASE WHEN a = 1 THEN a = 2; END CASE; a = 3; END;")
    assert isinstance(p.block.body[0], If) and p.block.body[0].other is None and len(p.block.body) == 2


def test_anonymous_blocks_parse():
    (p,) = parse_script("DECLARE i INTEGER; BEGIN LOOP EXIT; END LOOP; EXECUTE IMMEDIATE 'SELECT 1'; END;")
    assert p.name == "block" and isinstance(p.block.body[0], While)


@pytest.mark.parametrize("line", ["OPEN c;", "FETCH c INTO a;", "FORALL i IN 1..3 a = 1;", "EXECUTE IMMEDIATE 'x' USING a;", "RETURN 1;"])
def test_statements_without_translation_are_errors(line):
    with pytest.raises(DialectError):
        parse_script(f"CREATE PROCEDURE p AS DECLARE a INTEGER; BEGIN {line} END;")


def test_bounded_subqueries_keep_their_order_for_every_outer_row(spark):
    spark.range(40).selectExpr("id AS k").createOrReplaceTempView("outer_rows")
    spark.range(4000, numPartitions=8).selectExpr("pmod(hash(id), 40) AS fk", "id", "hash(id, 7) AS v").createOrReplaceTempView("inner_rows")
    by_key = {}
    for r in spark.table("inner_rows").collect():
        by_key.setdefault(r.fk, []).append((r.v, r.id))
    top = {k: sorted(x, reverse=True) for k, x in by_key.items()}
    ask = lambda text: sorted(tuple(r) for r in spark.sql(translate_query(text)).collect())
    one = sorted((k, top[k][0][0]) for k in top)
    assert len(top) == 40 and ask("SELECT o.k, t.b FROM outer_rows o OUTER APPLY (SELECT FIRST 1 v AS b FROM inner_rows i WHERE i.fk = o.k ORDER BY v DESC) t") == one
    assert ask("SELECT o.k, COALESCE((SELECT FIRST 1 v AS b FROM inner_rows i WHERE i.fk = o.k ORDER BY 1 DESC), 0) AS b FROM outer_rows o") == one
    assert ask("SELECT o.k, t.id FROM outer_rows o CROSS APPLY (SELECT id FROM inner_rows i WHERE i.fk = o.k ORDER BY i.v DESC ROWS 2 TO 3) t") == sorted((k, x[1]) for k in top for x in top[k][1:3])
    assert ask("SELECT o.k, t.id FROM outer_rows o CROSS APPLY (SELECT id FROM (SELECT FIRST 1 id, v AS w FROM inner_rows i WHERE i.fk = o.k ORDER BY w DESC) d) t") == sorted((k, top[k][0][1]) for k in top)
    assert ask("SELECT o.k, t.m FROM outer_rows o CROSS APPLY (SELECT FIRST 1 MAX(v) AS m FROM inner_rows i WHERE i.fk = o.k GROUP BY MOD(id, 3) ORDER BY MAX(v) DESC) t") == one
    assert len(ask("SELECT o.k, t.id FROM outer_rows o CROSS APPLY (SELECT FIRST 2 id FROM inner_rows i WHERE i.fk = o.k) t")) == 80
