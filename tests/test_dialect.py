import pytest

from caravel.dialect import DialectError, translate, translate_query
from caravel.dialect.interpreter import ProcedureError
from caravel.engine import Engine
from caravel.operators.triggers import compile_trigger
from caravel.dialect.parser import parse_script

SPACES = lambda s: " ".join(s.split())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SELECT FIRST 10 SKIP 20 id FROM t", "SELECT id FROM t LIMIT 10 OFFSET 20"),
        ("SELECT COUNT(*) FROM (SELECT FIRST 3 id FROM t) x", "SELECT COUNT(*) FROM (SELECT id FROM t LIMIT 3) x"),
        ("SELECT SKIP 2 a FROM t", "SELECT a FROM t OFFSET 2"),
        ("SELECT a FROM t UNION SELECT FIRST 1 b FROM u", "SELECT a FROM t UNION ( SELECT b FROM u LIMIT 1 )"),
        ("SELECT CURRENT_TIMESTAMP FROM RDB$DATABASE", "SELECT CURRENT_TIMESTAMP"),
        ("SELECT a FROM RDB$DATABASE, t", "SELECT a FROM RDB$DATABASE, t"),
        ("SELECT a FROM t WHERE:x > 0 AND b ^= 1", "SELECT a FROM t WHERE x > 0 AND b <> 1"),
        ('SELECT "Ab" FROM t', "SELECT `Ab` FROM t"),
        ("SELECT a FROM t ORDER BY a ROWS 5", "SELECT a FROM t ORDER BY a LIMIT 5"),
        ("SELECT a FROM t ORDER BY a OFFSET 2 ROWS FETCH NEXT 3 ROWS ONLY", "SELECT a FROM t ORDER BY a LIMIT 3 OFFSET 2"),
        ("SELECT sum(a) OVER (ORDER BY b ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) FROM t", "SELECT sum(a) OVER (ORDER BY b ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) FROM t"),
        ("SELECT 'a -- ; b' FROM t -- end", "SELECT 'a -- ; b' FROM t"),
        ("SELECT GEN_ID(g, 5), NEXT VALUE FOR g FROM t", "SELECT caravel_sequence('g', 5), caravel_sequence('g', 1) FROM t"),
        ("SELECT 7 / 2, 7.0 / 2, a / b FROM t", "SELECT 7 DIV 2, 7.0 / 2, a / b FROM t"),
    ],
)
def test_queries(text, want):
    assert SPACES(translate_query(text)) == want


@pytest.mark.parametrize("text", ["CREATE TRIGGER X FOR", "CREATE PROCEDURE P AS BEGIN SELECT 1 FROM RDB$DATABASE;", "FOOBAR BAZ QUX %$#@! 123", "SELECT (1", "CREATE PROCEDURE P AS BEGIN x = ; END", "SELECT a FROM t ORDER BY a FETCH FIRST 2 ROWS"])
def test_errors(text):
    with pytest.raises(DialectError):
        translate(text)


def test_nothing_is_dropped():
    found = translate("COMMIT; SELECT 1 FROM RDB$DATABASE; CREATE VIEW V (A) AS SELECT 1 FROM T ORDER BY 1; CREATE SEQUENCE S")
    assert [t.kind for t in found] == ["NOTE", "QUERY", "VIEW", "NOTE"] and found[0].notes
    assert "ORDER BY 1" in found[2].sql and "`v` (`a`)" in found[2].sql


@pytest.fixture
def engine(spark):
    for name, ddl in {"contas": "id INT, saldo DECIMAL(15,2)", "log": "id INT, texto STRING"}.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet")
    spark.sql("INSERT INTO contas VALUES (1, 10.00), (2, 20.00), (3, NULL)")
    return Engine(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_executable_procedure(engine):
    engine.register("CREATE OR ALTER PROCEDURE SP_SALDO (P_ID INTEGER, P_VALOR NUMERIC(15,2) = 1) AS BEGIN UPDATE CONTAS SET CONTAS.SALDO = SALDO + :P_VALOR WHERE ID = :P_ID; END")
    engine.call("sp_saldo", {"p_id": 1, "p_valor": 5})
    engine.call("sp_saldo", {"p_id": 2})
    assert sorted(rows(engine.spark.sql("SELECT id, cast(saldo AS double) FROM contas WHERE id < 3"))) == [(1, 15.0), (2, 21.0)]
    with pytest.raises(DialectError):
        engine.call("sp_saldo")


def test_selectable_procedures(engine):
    engine.register("CREATE PROCEDURE L RETURNS (ID INTEGER, S DOUBLE PRECISION) AS BEGIN FOR SELECT ID, SALDO FROM CONTAS WHERE SALDO > 5 INTO :ID, :S DO BEGIN SUSPEND; END END")
    assert sorted(rows(engine.call("l"))) == [(1, 10.0), (2, 20.0)]
    engine.register("CREATE PROCEDURE W RETURNS (I INTEGER) AS BEGIN I = 0; WHILE (I < 10) DO BEGIN I = I + 1; IF (I = 3) THEN CONTINUE; IF (I = 5) THEN LEAVE; SUSPEND; END END")
    assert rows(engine.call("w")) == [(1,), (2,), (4,)]
    engine.register("CREATE PROCEDURE F RETURNS (I INTEGER) AS BEGIN FOR EXECUTE STATEMENT 'SELECT ID FROM CONTAS ORDER BY ID' INTO :I DO SUSPEND; END")
    assert rows(engine.call("f")) == [(1,), (2,), (3,)]


def test_singleton_keeps_value_without_a_row(engine):
    engine.register("CREATE PROCEDURE G (P INTEGER) RETURNS (V DOUBLE PRECISION) AS BEGIN V = 7; SELECT SALDO FROM CONTAS WHERE ID = :P INTO :V; SUSPEND; END")
    assert [rows(engine.call("g", {"p": i})) for i in (99, 1, 3)] == [[(7.0,)], [(10.0,)], [(None,)]]


def test_sequences_calls_and_exceptions(engine):
    engine.sequences.set("gen", 10)
    engine.register("CREATE PROCEDURE S RETURNS (A INTEGER, B INTEGER) AS BEGIN A = GEN_ID(GEN, 0); B = GEN_ID(GEN, 5); SUSPEND; END")
    assert rows(engine.call("s")) == [(10, 15)]
    engine.register("CREATE PROCEDURE INNER_P (X INTEGER) RETURNS (Y INTEGER) AS BEGIN Y = X * 2; END; CREATE PROCEDURE OUTER_P RETURNS (Z INTEGER) AS BEGIN EXECUTE PROCEDURE INNER_P (21) RETURNING_VALUES :Z; SUSPEND; END")
    assert rows(engine.call("outer_p")) == [(42,)]
    engine.register("CREATE PROCEDURE R (N INTEGER) AS BEGIN IF (N < 1) THEN BEGIN EXCEPTION EX_LOW 'too low'; END END")
    with pytest.raises(Exception, match="EX_LOW: too low"):
        engine.call("r", {"n": 0}).collect()
    engine.register("CREATE PROCEDURE H RETURNS (T VARCHAR(9)) AS BEGIN EXECUTE PROCEDURE R (0); T = 'no'; SUSPEND; WHEN EXCEPTION EX_LOW DO BEGIN T = 'caught'; SUSPEND; END END")
    assert rows(engine.call("h")) == [("caught",)]
    assert ProcedureError("A", "b").name == "A"


def test_dml(engine):
    engine.register("DELETE FROM CONTAS WHERE SALDO > 15; INSERT INTO CONTAS (ID) VALUES (9); UPDATE CONTAS C SET C.SALDO = 1 WHERE C.ID IN (SELECT 9 FROM RDB$DATABASE)")
    assert sorted(rows(engine.spark.sql("SELECT id, cast(saldo AS double) FROM contas"))) == [(1, 10.0), (3, None), (9, 1.0)]
    engine.register("MERGE INTO contas t USING (SELECT 1 AS id, 3 AS v FROM RDB$DATABASE UNION ALL SELECT 4, 4 FROM RDB$DATABASE) s ON (t.id = s.id) WHEN MATCHED THEN UPDATE SET saldo = t.saldo + s.v WHEN NOT MATCHED THEN INSERT (id, saldo) VALUES (s.id, s.v)")
    assert sorted(rows(engine.spark.sql("SELECT id, cast(saldo AS double) FROM contas"))) == [(1, 13.0), (3, None), (4, 4.0), (9, 1.0)]
    engine.register("UPDATE OR INSERT INTO contas (id, saldo) VALUES (3, 8) MATCHING (id)")
    assert engine.spark.sql("SELECT cast(saldo AS double) FROM contas WHERE id = 3").collect()[0][0] == 8.0


def test_views_with_glued_variables_and_triggers(engine):
    engine.register("CREATE OR ALTER VIEW VW (K, N) AS SELECT ID, COUNT(*) FROM CONTAS GROUP BY ID")
    assert engine.query("SELECT FIRST 1 K FROM VW ORDER BY K DESC").collect()[0][0] == 3
    hook = compile_trigger(parse_script("CREATE TRIGGER T FOR X INACTIVE AFTER DELETE POSITION 3 AS DECLARE VARIABLE V INTEGER; BEGIN SELECT MAX(ID) FROM CONTAS INTO:V; INSERT INTO LOG (ID) VALUES (V); END")[0])
    assert (hook.active, hook.position, hook.inserts[0][2]) == (False, 3, {"id": "(SELECT MAX(ID) FROM CONTAS)"})
    with pytest.raises(DialectError):
        compile_trigger(parse_script("CREATE TRIGGER T FOR X AFTER INSERT AS BEGIN NEW.A = 1; END")[0])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SELECT id MOD 3 AS m FROM range(4) ORDER BY id", [0, 1, 2, 0]),
        ("SELECT (id + 1) MOD (1 + 1) AS m FROM range(3) ORDER BY id", [1, 0, 1]),
        ("SELECT MOD(id, 2) AS m FROM range(3) ORDER BY id", [0, 1, 0]),
        ("SELECT id AS m FROM range(4) WHERE LNNVL(id > 1) ORDER BY id", [0, 1]),
        ("SELECT id AS m FROM range(12) WHERE CAST(id AS VARCHAR(3)) LIKEC '1_'", [10, 11]),
    ],
)
def test_operators_of_the_dialect(spark, text, want):
    sql = translate(text)[0].sql
    assert sorted(r.m for r in spark.sql(sql).collect()) == sorted(want)
