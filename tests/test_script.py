import pytest

from caravel.script.run import check, report, run_file
from caravel.script.split import classify, split


def test_split():
    text = "-- first\nSELECT 1;\n\nINSERT INTO t VALUES ('a;b', 'it''s');\n/* ; */ ;\n-- only\n"
    assert [(s.text, s.line) for s in split(text)] == [("-- first\nSELECT 1;", 1), ("INSERT INTO t VALUES ('a;b', 'it''s');", 4)]


def test_bodies_hold_no_end():
    text = "CREATE FUNCTION f() AS $$ a; b; $$ LANGUAGE x;\nCREATE FUNCTION g() AS $t$ c; $$ ; $t$;SELECT \"x;y\""
    assert len(split(text)) == 3 and split(text)[2].text == 'SELECT "x;y"'


@pytest.mark.parametrize("text", ["", "  \n\t ", "-- a\n/* b\n c */\n", ";;"])
def test_nothing(text):
    assert split(text) == []


@pytest.mark.parametrize(
    ("text", "want"),
    [('CREATE DOMAIN "my_dom" AS INTEGER;', ("DOMAIN", "my_dom")), ('DO $$ BEGIN EXECUTE \'CREATE DOMAIN public."v20" AS X;\'; END $$;', ("DOMAIN", "v20")), ('CREATE DOMAIN public."e-mail" AS X', ("DOMAIN", "e-mail")), ("CREATE DOMAIN D AS INT", ("DOMAIN", "D")), ('DROP VIEW IF EXISTS "V";\nCREATE VIEW "V" AS SELECT 1', ("VIEW", "V")), ('CREATE FUNCTION "f"() RETURNS void', ("FUNCTION", "f")), ("CREATE OR ALTER PROCEDURE P AS BEGIN END", ("PROCEDURE", "P")), ('CREATE TRIGGER "T" BEFORE INSERT ON x', ("TRIGGER", "T")), ("SELECT 1; -- CREATE VIEW v", ("OTHER", "UNKNOWN"))],
)
def test_classify(text, want):
    assert classify(text) == want


def test_run_and_check(spark, tmp_path):
    f = tmp_path / "a.sql"
    f.write_text("CREATE OR REPLACE TEMPORARY VIEW sv AS SELECT 1 AS x;\nSELECT nope FROM sv;\nSELECT x FROM sv;")
    assert run_file(spark, str(tmp_path / "none.sql")) == 0
    with pytest.raises(Exception, match="nope"):
        run_file(spark, str(f))
    assert run_file(spark, str(f), continue_on_error=True) == 2
    results = check(spark, f.read_text().replace("sv", "sv2"))
    assert [r.ok for r in results] == [True, False, True]
    rows = {r.kind: (r.total, r.passed, r.failed, r.rate) for r in report(spark, results).collect()}
    assert rows == {"VIEW": (1, 1, 0, 100.0), "OTHER": (2, 1, 1, 50.0)}
    assert not spark.catalog.tableExists("sv2")
