import pytest
from pyspark.sql import types as T

from caravel.catalog import ddl
from caravel.catalog.model import Column, Domain, ForeignKey, Index, Table, UniqueKey
from caravel.catalog.types import UnsupportedTypeError, describe_trigger, domain_name, is_text, source_type, spark_type, trigger_events
from caravel.plans.procedural import sample_catalog


@pytest.mark.parametrize(
    ("args", "want"),
    [((8,), "INTEGER"), ((7,), "SMALLINT"), ((37, 0, 50), "VARCHAR(50)"), ((14, 0, 10), "CHAR(10)"), ((16, 1, 8, 15, -2), "NUMERIC(15, 2)"), ((8, 1, 4, 9, 0), "NUMERIC(9, 0)"), ((8, 1), "NUMERIC"), ((261, 1), "BLOB SUBTYPE 1"), ((261, 0), "BLOB SUBTYPE 0"), ((261, None), "BLOB SUBTYPE 0"), ((27, 0, 8, None, -2), "DOUBLE PRECISION"), ((999,), None)],
)
def test_source_types(args, want):
    assert source_type(*args) == want


def test_spark_types():
    assert spark_type("NUMERIC(15, 2)") == T.DecimalType(15, 2)
    assert spark_type("numeric") == T.DecimalType(38, 18)
    assert spark_type("VARCHAR(5)") == T.StringType() and spark_type("VARCHAR(5)", True) == T.VarcharType(5)
    assert spark_type("BLOB SUB_TYPE 1") == T.StringType() and spark_type("BLOB SUBTYPE 0") == T.BinaryType()
    assert spark_type("TIMESTAMP") == T.TimestampNTZType() and spark_type("FLOAT") == T.FloatType()
    assert is_text("CHAR(3)") and not is_text("INTEGER") and not is_text("NO SUCH")
    with pytest.raises(UnsupportedTypeError):
        spark_type("NO SUCH")


def test_trigger_codes():
    names = ["BEFORE INSERT", "AFTER INSERT", "BEFORE UPDATE", "AFTER UPDATE", "BEFORE DELETE", "AFTER DELETE"]
    assert [describe_trigger(i) for i in range(1, 7)] == names
    assert trigger_events(17) == ("BEFORE", ["INSERT", "UPDATE"])
    assert describe_trigger(-1) == "/* UNKNOWN TYPE -1 */"


def test_domain_names():
    assert domain_name("EMAIL ", ["users"]) == "email"
    assert domain_name("USERS", ["users"]) == "users_dom"
    assert domain_name("USERS", ["users", "USERS_DOM"]) == "users_dom_dom"
    assert Domain("d", "INTEGER", check="CHECK (VALUE > 0)").condition("x") == "x > 0"


def test_extraction(spark):
    tables = {t.target: t for t in sample_catalog(spark).tables()}
    assert list(tables) == ["clientes", "orders"]
    c = tables["clientes"]
    assert [(x.target, x.type, x.nullable, x.default, x.sequence, x.domain) for x in c.columns] == [("id", "INTEGER", False, None, "gen_clientes_id", None), ("nome", "VARCHAR(100)", True, "'N/A'", None, None), ("status", "VARCHAR(10)", False, None, None, "dom_status")]
    assert c.keys == (UniqueKey("PK_CLIENTES", ("ID",), True),)
    assert tables["orders"].keys[0].columns == ("ID", "COMPANY_ID")
    assert tables["orders"].foreign_keys == (ForeignKey("FK_O_C", ("CLIENTE_ID",), "CLIENTES", ("ID",)),)
    assert c.indexes == (Index("IX_NOME", ("NOME",), False, False),)
    assert tables["orders"].columns[0].sequence == "gen_orders"  # not the one in the comment


def test_ddl_and_dump(spark, tmp_path):
    t = Table("CLIENTES", (Column("ID", "INTEGER", False, sequence="gen"), Column("NOME", "VARCHAR(3)", False, "'x'"), Column("VALOR", "NUMERIC(15, 2)")), (UniqueKey("PK", ("ID", "NOME"), True), UniqueKey("UQ", ("NOME",))), (ForeignKey("FK", ("A", "B"), "OTHER", ("C", "D")),), (Index("IX", ("NOME",)), Index("OFF", ("ID",), active=False)))
    text = ddl.create_table(t)
    assert "`id` INT NOT NULL" in text and "`nome` VARCHAR(3) NOT NULL DEFAULT 'x'" in text and "`valor` DECIMAL(15,2)" in text
    assert ddl.constraint_text(t) == ["ALTER TABLE clientes ADD CONSTRAINT pk PRIMARY KEY (id, nome)", "ALTER TABLE clientes ADD CONSTRAINT uq UNIQUE (nome)", "CREATE INDEX ix ON clientes (nome)", "ALTER TABLE clientes ADD CONSTRAINT fk FOREIGN KEY (a, b) REFERENCES other (c, d)"]
    assert ddl.layout_hints(t) == {"ix": ["nome"]}
    ddl.create_tables(spark, [t])
    assert [f.name for f in spark.table("clientes").schema] == ["id", "nome", "valor"]
    ddl.drop_tables(spark, [t])
    from caravel.dialect import translate_text

    report = ddl.dump([("VIEW", "A", "CREATE VIEW A AS SELECT FIRST 1 ID FROM T"), ("VIEW", "B", "CREATE VIEW B %%")], translate_text, str(tmp_path), "views")
    assert [r[2] is None for r in report] == [True, False]
    out = (tmp_path / "views.spark.sql").read_text()
    assert "LIMIT" in out and "-- [TRANSLATION FAILED] VIEW B" in out and "CREATE VIEW B %%" in out


def test_engine_export_and_load(spark, tmp_path):
    from caravel.config import Config, TargetConfig
    from caravel.engine import Engine

    spark.sql("CREATE DATABASE IF NOT EXISTS caravel_t")
    e = Engine(spark, Config(target=TargetConfig("caravel_t", "")), sample_catalog(spark))
    report = e.export(str(tmp_path))
    assert {r[0] for r in report} == {"TRIGGER", "PROCEDURE", "VIEW", "DOMAIN"}
    assert [r for r in report if r[2] and r[0] != "DOMAIN"] == []
    e.create_tables()
    rows = {"clientes": [(1, "JOAO\0 SILVA", "A"), (5, "MARIA", "Z")], "orders": [(1, 1, 1), (1, 1, 9)]}

    def read(t):
        return spark.createDataFrame(rows[t.target], t.schema)

    loaded = e.load(read, workers=2)
    assert loaded.ok and {(t.table, t.rows) for t in loaded.tables} == {("clientes", 2), ("orders", 2)}
    assert spark.table("caravel_t.clientes").where("id = 1").collect()[0]["nome"] == "JOAO SILVA"
    assert e.sequences.last["gen_clientes_id"] == 5
    found = {(n, k): v for n, k, v in e.validate()}
    assert found["pk_orders", "PRIMARY KEY"] == 1 and found["fk_o_c", "FOREIGN KEY"] == 1 and found["clientes.status", "CHECK"] == 1 and found["pk_clientes", "PRIMARY KEY"] == 0

    def broken(t):
        if t.target == "orders":
            raise OSError("gone")
        return read(t)

    again = e.load(broken, workers=1)
    assert not again.ok and {t.table: t.error is None for t in again.tables} == {"clientes": True, "orders": False}
    s = again.summary(spark).collect()[0]
    assert (s.loaded, s.failed, s["rows"]) == (1, 1, 2)
    e.drop_schema()
    assert spark.catalog.listTables("caravel_t") == [] or all(t.database != "caravel_t" for t in spark.catalog.listTables("caravel_t"))
