import uuid

import pytest
from pyspark.sql import functions as F

from caravel.catalog.model import Column, Table
from caravel.operators.sequences import Sequences, numbered
from caravel.operators.triggers import compile_trigger
from caravel.dialect.parser import parse_script
from caravel.dialect.tokens import DialectError
from caravel.engine import Engine
from caravel.sources import jdbc, loader
from caravel.streaming import windows


def test_batches():
    assert [jdbc.batch_rows(n) for n in range(6)] == [10000, 5000, 2500, 1666, 1250, 1000]


def test_jdbc_round_trip(spark):
    options = {"url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("n"), "id").alias("NOME"))
    jdbc.write(df, options, "CLIENTES", truncate=False)
    t = Table("CLIENTES", (Column("ID", "INTEGER"), Column("NOME", "VARCHAR(100)")))
    assert jdbc.bounds(spark, options, "CLIENTES", "ID") == (0, 99)
    got = jdbc.scan(spark, options, t, ("ID", 0, 100, 4))
    assert got.columns == ["id", "nome"] and got.rdd.getNumPartitions() == 4
    assert got.where("id = 7").collect()[0]["nome"] == "n7"
    plan = got.where("id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(ID,7)" in plan.replace(" ", "").replace("*", "") or "ID" in plan


def test_order_and_sanitation(spark):
    a, b, c = Table("A", (Column("X", "INTEGER"),)), Table("B", (Column("X", "BLOB SUBTYPE 0"),)), Table("C", tuple(Column(f"X{i}", "INTEGER") for i in range(5)))
    assert [t.name for t in loader.heaviest_first([a, b, c])] == ["B", "C", "A"]
    numbers = spark.range(2)
    assert loader.sanitized(numbers) is numbers
    assert loader.sanitized(spark.createDataFrame([(1, "a\0b"), (2, None)], "id int, s string")).collect()[0]["s"] == "ab"


def test_parquet_targets(spark, tmp_path):
    frames = {"t1": spark.range(3).toDF("id"), "t2": spark.range(4).toDF("id")}
    tables = loader.tables_of(frames)
    r = loader.load(spark, tables, lambda t: frames[t.target], loader.to_parquet(str(tmp_path)))
    assert r.ok and {(x.table, x.rows) for x in r.tables} == {("t1", 3), ("t2", 4)}
    assert loader.from_parquet(spark, str(tmp_path))(tables[1]).count() == 4


def test_numbers_are_gapless(spark):
    got = numbered(spark.range(0, 5000, 1, 16), "n", ["-id"], 5, 2).collect()
    assert sorted(r.n for r in got) == list(range(5, 10005, 2)) and all(r.n == 5 + 2 * (4999 - r.id) for r in got)
    s = Sequences()
    assert [s.advance("G"), s.advance("g", 0), s.advance("g", 4)] == [1, 1, 5]
    assert s.synchronise("h", spark.range(0), "id") == 1


@pytest.mark.parametrize("partitions", [2, 4, 8, 200])
def test_numbers_at_any_number_of_partitions(spark, tmp_path, partitions):
    """One file of 1,500 rows: the partitioner samples, so placing the rows twice would cut them differently."""
    spark.range(0, 1500, 1, 1).selectExpr("(id * 7919) % 1500 AS k").write.parquet(str(tmp_path / "k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = numbered(spark.read.parquet(str(tmp_path / "k")), "n", ["k"], 100).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 1500 and all(r.n == 100 + r.k for r in got)


def test_engine_runs_row_hooks(spark):
    spark.sql("DROP TABLE IF EXISTS hooked"), spark.sql("DROP TABLE IF EXISTS hook_log")
    spark.createDataFrame([(1, "a", 5)], "id long, name string, total int").write.saveAsTable("hooked")
    spark.createDataFrame([], "what string, id long, old_total int, seq long").write.saveAsTable("hook_log")
    e = Engine(spark)
    e.sequences.set("gen_hooked", 10)
    e.register("CREATE TRIGGER BI FOR HOOKED BEFORE INSERT AS BEGIN IF (NEW.ID IS NULL) THEN NEW.ID = GEN_ID(GEN_HOOKED, 1); NEW.NAME = UPPER(NEW.NAME); END")
    e.register("CREATE TRIGGER AU FOR HOOKED AFTER UPDATE OR DELETE AS BEGIN INSERT INTO HOOK_LOG (WHAT, ID, OLD_TOTAL, SEQ) VALUES ('changed', OLD.ID, OLD.TOTAL, GEN_ID(GEN_LOG, 1)); END")
    e.register("INSERT INTO HOOKED (NAME, TOTAL) VALUES ('b', 7)")
    e.register("INSERT INTO HOOKED (ID, NAME, TOTAL) VALUES (3, 'c', 9)")
    e.register("INSERT INTO HOOKED (ID, NAME, TOTAL) VALUES (NEXT VALUE FOR GEN_HOOKED, 'd', 1)")
    e.register("UPDATE HOOKED SET TOTAL = TOTAL + 1 WHERE TOTAL > 6")
    e.register("DELETE FROM HOOKED WHERE ID = 3")
    assert sorted(tuple(r) for r in spark.table("hooked").collect()) == [(1, "a", 5), (11, "B", 8), (12, "D", 1)]
    log = [tuple(r) for r in spark.table("hook_log").collect()]
    assert sorted(x[:3] for x in log) == [("changed", 3, 9), ("changed", 3, 10), ("changed", 11, 7)] and sorted(x[3] for x in log) == [1, 2, 3]
    assert e.query("SELECT GEN_ID(GEN_HOOKED, 0) AS x, GEN_ID(GEN_HOOKED, 5) AS y FROM RDB$DATABASE").collect()[0][:] == (12, 17)
    with pytest.raises(DialectError):
        e.query("SELECT GEN_ID(GEN_HOOKED, 1) FROM HOOKED")
    spark.sql("DROP TABLE hooked"), spark.sql("DROP TABLE hook_log")


def test_stream_hooks_and_windows(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").write.parquet(str(src))
    hook = compile_trigger(parse_script("CREATE TRIGGER T FOR X BEFORE INSERT AS BEGIN NEW.NAME = UPPER(NEW.NAME); INSERT INTO LOG (ID) VALUES (NEW.ID); END")[0])
    stream = spark.readStream.schema("id int, name string").parquet(str(src))
    got = {}
    q = windows.with_hooks(stream, [hook], "INSERT", lambda t, df: got.setdefault(t, []).extend(df.collect()), str(tmp_path / "c"))
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in got["x"]) == [(1, "A"), (2, "B")] and sorted(r.id for r in got["log"]) == [1, 2]
    spark.sql("SELECT timestamp_ntz'2020-01-01 00:01:00' AS ts, 1 AS k UNION ALL SELECT timestamp_ntz'2020-01-01 01:30:00', 1").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp_ntz, k int").parquet(str(tmp_path / "ev"))
    agg = windows.tumbling(stream, "ts", "1 hour", ["k"], F.count("*").alias("n"))
    q = agg.writeStream.outputMode("complete").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("w").count() == 2
    assert windows.deduplicated(stream, "ts", ["k"]).isStreaming
