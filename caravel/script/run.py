"""Execution of scripts and their dry run, with a report."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .split import classify, split

log = logging.getLogger("caravel")


@dataclass(frozen=True)
class Result:
    file: str
    line: int
    kind: str
    name: str
    ok: bool
    error: str | None = None


def run_file(spark: SparkSession, path: str, continue_on_error: bool = False) -> int:
    """Runs a script's statements and returns how many succeeded; a file that is missing counts 0.

    Statements that ran stay done: one that fails takes none of them back.
    """
    if not Path(path).exists():
        log.warning("no script %s", path)
        return 0
    done = 0
    for s in split(Path(path).read_text(encoding="utf-8")):
        try:
            spark.sql(s.text.rstrip().rstrip(";")).count()
            done += 1
        except PySparkException as e:
            if not continue_on_error:
                raise
            log.error("%s line %d: %s", path, s.line, str(e).splitlines()[0])
    return done


def check(spark: SparkSession, script: str, file: str = "") -> list[Result]:
    """Analyses every statement without running it; views are made, in a session of their own, for those after them."""
    scratch, out = spark.newSession(), []
    for view in spark.catalog.listTables():
        if view.isTemporary:
            spark.table(view.name).createOrReplaceTempView(view.name)
            scratch_df = spark.table(view.name)
            scratch_df.createOrReplaceGlobalTempView(f"caravel_{view.name}")
            scratch.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{view.name}` AS SELECT * FROM global_temp.`caravel_{view.name}`")
    for s in split(script):
        kind, name = classify(s.text)
        text = s.text.rstrip().rstrip(";")
        try:
            if kind == "VIEW":
                import re

                scratch.sql(re.sub(r"(?is)^\s*create\s+(?:or\s+replace\s+)?(?:temporary\s+|temp\s+)?view", "CREATE OR REPLACE TEMPORARY VIEW", text))
                scratch.table(f"`{name}`").schema  # noqa: B018
            else:
                plan = scratch.sql(f"EXPLAIN {text}").collect()[0][0]
                if "Exception" in plan.split("\n", 1)[0] or plan.startswith("Error"):
                    raise ValueError(plan)
            out.append(Result(file, s.line, kind, name, True))
        except (PySparkException, ValueError) as e:
            out.append(Result(file, s.line, kind, name, False, str(e).splitlines()[0]))
    return out


def report(spark: SparkSession, results: list[Result]) -> DataFrame:
    """(kind, total, passed, failed, rate) by kind of object."""
    df = spark.createDataFrame([(r.kind, r.ok) for r in results], "kind string, ok boolean")
    return df.groupBy("kind").agg(F.count("*").alias("total"), F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.round(100 * F.avg(F.col("ok").cast("int")), 1).alias("rate")).orderBy("kind")
