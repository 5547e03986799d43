"""Loads: one job a table, heavy tables first, several at a time; a failed table does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog.model import Table
from ..operators.sequences import Sequences

WORKERS = 4


def sanitized(df: DataFrame) -> DataFrame:
    """Text columns without NUL characters; a table without text columns is returned as it is."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.translate(F.col(f"`{c}`"), "\0", "") for c in text}) if text else df


@dataclass(frozen=True)
class Loaded:
    table: str
    rows: int
    error: str | None = None


@dataclass
class Report:
    tables: list[Loaded]

    @property
    def ok(self) -> bool:
        return all(t.error is None for t in self.tables)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t.table, t.rows, t.error) for t in self.tables], "table string, rows long, error string")

    def summary(self, spark: SparkSession) -> DataFrame:
        return self.to_df(spark).agg(F.count_if(F.col("error").isNull()).alias("loaded"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def heaviest_first(tables: Sequence[Table]) -> list[Table]:
    """Longest first: by BLOB columns, then columns."""
    return sorted(tables, key=lambda t: (t.blobs, len(t.columns)), reverse=True)


def load(spark: SparkSession, tables: Sequence[Table], read: Callable[[Table], DataFrame], write: Callable[[Table, DataFrame], int], workers: int = WORKERS, sequences: Sequences | None = None, loaded: Callable[[Table], DataFrame] | None = None) -> Report:
    """Reads, sanitizes and writes every table; then sequences stand at their columns' maxima, failures or not.

    Row hooks are not run by a load.  ``write`` returns the number of rows it wrote.
    """

    def one(t: Table) -> Loaded:
        try:
            return Loaded(t.target, write(t, sanitized(read(t))))
        except Exception as e:  # whatever a source or sink raises concerns this table alone
            return Loaded(t.target, 0, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")

    ordered = heaviest_first(tables)
    if workers <= 1 or len(ordered) <= 1:
        results = [one(t) for t in ordered]
    else:
        with ThreadPoolExecutor(min(workers, len(ordered))) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(one), ordered))
    done = {r.table for r in results if r.error is None}
    for t in ordered:
        for c in t.columns:
            if sequences is not None and loaded is not None and c.sequence and t.target in done:
                sequences.synchronise(c.sequence, loaded(t), c.target)
    return Report(results)


def to_catalog(database: str | None = None) -> Callable[[Table, DataFrame], int]:
    """A writer that replaces the rows of tables in the session catalog, types cast to theirs."""

    def write(t: Table, df: DataFrame) -> int:
        name = f"`{database}`.`{t.target}`" if database else f"`{t.target}`"
        spark = df.sparkSession
        df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in t.schema]).write.mode("overwrite").insertInto(name)
        return spark.table(name).count()

    return write


def to_parquet(folder: str) -> Callable[[Table, DataFrame], int]:
    def write(t: Table, df: DataFrame) -> int:
        df.write.mode("overwrite").parquet(f"{folder}/{t.target}.parquet")
        return df.sparkSession.read.parquet(f"{folder}/{t.target}.parquet").count()

    return write


def from_parquet(spark: SparkSession, folder: str) -> Callable[[Table], DataFrame]:
    def read(t: Table) -> DataFrame:
        df = spark.read.parquet(f"{folder}/{t.target}.parquet")
        return df.select(*[c.target for c in t.columns]) if t.columns else df

    return read


def tables_of(frames: Mapping[str, DataFrame]) -> list[Table]:
    """Table records from DataFrames, for loads without a catalog."""
    from ..catalog.model import Column

    return [Table(n, tuple(Column(f.name, f.dataType.simpleString().upper(), f.nullable) for f in df.schema)) for n, df in frames.items()]
