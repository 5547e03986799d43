"""JDBC scans and sinks: projected, partitioned, with batch sizes that follow the number of BLOB columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..catalog.model import Table

ROWS, LEAST = 10_000, 1_000


def batch_rows(blobs: int) -> int:
    """Rows a fetch or insert: fewer where rows hold BLOBs."""
    return ROWS if blobs == 0 else max(LEAST, ROWS // (2 * blobs))


def scan(spark: SparkSession, options: dict[str, str], table: Table, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table's columns in catalog order; ``partition`` (column, low, high, tasks) splits the read."""
    quote = lambda n: '"' + n.strip().replace('"', '""') + '"'
    columns = ", ".join(quote(c.name) for c in table.columns) or "*"
    reader = spark.read.format("jdbc").options(**options).option("dbtable", f"(SELECT {columns} FROM {quote(table.name)}) t").option("fetchsize", batch_rows(table.blobs))
    if partition:
        column, low, high, n = partition
        reader = reader.option("partitionColumn", quote(column)).option("lowerBound", low).option("upperBound", high).option("numPartitions", n)
    df = reader.load()
    return df.toDF(*[c.target for c in table.columns]) if table.columns else df


def bounds(spark: SparkSession, options: dict[str, str], table: str, column: str) -> tuple[int, int] | None:
    """Least and largest value of a column, for a partitioned scan; one aggregate that the source runs."""
    row = spark.read.format("jdbc").options(**options).option("query", f'SELECT MIN("{column}") AS lo, MAX("{column}") AS hi FROM "{table}"').load().collect()[0]
    return None if row[0] is None else (int(row[0]), int(row[1]))


def write(df: DataFrame, options: dict[str, str], table: str, blobs: int = 0, truncate: bool = True) -> None:
    """Replaces a table's rows, keeping the table where ``truncate``."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_rows(blobs)).option("truncate", str(truncate).lower()).mode("overwrite").save()


def read_many(spark: SparkSession, options: dict[str, str], tables: Sequence[Table]) -> dict[str, DataFrame]:
    return {t.target: scan(spark, options, t) for t in tables}
