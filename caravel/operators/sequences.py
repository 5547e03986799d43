"""Sequences: named counters with bulk assignment that needs no global sort.

Numbers for a DataFrame are dealt by partition: rows are range-partitioned by their order, counted a partition, and
numbered within it from the partition's base.  So values are gapless and follow the order, and no task sees all rows.
The placed rows are kept in a reliable checkpoint: placed twice, they could be cut at other bounds, since the
partitioner samples.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def numbered(df: DataFrame, out: str, order: Iterable[str], start: int = 1, step: int = 1) -> DataFrame:
    """``df`` with ``out`` = start, start + step, ... in ascending order of expressions (equal ones in any order)."""
    keys = [F.expr(x) for x in order]
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not {"_part", "_at", "_base"}.isdisjoint(df.columns):
        raise ValueError("columns _part, _at and _base are taken")
    placed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    # the id's upper bits are the partition, its lower 33 bits the place within it
    placed = checkpointed(placed.withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("_part").agg(F.count("*").alias("n"))
    base = counts.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(base), "_part").withColumn(out, F.lit(start) + F.lit(step) * (F.col("_base") + F.col("_at"))).drop("_part", "_at", "_base")


@dataclass
class Sequences:
    """State of all sequences: the last value each gave."""

    last: dict[str, int] = field(default_factory=dict)

    def advance(self, name: str, step: int = 1) -> int:
        """Step 0 reads; other steps move the counter and give its new value."""
        key = name.lower()
        self.last[key] = self.last.get(key, 0) + step
        return self.last[key]

    def set(self, name: str, value: int) -> None:
        self.last[name.lower()] = value

    def assign(self, df: DataFrame, name: str, out: str, order: Iterable[str], step: int = 1) -> DataFrame:
        """A value a row; the counter moves by the rows' number, which costs a count."""
        key = name.lower()
        start, n = self.last.get(key, 0), df.count()
        if step == 0:
            return df.withColumn(out, F.lit(start))
        self.last[key] = start + step * n
        return numbered(df, out, order, start + step, step)

    def synchronise(self, name: str, df: DataFrame, column: str) -> int:
        """After a load: the counter stands at the column's maximum, or at 1 where there is none."""
        value = df.agg(F.coalesce(F.max(F.col(column)), F.lit(1)).cast("long")).collect()[0][0]
        self.set(name, value)
        return value
