"""Keys, references, not-null and checks as queries over loaded tables; an empty result is a constraint that holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog.model import Domain, Table


def duplicate_keys(df: DataFrame, columns: Sequence[str], primary: bool = False) -> DataFrame:
    """Keys that stand more than once, with their number; unique keys with a null do not count, primary keys' do."""
    rows = df if primary else df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def missing_references(df: DataFrame, columns: Sequence[str], other: DataFrame, referenced: Sequence[str]) -> DataFrame:
    """Distinct key values without a referenced row; a null anywhere in the key passes."""
    mine = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])
    mine = mine.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in mine.columns])).distinct()
    theirs = other.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(referenced)])
    return mine.join(theirs, mine.columns, "left_anti").toDF(*columns)


def failed_check(df: DataFrame, condition: str) -> DataFrame:
    """Rows whose condition is false; unknown passes."""
    return df.where(f"NOT coalesce(({condition}), true)")


def validate(table: Table, frames: Mapping[str, DataFrame], domains: Mapping[str, Domain] | None = None) -> list[tuple[str, str, int]]:
    """(constraint, kind, violations) of a table: keys first, then not-null and checks, references last."""
    df, out = frames[table.target], []
    for k in table.keys:
        cols = [c.lower() for c in k.columns]
        n = duplicate_keys(df, cols, k.primary).count() + (null_keys(df, cols).count() if k.primary else 0)
        out.append((k.name.lower(), "PRIMARY KEY" if k.primary else "UNIQUE", n))
    required = [c.target for c in table.columns if not c.nullable]
    if required:
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required]).collect()[0]
        out += [(f"{table.target}.{c}", "NOT NULL", counts[c]) for c in required]
    checks = [(f"{table.target}.{c.target}", domains[c.domain].condition(c.target)) for c in table.columns if domains and c.domain in domains and domains[c.domain].condition(c.target)]
    for name, condition in [*checks, *table.checks]:
        out.append((name, "CHECK", failed_check(df, condition).count()))
    for f in table.foreign_keys:
        other = frames.get(f.referenced.lower())
        n = -1 if other is None else missing_references(df, [c.lower() for c in f.columns], other, [c.lower() for c in f.referenced_columns]).count()
        out.append((f.name.lower(), "FOREIGN KEY", n))
    return out
