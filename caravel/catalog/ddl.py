"""DDL: Spark tables from table records, source objects put together again, dumps of translated objects."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import SparkSession

from ..config import dump_path
from .model import Domain, Table
from .types import describe_trigger, source_type, spark_type


def quoted(name: str) -> str:
    return "`" + name.strip().lower().replace("`", "``") + "`"


def create_table(table: Table, database: str | None = None, provider: str = "parquet") -> str:
    """CREATE TABLE for the session catalog; a column with a sequence has no default, as the load assigns its values."""
    parts = []
    for c in table.columns:
        default = f" DEFAULT {c.default}" if c.default and not c.sequence else ""
        parts.append(f"  {quoted(c.target)} {spark_type(c.type, True).simpleString().upper()}{'' if c.nullable else ' NOT NULL'}{default}")
    where = (f"{quoted(database)}." if database else "") + quoted(table.target)
    return f"CREATE TABLE {where} (\n" + ",\n".join(parts) + f"\n) USING {provider}" if parts else f"CREATE TABLE {where} USING {provider}"


def constraint_text(table: Table) -> list[str]:
    """Keys, indexes and references as comments-free statements for documentation and other targets; composite parts keep their order."""
    name = lambda cols: ", ".join(c.lower() for c in cols)
    keys = [f"ALTER TABLE {table.target} ADD CONSTRAINT {k.name.lower()} {'PRIMARY KEY' if k.primary else 'UNIQUE'} ({name(k.columns)})" for k in table.keys]
    indexes = [f"CREATE {'UNIQUE ' if i.unique else ''}INDEX {i.name.lower()} ON {table.target} ({name(i.columns)})" for i in table.indexes if i.active]
    refs = [f"ALTER TABLE {table.target} ADD CONSTRAINT {f.name.lower()} FOREIGN KEY ({name(f.columns)}) REFERENCES {f.referenced.lower()} ({name(f.referenced_columns)})" for f in table.foreign_keys]
    return keys + indexes + refs


def layout_hints(table: Table) -> dict[str, list[str]]:
    """What secondary indexes suggest for the layout of files: columns to sort within partitions by."""
    return {i.name.lower(): [c.lower() for c in i.columns] for i in table.indexes if i.active}


def drop_tables(spark: SparkSession, tables: Iterable[Table], database: str | None = None) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {f'{quoted(database)}.' if database else ''}{quoted(t.target)}")


def create_tables(spark: SparkSession, tables: Iterable[Table], database: str | None = None) -> None:
    """Drops, then creates; a table that exists is replaced."""
    tables = list(tables)
    drop_tables(spark, tables, database)
    for t in tables:
        spark.sql(create_table(t, database))


# source objects, from what the catalog keeps of them
def trigger_ddl(name: str, relation: str, code: int, source: str) -> str:
    return f"CREATE TRIGGER {name} FOR {relation} {describe_trigger(code)}\n{source.strip()}"


def _parameter(p) -> str:
    return f"{p['name']} {source_type(p['field_type'], p['field_sub_type'], p['field_length'], p['field_precision'], p['field_scale']) or 'VARCHAR(255)'}"


def procedure_ddl(name: str, ins, outs, source: str) -> str:
    given = [_parameter(p) for p in ins or [] if p is not None]
    found = [_parameter(p) for p in outs or [] if p is not None]
    return f"CREATE OR ALTER PROCEDURE {name}" + (f" (\n  {', '.join(given)}\n)" if given else "") + (f"\nRETURNS (\n  {', '.join(found)}\n)" if found else "") + f"\nAS\n{source.strip()}"


def view_ddl(name: str, columns, source: str) -> str:
    return f"CREATE OR ALTER VIEW {name}" + (" (" + ", ".join(f'"{c}"' for c in columns) + ")" if columns else "") + f" AS\n{source.strip()}"


def domain_ddl(d: Domain) -> str:
    check = "" if not d.check else f" {d.check.strip()}" if d.check.strip().upper().startswith("CHECK") else f" CHECK ({d.check.strip()})"
    return f"CREATE DOMAIN {d.name} AS {d.type}" + (f" DEFAULT {d.default}" if d.default else "") + ("" if d.nullable else " NOT NULL") + check


def dump(items: list[tuple[str, str, str]], translate: Callable[[str], str], folder: str, name: str) -> list[tuple[str, str, str | None]]:
    """Writes (kind, name, source) items as ``name``.source.sql and ``name``.spark.sql; returns (kind, name, error or None).

    An object that cannot be translated is marked and followed by its source, so nothing is lost silently.
    """
    rule, report, out = "-- " + "=" * 60, [], []
    before = []
    for kind, what, source in items:
        head = f"{rule}\n-- {kind}: {what}\n{rule}\n"
        before.append(f"{head}{source}\n")
        try:
            out.append(f"{head}{translate(source)}\n")
            report.append((kind, what, None))
        except ValueError as e:
            out.append(f"{head}-- [TRANSLATION FAILED] {kind} {what}: {str(e).splitlines()[0]}\n{source}\n")
            report.append((kind, what, str(e)))
    header = f"-- {len(items)} objects\n\n"
    for suffix, texts in (("source", before), ("spark", out)):
        Path(dump_path(f"{name}.{suffix}.sql", folder)).write_text(header + "\n".join(texts), encoding="utf-8")
    return report
