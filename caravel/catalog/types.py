"""Catalog type codes, their names and their Spark types."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import types as T

# The catalog's type codes.
TYPE_NAMES = {7: "SMALLINT", 8: "INTEGER", 10: "FLOAT", 12: "DATE", 13: "TIME", 14: "CHAR", 16: "BIGINT", 27: "DOUBLE PRECISION", 35: "TIMESTAMP", 37: "VARCHAR", 261: "BLOB"}
EXACT = {7, 8, 16}
SIZED = {14, 37}

SPARK_TYPES: dict[str, T.DataType] = {
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "REAL": T.FloatType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),  # HH:mm:ss.SSSS; Spark's TIME type is off by default
    "TIMESTAMP": T.TimestampNTZType(),
    "TEXT": T.StringType(),
    "BLOB SUBTYPE 1": T.StringType(),
    "BLOB SUBTYPE TEXT": T.StringType(),
    "BLOB SUBTYPE 0": T.BinaryType(),
    "BLOB SUBTYPE BINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "BYTEA": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "NUMERIC": T.DecimalType(38, 18),
    "DECIMAL": T.DecimalType(38, 18),
}


class UnsupportedTypeError(ValueError):
    """A type code or name that has no Spark counterpart."""


def source_type(code: int, subtype: int | None = None, length: int | None = None, precision: int | None = None, scale: int | None = None) -> str | None:
    """The declared type of a catalog row; None for codes that the catalog does not define.

    Exact numbers with a subtype are NUMERIC of the catalog's precision and positive scale; a scale on other types
    means nothing.  Lengths are the catalog's, in bytes.
    """
    name = TYPE_NAMES.get(code)
    if name is None:
        return None
    if code == 261:
        return f"BLOB SUBTYPE {1 if subtype == 1 else 0}"
    if code in EXACT and (subtype or 0) > 0:
        return f"NUMERIC({precision}, {abs(scale or 0)})" if precision else "NUMERIC"
    return f"{name}({length})" if code in SIZED and length else name


def spark_type(declared: str | None, in_table: bool = False) -> T.DataType:
    """The Spark type of a declared type; CHAR and VARCHAR keep their length only ``in_table`` definitions."""
    text = re.sub(r"\s+", " ", (declared or "").strip().upper())
    text = re.sub(r"SUB_TYPE", "SUBTYPE", text)
    if text in SPARK_TYPES:
        return SPARK_TYPES[text]
    if m := re.fullmatch(r"(?:NUMERIC|DECIMAL|DEC|NUMBER) ?\( ?(\d+) ?(?:, ?(\d+) ?)?\)", text):
        p, s = int(m[1]), int(m[2] or 0)
        return T.DecimalType(min(38, max(p, s)), s)
    if m := re.fullmatch(r"(CHAR|CHARACTER|NCHAR|VARCHAR|VARCHAR2|CHARACTER VARYING|NVARCHAR2|CSTRING) ?\( ?(\d+) ?\)(?: .*)?", text):
        if not in_table:
            return T.StringType()
        return T.CharType(int(m[2])) if m[1] in ("CHAR", "CHARACTER", "NCHAR") else T.VarcharType(int(m[2]))
    if text in ("CHAR", "VARCHAR", "CHARACTER", "STRING", "CLOB", "NCLOB", "CSTRING", "LONG"):
        return T.StringType()
    if text in ("BINARY_INTEGER", "PLS_INTEGER", "NATURAL", "NATURALN", "POSITIVE", "POSITIVEN", "SIGNTYPE", "SIMPLE_INTEGER"):
        return T.IntegerType()
    if text in ("BINARY_FLOAT", "BINARY_DOUBLE", "DOUBLE"):
        return T.FloatType() if text == "BINARY_FLOAT" else T.DoubleType()
    if text in ("RAW", "LONG RAW", "BFILE"):
        return T.BinaryType()
    if re.fullmatch(r"TIMESTAMP WITH (LOCAL )?TIME ZONE", text):
        return T.TimestampType()
    if re.fullmatch(r"INTERVAL YEAR TO MONTH", text):
        return T.YearMonthIntervalType()
    if re.fullmatch(r"INTERVAL DAY TO SECOND", text):
        return T.DayTimeIntervalType()
    raise UnsupportedTypeError(f"no Spark type for {declared!r}")


def is_text(declared: str | None) -> bool:
    """Whether values of the type can hold NUL characters that a load has to remove."""
    try:
        return isinstance(spark_type(declared), T.StringType)
    except UnsupportedTypeError:
        return False


def domain_name(name: str, relations: Iterable[str]) -> str:
    """A domain's name in the target: lower case, with ``_dom`` added while a relation has the name."""
    taken, out = {r.strip().lower() for r in relations}, name.strip().lower()
    while out in taken:
        out += "_dom"
    return out


EVENTS = {1: "INSERT", 2: "UPDATE", 3: "DELETE"}


def trigger_events(code: int) -> tuple[str, list[str]] | None:
    """(phase, events) of a trigger's type code; None where no event is set.

    One more than the code holds the phase in bit 0 and up to three events in two bits each above it.
    """
    bits = code + 1
    events = [EVENTS[x] for shift in (1, 3, 5) if (x := bits >> shift & 3)]
    return (("AFTER" if bits & 1 else "BEFORE"), events) if bits > 0 and events else None


def describe_trigger(code: int) -> str:
    found = trigger_events(code)
    return f"{found[0]} {' OR '.join(found[1])}" if found else f"/* UNKNOWN TYPE {code} */"
