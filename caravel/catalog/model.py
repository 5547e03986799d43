"""Metadata of a source: frozen records whose names are lower-cased, as the target's are."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .types import is_text, spark_type


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None  # SQL text without the word DEFAULT
    sequence: str | None = None
    domain: str | None = None

    @property
    def target(self) -> str:
        return self.name.strip().lower()

    def to_field(self, in_table: bool = False) -> T.StructField:
        given = {"source_type": self.type, "source_name": self.name, "default": self.default, "sequence": self.sequence, "domain": self.domain}
        return T.StructField(self.target, spark_type(self.type, in_table), self.nullable, {k: v for k, v in given.items() if v is not None})


@dataclass(frozen=True)
class UniqueKey:
    name: str
    columns: tuple[str, ...]
    primary: bool = False


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    referenced: str
    referenced_columns: tuple[str, ...]


@dataclass(frozen=True)
class Index:
    name: str
    columns: tuple[str, ...]
    unique: bool = False
    active: bool = True


@dataclass(frozen=True)
class Domain:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None
    check: str | None = None  # a condition on VALUE, with or without the word CHECK

    def condition(self, column: str) -> str | None:
        """The check as a condition on a column."""
        import re

        if not self.check:
            return None
        text = self.check.strip()
        if m := re.match(r"(?is)^check\s*\((.*)\)\s*$", text):
            text = m[1]
        return re.sub(r"(?i)\bvalue\b", column, text)


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...] = ()
    keys: tuple[UniqueKey, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    indexes: tuple[Index, ...] = ()
    checks: tuple[tuple[str, str], ...] = field(default=())

    @property
    def target(self) -> str:
        return self.name.strip().lower()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.to_field() for c in self.columns])

    @property
    def blobs(self) -> int:
        return sum("BLOB" in c.type.upper() for c in self.columns)

    @property
    def text_columns(self) -> list[str]:
        return [c.target for c in self.columns if is_text(c.type)]
