"""Copy-on-write DML: the rows that a table has afterwards, as a plan over the rows it has.

Built-in tables take no row-level changes, so a change is one projection, filter or join over the table, written to a
new place and put in the old one's stead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..dialect.rewrite import flat, is_op, is_word, split_commas, tree
from ..dialect.tokens import DialectError, Token, render
from ..dialect.translate import query_text


def update(df: DataFrame, sets: Mapping[str, str], where: str = "true") -> DataFrame:
    """Rows where the condition holds get the sets' expressions, which all see the row as it was."""
    names = {c.lower(): c for c in df.columns}
    unknown = [c for c in sets if c.lower() not in names]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}")
    given = {k.lower(): v for k, v in sets.items()}
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    return df.select(*[F.when(F.expr(where), F.expr(given[k]).cast(kinds[k])).otherwise(F.col(f"`{c}`")).alias(c) if k in given else F.col(f"`{c}`") for k, c in names.items()])


def delete(df: DataFrame, where: str = "true") -> DataFrame:
    """Rows whose condition is not true; unknown keeps them."""
    return df.where(~F.coalesce(F.expr(where), F.lit(False)))


def insert(df: DataFrame, rows: DataFrame, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` and ``rows`` by name; columns that rows lack get their defaults or null."""
    have, given = {c.lower() for c in rows.columns}, {k.lower(): v for k, v in (defaults or {}).items()}
    new = rows.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.expr(given.get(f.name.lower(), "NULL"))).cast(f.dataType).alias(f.name) for f in df.schema])
    return df.union(new)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], matched: Mapping[str, str] | None = None, delete_when: str | None = None, not_matched: Mapping[str, str] | None = None, matched_when: str = "true") -> DataFrame:
    """MERGE on equal keys, as one full outer join; expressions name columns as ``t.x`` and ``s.x``.

    A target row that several source rows match would be ambiguous: the query fails when such a key is met.
    """
    counted = source.groupBy(*keys).agg(F.count("*").alias("_n"))
    s = source.join(counted.where("_n > 1").select(*keys), list(keys), "left_anti").withColumn("_s", F.lit(1))
    twice = counted.where("_n > 1").select(*keys).withColumn("_many", F.lit(1))
    t = target.withColumn("_t", F.lit(1)).join(twice, list(keys), "left")
    t = t.where(F.expr("CASE WHEN _many = 1 THEN raise_error('MERGE: several source rows match one target row') IS NULL ELSE true END"))
    several = source.join(counted.where("_n > 1").select(*keys), list(keys), "left_semi").withColumn("_s", F.lit(1))
    both = t.alias("t").join(s.union(several).alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")
    hit, new = F.expr("t._t = 1 AND s._s = 1"), F.expr("t._t IS NULL")
    gone = F.coalesce(hit & F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    kept = both.where(~gone & (~new if not_matched is None else F.lit(True)))
    out = []
    for f in target.schema:
        c, col = f.name, F.col(f"t.`{f.name}`")
        change = F.expr(matched[c]).cast(f.dataType) if matched and c in matched else col
        first = F.expr((not_matched or {}).get(c, "NULL")).cast(f.dataType)
        out.append(F.when(new, first).when(hit & F.expr(matched_when), change).otherwise(col).alias(c))
    return kept.select(*out)


def update_or_insert(target: DataFrame, rows: DataFrame, matching: Sequence[str]) -> DataFrame:
    """Rows replace those with equal keys and are added where there are none."""
    values = {c: f"s.`{c}`" for c in rows.columns}
    return merge(target, rows, matching, matched=values, not_matched=values)


def multi_insert(rows: DataFrame, branches: Sequence[tuple[str, str, Mapping[str, str]]], first: bool = False) -> dict[str, DataFrame]:
    """{table: rows} of INSERT ALL or FIRST: branches are (condition, table, column -> expression)."""
    out: dict[str, DataFrame] = {}
    before = "false"
    for condition, table, values in branches:
        c = f"({condition}) AND NOT coalesce({before}, false)" if first else condition
        part = rows.where(c).select(*[F.expr(e).alias(n) for n, e in values.items()])
        out[table] = out[table].union(part) if table in out else part
        before = f"({before}) OR coalesce(({condition}), false)"
    return out


def replace_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Puts rows in a session-catalog table's stead.

    They are written whole under another name first; then the names are exchanged by two renames, and the old rows go
    last.  A crash in between leaves the old rows as ``<name>_old_...`` and the new ones as ``<name>_new_...``, none lost.
    """
    tag = uuid.uuid4().hex[:8]
    new, old = f"{name}_new_{tag}", f"{name}_old_{tag}"
    rows.write.saveAsTable(new)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


# statements of the dialect
def _text(x, integers=()) -> str:
    return query_text(flat(x), integers)


def _assignments(x: list) -> dict[str, str]:
    out: dict[str, str] = {}
    for part in split_commas(x):
        at = next((i for i, y in enumerate(part) if is_op(y, "=")), None)
        if at is None:
            raise DialectError("SET without =")
        left, right = part[:at], part[at + 1 :]
        if isinstance(left[0], list):  # (a, b) = (subquery)
            names = [flat(z)[-1].text.strip('"').lower() for z in split_commas(left[0][1:-1])]
            query = _text(right[0][1:-1])
            for i, n in enumerate(names):
                out[n] = f"(SELECT c{i} FROM ({query}) AS q({', '.join(f'c{j}' for j in range(len(names)))}))"
        else:
            out[flat(left)[-1].text.strip('"').lower()] = _text(right)
    return out


def _clause(x: list, word: str, start: int = 0) -> int | None:
    return next((i for i in range(start, len(x)) if is_word(x[i], word)), None)


def target_table(tokens: list[Token]) -> str:
    """The table that a statement changes."""
    words = [t for t in tokens if t.kind in ("word", "quoted")]
    skip = {"INSERT": 2, "DELETE": 2, "MERGE": 2, "UPDATE": 4 if len(words) > 1 and words[1].text.upper() == "OR" else 1}
    return words[skip.get(words[0].text.upper(), 1)].text.strip('"').lower()


@dataclass
class Change:
    """The rows that a statement changes, and those it leaves alone: what row hooks need."""

    table: str
    event: str
    kept: DataFrame
    rows: DataFrame  # with the structs new and/or old


def plan_change(spark: SparkSession, tokens: list[Token]) -> Change:
    """An INSERT, UPDATE or DELETE row by row; other statements run without hooks only."""
    x = tree(tokens)
    if is_word(x[0], "UPDATE") and not is_word(x[1], "OR"):
        at, end = _clause(x, "SET"), _clause(x, "WHERE")
        name = x[1].text.strip('"').lower()
        alias = next((y.text for y in x[2:at] if is_word(y) and not is_word(y, "AS")), name)
        where, table = _text(x[end + 1 :]) if end else "true", spark.table(name)
        hit, columns = table.alias(alias).where(where), table.columns
        both = update(hit.withColumn("_old", F.struct(*[F.col(f"{alias}.`{c}`") for c in columns])), _assignments(x[at + 1 : end]))
        return Change(name, "UPDATE", delete(table.alias(alias), where), both.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("new"), F.col("_old").alias("old")))
    if is_word(x[0], "DELETE"):
        end = _clause(x, "WHERE")
        name = x[2].text.strip('"').lower()
        alias = next((y.text for y in x[3:end] if is_word(y) and not is_word(y, "AS")), name)
        where, table = _text(x[end + 1 :]) if end else "true", spark.table(name).alias(alias)
        return Change(name, "DELETE", delete(table, where), table.where(where).select(F.struct(*spark.table(name).columns).alias("old")))
    if is_word(x[0], "INSERT"):
        name, rows = _inserted(spark, x)
        target = spark.table(name)
        return Change(name, "INSERT", target, insert(target.limit(0), rows).select(F.struct(*target.columns).alias("new")))
    raise DialectError(f"{render(flat(x[:2])).strip()} on a table with row hooks")


def _inserted(spark: SparkSession, x: list) -> tuple[str, DataFrame]:
    """(table, rows) of an INSERT."""
    name, columns, rest = x[2].text.strip('"').lower(), None, x[3:]
    if rest and isinstance(rest[0], list) and not is_word(rest[0][1], "SELECT"):
        columns, rest = [flat(c)[0].text.strip('"').lower() for c in split_commas(rest[0][1:-1])], rest[1:]
    if any(is_word(y, "RETURNING", "LOG") for y in rest):
        raise DialectError(f"line {x[0].line}: INSERT with RETURNING or an error log")
    if is_word(rest[0], "VALUES"):
        rows = spark.sql("SELECT " + ", ".join(_text(v) for v in split_commas(rest[1][1:-1])))
    else:
        rows = spark.sql(_text(rest))
    return name, rows.toDF(*(columns or spark.table(name).columns))


def plan_statement(spark: SparkSession, tokens: list[Token]) -> tuple[str, DataFrame]:
    """(table, its rows after the statement) of an INSERT, UPDATE, DELETE, MERGE or UPDATE OR INSERT."""
    x = tree(tokens)
    if is_word(x[0], "UPDATE") and is_word(x[1], "OR"):
        return _upsert(spark, x)
    if is_word(x[0], "UPDATE"):
        at, end = _clause(x, "SET"), _clause(x, "WHERE")
        if at is None:
            raise DialectError("UPDATE without SET")
        name = x[1].text.strip('"').lower()
        alias = next((y.text for y in x[2:at] if is_word(y) and not is_word(y, "AS")), name)
        sets, where = _assignments(x[at + 1 : end]), _text(x[end + 1 :]) if end else "true"
        table = spark.table(name).alias(alias)
        if "SELECT" not in where.upper():
            return name, update(table, sets, where)
        hit = table.where(where)
        return name, update(hit, sets).union(table.where(f"NOT coalesce(({where}), false)"))
    if is_word(x[0], "DELETE"):
        end = _clause(x, "WHERE")
        name = x[2].text.strip('"').lower()
        alias = next((y.text for y in x[3:end] if is_word(y) and not is_word(y, "AS")), name)
        return name, delete(spark.table(name).alias(alias), _text(x[end + 1 :]) if end else "true")
    if is_word(x[0], "INSERT"):
        name, rows = _inserted(spark, x)
        return name, insert(spark.table(name), rows)
    if is_word(x[0], "MERGE"):
        return _merge(spark, x)
    raise DialectError(f"no plan for {render(flat(x[:2])).strip()}")


def _upsert(spark: SparkSession, x: list) -> tuple[str, DataFrame]:
    """UPDATE OR INSERT INTO t (cols) VALUES (...) MATCHING (keys)."""
    name, columns = x[4].text.strip('"').lower(), [flat(c)[0].text.lower() for c in split_commas(x[5][1:-1])]
    at = _clause(x, "MATCHING")
    if at is None:
        raise DialectError("UPDATE OR INSERT without MATCHING")
    keys = [flat(c)[0].text.lower() for c in split_commas(x[at + 1][1:-1])]
    rows = spark.sql("SELECT " + ", ".join(_text(v) for v in split_commas(x[7][1:-1]))).toDF(*columns)
    return name, update_or_insert(spark.table(name), rows, keys)


def _merge(spark: SparkSession, x: list) -> tuple[str, DataFrame]:
    """MERGE INTO t [a] USING s [b] ON equal columns WHEN [NOT] MATCHED ... ."""
    using, on = _clause(x, "USING"), _clause(x, "ON")
    when = [i for i in range(len(x)) if is_word(x[i], "WHEN")]
    if using is None or on is None or not when:
        raise DialectError("MERGE needs USING, ON and WHEN")
    name = x[2].text.strip('"').lower()
    ta = next((y.text.lower() for y in x[3:using] if is_word(y) and not is_word(y, "AS")), name)
    src = x[using + 1]
    source = spark.sql(_text(src[1:-1])) if isinstance(src, list) else spark.table(src.text)
    sa = next((y.text.lower() for y in x[using + 2 : on] if is_word(y) and not is_word(y, "AS")), None if isinstance(src, list) else src.text.lower())
    import re

    def named(text: str) -> str:
        text = re.sub(rf"(?i)(?<![\w.]){re.escape(ta)}\.", "t.", text)
        return re.sub(rf"(?i)(?<![\w.]){re.escape(sa)}\.", "s.", text) if sa else text

    condition = x[on + 1][1:-1] if isinstance(x[on + 1], list) and on + 2 == when[0] else x[on + 1 : when[0]]
    keys = []
    for part in re.split(r"(?i)\s+and\s+", named(_text(condition))):
        m = re.fullmatch(r"\s*([ts])\.`?(\w+)`?\s*=\s*([ts])\.`?(\w+)`?\s*", part)
        if not m or m[1] == m[3]:
            raise DialectError(f"MERGE on {part.strip()}: equal columns of both sides only")
        keys.append((m[2], m[4]) if m[1] == "t" else (m[4], m[2]))
    source = source.select("*", *[F.col(b).alias(a) for a, b in keys if a.lower() not in {c.lower() for c in source.columns}])
    matched = drop = None
    added, matched_when = None, "true"
    for i, at in enumerate(when):
        part = x[at + 1 : when[i + 1] if i + 1 < len(when) else len(x)]
        then = _clause(part, "THEN")
        extra = named(_text(part[_clause(part, "AND") + 1 : then])) if _clause(part[:then], "AND") is not None else "true"
        act = part[then + 1 :]
        if is_word(part[0], "NOT"):
            cols = [flat(c)[0].text.strip('"').lower() for c in split_commas(act[1][1:-1])]
            added = {c: named(_text(v)) for c, v in zip(cols, split_commas(act[3][1:-1]), strict=True)}
        elif is_word(act[0], "DELETE"):
            drop = extra
        else:
            stop = _clause(act, "DELETE")
            matched, matched_when = {c: named(e) for c, e in _assignments(act[2:stop]).items()}, extra
            drop = named(_text(act[stop + 2 :])) if stop else drop
    return name, merge(spark.table(name), source, [a for a, _ in keys], matched, drop, added, matched_when)


