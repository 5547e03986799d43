"""The engine: extract, create, load, validate, translate, run."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import ddl
from .catalog.extract import Catalog
from .catalog.model import Table
from .config import Config
from .dialect import parser as p
from .dialect.interpreter import Interpreter
from .dialect.tokens import DialectError, Token, render, tokenize
from .dialect.translate import Script, Translation, literal, query_text, set_query, translate, translate_text
from .operators import constraints, dml
from .operators.sequences import Sequences
from .operators.triggers import Hook, apply_hooks, compile_trigger
from .script import run as scripts
from .session import checkpointed
from .sources import jdbc, loader


class Engine:
    def __init__(self, spark: SparkSession, config: Config | None = None, catalog: Catalog | None = None):
        self.spark, self.config, self.catalog = spark, config or Config.from_env(), catalog
        self.sequences, self.procedures, self.hooks = Sequences(), {}, []
        self.integers: set[str] = set()
        self._tables: list[Table] | None = None

    # schema
    @property
    def tables(self) -> list[Table]:
        """The source's tables, extracted once."""
        if self._tables is None:
            if self.catalog is None:
                raise ValueError("no catalog to extract tables from")
            self._tables = self.catalog.tables()
            self.integers |= {c.target for t in self._tables for c in t.columns if c.type in ("SMALLINT", "INTEGER", "BIGINT")}
        return self._tables

    def create_tables(self) -> None:
        ddl.create_tables(self.spark, self.tables, self.config.target.database)
        for t in self.tables:
            for c in t.columns:
                if c.sequence:
                    self.sequences.last.setdefault(c.sequence, 0)

    def drop_schema(self) -> None:
        """Tables first, then sequences, which tables may use."""
        ddl.drop_tables(self.spark, self.tables, self.config.target.database)
        self.sequences.last.clear()

    def frames(self) -> dict[str, DataFrame]:
        return {t.target: self.spark.table(f"`{self.config.target.database}`.`{t.target}`") for t in self.tables}

    def validate(self) -> list[tuple[str, str, int]]:
        """Every constraint with its number of violations: keys of all tables, then references."""
        frames, domains = self.frames(), {d.name: d for d in self.catalog.domain_records()} if self.catalog else {}
        found = [x for t in self.tables for x in constraints.validate(t, frames, domains)]
        return sorted(found, key=lambda x: x[1] == "FOREIGN KEY")

    # data
    def load(self, read: Callable[[Table], DataFrame] | None = None, workers: int = loader.WORKERS) -> loader.Report:
        """Loads every table, by JDBC unless ``read`` says otherwise; row hooks do not run meanwhile."""
        options, database = self.config.source.options(), self.config.target.database
        read = read or (lambda t: jdbc.scan(self.spark, options, t))
        return loader.load(self.spark, self.tables, read, loader.to_catalog(database), workers, self.sequences, lambda t: self.spark.table(f"`{database}`.`{t.target}`"))

    # code
    def translate(self, text: str) -> str:
        return translate_text(text, self.integers)

    def register(self, text: str) -> list[Translation | Hook | p.Procedure]:
        """Takes a script's views, procedures and triggers in; queries and changes run at once."""
        out = []
        for x in p.parse_script(text):
            if isinstance(x, p.Procedure):
                self.procedures[x.name.lower()] = x
                out.append(x)
            elif isinstance(x, p.Trigger):
                hook = compile_trigger(x, self.integers)
                self.hooks = [h for h in self.hooks if h.name != hook.name] + [hook]
                out.append(hook)
            elif isinstance(x, p.View):
                cols = f" ({', '.join(f'`{c.lower()}`' for c in x.columns)})" if x.columns else ""
                sql = f"CREATE OR REPLACE TEMPORARY VIEW `{x.name.lower()}`{cols} AS {query_text(x.query, self.integers)}"
                self.spark.sql(sql)
                out.append(Translation("VIEW", x.name.lower(), sql, x))
            elif x.verb in ("INSERT", "UPDATE", "DELETE", "MERGE"):
                self.change(x.tokens)
            else:
                raise DialectError(f"{x.verb}: use query()")
        return out

    def query(self, text: str) -> DataFrame:
        """A query of the dialect as a DataFrame."""
        if re.search(r"(?i)\bGEN_ID\b|\bNEXT\s+VALUE\s+FOR\b", text):
            text = render(self._valued(tokenize(text)))
        found = [t for t in translate(text, self.integers) if t.kind != "NOTE"]
        if len(found) != 1 or found[0].kind != "QUERY":
            raise DialectError("one query expected")
        return self.spark.sql(found[0].sql)

    def change(self, tokens: list[Token]) -> None:
        """A change of rows, copy-on-write, with the active row hooks of its table around it.

        BEFORE hooks change the rows, AFTER hooks see them as they are written; what hooks insert into other tables goes
        there with those tables' own hooks.
        """
        tokens = self._valued(tokens)
        name = dml.target_table(tokens)
        if not self._hooks(name):
            name, rows = dml.plan_statement(self.spark, tokens)
            dml.replace_table(self.spark, name, rows)
            return
        c = dml.plan_change(self.spark, tokens)
        self._apply(c.table, c.event, c.kept, c.rows)

    def _hooks(self, table: str) -> list[Hook]:
        return [h for h in self.hooks if h.active and h.table == table]

    def _apply(self, table: str, event: str, kept: DataFrame, rows: DataFrame, depth: int = 0) -> None:
        if depth > 16:
            raise DialectError(f"hooks of {table} set each other off")
        hooks = self._hooks(table)
        rows, before = apply_hooks(rows, hooks, event, "BEFORE", self.sequences)
        rows = checkpointed(rows)
        _, after = apply_hooks(rows, hooks, event, "AFTER", self.sequences)
        sides = [(t, checkpointed(df)) for found in (before, after) for t, dfs in found.items() for df in dfs]
        dml.replace_table(self.spark, table, dml.insert(kept, rows.select("new.*")) if event != "DELETE" else kept)
        for t, df in sides:
            target = self.spark.table(t)
            self._apply(t, "INSERT", target, dml.insert(target.limit(0), df).select(F.struct(*target.columns).alias("new")), depth + 1)

    def _valued(self, tokens: list[Token]) -> list[Token]:
        """GEN_ID and NEXT VALUE FOR with the values that they have: of statements without rows of their own, and of step 0."""
        out, i = [], 0
        rows = any(t.kind == "word" and t.text.upper() == "FROM" and tokens[j + 1].text.upper() != "RDB$DATABASE" for j, t in enumerate(tokens[:-1]))
        word = lambda j, w: j < len(tokens) and tokens[j].kind == "word" and tokens[j].text.upper() == w
        while i < len(tokens):
            t, step, name, used = tokens[i], 1, None, 4
            if word(i, "NEXT") and word(i + 1, "VALUE") and word(i + 2, "FOR"):
                name = tokens[i + 3].text
            elif word(i, "GEN_ID") and i + 5 < len(tokens) and tokens[i + 1].text == "(":
                end = next(j for j in range(i, len(tokens)) if tokens[j].text == ")")
                name, text, used = tokens[i + 2].text, "".join(x.text for x in tokens[i + 4 : end]), end + 1 - i
                if not text.lstrip("-").isdigit():
                    raise DialectError(f"line {t.line}: GEN_ID by {text}")
                step = int(text)
            if name is None:
                out.append(t)
                i += 1
                continue
            if rows and step:
                raise DialectError(f"line {t.line}: a sequence that advances for every row of a query; number the rows by Sequences.assign")
            out.append(Token("number", str(self.sequences.advance(name.strip('"'), step)), t.line, t.before or " "))
            i += used
        return out

    def call(self, name: str, arguments: Mapping[str, object] | None = None) -> DataFrame:
        """A procedure's rows: by one query, else a SQL script, else statement by statement."""
        proc = self.procedures.get(name.lower())
        if proc is None:
            raise DialectError(f"procedure {name} is not known")
        given = {k.lower(): literal(v) for k, v in (arguments or {}).items()}
        missing = [d.name for d in proc.ins if d.name.lower() not in given and d.default is None]
        if missing:
            raise DialectError(f"{name}: no value for {', '.join(missing)}")
        if proc.outs and (text := set_query(proc, given, self.integers)) and "caravel_sequence" not in text:
            return self.spark.sql(text)
        try:
            script = Script(self.integers, self.procedures).procedure(proc, given)
        except DialectError:
            script = None
        if script and "caravel_sequence" not in script and "CALLED_MARK" not in script and not any(isinstance(s, p.Call) for s in _walk(proc.block)):
            return self.spark.sql(script)
        return self._interpreted(proc, arguments or {})

    def _interpreted(self, proc: p.Procedure, arguments: Mapping[str, object]) -> DataFrame:
        from .catalog.types import spark_type
        from pyspark.sql import types as T

        rows = list(Interpreter(self).call(proc, arguments))
        schema = T.StructType([T.StructField(d.name.lower(), spark_type(d.type)) for d in proc.outs])
        return self.spark.createDataFrame([tuple(r.values()) for r in rows], schema) if proc.outs else self.spark.createDataFrame([], T.StructType([]))

    def run_script(self, path: str, continue_on_error: bool = False) -> int:
        return scripts.run_file(self.spark, path, continue_on_error)

    def check(self, text: str) -> list[scripts.Result]:
        return scripts.check(self.spark, text)

    # export
    def export(self, folder: str | None = None) -> list[tuple[str, str, str | None]]:
        """Dumps domains, triggers, procedures and views with their translations; (kind, name, error) of each."""
        if self.catalog is None:
            raise ValueError("no catalog to export from")
        folder, c, out = folder or self.config.dump_dir, self.catalog, []
        domains = [("DOMAIN", d.name, ddl.domain_ddl(d)) for d in c.domain_records()]
        triggers = [("TRIGGER", r["name"], ddl.trigger_ddl(r["name"], r["relation_name"], r["trigger_type"], r["trigger_source"])) for r in c.triggers().collect()]
        procedures = [("PROCEDURE", r["name"], ddl.procedure_ddl(r["name"], r["ins"], r["outs"], r["source"])) for r in c.procedures().collect()]
        views = [("VIEW", r["name"], ddl.view_ddl(r["name"], r["columns"], r["source"])) for r in c.views().collect()]
        for name, items in (("domains", domains), ("triggers", triggers), ("procedures", procedures), ("views", views)):
            out += ddl.dump(items, self.translate, folder, name)
        return out


def _walk(s) -> Iterable:
    yield s
    for child in [*getattr(s, "body", [])] if isinstance(getattr(s, "body", None), list) else [getattr(s, "body", None), getattr(s, "then", None), getattr(s, "other", None)]:
        if child is not None and not isinstance(child, str):
            yield from _walk(child)


def translate_file(path: str) -> str:
    return translate_text(Path(path).read_text(encoding="utf-8"))


__all__ = ["DialectError", "Engine", "PySparkException", "translate_file"]
