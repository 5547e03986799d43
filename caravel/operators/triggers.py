"""Row triggers as DataFrame hooks.

A trigger's block is executed symbolically: each assignment to ``NEW.column`` becomes an expression of the row, an IF
a CASE, and an INSERT into another table a side output.  BEFORE hooks return the changed rows; AFTER hooks and the
inserts of BEFORE hooks return {table: rows}.  Rows carry the structs ``new`` and ``old`` as their events have them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dialect import parser as p
from ..dialect.tokens import DialectError
from ..session import checkpointed
from .sequences import Sequences

SEQUENCE = re.compile(r"(?i)caravel_sequence\('([^']+)', ([^()]+)\)")


@dataclass
class Hook:
    name: str
    table: str
    phase: str
    events: list[str]
    position: int = 0
    active: bool = True
    sets: dict[str, str] = field(default_factory=dict)  # column -> expression over new.*, old.*
    inserts: list[tuple[str, str, dict[str, str]]] = field(default_factory=list)  # table, condition, column -> expression
    raises: list[tuple[str, str]] = field(default_factory=list)  # condition, message expression
    draws: list[tuple[str, int, str, str]] = field(default_factory=list)  # column with the value, step, condition, sequence

    def describe(self) -> str:
        lines = [f"-- {self.phase} {' OR '.join(self.events)} ON {self.table}"]
        lines += [f"{c} = next value of {s} by {n} WHERE {w}" for c, n, w, s in self.draws]
        lines += [f"new.{c} = {e}" for c, e in self.sets.items()]
        lines += [f"INSERT INTO {t} ({', '.join(v)}) SELECT {', '.join(v.values())} WHERE {c}" for t, c, v in self.inserts]
        lines += [f"raise_error({m}) WHERE {c}" for c, m in self.raises]
        return "\n".join(lines)


class _Compiler:
    def __init__(self, trigger: p.Trigger, integers: Iterable[str]):
        from ..dialect.rewrite import translate_expression

        self.trigger, self.hook = trigger, Hook(trigger.name.lower(), trigger.table.lower(), trigger.phase, trigger.events, trigger.position, trigger.active)
        self.to_sql = lambda run: translate_expression(run, integers)
        self.env: dict[str, str] = {d.name.lower(): self.to_sql(d.default) if d.default else "NULL" for d in trigger.block.declarations}

    def expr(self, run, condition: str = "true") -> str:
        """Sequence calls become columns, drawn for the rows that meet the condition."""

        def draw(m: re.Match) -> str:
            step = m[2].strip()
            if not re.fullmatch(r"-?\d+", step):
                raise DialectError(f"{self.hook.name}: a step of {step} for sequence {m[1]}")
            self.hook.draws.append((f"_seq_{self.hook.name}_{len(self.hook.draws)}", int(step), condition, m[1]))
            return self.hook.draws[-1][0]

        text = SEQUENCE.sub(draw, self.to_sql(run))
        # an earlier assignment is what a later read sees
        swap = lambda m: self.env.get(re.sub(r"\s", "", m[0]).lower(), m[0]) if m[0][0] != "'" else m[0]
        return re.sub(r"'(?:[^']|'')*'|(?<![\w.`])[A-Za-z_]\w*(?:\s*\.\s*\w+)?(?![\w.(`])", swap, text)

    def run(self, body: Iterable, condition: str = "true") -> None:
        for s in body:
            if isinstance(s, p.Block):
                self.run(s.body, condition)
            elif isinstance(s, p.If):
                c = self.expr(s.condition)
                self.run([s.then], c if condition == "true" else f"({condition}) AND ({c})")
                if s.other is not None:
                    n = f"NOT coalesce(({c}), false)"
                    self.run([s.other], n if condition == "true" else f"({condition}) AND {n}")
            elif isinstance(s, p.Assign):
                name, value = s.target.lower(), self.expr(s.value, condition)
                value = value if condition == "true" else f"CASE WHEN {condition} THEN {value} ELSE {self.env.get(name, name)} END"
                self.env[name] = f"({value})"
                if name.startswith("new."):
                    if self.hook.phase == "AFTER":
                        raise DialectError(f"{self.hook.name}: NEW cannot change after the fact")
                    self.hook.sets[name[4:]] = value
            elif isinstance(s, p.Raise):
                message = f"concat('{s.name}: ', {self.expr(s.message)})" if s.message else f"'{s.name}'"
                self.hook.raises.append((condition, message))
            elif isinstance(s, p.Dml) and s.verb == "INSERT":
                self.hook.inserts.append(self.insert(s, condition))
            elif isinstance(s, p.SelectInto):
                self.select(s, condition)
            elif isinstance(s, (p.Exit, p.Suspend)):
                if condition != "true":
                    raise DialectError(f"{self.hook.name}: a conditional EXIT")
                return
            else:
                raise DialectError(f"{self.hook.name}: {type(s).__name__} in a trigger needs rows of other tables; use a join before the hook")

    def select(self, s: p.SelectInto, condition: str) -> None:
        """A singleton select is a scalar subquery; variables that held nothing stay null where it finds no row."""
        from ..dialect.translate import query_text

        held = [n for n in s.into if self.env.get(n.lower(), "NULL") != "NULL"]
        if held or condition != "true":
            raise DialectError(f"{self.hook.name}: a select into {', '.join(held or s.into)}, which must keep a value where no row is found")
        query = query_text(s.query)
        for i, n in enumerate(s.into):
            one = query if len(s.into) == 1 else f"SELECT c{i} FROM ({query}) AS q({', '.join(f'c{j}' for j in range(len(s.into)))})"
            self.env[n.lower()] = f"({one})"

    def insert(self, s: p.Dml, condition: str) -> tuple[str, str, dict[str, str]]:
        q = p.Parser("")
        q.tokens, q.at = [*s.tokens, q.tokens[-1]], 0
        q.need("INSERT", "INTO")
        table = q.name().lower()
        columns = [x.text.strip('"').lower() for x in q.bracketed() if x.kind in ("word", "quoted")]
        q.need("VALUES")
        values, part, depth = [], [], 0
        for x in q.bracketed():
            depth += (x.text == "(") - (x.text == ")")
            if x.text == "," and depth == 0:
                values.append(part)
                part = []
            else:
                part.append(x)
        values.append(part)
        if len(columns) != len(values):
            raise DialectError(f"{self.hook.name}: {len(columns)} columns and {len(values)} values")
        return table, condition, {c: self.expr(v, condition) for c, v in zip(columns, values, strict=True)}


def compile_trigger(trigger: p.Trigger, integers: Iterable[str] = ()) -> Hook:
    c = _Compiler(trigger, integers)
    if trigger.block.handlers:
        raise DialectError(f"{trigger.name}: handlers in a trigger")
    c.run(trigger.block.body)
    return c.hook


def _drawn(rows: DataFrame, hook: Hook, sequences: Sequences | None, order: list[str]) -> DataFrame:
    """``rows`` with the hook's sequence values: a sequence advances for the rows alone that reach the call."""
    for column, step, condition, name in hook.draws:
        if sequences is None:
            raise DialectError(f"sequence {name} is not known")
        if condition == "true":
            rows = sequences.assign(rows, name, column, order, step)
            continue
        rows = checkpointed(rows.withColumn("_reached", F.coalesce(F.expr(condition), F.lit(False))))
        reached = sequences.assign(rows.where("_reached"), name, column, order, step)
        rows = reached.unionByName(rows.where("NOT _reached").withColumn(column, F.lit(None).cast("long"))).drop("_reached")
    return rows


def apply_hooks(rows: DataFrame, hooks: Iterable[Hook], event: str, phase: str, sequences: Sequences | None = None, order: list[str] | None = None) -> tuple[DataFrame, Mapping[str, list[DataFrame]]]:
    """(rows, {table: [inserted rows]}) after the active hooks of an event and phase, by position and name.

    ``rows`` have the structs ``new`` and/or ``old``; ``order`` names the expressions by which sequences advance.
    """
    side: dict[str, list[DataFrame]] = {}
    fits = sorted((h for h in hooks if h.active and h.phase == phase and event in h.events), key=lambda h: (h.position, h.name))
    for h in fits:
        for condition, message in h.raises:
            rows = rows.where(F.expr(f"CASE WHEN {condition} THEN raise_error({message}) IS NULL ELSE true END"))
        rows = _drawn(rows, h, sequences, order or ["new" if "new" in rows.columns else "old"])
        # the expressions are over the row as it came to this hook
        for table, condition, values in h.inserts:
            side.setdefault(table, []).append(rows.where(F.expr(condition)).select(*[F.expr(e).alias(c) for c, e in values.items()]))
        if phase == "BEFORE" and event != "DELETE" and h.sets:
            kinds = {f.name.lower(): f for f in rows.schema["new"].dataType.fields}
            unknown = sorted(set(h.sets) - set(kinds))
            if unknown:
                raise DialectError(f"{h.name}: {h.table} has no column {', '.join(unknown)}")
            changed = {c: F.expr(text).cast(kinds[c].dataType) for c, text in h.sets.items()}
            fields = [changed.get(n, F.col(f"new.`{f.name}`")).alias(f.name) for n, f in kinds.items()]
            rows = rows.withColumn("new", F.struct(*fields))
        rows = rows.drop(*[d[0] for d in h.draws])
    return rows, side
