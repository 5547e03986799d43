"""Objects of the dialect as Spark SQL: views, set-based table functions, SQL scripts.

A selectable procedure becomes one query where its loop allows it (projection, filter, running sums over the cursor's
order); else, and for all others, it becomes a SQL script: variables, loops with labels, guarded singleton selects and
an array of the suspended rows.  What has no counterpart raises DialectError; nothing is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from ..catalog.types import UnsupportedTypeError, spark_type
from . import parser as p
from .rewrite import Rewriter, flat, is_word, split_commas, translate_expression, tree
from .tokens import DialectError, Token, render

ROWS = "caravel_rows"


@dataclass
class Translation:
    kind: str  # VIEW, PROCEDURE, TRIGGER, QUERY, DML, NOTE
    name: str
    sql: str
    node: object = None
    notes: list[str] = field(default_factory=list)


def sql_type(declared: str) -> str:
    try:
        return spark_type(declared).simpleString().upper()
    except UnsupportedTypeError as e:
        raise DialectError(str(e)) from None


def query_text(run: list[Token], integers: Iterable[str] = ()) -> str:
    return render(flat(Rewriter(integers).query(tree(run)))).strip()


def literal(value) -> str:
    """A Python value as a SQL literal."""
    import datetime
    import decimal

    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class Script:
    """A procedure as a SQL script."""

    def __init__(self, integers: Iterable[str] = (), procedures: Mapping[str, p.Procedure] | None = None, depth: int = 0):
        self.integers, self.procedures, self.loops, self.labels, self.depth = integers, procedures or {}, [], 0, depth
        self.notes: list[str] = []

    def expr(self, run: list[Token]) -> str:
        return translate_expression(run, self.integers)

    def label(self) -> str:
        self.labels += 1
        return f"l{self.depth}_{self.labels}"

    def declare(self, items: Iterable[p.Parameter], values: Mapping[str, str] | None = None) -> list[str]:
        out = []
        for d in items:
            value = (values or {}).get(d.name.lower()) or (self.expr(d.default) if d.default else None)
            out.append(f"DECLARE {d.name} {sql_type(d.type)}" + (f" DEFAULT {value}" if value is not None else "") + ";")
        return out

    def procedure(self, proc: p.Procedure, values: Mapping[str, str]) -> str:
        missing = [d.name for d in proc.ins if d.name.lower() not in values and d.default is None]
        if missing:
            raise DialectError(f"{proc.name}: no value for {', '.join(missing)}")
        self.outs, self.main = proc.outs, f"main{self.depth}"
        kinds = ", ".join(f"{d.name}: {sql_type(d.type)}" for d in proc.outs)
        inner = "\n".join(self.statements(proc.block.body))
        rows = [f"DECLARE {ROWS} ARRAY<STRUCT<{kinds}>> DEFAULT array();"] if proc.outs else []
        suspends = re.search(r"\bSUSPEND_MARK\b", inner) is not None
        inner = inner.replace("/*SUSPEND_MARK*/", "")
        result = []
        if proc.outs:
            one = ", ".join(f"{d.name} AS {d.name}" for d in proc.outs)
            result = [f"SELECT inline({ROWS});" if suspends else f"SELECT {one};"]
        head = self.declare(proc.ins, values) + self.declare(proc.outs) + self.declare(proc.block.declarations) + rows
        handlers = self.handlers(proc.block.handlers)
        return "BEGIN\n" + "\n".join([*head, f"{self.main}: BEGIN", *handlers, inner, f"END {self.main};", *result]) + "\nEND"

    def handlers(self, found: list[tuple[str, list]]) -> list[str]:
        out = []
        for what, body in found:
            if re.fullmatch(r"(?i)any|others|sqlcode\s+-?\d+|gdscode\s+\w+|exception\s+\w+", what) is None:
                raise DialectError(f"handler for {what}")
            out.append("DECLARE EXIT HANDLER FOR SQLEXCEPTION BEGIN\n" + "\n".join(self.statements(body)) + "\nEND;")
        return out

    def statements(self, body: list) -> list[str]:
        return [x for s in body for x in self.one(s)]

    def nested(self, s) -> str:
        return "\n".join(self.statements(s.body if isinstance(s, p.Block) and not s.declarations and not s.handlers else [s]))

    def assign(self, names: list[str], query: str) -> str:
        return f"SET {names[0]} = ({query});" if len(names) == 1 else f"SET ({', '.join(names)}) = ({query});"

    def one(self, s) -> list[str]:
        if isinstance(s, p.Block):
            return ["BEGIN", *self.declare(s.declarations), *self.handlers(s.handlers), *self.statements(s.body), "END;"]
        if isinstance(s, p.If):
            other = ["ELSE", self.nested(s.other)] if s.other is not None else []
            return [f"IF {self.expr(s.condition)} THEN", self.nested(s.then), *other, "END IF;"]
        if isinstance(s, p.While):
            label = self.label()
            self.loops.append((s.label, label))
            inner = self.nested(s.body)
            self.loops.pop()
            return [f"{label}: WHILE {self.expr(s.condition)} DO", inner, f"END WHILE {label};"]
        if isinstance(s, p.ForExecute):
            if len(s.text) != 1 or s.text[0].kind != "string":
                raise DialectError("a loop over a query that is made at run time")
            from .tokens import tokenize

            return self.one(p.ForSelect(tokenize(s.text[0].text[1:-1].replace("''", "'"))[:-1], s.into, s.body, s.label))
        if isinstance(s, p.ForSelect):
            label, row = self.label(), f"r{self.depth}_{self.labels}"
            cols = [f"c{i}" for i in range(len(s.into))]
            self.loops.append((s.label, label))
            inner = self.nested(s.body)
            self.loops.pop()
            query = query_text(s.query, self.integers)
            sets = [f"SET {v} = {row}.{c};" for v, c in zip(s.into, cols, strict=True)]
            # the wrapping query keeps the order of the inner one only if it is sorted again by it
            wrapped = f"SELECT * FROM ({query}) AS q({', '.join(cols)})" if cols else query
            return [f"{label}: FOR {row} AS {wrapped} DO", *sets, inner, f"END FOR {label};"]
        if isinstance(s, p.SelectInto):
            query = query_text(s.query, self.integers)
            return [f"IF EXISTS ({query}) THEN", self.assign(s.into, query), "END IF;"]
        if isinstance(s, p.Assign):
            return [f"SET {s.target} = {self.expr(s.value)};"]
        if isinstance(s, p.Suspend):
            row = ", ".join(f"'{d.name}', {d.name}" for d in self.outs)
            return [f"SET {ROWS} = array_append({ROWS}, named_struct({row}));/*SUSPEND_MARK*/"] if self.outs else []
        if isinstance(s, p.Leave):
            names = [new for old, new in self.loops if s.label is None or (old or "").upper() == s.label.upper()]
            if not names:
                raise DialectError("LEAVE outside a loop")
            return [f"{'ITERATE' if s.again else 'LEAVE'} {names[-1]};"]
        if isinstance(s, p.Exit):
            return [f"LEAVE {self.main};"]
        if isinstance(s, p.Raise):
            text = f"concat('{s.name}: ', {self.expr(s.message)})" if s.message else f"'{s.name}'"
            return [f"SELECT raise_error({text});"]
        if isinstance(s, p.Execute):
            into = f" INTO {', '.join(s.into)}" if s.into else ""
            return [f"EXECUTE IMMEDIATE {self.expr(s.text)}{into};"]
        if isinstance(s, p.Call):
            return [self.call(s)]
        if isinstance(s, p.Dml):
            if s.verb != "INSERT":
                raise DialectError(f"{s.verb} inside a script: the session's tables take it through operators.dml only")
            if s.into:
                raise DialectError("RETURNING inside a script")
            return [query_text(s.tokens, self.integers) + ";"]
        raise DialectError(f"no translation for {type(s).__name__}")

    def call(self, s: p.Call) -> str:
        """A call is the called procedure's body in place, under its own scope."""
        proc = self.procedures.get(s.name.lower())
        if proc is None:
            raise DialectError(f"procedure {s.name} is not known")
        if self.depth > 8:
            raise DialectError(f"procedure {s.name} calls itself too deeply")
        inner = Script(self.integers, self.procedures, self.depth + 1)
        inner.outs, inner.main = proc.outs, f"main{self.depth + 1}"
        # other names, so that arguments are read in the caller's scope
        names = {d.name.lower(): f"a{self.depth + 1}_{d.name}" for d in [*proc.ins, *proc.outs, *proc.block.declarations]}
        for d, a in zip(proc.ins, s.arguments, strict=False):
            if d.default is None and not a:
                raise DialectError(f"{s.name}: no value for {d.name}")
        given = {d.name.lower(): self.expr(a) for d, a in zip(proc.ins, s.arguments, strict=False)}
        head = inner.declare(proc.ins, given) + inner.declare(proc.outs) + inner.declare(proc.block.declarations)
        body = "\n".join(inner.statements([x for x in proc.block.body if not isinstance(x, p.Suspend)]))
        text = "\n".join(["BEGIN", *head, f"{inner.main}: BEGIN", body, f"END {inner.main};", *[f"SET {v} = {d.name};" for v, d in zip(s.into, proc.outs, strict=False)], "END;"])
        for old, new in names.items():
            if given or True:
                text = re.sub(rf"(?i)(?<![\w.'`]){re.escape(old)}(?![\w'`])", new, text) if old not in {g.lower() for g in given.values()} else text
        return text


def _order(query: list[Token], into: list[str]) -> str | None:
    """The ORDER BY of a cursor over its variables; None where it names other things than selected columns."""
    top = tree(query)
    at = next((i for i in range(len(top) - 1) if is_word(top[i], "ORDER") and is_word(top[i + 1], "BY")), None)
    start = next((i for i, x in enumerate(top) if is_word(x, "SELECT")), None)
    stop = next((i for i, x in enumerate(top) if is_word(x, "FROM")), None)
    if at is None or start is None or stop is None:
        return None
    names = [render(flat(x)).strip().lower() for x in split_commas(top[start + 1 : stop])]
    out = []
    for item in split_commas(top[at + 2 :]):
        text = render(flat(item)).strip()
        m = re.fullmatch(r"(?i)([\w.]+)((?:\s+(?:asc|desc))?(?:\s+nulls\s+(?:first|last))?)", text)
        if not m:
            return None
        key = m[1].lower()
        i = int(key) - 1 if key.isdigit() else next((k for k, n in enumerate(names) if n == key or re.sub(r"(?i)^.*\sas\s+", "", n) == key or n.split(".")[-1] == key.split(".")[-1]), None)
        if i is None or i >= len(into):
            return None
        out.append(into[i] + m[2])
    return ", ".join(out)


def set_query(proc: p.Procedure, values: Mapping[str, str] | None = None, integers: Iterable[str] = ()) -> str | None:
    """A selectable procedure of one cursor loop as one query; None where rows depend on each other in other ways.

    Assignments before the loop give variables their start; in the loop ``v = v + e`` is a running sum in the cursor's
    order, other assignments are expressions of the row; ``IF (c) THEN SUSPEND`` filters.
    """
    env = {k.lower(): v for k, v in (values or {}).items()}
    body = list(proc.block.body)
    for d in proc.block.declarations:
        env[d.name.lower()] = translate_expression(d.default, integers) if d.default else "NULL"
    while body and isinstance(body[0], p.Assign):
        s = body.pop(0)
        env[s.target.lower()] = f"({_substituted(translate_expression(s.value, integers), env)})"
    if len(body) != 1 or not isinstance(body[0], p.ForSelect):
        return None
    loop = body[0]
    rows = [x.lower() for x in loop.into]
    start = dict(env)
    env |= {x: f"q.{x}" for x in rows}
    order = _order(loop.query, loop.into)
    where, seen = [], False
    steps = loop.body.body if isinstance(loop.body, p.Block) else [loop.body]
    for s in steps:
        if seen:
            return None
        if isinstance(s, p.Assign):
            text, name = translate_expression(s.value, integers), s.target.lower()
            if name not in rows and (m := re.fullmatch(rf"(?is){re.escape(name)}\s*\+\s*(.+)", text)) and not re.search(rf"(?i)\b{re.escape(name)}\b", m[1]):
                if order is None or where:
                    return None
                env[name] = f"({start.get(name, 'NULL')} + sum({_substituted(m[1], env)}) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
            elif name not in rows and re.search(rf"(?i)\b{re.escape(name)}\b", text):
                return None
            else:
                env[name] = f"({_substituted(text, env)})"
        elif isinstance(s, p.Suspend):
            seen = True
        elif isinstance(s, p.If) and s.other is None and (isinstance(s.then, p.Suspend) or isinstance(s.then, p.Block) and len(s.then.body) == 1 and isinstance(s.then.body[0], p.Suspend)):
            where.append(_substituted(translate_expression(s.condition, integers), env))
            seen = True
        else:
            return None
    if not seen:
        return None
    outs = ", ".join(f"CAST({env.get(d.name.lower(), 'NULL')} AS {sql_type(d.type)}) AS {d.name.lower()}" for d in proc.outs)
    inner = _substituted(query_text(loop.query, integers), {k: v for k, v in start.items() if k not in rows and k in {x.name.lower() for x in proc.ins}})
    if where and "OVER (" in " ".join(where):
        return None
    return f"SELECT {outs} FROM ({inner}) AS q({', '.join(rows)})" + (f" WHERE {where[0]}" if where else "")


def _substituted(text: str, env: Mapping[str, str]) -> str:
    """Variables of an expression replaced by what they hold; strings and qualified names stay."""
    return re.sub(r"'(?:[^']|'')*'|(?<![\w.`])[A-Za-z_]\w*(?![\w.(`])", lambda m: env.get(m[0].lower(), m[0]) if m[0][0] != "'" else m[0], text)


def translate(text: str, integers: Iterable[str] = (), values: Mapping[str, str] | None = None) -> list[Translation]:
    """Every object and statement of a script, in order.

    ``integers`` are names of integral columns, whose division is integral; ``values`` literals for the parameters of procedures.
    """
    out, procedures = [], {}
    for x in p.parse_script(text):
        if isinstance(x, p.View):
            cols = f" ({', '.join('`' + c.lower() + '`' for c in x.columns)})" if x.columns else ""
            out.append(Translation("VIEW", x.name.lower(), f"CREATE OR REPLACE TEMPORARY VIEW `{x.name.lower()}`{cols} AS {query_text(x.query, integers)}", x))
        elif isinstance(x, p.Procedure):
            procedures[x.name.lower()] = x
            given = {d.name.lower(): (values or {}).get(d.name.lower(), "NULL") for d in x.ins if d.default is None or d.name.lower() in (values or {})}
            fast = set_query(x, given, integers) if x.outs else None
            out.append(Translation("PROCEDURE", x.name.lower(), fast or _scripted(x, given, integers, procedures), x))
        elif isinstance(x, p.Trigger):
            from ..operators.triggers import compile_trigger

            out.append(Translation("TRIGGER", x.name.lower(), compile_trigger(x, integers).describe(), x))
        elif x.verb in ("SELECT", "WITH", "("):
            out.append(Translation("QUERY", "", query_text(x.tokens, integers), x))
        elif x.verb in ("INSERT", "UPDATE", "DELETE", "MERGE"):
            out.append(Translation("DML", x.verb.lower(), query_text(x.tokens, integers), x))
        elif x.verb in ("COMMIT", "ROLLBACK", "SAVEPOINT", "LOCK", "SET"):
            out.append(Translation("NOTE", x.verb.lower(), "", x, [f"{x.verb}: Spark tables have no transactions"]))
        elif x.verb in ("EXPLAIN",):
            at = next(i for i, t in enumerate(x.tokens) if t.key in ("SELECT", "WITH"))
            out.append(Translation("QUERY", "", f"EXPLAIN FORMATTED {query_text(x.tokens[at:], integers)}", x))
        elif x.verb in ("CREATE TABLE", "DROP"):
            out.append(Translation("DDL", x.verb.lower(), query_text(x.tokens, integers), x))
        elif x.verb in ("CREATE SEQUENCE", "CREATE GENERATOR", "CREATE DOMAIN", "CREATE EXCEPTION"):
            out.append(Translation("NOTE", x.verb.lower(), "", x, [f"{x.verb}: kept by the engine's registries"]))
        else:
            raise DialectError(f"no translation for {x.verb}")
    return out


def _scripted(x: p.Procedure, given: Mapping[str, str], integers: Iterable[str], procedures: Mapping[str, p.Procedure]) -> str:
    return Script(integers, procedures).procedure(x, given)


def translate_text(text: str, integers: Iterable[str] = ()) -> str:
    """A script's translation as one text."""
    return "\n\n".join(t.sql.rstrip(";") + ";" if t.sql else "".join(f"-- {n}\n" for n in t.notes) for t in translate(text, integers))
