"""Queries and expressions of the dialect as Spark SQL, on tokens.

Brackets are kept as nested lists, so that a rewrite of a query block never reaches into or out of a subquery.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from . import constructs
from .tokens import DialectError, Token, render, tokenize
from .trees import Tree, before, flat, is_op, is_word, raw, split_commas, tree

#: Functions whose name alone differs.
RENAMED = {"IIF": "IF", "LIST": "LISTAGG", "SUBSTRING": "SUBSTRING", "CHAR_LENGTH": "LENGTH", "CHARACTER_LENGTH": "LENGTH", "STRLEN": "LENGTH", "OCTET_LENGTH": "OCTET_LENGTH", "ASCII_VAL": "ASCII", "ASCII_CHAR": "CHR", "MAXVALUE": "GREATEST", "MINVALUE": "LEAST", "CEILING": "CEIL", "RAND": "RAND", "GEN_UUID": "UUID", "WM_CONCAT": "LISTAGG", "STATS_MODE": "MODE", "SYSDATE": "LOCALTIMESTAMP", "SYSTIMESTAMP": "CURRENT_TIMESTAMP", "TO_TIMESTAMP": "TO_TIMESTAMP_NTZ"}
UNARY_NAMES = {"SYSDATE": "localtimestamp()", "SYSTIMESTAMP": "current_timestamp()", "LOCALTIMESTAMP": "localtimestamp()"}
SYSTEM_TABLE = "RDB$DATABASE"
CLAUSES = {"WHERE", "GROUP", "HAVING", "ORDER", "UNION", "INTERSECT", "MINUS", "EXCEPT", "LIMIT", "OFFSET", "FETCH", "FOR", "ROWS", "WINDOW", "PLAN", "INTO"}
SETS = {"UNION", "INTERSECT", "MINUS", "EXCEPT"}


class Rewriter:
    """``variables`` are names that need no mark, as a script's; ``integers`` columns known to be integral."""

    def __init__(self, integers: Iterable[str] = (), sequences: str = "caravel_sequence"):
        self.integers, self.sequences = {x.lower() for x in integers}, sequences
        self.inner = False  # within a subquery that may name columns from outside

    # queries
    def subquery(self, x: Tree, derived: bool = False) -> Tree:
        """A query in brackets; ``derived`` ones, tables of their own, name outer columns only where the query around does."""
        was, self.inner = self.inner, self.inner or not derived
        out = self.query(x)
        self.inner = was
        return out

    def query(self, x: Tree) -> Tree:
        """A query's tree, its set operations and subqueries included."""
        parts, out = [[]], []
        for y in x:
            if is_word(y, *SETS) and not (parts[-1] and is_word(parts[-1][-1], "MULTISET")):
                parts.append([y])
            else:
                parts[-1].append(y)
        for part in parts:
            lead = []
            while part and (is_word(part[0], *SETS, "ALL") and not is_word(part[0], "SELECT")):
                lead.append(part[0])
                part = part[1:]
            out += lead + self.block(part, several=len(parts) > 1)
        return out

    def block(self, x: Tree, several: bool = False) -> Tree:
        if not x or not any(is_word(y, "SELECT") for y in x):
            return self.expressions(x)
        constructs.refuse(x)
        x = constructs.marked_joins(self, x)
        if any(is_word(y, "CONNECT") and is_word(z, "BY") for y, z in zip(x, x[1:], strict=False)):
            return self._hierarchy(x)
        at = next(i for i, y in enumerate(x) if is_word(y, "SELECT"))
        head, rest, limit, skip = self.expressions(x[:at]) + [x[at]], x[at + 1 :], None, None
        while rest and is_word(rest[0], "FIRST", "SKIP"):
            if len(rest) < 2 or not (isinstance(rest[1], list) or rest[1].kind in ("number", "bind")):
                break
            value = self.expressions([rest[1]])
            limit, skip = (value, skip) if is_word(rest[0], "FIRST") else (limit, value)
            rest = rest[2:]
        if rest and is_word(rest[0], "UNIQUE"):
            rest = [rest[0].with_text("DISTINCT"), *rest[1:]]
        body, ties = [], None
        i = 0
        while i < len(rest):
            y = rest[i]
            if is_word(y, "FROM"):
                stop = next((j for j in range(i + 1, len(rest)) if is_word(rest[j], *CLAUSES)), len(rest))
                sources = rest[i + 1 : stop]
                if is_word(sources[0] if sources else None, SYSTEM_TABLE) and not any(is_op(z, ",") or is_word(z, "JOIN") for z in sources):
                    i = stop  # a relation of one row: no FROM
                    continue
            if is_word(y, "ROWS") and i + 1 < len(rest) and not self._in_window(rest, i):
                i, skip, limit = self._rows(rest, i, limit, skip)
                continue
            if is_word(y, "OFFSET") and i + 2 < len(rest) and is_word(rest[i + 2], "ROW", "ROWS"):
                skip, i = self.expressions([rest[i + 1]]), i + 3
                continue
            if is_word(y, "FETCH") and i + 1 < len(rest) and is_word(rest[i + 1], "FIRST", "NEXT"):
                limit, ties, i = self._fetch(rest, i)
                continue
            if is_word(y, "FOR") and i + 1 < len(rest) and is_word(rest[i + 1], "UPDATE"):
                i = len(rest)  # no row locks
                continue
            if is_word(y, "PLAN"):
                i = next((j for j in range(i + 1, len(rest)) if is_word(rest[j], "ORDER", "UNION", "ROWS", "FOR")), len(rest))
                continue
            body.append(y)
            i += 1
        out = head + self.expressions(body)
        if ties is not None:
            return self._with_ties(out, ties, limit)
        if self.inner and not several and (limit is not None or skip is not None):
            return self._ranked(out, len(head), limit, skip)
        if limit is not None:
            out += [raw(" LIMIT")] + self._spaced(limit)
        if skip is not None:
            out += [raw(" OFFSET")] + self._spaced(skip)
        if several and (limit is not None or skip is not None):
            return [raw("("), *out, raw(")")]
        return out

    def _hierarchy(self, x: Tree) -> Tree:
        """SELECT ... FROM t [WHERE c] [START WITH s] CONNECT BY PRIOR a = b [ORDER BY ...] as a recursive query with LEVEL."""
        find = lambda *words: next((i for i in range(len(x)) if all(i + k < len(x) and is_word(x[i + k], w) for k, w in enumerate(words))), None)
        select, source, connect, start, where, order = find("SELECT"), find("FROM"), find("CONNECT", "BY"), find("START", "WITH"), find("WHERE"), find("ORDER", "BY")
        marks = sorted(i for i in (connect, start, where, order, len(x)) if i is not None)
        part = lambda i, skip: x[i + skip : next(m for m in marks if m > i)]
        link = part(connect, 2)
        prior = next((i for i, y in enumerate(link) if is_word(y, "PRIOR")), None)
        equal = next((i for i, y in enumerate(link) if is_op(y, "=")), None)
        if is_word(link[0], "NOCYCLE") or prior is None or equal is None or sum(is_op(y, "=") for y in link) != 1:
            raise DialectError(f"line {x[connect].line}: CONNECT BY other than PRIOR a = b")
        column = lambda run: flat(run)[-1].text.strip('"')
        sides = [[y for y in side if not is_word(y, "PRIOR")] for side in (link[:equal], link[equal + 1 :])]
        parent, child = (sides[0], sides[1]) if prior < equal else (sides[1], sides[0])
        table = x[source + 1 : next(m for m in marks if m > source)]
        if len(table) != 1 or not isinstance(table[0], Token):
            raise DialectError(f"line {x[connect].line}: CONNECT BY over one table without alias only")
        name = render(table).strip()
        text = lambda run: render(flat(self.expressions(run))).strip()
        root = f" WHERE {text(part(start, 2))}" if start is not None else ""
        rest = (f" WHERE {text(part(where, 1))}" if where is not None else "") + (f" ORDER BY {text(part(order, 2))}" if order is not None else "")
        return [raw(f"WITH RECURSIVE _h AS (SELECT *, 1 AS level FROM {name}{root} UNION ALL SELECT _t.*, _h.level + 1 FROM _h JOIN {name} AS _t ON _t.{column(child)} = _h.{column(parent)}) SELECT {text(x[select + 1 : source])} FROM _h{rest}")]

    @staticmethod
    def _spaced(x: Tree) -> Tree:
        return [raw(" " + render(flat(x)).strip())]

    @staticmethod
    def _in_window(rest: Tree, i: int) -> bool:
        return is_word(rest[i + 1], "BETWEEN", "UNBOUNDED", "CURRENT")

    def _rows(self, rest: Tree, i: int, limit, skip):
        """ROWS m [TO n]: the first m rows, or rows m to n, counted from one."""
        first = self.expressions([rest[i + 1]])
        if i + 3 < len(rest) and is_word(rest[i + 2], "TO"):
            a, b = (render(flat(z)).strip() for z in (first, self.expressions([rest[i + 3]])))
            fold = lambda text: str(eval(text)) if re.fullmatch(r"[\d+\-() ]+", text) else text  # noqa: E731, S307  digits and signs only
            return i + 4, [raw(fold(f"{a} - 1"))], [raw(fold(f"{b} - {a} + 1"))]
        return i + 2, skip, first

    def _fetch(self, rest: Tree, i: int):
        j = i + 2
        count = [raw("1")] if is_word(rest[j], "ROW", "ROWS") else self.expressions([rest[j]])
        j += 0 if is_word(rest[j], "ROW", "ROWS") else 1
        percent = j < len(rest) and is_word(rest[j], "PERCENT")
        j += percent
        if j >= len(rest) or not is_word(rest[j], "ROW", "ROWS"):
            raise DialectError(f"line {rest[i].line}: FETCH without ROWS")
        j += 1
        if j < len(rest) and is_word(rest[j], "ONLY"):
            return count, ("percent" if percent else None), j + 1
        if j + 1 < len(rest) and is_word(rest[j], "WITH") and is_word(rest[j + 1], "TIES"):
            return count, ("percent ties" if percent else "ties"), j + 2
        raise DialectError(f"line {rest[i].line}: FETCH without ONLY or WITH TIES")

    def _with_ties(self, out: Tree, kind: str, limit: Tree) -> Tree:
        """Ranks over the block's order: ties by rank(), shares by the number of rows."""
        at = next((k for k in range(len(out) - 1) if is_word(out[k], "ORDER") and is_word(out[k + 1], "BY")), None)
        if at is None:
            raise DialectError("WITH TIES and PERCENT need an ORDER BY")
        order, body, n = render(flat(out[at + 2 :])).strip(), render(flat(out[:at])), render(flat(limit)).strip()
        rank = "rank()" if "ties" in kind else "row_number()"
        bound = f"ceil(_n * {n} / 100.0)" if "percent" in kind else n
        return [raw(f"SELECT * EXCEPT (_r, _n) FROM (SELECT *, {rank} OVER (ORDER BY {order}) AS _r, count(*) OVER () AS _n FROM ({body})) WHERE _r <= {bound}")]
    def _ranked(self, out: Tree, start: int, limit, skip) -> Tree:
        """A block of a subquery, its rows bounded by row_number(): Spark takes LIMIT out of a correlated subquery without its
        order, and in some without its groups.  Keys that are no output column become columns for the time being."""
        at = next((k for k in range(start, len(out) - 1) if is_word(out[k], "ORDER") and is_word(out[k + 1], "BY")), len(out))
        stop = next((k for k in range(start, at) if is_word(out[k], *CLAUSES) or is_word(out[k], "FROM") and not is_word(out[k - 1], "DISTINCT")), at)
        items = split_commas(out[start:stop])
        named = lambda x: len(x) > 1 and isinstance(x[-1], Token) and x[-1].kind in ("word", "quoted") and (is_word(x[-2], "AS") or self._operand(x[-2]) and self._operand(x[-1]))
        names = [x[-1].text if named(x) else None for x in items]
        keys, order = [], []
        for key in split_commas(out[at + 2 :]):
            n = next((k for k, y in enumerate(key) if is_word(y, "ASC", "DESC", "NULLS")), len(key))
            by, how = render(flat(key[:n])).strip(), render(flat(key[n:])).strip()
            if by.isdigit():
                if int(by) > len(items) or any(is_op(x[-1], "*") for x in items[: int(by)]):
                    raise DialectError(f"line {flat(key)[0].line}: ORDER BY {by} in a subquery with a bound")
                item = items[int(by) - 1]
                item = item[1:] if is_word(item[0], "DISTINCT", "ALL") else item
                by = names[int(by) - 1] or render(flat(item)).strip()
            if by.lower() not in {x.lower() for x in names if x}:
                keys.append(f", {by} AS _k{len(keys)}")
                by = f"_k{len(keys) - 1}"
            order.append(f"{by} {how}".rstrip())
        n, m = (render(flat(x)).strip() if x is not None else None for x in (limit, skip))
        bounds = ([f"_r > {m}"] if m else []) + ([f"_r <= {n}" if not m else f"_r <= {m} + {n}"] if n else [])
        body = render(flat(out[start:stop])).strip() + "".join(keys) + " " + render(flat(out[stop:at])).strip()
        without = ", ".join(["_r", *(f"_k{k}" for k in range(len(keys)))])
        return [*out[: start - 1], raw(f"SELECT * EXCEPT ({without}) FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(order) or '1'}) AS _r FROM (SELECT {body.rstrip()})) WHERE {' AND '.join(bounds)}")]

    # expressions
    def expressions(self, x: Tree) -> Tree:
        out: Tree = []
        i = 0
        while i < len(x):
            y = x[i]
            follows = x[i + 1] if i + 1 < len(x) else None
            if (used := constructs.operator(self, x, i, out)) is not None:
                i += used
            elif isinstance(y, list):
                inner = y[1:-1]
                sub = bool(inner) and is_word(inner[0], "SELECT", "WITH")
                out.append([y[0], *(self.subquery(inner, i > 0 and is_word(x[i - 1], "FROM", "JOIN", "AS")) if sub else self.expressions(inner)), y[-1]])
            elif y.kind == "bind":
                out.append(y.with_text(y.text[1:].strip('"') if re.fullmatch(r':"?[A-Za-z_]\w*"?', y.text) else f"`{y.text[1:]}`", "word"))
            elif y.kind == "quoted":
                out.append(y.with_text("`" + y.text[1:-1].replace('""', '"').replace("`", "``") + "`"))
            elif is_op(y, "^=", "~=", "!="):
                out.append(y.with_text("<>"))
            elif is_op(y, "**") and out:
                base, power = self._take(out), self.expressions([follows])
                out.append(raw(f"{before(base)}power({render(flat(base)).strip()}, {render(flat(power)).strip()})"))
                i += 1
            elif is_op(y, "/") and out and self._integral(out[-1]) and follows is not None and self._integral(follows):
                out.append(y.with_text(" DIV ", "raw"))
            elif is_word(y, "STARTING", "CONTAINING") and out:
                i += self._predicate(x, i, out)
            elif is_word(y, "LIKEC", "LIKE2", "LIKE4") and out:
                out.append(y.with_text("LIKE"))
            elif is_word(y, "MOD") and out and self._operand(out[-1]) and self._operand(follows):
                out.append(y.with_text("%", "op"))
            elif is_word(y, "SIMILAR") and is_word(follows, "TO"):
                out.append(y.with_text("RLIKE"))
                i += 1
            elif is_word(y, "SINGULAR") and isinstance(follows, list):
                out.append(raw(f"{y.before}(SELECT count(*) = 1 FROM (SELECT 1 FROM ({render(flat(self.subquery(follows[1:-1]))).strip()}) LIMIT 2))"))
                i += 1
            elif is_word(y) and isinstance(follows, list) and not (is_word(y, "ANY", "SOME", "ALL", "SAMPLE") and (is_word(y, "SAMPLE") or is_word(follows[1], "SELECT"))):
                i += self._call(x, i, out)
            elif is_word(y, *UNARY_NAMES) and not (out and is_op(out[-1], ".")):
                out.append(y.with_text(UNARY_NAMES[y.text.upper()], "raw"))
            elif is_word(y, "NEXT") and is_word(follows, "VALUE") and i + 3 < len(x) and is_word(x[i + 2], "FOR"):
                out.append(raw(f"{y.before or ' '}{self.sequences}('{x[i + 3].text.strip(chr(34)).lower()}', 1)"))
                i += 3
            elif is_word(y, "BLOB") and is_word(follows, "SUBTYPE", "SUB_TYPE"):
                out.append(y.with_text("STRING" if x[i + 2].text.upper() in ("1", "TEXT") else "BINARY"))
                i += 2
            elif is_word(y, "ANY", "SOME", "ALL") and isinstance(follows, list) and is_word(follows[1], "SELECT"):
                i += self._quantified(y, follows, out)
            elif is_word(y, "SAMPLE") and isinstance(follows, list):
                out.append(raw(f"{y.before}TABLESAMPLE ({render(flat(follows[1:-1])).strip()} PERCENT)"))
                i += 1
                if i + 2 < len(x) and is_word(x[i + 1], "SEED"):
                    out.append(raw(f" REPEATABLE {render(flat(x[i + 2])).strip()}"))
                    i += 2
            else:
                out.append(y)
            i += 1
        return out

    @staticmethod
    def _operand(x) -> bool:
        """Whether x may end or begin an operand: brackets, a number, a bind variable or a name that is no keyword."""
        return isinstance(x, list) or isinstance(x, Token) and (x.kind in ("number", "bind", "quoted") or is_word(x) and x.text.upper() not in CLAUSES | {"SELECT", "FROM", "AS", "AND", "OR", "NOT", "ON", "BY", "WHEN", "THEN", "ELSE", "END", "DISTINCT", "ALL", "CASE", "IN", "IS", "LIKE", "BETWEEN", "ASC", "DESC"})

    @staticmethod
    def _take(out: Tree):
        """The operand that ends ``out``: a name, a qualified name, a call or brackets."""
        got = [out.pop()]
        while out and (is_op(out[-1], ".") or is_op(got[0], ".") or isinstance(got[0], list) and is_word(out[-1]) and out[-1].text.upper() not in ("AND", "OR", "NOT", "WHERE", "ON", "WHEN", "THEN", "ELSE", "IN", "SELECT", "HAVING", "BY")):
            got.insert(0, out.pop())
        return got

    def _quantified(self, y: Token, sub: Tree, out: Tree) -> int:
        """``a op ANY (q)`` and ``a op ALL (q)`` as EXISTS over q's one column; unknown comparisons fail ALL, as they leave it unknown."""
        op = out.pop() if out else None
        if not is_op(op, "=", "<>", "<", ">", "<=", ">="):
            raise DialectError(f"line {y.line}: {y.text} without a comparison")
        left = self._take(out)
        a, q = render(flat(left)).strip(), render(flat(self.subquery(sub[1:-1]))).strip()
        if is_word(y, "ALL"):
            test = f"NOT EXISTS (SELECT 1 FROM ({q}) AS q(v) WHERE NOT coalesce({a} {op.text} q.v, false))"
        else:
            test = f"EXISTS (SELECT 1 FROM ({q}) AS q(v) WHERE {a} {op.text} q.v)"
        out.append(raw(f"{before(left) or ' '}{test}"))
        return 1

    def _predicate(self, x: Tree, i: int, out: Tree) -> int:
        """STARTING [WITH] and CONTAINING: prefix, and substring whatever the case."""
        y, used, j = x[i], 1, i + 1
        if is_word(x[j], "WITH"):
            j, used = j + 1, used + 1
        negated = is_word(out[-1], "NOT")
        if negated:
            out.pop()
        left = self._take(out)
        stop = j + 1
        while stop < len(x) and (is_op(x[stop], "||", ".") or is_op(x[stop - 1], "||", ".") or isinstance(x[stop], list)):
            stop += 1
        a, b = render(flat(left)).strip(), render(flat(self.expressions(x[j:stop]))).strip()
        call = f"startswith({a}, {b})" if is_word(y, "STARTING") else f"contains(lower({a}), lower({b}))"
        out.append(raw(f"{before(left) or ' '}{'NOT ' if negated else ''}{call}"))
        return used + (stop - j) - 1

    def _integral(self, x) -> bool:
        if isinstance(x, list):
            inner = [y for y in x[1:-1] if not is_op(y, "+", "-", "*", "/")]
            return bool(inner) and all(self._integral(y) for y in inner)
        return x.kind == "number" and x.text.isdigit() or x.kind in ("word", "bind") and x.text.lstrip(":").lower() in self.integers

    def _call(self, x: Tree, i: int, out: Tree) -> int:
        """A function call x[i] x[i + 1]; returns how many more elements it took."""
        y, name, args = x[i], x[i].text.upper(), x[i + 1]
        inner = args[1:-1]
        put = lambda text: out.append(raw(f"{y.before}{text}"))
        plain = lambda z: render(flat(self.subquery(z) if z and is_word(z[0], "SELECT") else self.expressions(z))).strip()
        parts = split_commas(inner)
        if (used := constructs.call(self, x, i, out)) is not None:
            return used
        if name == "GEN_ID" and len(parts) == 2:
            put(f"{self.sequences}('{render(flat(parts[0])).strip().strip(chr(34)).lower()}', {plain(parts[1])})")
        elif name == "EXTRACT" and inner and is_word(inner[0], "WEEKDAY", "YEARDAY"):
            value = plain(inner[2:])
            put(f"({'dayofweek' if is_word(inner[0], 'WEEKDAY') else 'dayofyear'}({value}) - 1)")
        elif name in ("DATEADD", "DATEDIFF") and parts and len(parts) == 1:  # DATEADD(n unit TO d), DATEDIFF(unit FROM a TO b)
            words = [k for k, z in enumerate(inner) if is_word(z, "TO", "FROM")]
            if name == "DATEADD":
                put(f"dateadd({render(flat(inner[words[0] - 1])).strip()}, {plain(inner[: words[0] - 1])}, {plain(inner[words[0] + 1 :])})")
            else:
                put(f"datediff({render(flat(inner[0])).strip()}, {plain(inner[words[0] + 1 : words[1]])}, {plain(inner[words[1] + 1 :])})")
        elif name in ("TRUNC", "TRUNCATE") and len(parts) <= 2 and parts and not (len(parts) == 2 and parts[1] and isinstance(parts[1][0], Token) and parts[1][0].kind == "string"):
            v, n = plain(parts[0]), plain(parts[1]) if len(parts) == 2 else "0"
            put(f"(sign({v}) * floor(abs({v}) * pow(10, {n})) / pow(10, {n}))")
        elif name in ("LIST", "WM_CONCAT"):
            put(f"listagg({plain(parts[0])}, {plain(parts[1]) if len(parts) > 1 else chr(39) + ',' + chr(39)})")
        elif name == "RATIO_TO_REPORT" and i + 3 <= len(x) and is_word(x[i + 2], "OVER"):
            over = plain([x[i + 3]])
            put(f"({plain(inner)} / sum({plain(inner)}) OVER {over})")
            return 3
        elif name == "JSON_VALUE" and len(parts) == 2:
            put(f"get_json_object({plain(parts[0])}, {plain(parts[1])})")
        elif name == "LNNVL" and len(parts) == 1:
            put(f"coalesce(NOT ({plain(inner)}), true)")
        elif name == "BITAND" and len(parts) == 2 or name == "BIN_AND":
            put("(" + " & ".join(plain(p) for p in parts) + ")")
        elif name == "CAST" and any(is_word(z, "BLOB") for z in inner) or name == "CAST":
            put(f"CAST({plain(_types(inner))})")
        elif name in ("VALUES", "IN", "EXISTS", "AND", "OR", "NOT", "ON", "WHEN", "THEN", "OVER", "USING", "AS", "BY", "FROM", "WHERE", "JOIN", "SELECT", "SET"):
            out.append(y)
            return 0
        else:
            sub = bool(inner) and is_word(inner[0], "SELECT")
            out.append(y.with_text(RENAMED.get(name, y.text)))
            out.append([args[0], *(self.subquery(inner) if sub else self.expressions(inner)), args[-1]])
        return 1


def _types(inner: Tree) -> Tree:
    """A cast's target in Spark's names."""
    from ..catalog.types import UnsupportedTypeError, spark_type

    at = next((k for k in range(len(inner) - 1, -1, -1) if is_word(inner[k], "AS")), None)
    if at is None:
        return inner
    try:
        name = spark_type(render(flat(inner[at + 1 :])).strip()).simpleString()
    except UnsupportedTypeError:
        return inner
    return [*inner[: at + 1], raw(" " + name)]


def translate_query(text: str, integers: Iterable[str] = ()) -> str:
    """A query of the dialect as Spark SQL."""
    x = tree(tokenize(text.strip().rstrip(";")))
    return render(flat(Rewriter(integers).query(x))).strip()


def translate_expression(tokens: list[Token], integers: Iterable[str] = ()) -> str:
    x = tree(tokens)
    return render(flat(Rewriter(integers).expressions(x))).strip()
