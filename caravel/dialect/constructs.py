"""Constructs of the dialect that Spark SQL writes otherwise: format patterns, conversions with defaults, KEEP, hypothetical
ranks, collections, JSON and XML functions, APPLY and joins marked by ``(+)``.

What has no translation raises a ``DialectError`` that names its line; nothing is passed on in the hope that Spark knows it.
"""

from __future__ import annotations

import re

from .tokens import DialectError, Token, render
from .trees import Tree, before, flat, is_op, is_word, raw, split_commas

#: Parts of date formats and Spark's letters for them.
DATE_PARTS = {"YYYY": "yyyy", "RRRR": "yyyy", "YY": "yy", "RR": "yy", "MM": "MM", "MON": "MMM", "DDD": "DDD", "DD": "dd", "DY": "EEE", "Q": "Q", "HH24": "HH", "HH12": "hh", "HH": "hh", "MI": "mm", "SS": "ss", "FF3": "SSS", "FF6": "SSSSSS", "FF": "SSSSSS", "AM": "a", "PM": "a"}
NUMBER_FORMAT = re.compile(r"(?i)(FM)?([S$]?[09GD.,]+(?:MI|PR|S)?)")
REFUSED = ("PREDICTION", "PREDICTION_PROBABILITY", "PREDICTION_SET", "PREDICTION_COST", "PREDICTION_DETAILS", "XMLTABLE", "XMLQUERY", "XMLEXISTS", "XMLROOT", "JSON_TRANSFORM", "JSON_EQUAL")
XML = ("XMLELEMENT", "XMLFOREST", "XMLCOLATTVAL", "XMLAGG", "XMLPI", "XMLCOMMENT", "XMLPARSE", "XMLCONCAT")
END_OF_WHERE = ("GROUP", "HAVING", "ORDER", "LIMIT", "OFFSET", "FETCH", "FOR", "ROWS", "WINDOW", "PLAN", "CONNECT", "START")


def date_pattern(text: str, line: int) -> tuple[str, str]:
    """(Spark's pattern, a function for the case of names or "") for a date format."""
    out, case = "", ""
    for m in re.finditer(r'"([^"]*)"|([A-Za-z]+\d*)|([^A-Za-z"]+)', text):
        if m[1] is not None:
            out += "'" + m[1].replace("'", "''") + "'"
        elif m[3] is not None:
            out += m[3]
        else:
            run = m[2]
            while run:
                part = next((k for k in sorted(DATE_PARTS, key=len, reverse=True) if run.upper().startswith(k)), None)
                if part is None:
                    raise DialectError(f"line {line}: {run} in the format {text!r}")
                if part in ("MON", "DY", "AM", "PM"):
                    given = run[: len(part)]
                    case = "upper" if given.isupper() else "lower" if given.islower() else ""
                out, run = out + DATE_PARTS[part], run[len(part) :]
    return out, case


def _literal(run: Tree, what: str, line: int) -> str:
    if len(run) != 1 or not isinstance(run[0], Token) or run[0].kind != "string":
        raise DialectError(f"line {line}: {what} without a literal format")
    return run[0].text[1:-1].replace("''", "'")


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(r, run: Tree) -> str:
    return render(flat(r.subquery(run) if run and is_word(run[0], "SELECT") else r.expressions(run))).strip()


def _find(run: Tree, *words: str) -> int | None:
    return next((i for i in range(len(run) - len(words) + 1) if all(is_word(run[i + k], w) for k, w in enumerate(words))), None)


def refuse(x: Tree) -> None:
    """A ``DialectError`` for clauses of a block that have no translation."""
    for words, what in ((("ORDER", "SIBLINGS"), "ORDER SIBLINGS BY"), (("AS", "OF"), "AS OF"), (("VERSIONS", "BETWEEN"), "VERSIONS"), (("DIMENSION", "BY"), "MODEL"), (("SEARCH", "DEPTH"), "SEARCH"), (("SEARCH", "BREADTH"), "SEARCH")):
        at = _find(x, *words)
        if at is not None:
            raise DialectError(f"line {x[at].line}: {what} has no translation")
    cycle = next((i for i, y in enumerate(x) if is_word(y, "CYCLE") and i and isinstance(x[i - 1], list) and any(is_word(z, "SET") for z in x[i:])), None)
    if cycle is not None:
        raise DialectError(f"line {x[cycle].line}: CYCLE has no translation")
    for i, y in enumerate(x[:-2]):
        if is_word(y, "PARTITION") and is_word(x[i + 1], "BY") and isinstance(x[i + 2], list) and any(is_word(z, "JOIN") for z in x[i + 3 : i + 6]):
            raise DialectError(f"line {y.line}: a partitioned outer join has no translation")


def _marked(run: Tree) -> list[str]:
    """Qualifiers of the columns in a run that ``(+)`` stands after."""
    out = []
    for i, y in enumerate(run):
        if isinstance(y, list):
            if len(y) == 3 and is_op(y[1], "+"):
                if i < 3 or not is_op(run[i - 2], "."):
                    raise DialectError(f"line {y[0].line}: (+) after a column without its table's name")
                out.append(run[i - 3].text.strip('"').lower())
            else:
                out += _marked(y[1:-1])
    return out


def _unmarked(run: Tree) -> Tree:
    return [[y[0], *_unmarked(y[1:-1]), y[-1]] if isinstance(y, list) else y for y in run if not (isinstance(y, list) and len(y) == 3 and is_op(y[1], "+"))]


def _conjuncts(run: Tree) -> list[Tree]:
    out, between, cases = [[]], 0, 0
    for y in run:
        cases += is_word(y, "CASE") - is_word(y, "END")
        if is_word(y, "AND") and not cases:
            if between:
                between -= 1
            else:
                out.append([])
                continue
        between += is_word(y, "BETWEEN") and not cases
        out[-1].append(y)
    return out


def marked_joins(r, x: Tree) -> Tree:
    """A block whose WHERE marks columns with ``(+)``, with LEFT JOINs instead; other blocks as they are."""
    start, where = _find(x, "FROM"), _find(x, "WHERE")
    if start is None or where is None or where < start:
        return x
    stop = next((i for i in range(where, len(x)) if is_word(x[i], *END_OF_WHERE)), len(x))
    if not _marked(x[where + 1 : stop]):
        return x
    line, sources = x[where].line, {}
    for source in split_commas(x[start + 1 : where]):
        if any(is_word(y, "JOIN") for y in source):
            raise DialectError(f"line {line}: (+) beside JOIN")
        sources[flat(source[-1:])[-1].text.strip('"').lower()] = source
    joins: dict[str, list[Tree]] = {}
    rest = []
    for c in _conjuncts(x[where + 1 : stop]):
        names = set(_marked(c))
        if len(names) > 1 or names and (any(is_word(y, "OR") for y in c) or not names <= set(sources)):
            raise DialectError(f"line {line}: (+) on {', '.join(sorted(names))} in one condition")
        (joins.setdefault(names.pop(), []) if names else rest).append(_unmarked(c))
    used = {k: {y.text.strip('"').lower() for c in cs for y, z in zip(flat(c), flat(c)[1:], strict=False) if is_op(z, ".")} & set(sources) - {k} for k, cs in joins.items()}
    plain = [k for k in sources if k not in joins]
    done, order = set(plain), []
    while len(order) < len(joins):
        ready = next((k for k in joins if k not in done and used[k] <= done), None)
        if ready is None or not plain:
            raise DialectError(f"line {line}: outer joins by (+) that need each other")
        order.append(ready)
        done.add(ready)
    out: Tree = [*x[: start + 1]]
    for i, k in enumerate(plain):
        out += [raw(" CROSS JOIN")] * (i > 0) + sources[k]
    for k in order:
        out += [raw(" LEFT JOIN"), *sources[k], raw(" ON")]
        for i, c in enumerate(joins[k]):
            out += [raw(" AND")] * (i > 0) + c
    for i, c in enumerate(rest):
        out += [raw(" AND") if i else x[where], *c]
    return out + x[stop:]


def _right(x: Tree, j: int) -> int:
    """The end of the operand that begins at x[j]: a name, a qualified name or a call."""
    j += 1
    while j < len(x) and (isinstance(x[j], list) or is_op(x[j], ".") or is_op(x[j - 1], ".")):
        j += 1
    return j


def operator(r, x: Tree, i: int, out: Tree) -> int | None:
    """Operators between operands; returns how many more elements they took, None where x[i] begins none."""
    y = x[i]
    word = lambda k: x[i + k].text.upper() if i + k < len(x) and is_word(x[i + k]) else ""
    if not is_word(y):
        if is_op(y, "%") and word(1) in ("ISOPEN", "FOUND", "NOTFOUND", "ROWCOUNT"):
            raise DialectError(f"line {y.line}: %{word(1)} has no translation")
        return None
    if word(0) == "CURRENT" and word(1) == "OF":
        raise DialectError(f"line {y.line}: WHERE CURRENT OF has no translation")
    if word(0) in ("CROSS", "OUTER") and word(1) == "APPLY" and i + 2 < len(x):
        out.append(raw(f"{y.before}{'CROSS' if word(0) == 'CROSS' else 'LEFT'} JOIN LATERAL"))
        return 1
    if word(0) == "IS" and out:
        negated = word(1) == "NOT"
        test, used = word(1 + negated), 1 + negated
        if test in ("NAN", "INFINITE", "JSON", "EMPTY"):
            left = r._take(out)
            a = render(flat(left)).strip()
            if test == "EMPTY" or test == "JSON" and word(2 + negated) in ("STRICT", "LAX", "WITH", "WITHOUT"):
                raise DialectError(f"line {y.line}: IS {test} {word(2 + negated)}".rstrip())
            made = {"NAN": f"isnan({a})", "INFINITE": f"abs({a}) = double('Infinity')", "JSON": f"try_parse_json({a}) IS NOT NULL"}[test]
            out.append(raw(f"{before(left) or ' '}{'NOT ' if negated else ''}({made})"))
            return used
        if test == "A" and word(2 + negated) == "SET" or test == "OF" or test in ("PRESENT", "ANY"):
            raise DialectError(f"line {y.line}: IS {test} has no translation")
        return None
    if word(0) in ("MEMBER", "SUBMULTISET") and out and (word(0) == "SUBMULTISET" or word(1) == "OF"):
        j = i + 1 + (word(1) == "OF")
        negated = is_word(out[-1], "NOT")
        if negated:
            out.pop()
        left, stop = r._take(out), _right(x, j)
        a, b = render(flat(left)).strip(), _text(r, x[j:stop])
        made = f"array_contains({b}, {a})" if word(0) == "MEMBER" else f"forall({a}, v -> {_count(a)} <= {_count(b)})"
        out.append(raw(f"{before(left) or ' '}{'NOT ' if negated else ''}{made}"))
        return stop - i - 1
    if word(0) == "MULTISET" and word(1) in ("UNION", "INTERSECT", "EXCEPT") and out:
        how, j = word(2) if word(2) in ("ALL", "DISTINCT") else "", i + 2
        j += bool(how)
        left, stop = r._take(out), _right(x, j)
        a, b = render(flat(left)).strip(), _text(r, x[j:stop])
        if how == "DISTINCT":
            made = f"array_{word(1).lower()}({a}, {b})"
        elif word(1) == "UNION":
            made = f"concat({a}, {b})"
        else:
            n = f"least({_count(a)}, {_count(b)})" if word(1) == "INTERSECT" else f"greatest({_count(a)} - {_count(b)}, 0)"
            made = f"flatten(transform(array_distinct({a}), v -> array_repeat(v, {n})))"
        out.append(raw(f"{before(left) or ' '}{made}"))
        return stop - i - 1
    return None


def _count(a: str) -> str:
    return f"size(filter({a}, u -> u <=> v))"


def _pairs(r, part: Tree, line: int) -> tuple[str, str]:
    """Key and value of a JSON member: KEY k VALUE v, k VALUE v or k IS v."""
    part = part[1:] if is_word(part[0], "KEY") else part
    at = next((k for k, z in enumerate(part) if is_word(z, "VALUE", "IS")), None)
    if at is None:
        raise DialectError(f"line {line}: a JSON member without VALUE")
    return _text(r, part[:at]), _text(r, part[at + 1 :])


def _options(inner: Tree) -> tuple[Tree, bool | None]:
    """A JSON function's arguments without NULL ON NULL, ABSENT ON NULL and RETURNING; whether nulls stay, None if not said."""
    at, nulls = next((k for k in range(len(inner) - 2) if is_word(inner[k], "NULL", "ABSENT") and is_word(inner[k + 1], "ON") and is_word(inner[k + 2], "NULL")), None), None
    if at is not None:
        nulls = is_word(inner[at], "NULL")
        inner = inner[:at] + inner[at + 3 :]
    back = _find(inner, "RETURNING")
    return (inner[:back] if back is not None else inner), nulls


def _ordered(r, part: Tree, line: int) -> tuple[str, str | None, bool]:
    """(value, order's expression, descending) of an aggregate's argument with ORDER BY."""
    at = _find(part, "ORDER", "BY")
    if at is None:
        return _text(r, part), None, False
    keys = split_commas(part[at + 2 :])
    if len(keys) != 1 or any(is_word(z, "NULLS") for z in keys[0]):
        raise DialectError(f"line {line}: an aggregate ordered by more than one plain key")
    down = is_word(keys[0][-1], "DESC")
    return _text(r, part[:at]), _text(r, [z for z in keys[0] if not is_word(z, "ASC", "DESC")]), down


def _collected(value: str, key: str | None, down: bool) -> str:
    if key is None:
        return f"collect_list({value})"
    lists = f"array_sort(filter(collect_list(named_struct('k', {key}, 'v', {value})), e -> e.v IS NOT NULL))"
    return f"transform({f'reverse({lists})' if down else lists}, e -> e.v)"


def _escaped(r, part: Tree) -> str:
    """XML content: nested XML functions as they are, other values with & < > escaped."""
    text = _text(r, part)
    if part and is_word(part[0], *XML):
        return f"coalesce({text}, '')"
    return f"coalesce(replace(replace(replace(CAST({text} AS STRING), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '')"


def _name(run: Tree) -> str:
    return flat(run)[-1].text.strip('"`')


def _json_table(r, y: Token, inner: Tree) -> str:
    """JSON_TABLE(doc, '$.path[*]' COLUMNS (c type PATH '$.p', n FOR ORDINALITY)) as a lateral subquery."""
    at = _find(inner, "COLUMNS")
    if at is None or at + 1 >= len(inner) or not isinstance(inner[at + 1], list):
        raise DialectError(f"line {y.line}: JSON_TABLE without COLUMNS")
    source = split_commas(inner[:at])
    doc, path = _text(r, source[0]), _literal([z for z in source[1] if not is_word(z)], "JSON_TABLE", y.line) if len(source) > 1 else "$"
    from .rewrite import _types

    cols = []
    for c in split_commas(inner[at + 1][1:-1]):
        p = _find(c, "PATH")
        if _find(c, "FOR", "ORDINALITY") is not None:
            cols.append(f"i + 1 AS {_name(c[:1])}")
        elif p is None or _find(c, "NESTED") is not None:
            raise DialectError(f"line {y.line}: a JSON_TABLE column without PATH")
        else:
            kind = render(flat(_types([Token("word", "AS", y.line), *c[1:p]])[1:])).strip()
            cols.append(f"CAST(get_json_object(e, {_quote(_literal(c[p + 1 : p + 2], 'PATH', y.line))}) AS {kind}) AS {_name(c[:1])}")
    if path.endswith("[*]"):
        held = doc if path == "$[*]" else f"get_json_object({doc}, {_quote(path[:-3])})"
        items = f"from_json({held}, 'array<string>')"
    else:
        items = f"array(get_json_object({doc}, {_quote(path)}))" if path != "$" else f"array({doc})"
    return f"LATERAL (SELECT {', '.join(cols)} FROM (SELECT posexplode({items}) AS (i, e)))"


def call(r, x: Tree, i: int, out: Tree) -> int | None:
    """Calls x[i] x[i + 1]; returns how many more elements they took, None where the call is an ordinary one."""
    y, name, inner = x[i], x[i].text.upper(), x[i + 1][1:-1]
    parts = split_commas(inner)
    after = lambda k, *words: i + k < len(x) and is_word(x[i + k], *words)

    def put(text: str, used: int = 1) -> int:
        out.append(raw(f"{y.before or ' '}{text}"))
        return used

    if name in REFUSED:
        raise DialectError(f"line {y.line}: {name} has no translation")
    if after(2, "KEEP") and i + 3 < len(x) and isinstance(x[i + 3], list):
        return put(*_keep(r, y, name, inner, x[i + 3][1:-1]), 3)
    if name in ("RANK", "DENSE_RANK", "CUME_DIST", "PERCENT_RANK") and inner and after(2, "WITHIN") and after(3, "GROUP"):
        value, key, down = _ordered(r, [*inner, *x[i + 4][1:-1]], y.line)
        op = ">" if down else "<"
        return put({"RANK": f"(1 + count_if({key} {op} {value}))", "DENSE_RANK": f"(1 + count(DISTINCT CASE WHEN {key} {op} {value} THEN {key} END))", "CUME_DIST": f"((count_if({key} {op}= {value}) + 1) / (count(*) + 1))", "PERCENT_RANK": f"(count_if({key} {op} {value}) / count(*))"}[name], 4)
    if name in ("TO_CHAR", "TO_DATE", "TO_TIMESTAMP") and len(parts) == 2:
        fmt = _literal(parts[1], name, y.line)
        number = NUMBER_FORMAT.fullmatch(fmt)
        if name == "TO_CHAR" and number:
            return put(f"{'trim' if number[1] else ''}(to_char({_text(r, parts[0])}, '{number[2]}'))")
        pattern, case = date_pattern(fmt, y.line)
        if name == "TO_CHAR":
            return put(f"{case}(date_format({_text(r, parts[0])}, {_quote(pattern)}))")
        return put(f"{'to_date' if name == 'TO_DATE' else 'to_timestamp_ntz'}({_text(r, parts[0])}, {_quote(pattern)})")
    if name == "TO_CHAR" and len(parts) == 1:
        return put(f"CAST({_text(r, inner)} AS STRING)")
    if name in ("CAST", "VALIDATE_CONVERSION") and _find(inner, "AS") is not None:
        at, default = _find(inner, "AS"), _find(inner, "DEFAULT")
        if name == "CAST" and default is None:
            return None
        from .rewrite import _types

        a, kind = _text(r, inner[:at]), render(flat(_types(inner[:default] if default is not None else inner)[at + 1 :])).strip()
        if name == "VALIDATE_CONVERSION":
            return put(f"CASE WHEN {a} IS NULL OR try_cast({a} AS {kind}) IS NOT NULL THEN 1 ELSE 0 END")
        stop = _find(inner, "ON", "CONVERSION")
        return put(f"CASE WHEN {a} IS NOT NULL THEN coalesce(try_cast({a} AS {kind}), CAST({_text(r, inner[default + 1 : stop])} AS {kind})) END")
    if name in ("TO_DSINTERVAL", "TO_YMINTERVAL", "TO_BINARY_DOUBLE", "TO_BINARY_FLOAT") and len(parts) == 1:
        kind = {"TO_DSINTERVAL": "INTERVAL DAY TO SECOND", "TO_YMINTERVAL": "INTERVAL YEAR TO MONTH", "TO_BINARY_DOUBLE": "DOUBLE", "TO_BINARY_FLOAT": "FLOAT"}[name]
        return put(f"CAST({_text(r, inner)} AS {kind})")
    if name == "COLLECT":
        return put(_collected(*_ordered(r, inner, y.line)))
    if name == "CURSOR" and inner and is_word(inner[0], "SELECT", "WITH"):
        return put(f"(SELECT collect_list(struct(*)) FROM ({_text(r, inner)}))")
    if name == "LAG_DIFF" and len(parts) == 1 and after(2, "OVER"):
        a, over = _text(r, inner), render(flat(r.expressions([x[i + 3]]))).strip()
        return put(f"({a} - lag({a}) OVER {over})", 3)
    if name.startswith("JSON_"):
        return _json(r, y, name, inner, put)
    if name.startswith("XML"):
        return _xml(r, y, name, inner, put)
    return None


def _keep(r, y: Token, name: str, inner: Tree, keep: Tree) -> tuple[str]:
    """MIN and MAX over the rows that are first or last by one key; a null key counts as the least."""
    at = _find(keep, "ORDER", "BY")
    if not is_word(keep[0], "DENSE_RANK") or at is None or not is_word(keep[1], "FIRST", "LAST"):
        raise DialectError(f"line {y.line}: KEEP without DENSE_RANK FIRST or LAST")
    value, key, down = _ordered(r, [*inner, *keep[at:]], y.line)
    least = is_word(keep[1], "FIRST") != down
    if name == "MAX" and not least:
        return (f"max(named_struct('k', {key}, 'v', {value})).v",)
    if name == "MIN" and least:
        return (f"min(named_struct('k', {key}, 'n', {value} IS NULL, 'v', {value})).v",)
    raise DialectError(f"line {y.line}: {name} with KEEP at the {'least' if least else 'greatest'} key has no translation")


def _json(r, y: Token, name: str, inner: Tree, put) -> int | None:
    args, nulls = _options(inner)
    parts = split_commas(args)
    if name == "JSON_OBJECT":
        members = [_pairs(r, p, y.line) for p in parts]
        return put(f"to_json(named_struct({', '.join(f'{k}, {v}' for k, v in members)}), map('ignoreNullFields', '{str(nulls is False).lower()}'))" if members else "'{}'")
    if name == "JSON_ARRAY":
        one = "substr(to_json(array({0})), 2, char_length(to_json(array({0}))) - 2)"
        items = [one.format(a) if nulls else f"CASE WHEN {a} IS NOT NULL THEN {one.format(a)} END" for a in (_text(r, p) for p in parts)]
        return put(f"concat('[', concat_ws(',', {', '.join(items)}), ']')" if items else "'[]'")
    if name == "JSON_ARRAYAGG":
        if nulls:
            raise DialectError(f"line {y.line}: JSON_ARRAYAGG with NULL ON NULL")
        return put(f"to_json({_collected(*_ordered(r, args, y.line))})")
    if name == "JSON_OBJECTAGG":
        k, v = _pairs(r, args, y.line)
        held = f"collect_list(named_struct('k', CAST({k} AS STRING), 'v', {v}))"
        return put(f"to_json(map_from_entries({held if nulls is not False else f'filter({held}, e -> e.v IS NOT NULL)'}))")
    if name in ("JSON_QUERY", "JSON_EXISTS") and len(parts) == 2:
        got = f"get_json_object({_text(r, parts[0])}, {_quote(_literal(parts[1], name, y.line))})"
        return put(got if name == "JSON_QUERY" else f"({got} IS NOT NULL)")
    if name == "JSON_SERIALIZE" and len(parts) == 1:
        return put(f"CAST({_text(r, args)} AS STRING)")
    if name == "JSON_TABLE":
        return put(_json_table(r, y, inner))
    return None


def _xml(r, y: Token, name: str, inner: Tree, put) -> int | None:
    parts = split_commas(inner)
    if name == "XMLELEMENT":
        tag, attributes, content = _name(parts[0]), "", parts[1:]
        if content and is_word(content[0][0], "XMLATTRIBUTES"):
            for a in split_commas(content[0][1][1:-1]):
                at = _find(a, "AS")
                value = _escaped(r, a[:at] if at is not None else a)
                attributes += f", concat(' {_name(a)}=\"', replace({value}, '\"', '&quot;'), '\"')"
            content = content[1:]
        return put(f"concat('<{tag}'{attributes}, '>', {''.join(_escaped(r, c) + ', ' for c in content)}'</{tag}>')")
    if name == "XMLFOREST":
        made = []
        for a in parts:
            at = _find(a, "AS")
            value = a[:at] if at is not None else a
            made.append(f"CASE WHEN {_text(r, value)} IS NOT NULL THEN concat('<{_name(a)}>', {_escaped(r, value)}, '</{_name(a)}>') ELSE '' END")
        return put(f"concat({', '.join(made)})")
    if name == "XMLCOLATTVAL":
        named = [(_name(a), a[: _find(a, "AS")] if _find(a, "AS") is not None else a) for a in parts]
        return put(f"concat({', '.join(f'''concat('<column name="{n}">', {_escaped(r, v)}, '</column>')''' for n, v in named)})")
    if name == "XMLAGG":
        return put(f"array_join({_collected(*_ordered(r, inner, y.line))}, '')")
    if name == "XMLCONCAT":
        return put(f"concat_ws('', {', '.join(_text(r, p) for p in parts)})")
    if name in ("XMLPARSE", "XMLSERIALIZE") and is_word(inner[0], "CONTENT", "DOCUMENT"):
        stop = next((k for k, z in enumerate(inner) if is_word(z, "AS", "WELLFORMED")), len(inner))
        return put(f"CAST({_text(r, inner[1:stop])} AS STRING)")
    if name == "XMLPI" and parts:
        return put(f"concat('<?{_name(parts[0])}'{''.join(', coalesce(concat(chr(32), ' + _text(r, p) + '), chr(32))' for p in parts[1:])}, '?>')")
    if name == "XMLCOMMENT":
        return put(f"concat('<!--', {_text(r, inner)}, '-->')")
    return None
