"""A recursive-descent parser for the dialect's objects and procedural statements.

Queries and expressions stay token runs; ``rewrite`` turns them into Spark SQL.  Every error names its line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .tokens import DialectError, Token, render, tokenize

__all__ = ["DialectError", "parse_script"]

Run = list[Token]


@dataclass(frozen=True)
class Parameter:
    name: str
    type: str
    default: Run | None = None


# procedural statements
@dataclass
class Block:
    declarations: list[Parameter] = field(default_factory=list)
    body: list = field(default_factory=list)
    handlers: list[tuple[str, list]] = field(default_factory=list)


@dataclass
class If:
    condition: Run
    then: object
    other: object | None


@dataclass
class While:
    condition: Run
    body: object
    label: str | None = None


@dataclass
class ForSelect:
    query: Run
    into: list[str]
    body: object
    label: str | None = None


@dataclass
class ForExecute:
    text: Run
    into: list[str]
    body: object
    label: str | None = None


@dataclass
class SelectInto:
    query: Run
    into: list[str]


@dataclass
class Assign:
    target: str
    value: Run


@dataclass
class Suspend:
    pass


@dataclass
class Leave:
    label: str | None = None
    again: bool = False


@dataclass
class Exit:
    pass


@dataclass
class Raise:
    name: str
    message: Run | None = None


@dataclass
class Call:
    name: str
    arguments: list[Run]
    into: list[str]


@dataclass
class Execute:
    text: Run
    into: list[str]


@dataclass
class Dml:
    verb: str
    tokens: Run
    into: list[str] = field(default_factory=list)


# objects
@dataclass
class View:
    name: str
    columns: list[str]
    query: Run


@dataclass
class Procedure:
    name: str
    ins: list[Parameter]
    outs: list[Parameter]
    block: Block


@dataclass
class Trigger:
    name: str
    table: str
    phase: str
    events: list[str]
    block: Block
    active: bool = True
    position: int = 0


@dataclass
class Statement:
    """A query, a DML or DDL statement at the top of a script."""

    verb: str
    tokens: Run


def name_of(t: Token) -> str:
    return t.text[1:-1].replace('""', '"') if t.kind == "quoted" else t.text.lstrip(":").strip('"')


class Parser:
    def __init__(self, text: str):
        self.tokens, self.at = tokenize(text), 0
        self.result, self.loops, self.made = None, 0, 0  # a function's output, LOOPs around, names made

    # plumbing
    @property
    def now(self) -> Token:
        return self.tokens[self.at]

    def fail(self, want: str) -> DialectError:
        t = self.now
        return DialectError(f"line {t.line}: {want} expected, found {t.text!r}" if t.kind != "end" else f"line {t.line}: {want} expected, the text ends")

    def next(self) -> Token:
        t = self.now
        if t.kind == "end":
            raise self.fail("more")
        self.at += 1
        return t

    def ahead(self, *words: str, skip: int = 0) -> bool:
        return all(self.at + skip + i < len(self.tokens) and self.tokens[self.at + skip + i].key == w and self.tokens[self.at + skip + i].kind in ("word", "op") for i, w in enumerate(words))

    def take(self, *words: str) -> bool:
        if self.ahead(*words):
            self.at += len(words)
            return True
        return False

    def need(self, *words: str) -> None:
        for w in words:
            if not self.take(w):
                raise self.fail(w)

    def name(self, what: str = "a name") -> str:
        if self.now.kind not in ("word", "quoted"):
            raise self.fail(what)
        return name_of(self.next())

    def until(self, *stops: str, eat: bool = True) -> Run:
        """Tokens to a stop outside brackets and CASE; the stop is eaten."""
        out, depth, cases = [], 0, 0
        while True:
            t = self.now
            if t.kind == "end":
                raise self.fail(" or ".join(stops))
            if depth == 0 and not (cases and t.key != ";") and t.kind in ("word", "op") and t.key in stops:
                if eat:
                    self.at += 1
                return out
            depth += (t.text == "(") - (t.text == ")")
            cases += (t.key == "CASE" and t.kind == "word") - (t.key == "END" and t.kind == "word" and cases > 0)
            if depth < 0:
                raise self.fail("no )")
            out.append(self.next())

    def bracketed(self) -> Run:
        self.need("(")
        depth, out = 1, []
        while depth:
            t = self.next()
            depth += (t.text == "(" and t.kind == "op") - (t.text == ")" and t.kind == "op")
            if depth:
                out.append(t)
        return out

    # scripts and objects
    def script(self) -> list:
        out = []
        while self.now.kind != "end":
            if self.take(";"):
                continue
            out.append(self.unit())
        return out

    def unit(self):
        if self.ahead("CREATE") or self.ahead("RECREATE") or self.ahead("ALTER"):
            start = self.at
            self.next()
            if self.take("OR"):
                if not (self.take("ALTER") or self.take("REPLACE")):
                    raise self.fail("ALTER or REPLACE")
            for word, rule in (("VIEW", self.view), ("PROCEDURE", self.procedure), ("FUNCTION", self.function), ("TRIGGER", self.trigger)):
                if self.take(word):
                    return rule()
            if self.ahead("TABLE") or self.ahead("SEQUENCE") or self.ahead("GENERATOR") or self.ahead("DOMAIN") or self.ahead("EXCEPTION"):
                verb = f"CREATE {self.now.key}"
                self.at = start
                return Statement(verb, self.to_end())
            raise self.fail("VIEW, PROCEDURE, FUNCTION, TRIGGER, TABLE, SEQUENCE, DOMAIN or EXCEPTION")
        if self.now.key in ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "MERGE", "COMMIT", "ROLLBACK", "SAVEPOINT", "LOCK", "SET", "EXPLAIN", "DROP") and self.now.kind == "word" or self.ahead("("):
            verb = self.now.key
            return Statement(verb, self.to_end())
        if self.ahead("DECLARE") or self.ahead("BEGIN"):
            return Procedure("block", [], [], self.body())
        if self.ahead("EXECUTE", "BLOCK"):
            self.at += 2
            ins = self.parameters() if self.ahead("(") else []
            outs = self.parameters() if self.take("RETURNS") else []
            self.need("AS")
            return Procedure("block", ins, outs, self.body())
        raise self.fail("a statement")

    def to_end(self) -> Run:
        out, depth = [], 0
        while self.now.kind != "end" and not (depth == 0 and self.ahead(";")):
            depth += (self.now.text == "(") - (self.now.text == ")")
            if depth < 0:
                raise self.fail("no )")
            out.append(self.next())
        if depth:
            raise self.fail(")")
        self.take(";")
        return out

    def view(self) -> View:
        name, columns = self.name(), []
        if self.ahead("("):
            columns = [name_of(t) for t in self.bracketed() if t.kind in ("word", "quoted")]
        self.need("AS")
        query = self.to_end()
        if not query:
            raise self.fail("a query")
        return View(name, columns, query)

    def parameters(self) -> list[Parameter]:
        inner, out, run, depth = self.bracketed(), [], [], 0
        for t in [*inner, Token("op", ",", 0)]:
            depth += (t.text == "(") - (t.text == ")")
            if t.text == "," and depth == 0:
                if run:
                    out.append(self.parameter(run))
                run = []
            else:
                run.append(t)
        return out

    @staticmethod
    def parameter(run: Run) -> Parameter:
        at = next((i for i, t in enumerate(run) if t.text == "=" or t.key == "DEFAULT"), len(run))
        kind = [t for i, t in enumerate(run[1:at]) if not (t.key in ("NOT", "NULL") and t.kind == "word")]
        if not kind:
            raise DialectError(f"line {run[0].line}: {run[0].text} has no type")
        return Parameter(name_of(run[0]), render(kind).strip(), run[at + 1 :] or None)

    def procedure(self) -> Procedure:
        name = self.name()
        ins = self.parameters() if self.ahead("(") else []
        outs = self.parameters() if self.take("RETURNS") else []
        self.need("AS")
        return Procedure(name, ins, outs, self.body())

    def function(self) -> Procedure:
        """A function is a procedure with one output, ``result``, that RETURN sets."""
        name = self.name()
        ins = self.parameters() if self.ahead("(") else []
        self.need("RETURNS")
        kind = self.until("AS")
        if not kind:
            raise self.fail("a type")
        self.result = "result"
        block = self.body()
        self.result = None
        return Procedure(name, ins, [Parameter("result", render(kind).strip())], block)

    def trigger(self) -> Trigger:
        name = self.name()
        self.need("FOR")
        table, active = self.name("a table"), True
        if self.take("INACTIVE"):
            active = False
        else:
            self.take("ACTIVE")
        if self.now.key not in ("BEFORE", "AFTER"):
            raise self.fail("BEFORE or AFTER")
        phase, events = self.next().key, []
        while True:
            if self.now.key not in ("INSERT", "UPDATE", "DELETE"):
                raise self.fail("INSERT, UPDATE or DELETE")
            events.append(self.next().key)
            if not self.take("OR"):
                break
        position = int(self.next().text) if self.take("POSITION") else 0
        self.need("AS")
        return Trigger(name, table, phase, events, self.body(), active, position)

    # procedural statements
    def body(self) -> Block:
        declared = []
        while self.take("DECLARE"):
            self.take("VARIABLE")
            run = self.until(";")
            declared.append(self.parameter(run))
        if not self.ahead("BEGIN"):
            raise self.fail("BEGIN")
        block = self.block()
        block.declarations = declared
        self.take(";")
        return block

    def block(self) -> Block:
        self.need("BEGIN")
        out = Block()
        while not self.take("END"):
            if self.ahead("WHEN"):
                self.next()
                what = render(self.until("DO")).strip()
                out.handlers.append((what, [self.statement()]))
                continue
            if self.take(";"):
                continue
            out.body.append(self.statement())
        return out

    def names(self) -> list[str]:
        out = []
        while True:
            t = self.now
            if t.kind not in ("bind", "word", "quoted"):
                raise self.fail("a variable")
            self.next()
            name = name_of(t)
            if self.take("."):
                name += "." + self.name()
            out.append(name)
            if not self.take(","):
                return out

    def statement(self):
        label = None
        if self.now.kind == "word" and self.tokens[self.at + 1].kind == "bind" and self.tokens[self.at + 1].key.upper() in (":WHILE", ":FOR"):
            label = self.next().text
            t = self.tokens[self.at]
            self.tokens[self.at] = t.with_text(t.text[1:], "word")
        key = self.now.key if self.now.kind == "word" else ""
        if key == "BEGIN":
            block = self.block()
            self.take(";")
            return block
        if key == "IF":
            self.next()
            condition = self.bracketed()
            self.need("THEN")
            then = self.statement()
            return If(condition, then, self.statement() if self.take("ELSE") else None)
        if key == "WHILE":
            self.next()
            condition = self.bracketed()
            self.need("DO")
            return While(condition, self.statement(), label)
        if key == "LOOP":
            return While([Token("word", "TRUE", self.now.line)], self.loop(), label)
        if key == "CASE":
            return self.cases()
        if key == "RETURN":
            return self.returned()
        if key == "RAISE":
            self.next()
            name = self.name() if self.now.kind in ("word", "quoted") else ""
            self.need(";")
            return Raise(name)
        if key in ("OPEN", "FETCH", "CLOSE", "FORALL", "PIPE", "GOTO") and self.tokens[self.at + 1].kind in ("word", "quoted", "bind"):
            raise DialectError(f"line {self.now.line}: {key} has no translation")
        if key == "FOR" and self.tokens[self.at + 2].key == "IN" and self.tokens[self.at + 1].kind == "word":
            return self.counted(label)
        if key == "FOR":
            self.next()
            if self.take("EXECUTE", "STATEMENT"):
                text = self.until("INTO", "DO")
                into = self.names_until_do() if self.tokens[self.at - 1].key == "INTO" else []
                return ForExecute(text, into, self.statement(), label)
            query = self.until("INTO", "DO")
            into = self.names_until_do() if self.tokens[self.at - 1].key == "INTO" else []
            return ForSelect(query, into, self.statement(), label)
        if key in ("SELECT", "WITH"):
            query = self.until("INTO", ";")
            if self.tokens[self.at - 1].key == ";":
                raise DialectError(f"line {self.tokens[self.at - 1].line}: a query without INTO")
            into = self.names()
            rest = self.until(";")  # INTO may stand before FROM
            return SelectInto(query + rest, into)
        if key in ("INSERT", "UPDATE", "DELETE", "MERGE"):
            run = self.until(";")
            at = next((i for i, t in enumerate(run) if t.key == "RETURNING" and t.kind == "word"), None)
            into: list[str] = []
            if at is not None:
                cut = next((i for i in range(at, len(run)) if run[i].key == "INTO" and run[i].kind == "word"), len(run))
                into = [name_of(t) for t in run[cut + 1 :] if t.kind in ("bind", "word")]
                run = run[:cut]
            return Dml(key, run, into)
        if key == "SUSPEND":
            self.next()
            self.need(";")
            return Suspend()
        if key in ("LEAVE", "BREAK", "CONTINUE") or key == "EXIT" and (self.loops or self.ahead("WHEN", skip=1)):
            self.next()
            label = self.name() if self.now.kind == "word" and not self.ahead("WHEN") else None
            leave = Leave(label, key == "CONTINUE")
            if self.take("WHEN"):
                return If(self.until(";"), leave, None)
            self.need(";")
            return leave
        if key == "EXIT":
            self.next()
            self.need(";")
            return Exit()
        if key == "EXCEPTION":
            self.next()
            name = self.name() if self.now.kind in ("word", "quoted") else ""
            return Raise(name, self.until(";") or None)
        if key == "EXECUTE":
            self.next()
            if self.take("PROCEDURE"):
                return self.call()
            if self.take("STATEMENT") or self.take("IMMEDIATE"):
                text = self.until("INTO", "USING", ";")
                if self.tokens[self.at - 1].key == "USING":
                    raise DialectError(f"line {self.tokens[self.at - 1].line}: EXECUTE with USING has no translation")
                into = []
                if self.tokens[self.at - 1].key == "INTO":
                    into = self.names()
                    self.need(";")
                return Execute(text, into)
            raise self.fail("PROCEDURE, STATEMENT or IMMEDIATE")
        if self.now.kind in ("word", "bind", "quoted"):
            target = name_of(self.next())
            if self.take("."):
                target += "." + self.name()
            if not (self.take("=") or self.take(":=")):
                raise self.fail("=")
            value = self.until(";")
            if not value:
                raise self.fail("a value")
            return Assign(target, value)
        raise self.fail("a statement")

    def loop(self) -> Block:
        """LOOP ... END LOOP"""
        self.need("LOOP")
        self.loops += 1
        body = self.until_end("LOOP")
        self.loops -= 1
        return Block(body=body)

    def until_end(self, word: str, *stops: str) -> list:
        """Statements to END word, or to one of the stops, which stays."""
        out = []
        while not any(self.ahead(s) for s in stops):
            if self.take("END"):
                self.need(word)
                self.take(";")
                return out
            if not self.take(";"):
                out.append(self.statement())
        return out

    def counted(self, label: str | None) -> Block:
        """FOR i IN [REVERSE] a..b LOOP: the bounds are taken once; the variable moves first, so that CONTINUE moves it too."""
        self.next()
        line, name = self.now.line, self.name()
        self.need("IN")
        back = self.take("REVERSE")
        if self.ahead("SELECT") or self.ahead("("):
            raise DialectError(f"line {line}: FOR over a cursor's rows has no translation")
        low = self.until("..")
        high = self.until("LOOP", eat=False)
        self.made += 1
        word = lambda text: Token("word", text, line)
        op = lambda text: Token("op", text, line)
        start, stop = (high, low) if back else (low, high)
        last, step = f"{name}_last{self.made}", [op("+" if back else "-"), Token("number", "1", line)]
        move = Assign(name, [word(name), op("-" if back else "+"), Token("number", "1", line)])
        body = self.loop()
        loop = While([word(name), op(">" if back else "<"), word(last)], Block(body=[move, *body.body]), label)
        first = [Assign(name, [op("("), *start, op(")"), *step]), Assign(last, stop)]
        return Block([Parameter(name, "BIGINT"), Parameter(last, "BIGINT")], [*first, loop])

    def cases(self) -> If:
        """The CASE statement as nested IFs; without ELSE and a match it does nothing."""
        self.next()
        subject = [] if self.ahead("WHEN") else self.until("WHEN", eat=False)
        arms, other = [], None
        while other is None and self.take("WHEN"):
            test = self.until("THEN")
            line = test[0].line if test else self.now.line
            if subject:
                test = [Token("op", "(", line), *subject, Token("op", ")", line), Token("op", "=", line), Token("op", "(", line), *test, Token("op", ")", line)]
            before = self.at
            arms.append((test, Block(body=self.until_end("CASE", "WHEN", "ELSE"))))
            if self.ahead("ELSE"):
                self.next()
                other = Block(body=self.until_end("CASE"))
            elif self.at > before and not self.ahead("WHEN"):
                break
        if not arms:
            raise self.fail("WHEN")
        for test, body in reversed(arms):
            other = If(test, body, other)
        return other

    def returned(self) -> Block:
        self.next()
        value = self.until(";")
        if value and self.result is None:
            raise DialectError(f"line {value[0].line}: RETURN with a value outside a function")
        return Block(body=[*([Assign(self.result, value)] if value else []), Exit()])

    def names_until_do(self) -> list[str]:
        out = self.names()
        self.need("DO")
        return out

    def call(self) -> Call:
        name = self.name()
        run = self.until(";", "RETURNING_VALUES", "INTO")
        into = []
        if self.tokens[self.at - 1].key != ";":
            bracket = self.take("(")
            into = self.names()
            if bracket:
                self.need(")")
            self.need(";")
        if run and run[0].text == "(" and run[-1].text == ")":
            run = run[1:-1]
        args, part, depth = [], [], 0
        for t in run:
            depth += (t.text == "(") - (t.text == ")")
            if t.text == "," and depth == 0:
                args.append(part)
                part = []
            else:
                part.append(t)
        return Call(name, [*args, part] if part else args, into)


def parse_script(text: str) -> list:
    """All objects and statements of a script, in order; none is dropped."""
    return Parser(text).script()
