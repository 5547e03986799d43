"""Token runs as nested lists: a list begins with "(" and ends with ")"."""

from __future__ import annotations

from collections.abc import Iterable

from .tokens import DialectError, Token

Tree = list  # of Token or Tree; a Tree begins with "(" and ends with ")"


def tree(tokens: Iterable[Token]) -> Tree:
    stack: list[Tree] = [[]]
    for t in tokens:
        if t.kind == "end":
            break
        if t.text == "(" and t.kind == "op":
            stack.append([t])
        elif t.text == ")" and t.kind == "op":
            if len(stack) == 1:
                raise DialectError(f"line {t.line}: unexpected )")
            stack[-1].append(t)
            done = stack.pop()
            stack[-1].append(done)
        else:
            stack[-1].append(t)
    if len(stack) > 1:
        raise DialectError(f"line {stack[-1][0].line}: ( is not closed")
    return stack[0]


def flat(x) -> list[Token]:
    return [x] if isinstance(x, Token) else [t for y in x for t in flat(y)]


def is_word(x, *names: str) -> bool:
    return isinstance(x, Token) and x.kind == "word" and (not names or x.text.upper() in names)


def is_op(x, *ops: str) -> bool:
    return isinstance(x, Token) and x.kind == "op" and x.text in ops


def raw(text: str, like: Token | None = None) -> Token:
    return Token("raw", text, like.line if like else 0, like.before if like else " ")


def before(x) -> str:
    return flat(x)[0].before if flat(x) else " "


def split_commas(x: Tree) -> list[Tree]:
    out: list[Tree] = [[]]
    for y in x:
        if is_op(y, ","):
            out.append([])
        else:
            out[-1].append(y)
    return out if x else []
