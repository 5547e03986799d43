"""Tokens of the legacy dialect; comments and spaces ride along as what stands before a token."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace


class DialectError(ValueError):
    """A text that is not of the dialect, or a construct with no translation."""


@dataclass(frozen=True)
class Token:
    kind: str  # word, quoted, string, number, bind, op, end
    text: str
    line: int
    before: str = " "

    @property
    def key(self) -> str:
        return self.text.upper() if self.kind == "word" else self.text

    def with_text(self, text: str, kind: str | None = None) -> Token:
        return replace(self, text=text, kind=kind or self.kind)


PATTERN = re.compile(
    r"""(?P<space>(?:\s+|--[^\n]*|/\*.*?\*/)+)
      | (?P<string>[xXnN]?'(?:[^']|'')*')
      | (?P<quoted>"(?:[^"]|"")*")
      | (?P<number>\d+(?:\.(?!\.)\d+)?(?:[eE][+-]?\d+)?|\.\d+)
      | (?P<bind>:\s*(?:"[^"]+"|[A-Za-z_][\w$]*))
      | (?P<word>[^\W\d][\w$]*)
      | (?P<op>\.\.|\|\||<>|<=|>=|!=|\^=|~=|:=|\*\*|[-+*/%=<>(),.;\[\]?@&|])""",
    re.VERBOSE | re.DOTALL,
)


def tokenize(text: str) -> list[Token]:
    out, at, line, before = [], 0, 1, ""
    while at < len(text):
        m = PATTERN.match(text, at)
        if not m:
            raise DialectError(f"line {line}: unexpected {text[at : at + 20]!r}")
        if m.lastgroup == "space":
            before += m[0]
        else:
            found = m[0] if m.lastgroup != "bind" else ":" + m[0][1:].strip()
            out.append(Token(m.lastgroup, found, line, before))
            before = ""
        line += m[0].count("\n")
        at = m.end()
    out.append(Token("end", "", line, before))
    return out


def line_comment(before: str) -> str:
    """Spacing whose line comments cannot swallow what follows."""
    return re.sub(r"--([^\n]*)(?=\n|$)", lambda m: f"/*{m[1].replace('*/', '* /')} */", before)


#: Words after which an opening bracket or a value keeps its distance.
def render(tokens: list[Token]) -> str:
    """Text of tokens with the spacing they came with; a bind variable or word never sticks to the word before it."""
    out = ""
    for t in tokens:
        if t.kind == "end":
            break
        gap = line_comment(t.before) if out else t.before.lstrip() and line_comment(t.before.lstrip())
        if not gap and out and t.kind in ("word", "quoted", "number", "bind", "string") and (out[-1].isalnum() or out[-1] in "_$\"'`"):
            gap = " "
        out += gap + t.text
    return out
