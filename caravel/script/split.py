"""A script's statements with the lines they start at."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: One piece of a script: what a semicolon cannot end, a semicolon, or any other run of characters.
PIECE = re.compile(
    r"""(?P<comment>--[^\n]*|/\*.*?(?:\*/|\Z))
      | (?P<solid>'(?:[^']|'')*(?:'|\Z)|"(?:[^"]|"")*(?:"|\Z)|(?P<tag>\$\w*\$).*?(?:(?P=tag)|\Z))
      | (?P<end>;)
      | (?P<code>[^-/'"$;]+|.)""",
    re.VERBOSE | re.DOTALL,
)

# Kinds of object, in the order in which they are looked for.
KINDS = ["DOMAIN", "VIEW", "FUNCTION", "PROCEDURE", "TRIGGER", "TABLE"]


@dataclass(frozen=True)
class Statement:
    text: str
    line: int


def split(script: str) -> list[Statement]:
    """Statements with their semicolons; those of comments and space alone are left out.

    Strings, quoted names, comments and dollar-quoted bodies hold no end of a statement.
    """
    out: list[Statement] = []
    start, code = 0, False

    def close(end: int) -> None:
        nonlocal start, code
        text = script[start:end]
        if code:
            lead = len(text) - len(text.lstrip())
            out.append(Statement(text.strip(), script.count("\n", 0, start + lead) + 1))
        start, code = end, False

    for m in PIECE.finditer(script):
        if m.lastgroup == "end":
            if code:
                close(m.end())
            else:
                start, code = m.end(), False
        elif m.lastgroup != "comment" and m[0].strip():
            code = True
    close(len(script))
    return out


def without_comments(text: str) -> str:
    return PIECE.sub(lambda m: " " if m.lastgroup == "comment" else m[0], text)


def classify(text: str) -> tuple[str, str]:
    """(kind, name) of the object that a statement creates; ("OTHER", "UNKNOWN") where it creates none."""
    code = without_comments(text)
    for kind in KINDS:
        m = re.search(rf'(?is)\bcreate\s+(?:or\s+(?:replace|alter)\s+)?(?:global\s+)?(?:temporary\s+|temp\s+)?{kind}\s+(?:if\s+not\s+exists\s+)?(?:[\w`"]+\.)?(?:"([^"]+)"|`([^`]+)`|([\w$]+))', code)
        if m:
            return kind, m[1] or m[2] or m[3]
    return "OTHER", "UNKNOWN"
