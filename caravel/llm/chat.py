r"""Chat formatting by prefix-target expansion.

A turn is ``<|im_start|>ROLE\nTEXT<|im_end|>\n``.  Control strings inside roles and texts are escaped reversibly: the
escape character ``\\`` is doubled, ``<|`` becomes ``<\\|``, a line break in a role ``\\n``, so no text can hold a mark.  Every assistant turn is
an example of its own: all turns before it as context, its reply and the closing mark as the target; the reply's text
alone is under the loss mask.

Long conversations would repeat their prefixes with every reply, so examples are kept by reference: the conversation's
formatted text once, and for each example the end of its context and the bounds of its trainable text in it.
``examples`` makes the texts themselves from that, one at a time.

Results in unusual cases: null texts are empty, null roles the empty role; rows of one turn are ordered by role and
text; rows with a null turn come first; rows with a null conversation form one of their own; an empty table gives an
empty result.  A conversation without an assistant has no example.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out, i = [], 0
    while (j := text.find("\\", i)) >= 0:
        out.append(text[i:j])
        out.append("\n" if text[j + 1] == "n" else text[j + 1])
        i = j + 2
    out.append(text[i:])
    return "".join(out)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The formatted text and (context end, target start, target end) of every example, in characters."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = START + escape(role).replace("\n", "\\n") + "\n", escape(text)
        if role == TRAINED:
            spans.append((at, at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, _, rest = piece.partition("\n")
        if not rest.endswith(END + "\n"):
            raise ValueError("a turn does not end with its mark")
        out.append((unescape(role), unescape(rest[: -len(END) - 1])))
    return out


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, examples: array of (context_end, start, end)) of every conversation.

    Rows of a conversation stand together, sorted, and are read as a stream: one conversation is held at a time.
    """
    sorted_rows = (
        rows.select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("t"), F.coalesce(F.col(role_col), F.lit("")).alias("r"), F.coalesce(F.col(text_col), F.lit("")).alias("x"))
        .repartition(F.col("c"))
        .sortWithinPartitions(F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first(), "r", "x")
        .select("c", "r", "x")
    )
    span = pa.list_(pa.struct([("context_end", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("examples", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, out, begun = None, [], [], False

        def close() -> None:
            text, spans = render(turns)
            out.append({"conv_id": key, "formatted": text, "examples": [dict(zip(("context_end", "start", "end"), s, strict=True)) for s in spans]})

        for batch in batches:
            for c, r, x in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if begun and c != key:
                    close()
                    turns = []
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
                key, begun = c, True
                turns.append((r, x))
        if begun:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return sorted_rows.mapInArrow(run, "conv_id long, formatted string, examples array<struct<context_end:long,start:long,end:long>>")


@dataclass(frozen=True)
class Example:
    """A reply with all before it: the mask's bounds count in ``target``, which begins with the reply's opening mark."""

    text: str
    context_end: int
    target: str
    loss_start: int
    loss_end: int

    @property
    def context(self) -> str:
        return self.text[: self.context_end]


def expand(text: str, spans: list[tuple[int, int, int]]) -> Iterator[Example]:
    """The examples of a conversation's formatted text, one for each assistant turn."""
    for context_end, start, end in spans:
        yield Example(text, context_end, text[context_end : end + len(END) + 1], start - context_end, end - context_end)


def examples(formatted: DataFrame) -> DataFrame:
    """(conv_id, example, context, target, loss_start, loss_end): the training texts; the mask's bounds are in ``target``.

    target begins with the reply's opening mark and ends with its closing mark.  A task holds one example at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, text, spans = (batch.column(k)[i].as_py() for k in range(3))
                for n, e in enumerate(expand(text, [(s["context_end"], s["start"], s["end"]) for s in spans])):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([n], pa.int32()), pa.array([e.context]), pa.array([e.target]), pa.array([e.loss_start], pa.int64()), pa.array([e.loss_end], pa.int64())], names=["conv_id", "example", "context", "target", "loss_start", "loss_end"])

    return formatted.select("conv_id", "formatted", "examples").mapInArrow(run, "conv_id long, example int, context string, target string, loss_start long, loss_end long")


def write(formatted: DataFrame, folder: str) -> None:
    """Stores conversations and their examples as Parquet; read() gives them back."""
    formatted.write.mode("errorifexists").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("conv_id long, formatted string, examples array<struct<context_end:long,start:long,end:long>>").parquet(folder)


def digests(formatted: DataFrame) -> DataFrame:
    """What stored conversations and their examples hold: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    The loss is what the expanded examples' masks hold, one example after another: an example's context is the
    conversation up to its reply, so only its end is kept, and the texts of all examples are never there at once.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                key, text, spans = (batch.column(k)[i].as_py() for k in range(3))
                turns, whole, loss, loss_chars = 0, hashlib.sha256(), hashlib.sha256(), 0
                for role, x in parse(text):
                    whole.update(f"{role}\n{x}\n".encode("utf-8", "surrogatepass"))
                    turns += 1
                for e in expand(text, [(s["context_end"], s["start"], s["end"]) for s in spans]):
                    said = unescape(e.target[e.loss_start : e.loss_end])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    loss_chars += len(said)
                out.append((key, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), len(text)))
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=names)

    return formatted.select("conv_id", "formatted", "examples").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
