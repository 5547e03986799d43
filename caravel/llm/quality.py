"""Quality rules as a short-circuit cascade, JVM side only.

Each rule is a Boolean column that is true where a document is rejected.  The cascade estimates every rule's cost
(seconds a row) and selectivity (share rejected) on a bounded sample, orders the rules by rejection per cost, and
evaluates them as nested CASE branches, so that a rejected document pays for no later rule.  The order decides only
the work: the verdict is that of all rules together.

Results in unusual cases: a null text counts as empty and has no words, so it fails ``too_short``; repeated rows are
judged one by one; a null id passes through; an empty table gives an empty result; columns of the input that are not
named in a call keep their values, except those whose names an operator adds, which it overwrites.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

#: Rows, and characters a row, of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS, SAMPLE_CHARS, REPEATS = 400, 1 << 15, 3
WINDOW = 8


@dataclass(frozen=True)
class View:
    """What a rule may ask of a document: expressions, or columns where they are there already."""

    text: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_lines: Column
    n_dup_lines: Column
    n_repeat_words: Column


@dataclass(frozen=True)
class Rule:
    """``reject``: from a View of a document, a Column that is true for rejection."""

    name: str
    reject: Callable[[View], Column]


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long")


def lines_with_word(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t-\r]"))


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def doubled(h: Column, step: int) -> Column:
    """Hashes of windows twice as wide as those in ``h`` (a column that is there already), ``step`` words; the last ``step`` are not whole windows."""
    return F.zip_with(h, F.slice(h, F.lit(step + 1), F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), _q_n_lines and the base verdict base_failed.

    A chain of projections, each naming what the next uses more than once, so that nothing is computed twice.
    """
    mine = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "_q_n_lines"} | {f"_q_{x}" for x in ("words", "lines", "hash", "sorted", "at")}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in mine]
    w, lines, h, srt, at = (F.col(f"_q_{x}") for x in ("words", "lines", "hash", "sorted", "at"))
    t = F.col(f"`{text}`")
    a = df.select(*keep, words(t).alias("_q_words"), lines_with_word(t).alias("_q_lines"), n_symbols(t).alias("n_symbols"))
    done = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "_q_n_lines"]
    twice = F.size(F.array_distinct(h)) < F.size(h)
    base = [F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"), "n_symbols", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), F.size(lines).alias("_q_n_lines")]
    b = a.select(*keep, *base, hashes(w).alias("_q_hash"))
    b = b.select(*keep, *done, doubled(h, 1).alias("_q_hash")).select(*keep, *done, doubled(h, 2).alias("_q_hash"))
    # where no four words repeat, no eight do
    b = b.select(*keep, *done, F.when(twice, F.slice(doubled(h, 4), F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))).alias("_q_hash"))
    c = b.select(*keep, *done, F.when(twice, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_q_sorted"))
    near = lambda i: F.get(srt, i)["h"]
    same = F.filter(srt, lambda x, i: ((i > 0) & near(i - 1).eqNullSafe(x["h"])) | near(i + 1).eqNullSafe(x["h"]))
    d = c.select(*keep, *done, F.sort_array(F.transform(same, lambda x: x["i"])).alias("_q_at"))
    steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
    rep = F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long")
    e = d.select(*keep, *done, rep.alias("n_repeat_words"))
    n = F.col("n_words")
    return e.withColumn("base_failed", (n < 20) | (100 * F.col("n_repeat_words") > 30 * n))


#: Verdicts beside the base rules. Thresholds leave prose, lists and tables alone: rejected is what has more symbols
#: than words, mostly repeated lines, words far shorter or longer than any language's, or hardly a word with a letter.
RULES = [
    Rule("symbols", lambda v: v.n_symbols > v.n_words),
    Rule("repeated_lines", lambda v: 2 * v.n_dup_lines > v.n_lines),
    Rule("word_length", lambda v: (v.word_chars < 2 * v.n_words) | (v.word_chars > 20 * v.n_words)),
    Rule("letters", lambda v: ~F.coalesce(v.text, F.lit("")).rlike(r"^(?:\P{L}*+\p{L}++){10}")),
]
BASE_RULES = [
    Rule("too_short", lambda v: v.n_words < 20),
    Rule("repeated_words", lambda v: 100 * v.n_repeat_words > 30 * v.n_words),
]


def repeat_words(ws: Column) -> Column:
    """n_repeat_words as one expression for the cascade, whose short circuit keeps it from the rows rejected before.

    Sorting the hashes with their places brings equal windows together; ``F.get`` on the sorted array finds neighbours.
    """
    let = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  binds x once

    def at(srt: Column) -> Column:
        near = lambda i: F.get(srt, i)["h"]
        same = F.filter(srt, lambda x, i: ((i > 0) & near(i - 1).eqNullSafe(x["h"])) | near(i + 1).eqNullSafe(x["h"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def total(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("n")), lambda s, x: F.struct(x.alias("p"), (s["n"] + F.least(F.lit(WINDOW), x - s["p"])).alias("n")), lambda s: s["n"])

    def count(h: Column) -> Column:
        h = F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
        return let(h, counted)

    def counted(h: Column) -> Column:
        srt = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(srt, lambda s: let(at(s), total))).otherwise(F.lit(0))

    eight = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(doubled(h, 4), count)).otherwise(F.lit(0))
    return let(hashes(ws), lambda a: let(doubled(a, 1), lambda b: let(doubled(b, 2), eight))).cast("long")


def view(text: Column, ws: Column) -> View:
    lines = lines_with_word(text)
    return View(text, F.size(ws), word_chars(ws), n_symbols(text), F.size(lines), F.size(lines) - F.size(F.array_distinct(lines)), repeat_words(ws))


def order_rules(sample: DataFrame, rules: list[Rule], v: View) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected), best rejection per cost first.

    Costs and selectivities are those of the expressions that the cascade runs, on a sample that holds what these read.
    A rule's cost is the least of REPEATS compiled runs less that of a run without a rule, since the job itself takes
    longer than most rules do.
    """
    n = max(1, sample.count())

    def timed(reject: Column) -> tuple[float, int]:
        hit, took, rejected = sample.agg(F.sum(F.when(reject, 1).otherwise(0)).alias("n")), [], 0
        for _ in range(REPEATS + 1):
            began = time.perf_counter()
            rejected = hit.collect()[0]["n"] or 0
            took.append(time.perf_counter() - began)
        return min(took[1:]), rejected

    idle = timed(F.lit(False))[0]
    found = [(rule, max(took - idle, 1e-6) / n, rejected / n) for rule in rules for took, rejected in [timed(rule.reject(v))]]
    return sorted(found, key=lambda x: -(x[2] + 0.5 / n) / x[1])


def sampled(df: DataFrame, text: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (t) of a bounded random sample of all partitions, each cut to SAMPLE_CHARS characters; it decides the order of the rules alone."""
    n = df.count()
    picked = df.select(F.substring(F.col(f"`{text}`"), 1, SAMPLE_CHARS).alias("t"), F.rand(7).alias("r")).where(F.col("r") * n < 4.0 * sample_rows)
    found = picked.orderBy("r").limit(sample_rows).collect()
    return df.sparkSession.createDataFrame([(r.t,) for r in found], "t string").repartition(1)


def cascade(v: View, rules: list[Rule]) -> Column:
    """True where no rule rejects; a CASE stops at the first rule that does."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.reject(v), F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def judge(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, out: str = "kept") -> DataFrame:
    """``df`` with a Boolean ``out``: the cascade's verdict over rules ordered on a sample."""
    held = sampled(df, text).select("t", words(F.col("t")).alias("w")).cache()
    try:
        ordered = [r for r, _, _ in order_rules(held, rules if rules is not None else BASE_RULES + RULES, view(F.col("t"), F.col("w")))]
    finally:
        held.unpersist()
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (out, "_q_w")]
    t = F.col(f"`{text}`")
    return df.select(*keep, words(t).alias("_q_w")).select(*keep, cascade(view(t, F.col("_q_w")), ordered).alias(out))


def quality(df: DataFrame, text: str = "text") -> DataFrame:
    """All metrics, base_failed, and kept: false where the base fails, else the cascade's verdict over RULES.

    The rules read the metrics, which are there anyway, and are timed on them.
    """
    c = F.col
    v = lambda t: View(c(f"`{t}`"), c("n_words"), c("word_chars"), c("n_symbols"), c("_q_n_lines"), c("n_dup_lines"), c("n_repeat_words"))
    # stored before it is filtered: a filter is pushed below the projections, which then evaluate each other many times over
    held = with_metrics(sampled(df, text), "t").cache()
    try:
        ordered = [r for r, _, _ in order_rules(held.where("NOT base_failed"), RULES, v("t"))]
    finally:
        held.unpersist()
    return with_metrics(df, text).withColumn("kept", F.when(c("base_failed"), False).otherwise(cascade(v(text), ordered))).drop("_q_n_lines")
