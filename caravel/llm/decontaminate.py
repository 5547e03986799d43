r"""Benchmark decontamination by template canonicalisation, JVM side only.

A text's words become template tokens: lower-cased, without punctuation at their ends, with typed placeholders for
numbers (``<num>``), units (``<unit>``) and names (``<name>``).  Each word gives one token, so that tokens and words
share their places.  In a document every capitalised word of two letters or more is ``<name>``, wherever it stands.  An
item's windows stand in the index once for each choice of words that the document may have capitalised (of those that
neither are so in the item nor begin a sentence there, one a window), so a word meets itself in either case, and a name
meets another name at the start of a sentence as elsewhere.

Windows of five tokens are hash-joined with the benchmark's windows.  What a placeholder stands for is compared then:
a word that is not capitalised in the item has to be the same; numbers, units and capitalised words within the item's
sentences are slots; a capitalised word that begins one may be a name or not.  Matches of a document and an item on one
diagonal (the same shift of places) are one alignment; an alignment holds only if its slots agree, that is, equal
values of the item's slots always stand for equal values in the document.  Where they do not agree with the words that
begin sentences among them, those count as plain words, and windows where they differ do not match.  A document holds
an item if alignments that agree cover at least 0.8 of the item's windows; the item is there ``exact`` if all slots
have the item's values, else ``reparameterised``.  Items shorter than a window are sought as whole sequences with the
values they have, since a template of so few words says nothing.

The hashes of the benchmark's windows are broadcast while they are at most BROADCAST_WINDOWS, else the join shuffles.

Results in unusual cases: null and empty texts hold and match nothing, on either side; repeated rows of an id count as one document or item; rows with a null id are neither searched nor sought;
equal items are each reported; an empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut

WINDOW, COVER = 5, 0.8
#: Hashes, some 16 to 32 bytes each as a hash table: at most some 32 MB are broadcast.
BROADCAST_WINDOWS = 1_000_000
# Units that stand as words of their own.
UNITS = ["mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yd", "yards", "miles", "mile", "mg", "g", "kg", "lb", "lbs", "oz", "ml", "l", "liters", "litres", "s", "sec", "seconds", "min", "minutes", "h", "hours", "hour", "days", "day", "weeks", "months", "years", "mph", "kmh", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb", "w", "kw", "v", "a", "percent", "dollars", "euros", "pounds", "cents", "degrees"]


#: Capitalised words; within sentences, those after a word that does not end one.
CAPITALISED = r"\p{Lu}[\p{L}'’-]*\p{L}(?![\p{L}\p{N}])"
ANYWHERE, WITHIN = r"(?<![\p{L}\p{N}'’-])" + CAPITALISED, r"(?<=[^\s.!?:;][ \t]{1,4})" + CAPITALISED
#: How a placeholder of an item stands for a document's word.
SLOT, START, FIXED = 1, 2, 3


def tokens(text: Column, names: str | None = ANYWHERE) -> Column:
    """Template tokens of a text, one a word."""
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(t, names, "<name>") if names else t
    t = F.lower(t)
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}<])[+-]?[$€£]?\p{N}+(?:[.,:/]\p{N}+)*%?", "<num>")
    # a unit counts only after a number
    t = F.regexp_replace(t, rf"<num>([ \t]{{0,4}})(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])", "<num>$1<unit>")
    # punctuation at the ends of words; words of punctuation alone stay
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N}>])[^\p{L}\p{N}<>\s]+(?=\s|$)", "")
    t = F.regexp_replace(t, r"(?<=\s|^)[^\p{L}\p{N}<>\s]+(?=[\p{L}\p{N}<])", "")
    return F.filter(F.split(t, SPACE), lambda w: w != "")


def raw_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _joined(h: Column, other: Column, step: int) -> Column:
    """Hashes of neighbours: element i of h with element i + step of other."""
    return F.zip_with(h, F.slice(other, F.lit(step + 1), F.greatest(F.size(other) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def windows(rows: DataFrame, key: str, size: int = WINDOW) -> DataFrame:
    """(key, at, h, words): every window of ``size`` tokens of rows (key, text)."""
    c = F.col
    t = rows.select(key, tokens(c("text")).alias("tokens"), raw_words(c("text")).alias("words"))
    held = t.select(key, "words", F.transform("tokens", lambda w: F.xxhash64(w)).alias("one"))
    if size > 1:
        held = held.select(key, "words", "one", _joined(c("one"), c("one"), 1).alias("two"))
    if size > 3:
        held = held.select(key, "words", "one", _joined(c("two"), c("two"), 2).alias("four"))
    whole = {1: c("one"), 2: c("two"), 4: c("four")}
    last = whole[size] if size in whole else _joined(whole[size - 1], c("one"), size - 1)
    # zip_with pads to the longer side
    held = held.select(key, "words", F.slice(last, F.lit(1), F.greatest(F.size("one") - (size - 1), F.lit(0))).alias("all"))
    # the outer form: for the plain one the optimizer adds a filter on the array's size, and pushing that below the
    # projections evaluates each of them again, many times over
    return held.select(key, "words", F.posexplode_outer("all").alias("at", "h")).where("h IS NOT NULL")


def _hash(ones: list[Column]) -> Column:
    """What windows() makes of a window's tokens' hashes."""
    if len(ones) == 1:
        return ones[0]
    two = F.xxhash64(ones[0], ones[1])
    if len(ones) < 4:
        return F.xxhash64(two, ones[2]) if len(ones) == 3 else two
    four = F.xxhash64(two, F.xxhash64(ones[2], ones[3]))
    return F.xxhash64(four, ones[4]) if len(ones) == 5 else four


def value(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}+$€£-]+|[^\p{L}\p{N}%$€£]+$", "")


def index(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, i_at, size, h, slots): the windows of items (item_id, text), once for each choice of capitalised words;
    slots are structs (k, word, kind) of the placeholders."""
    c = F.col
    t = items.select("item_id", tokens(c("text"), None).alias("plain"), tokens(c("text")).alias("name"), tokens(c("text"), WITHIN).alias("within"), tokens(F.initcap("text")).alias("other"), raw_words(c("text")).alias("words"))
    t = t.where(F.size("plain") >= WINDOW if size == WINDOW else F.size("plain") == size)
    t = t.select("*", F.explode(F.sequence(F.lit(0), F.size("plain") - size)).alias("i_at"), F.lit(size).alias("size"))
    own = [F.get("name", c("i_at") + k) != F.get("plain", c("i_at") + k) for k in range(size)]
    t = t.select("item_id", "i_at", "size", *[F.struct(
        F.get("plain", c("i_at") + k).alias("plain"),
        F.when(own[k], F.get("name", c("i_at") + k)).otherwise(F.get("other", c("i_at") + k)).alias("name"),
        F.when(~own[k], FIXED).when(F.get("within", c("i_at") + k) == F.get("name", c("i_at") + k), SLOT).otherwise(START).alias("kind"),
        value(F.get("words", c("i_at") + k)).alias("word"),
        F.coalesce(F.get("words", c("i_at") + (k - 1)).rlike("[.!?:;]$"), F.lit(True)).alias("begins"),
    ).alias(f"w{k}") for k in range(size)], F.explode(F.sequence(F.lit(0), F.lit(2**size - 1))).alias("mask"))
    chosen = [c("mask").bitwiseAND(F.lit(1 << k)) != 0 for k in range(size)]
    for k in range(size):
        t = t.where(~chosen[k] | (c(f"w{k}.plain") != c(f"w{k}.name")))
    # else windows of names alone would stand for every window of an item
    inside = [F.when(chosen[k] & (c(f"w{k}.kind") == FIXED) & ~c(f"w{k}.begins"), 1).otherwise(0) for k in range(size)]
    t = t.where(reduce(Column.__add__, inside) <= 1)
    token = [F.when(chosen[k], c(f"w{k}.name")).otherwise(c(f"w{k}.plain")) for k in range(size)]
    found = F.array(*[F.when(token[k].rlike("<(num|name|unit)>"), F.struct(F.lit(k).alias("k"), c(f"w{k}.word").alias("word"), F.when(chosen[k], c(f"w{k}.kind")).otherwise(SLOT).alias("kind"))) for k in range(size)])
    return t.select("item_id", "i_at", "size", _hash([F.xxhash64(x) for x in token]).alias("h"), F.filter(found, lambda x: x.isNotNull()).alias("slots")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, kind) of every document that holds an item of the benchmark."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    b = cut(reduce(DataFrame.union, [index(items, n) for n in range(1, WINDOW + 1)]))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sizes = b.groupBy("item_id").agg(F.countDistinct("i_at").alias("n_windows"))

    def hits(n: int) -> DataFrame:
        mine = b.where(F.col("size") == n)
        keys = mine.select("h").distinct()
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys
        # hashes alone first: only windows that match take their words on to the join with the index
        met = windows(rows, "doc_id", n).join(keys, "h", "left_semi").select("doc_id", "at", "h", F.slice("words", F.col("at") + 1, F.lit(n)).alias("own"))
        pairs = F.transform("slots", lambda s: F.struct(s["word"].alias("item"), value(F.get("own", s["k"])).alias("doc"), s["kind"].alias("kind")))
        found = met.join(mine, "h").select("doc_id", "item_id", "i_at", (F.col("at") - F.col("i_at")).alias("shift"), pairs.alias("pairs"))
        return found.where(F.forall("pairs", lambda p: (p["kind"] != FIXED if n == WINDOW else F.lit(False)) | p["item"].eqNullSafe(p["doc"])))

    # other sizes only where the benchmark has such items
    hit = reduce(DataFrame.union, [hits(n) for n in sorted({WINDOW, *(r["size"] for r in b.select("size").distinct().collect())})])
    plain = F.forall("pairs", lambda p: (p["kind"] != START) | p["item"].eqNullSafe(p["doc"]))
    of = lambda kinds: F.transform(F.filter("pairs", lambda p: p["kind"].isin(*kinds)), lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc")))
    hit = hit.select("doc_id", "item_id", "shift", "i_at", of([SLOT, START]).alias("all"), F.when(plain, F.col("i_at")).alias("p_at"), F.when(plain, of([SLOT])).alias("slots"))
    joined = lambda x: F.array_distinct(F.flatten(F.collect_list(x)))
    aligned = hit.groupBy("doc_id", "item_id", "shift").agg(F.collect_set("i_at").alias("places"), joined("all").alias("all"), F.collect_set("p_at").alias("p_places"), joined("slots").alias("slots"))
    agrees = lambda x: F.size(x) == F.size(F.array_distinct(F.transform(x, lambda p: p["item"])))
    same = F.forall("slots", lambda p: p["item"].eqNullSafe(p["doc"]))
    found = aligned.select("doc_id", "item_id", F.when(agrees("all"), F.col("places")).when(agrees("slots"), F.col("p_places")).alias("places"), F.when(same, F.col("p_places")).alias("same")).where("places IS NOT NULL")
    whole = found.groupBy("doc_id", "item_id").agg(F.size(joined("places")).cast("long").alias("n_matched"), F.size(joined("same")).cast("long").alias("n_same"))
    held = whole.join(sizes, "item_id").where(F.col("n_matched") >= COVER * F.col("n_windows"))
    kind = F.when(F.col("n_same") >= COVER * F.col("n_windows"), "exact").otherwise("reparameterised")
    return held.select("doc_id", "item_id", "n_windows", "n_matched", kind.alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    bad = contaminated(docs, benchmark, id_col, text_col, item_col, item_text).select(F.col("doc_id").alias("_b_id")).distinct()
    return docs.join(bad, docs[id_col].cast("long") == F.col("_b_id"), "left_anti")
