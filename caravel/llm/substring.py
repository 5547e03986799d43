"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed against all the documents with smaller ids.  The reference is the index of those documents'
runs of WINDOW words, in blocks: a block is a range of hashes, and a run's hash says which block alone can hold it, so
that a document is held against every block without meeting blocks that cannot answer.

1. Copies: documents with the same word sequence as a smaller one are one long factor; they leave after one aggregation.
2. Seeds: of the runs of SEED words, the minimizers, so that each window of WINDOW words holds one and equal windows
   hold equal ones.  A seed that stands in one document only cannot lie in a repeated window; those that stand in two
   or more mark the stretches of text to be parsed.
3. Index: the windows of these stretches under 96 bits of hash, with the first place (least id, then least offset) each
   stands at.
4. Reference words: where the index names places that go on one after another, the reference's words from there on are
   fetched, up to LOOK words past the last such place while windows go on to be found.
5. Parse: from left to right, at each window with a place in an earlier document, the longest factor that goes on there,
   compared word by word; a window whose words are not those of its place (equal hashes) gives none.  Where a factor ends,
   the windows across its end are looked up anew, so none is missed.  Factors of WINDOW words or more are duplicate spans.

Results in unusual cases: null and empty texts have no words and no factors; documents of fewer than WINDOW words have
none; rows of one id count as one document, whose rows neither repeat each other nor refer to each other; rows with a
null id are neither parsed nor referred to; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, stored, with_aggregates
from .texthash import gram_hashes, minimizers, split, word_hashes

WINDOW, SEED = 13, 5
#: Words of a reference that are fetched past the places that the index names there; least words that are fetched at once.
LOOK, FETCH = 64, 16


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def statistics(docs: DataFrame) -> DataFrame:
    """(id, n_words, sha binary): the words' number and the SHA-256 of the words joined by single spaces, for docs (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha = [], []
            for t in batch.column(1):
                ws = split(t.as_py())
                n.append(len(ws))
                sha.append(hashlib.sha256(b" ".join(ws)).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.binary())], names=["id", "n_words", "sha"])

    return docs.mapInArrow(run, "id long, n_words long, sha binary")


def seeds(docs: DataFrame, k: int, window: int) -> DataFrame:
    """(seed, id, words): the distinct seeds of each row of docs (id, text), with 64 bits of hash of its whole word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, whole = batch.column(0).to_numpy(zero_copy_only=False), [], []
            for t in batch.column(1):
                data = _encoded(t.as_py())
                wh = word_hashes(data)
                g = gram_hashes(wh, k) if len(wh) >= window else wh[:0]
                found.append(np.unique(g[minimizers(g, window - k + 1)]))
                whole.append(xxhash.xxh64_intdigest(wh.tobytes()))
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            hs = np.concatenate(found) if found else np.zeros(0, np.uint64)
            owner, seq = np.repeat(ids, sizes), np.repeat(np.array(whole, dtype=np.uint64), sizes)
            for i in range(0, len(hs), 1 << 16):
                c = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(hs[c].view(np.int64)), pa.array(owner[c]), pa.array(seq[c].view(np.int64))], names=["seed", "id", "words"])

    return docs.mapInArrow(run, "seed long, id long, words long")


def windows(docs: DataFrame, k: int, window: int) -> DataFrame:
    """(h, h2, id, at, first) of the windows that hold one of a row's shared seeds; docs (id, text, shared: array of seeds).

    ``first`` says whether the row holds the window at no smaller place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                shared = batch.column(2)[i].values
                data = _encoded(batch.column(1)[i].as_py())
                wh = word_hashes(data)
                n = len(wh) - window + 1
                if n <= 0 or shared is None or not len(shared):
                    continue
                g = gram_hashes(wh, k)
                at = minimizers(g, window - k + 1)
                at = at[np.isin(g[at], shared.to_numpy(zero_copy_only=False).view(np.uint64))]
                mark = np.zeros(n + 1, dtype=np.int64)
                np.add.at(mark, np.maximum(at - (window - k), 0), 1)
                np.add.at(mark, np.minimum(at + 1, n), -1)
                own = np.flatnonzero(np.cumsum(mark[:n]) > 0)
                h, h2 = gram_hashes(wh, window)[own], gram_hashes(word_hashes(data, 1), window, 1)[own]
                first = np.zeros(len(own), dtype=bool)
                first[np.unique(h, return_index=True)[1]] = True
                held.append((h.view(np.int64), (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(own), batch.column(0)[i].as_py(), np.int64), own.astype(np.int32), first))
                size += len(own)
                if size >= 1 << 16:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate(c) for c in zip(*held, strict=True)]
        for j in range(0, len(cols[0]), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(c[j : j + (1 << 17)]) for c in cols], names=["h", "h2", "id", "at", "first"])

    return docs.mapInArrow(run, "h long, h2 int, id long, at int, first boolean")


def stretches(places: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """(at, ref, ref_at, words to fetch): where the index names a reference that does not go on from the place before."""
    if not len(places):
        return []
    follows = np.diff(places) == 1
    first = np.concatenate([[0], np.flatnonzero(~(follows & (np.diff(ref) == 0) & (np.diff(ref_at) == 1))) + 1])
    stop = np.concatenate([first[1:], [len(places)]])
    # the last place of each run of consecutive places: no factor goes beyond its window
    ends = np.concatenate([np.flatnonzero(~follows), [len(places) - 1]])
    run = places[ends[np.searchsorted(ends, first)]]
    want = np.minimum(run - places[first], stop - 1 - first + LOOK) + window
    size = FETCH << np.maximum(0, np.ceil(np.log2(want / FETCH))).astype(np.int64)
    return list(zip(*(x.tolist() for x in (places[first], ref[first], ref_at[first], size)), strict=True))


def parse(ws: list[bytes], places: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, fetched: dict[int, list[list[bytes]]], window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, length, ref, ref_start) of a document's words, from the places that the index gave and the
    references' words from each stretch's start on (of several rows of a reference, those that go on longest)."""
    out, k = [], 0
    starts = np.array([x[0] for x in stretches(places, ref, ref_at, window)], dtype=np.int64)
    while k < len(places):
        at = int(places[k])
        if at + window > len(ws):
            break
        begun = int(starts[np.searchsorted(starts, at, side="right") - 1])
        length = 0
        for words in fetched.get(begun, ()):
            n = 0
            for a, b in zip(ws[at:], words[at - begun :], strict=False) if at - begun < len(words) else ():
                if a != b:
                    break
                n += 1
            length = max(length, n)
        if length < window:
            k += 1
            continue
        out.append((at, length, int(ref[k]), int(ref_at[k])))
        k = int(np.searchsorted(places, at + length - window + 1))
    return out


def spans(factors: list, n_words: int) -> np.ndarray:
    """A mask of the words that factors (start, length, ...) cover."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for f in factors:
        edge[f[0]] += 1
        edge[min(f[0] + f[1], n_words)] -= 1
    return np.cumsum(edge[:n_words]) > 0


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def copies_of(stats: DataFrame, window: int) -> DataFrame:
    """(id, ref) of documents whose words are all those of the smaller document ref, which is the least such."""
    least = stats.where(f"id is not null and n_words >= {window}").groupBy("sha").agg(F.min("id").alias("ref"), F.count("*").alias("n")).where("n > 1").select("sha", "ref")
    return stats.where("id is not null").join(least, "sha").where("ref < id").select("id", "ref").distinct()


def matches(rows: DataFrame, copies: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, found: array of (at, ref, ref_at), fetched): the windows of rows (id, text), without copies, that stand in an
    earlier document, and the words there.

    ref is the least id with the window, ref_at its least place there.
    """
    spark = rows.sparkSession
    found, place = stored(seeds(rows, seed, window), "seeds")
    known = with_aggregates(found, ["seed"], [F.min("words").alias("a"), F.max("words").alias("b")], "id")
    marked = known.where("a < b").groupBy("id").agg(F.collect_set("seed").alias("shared"))
    marked, at = stored(marked.join(copies.select("id"), "id", "left_anti"), "marked")
    drop(spark, place)
    held, place = stored(windows(rows.join(marked, "id"), seed, window), "windows")
    drop(spark, at)
    places = [F.min("id").alias("ref"), F.min_by("at", F.when(F.col("first"), F.col("id"))).alias("ref_at")]
    matched = with_aggregates(held, ["h", "h2"], places, "id").where("ref < id AND ref_at IS NOT NULL")
    found, at = stored(matched.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("at", "ref", "ref_at"))).alias("found")), "matches")
    drop(spark, place)
    out, _ = stored(found.join(_fetched(found, rows, window), "id"), "parsed")
    drop(spark, at)
    return out


def _fetched(found: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """(id, fetched: array of (at, words)): the references' words for each stretch of a document; rows (id, text).

    Documents that ask for the same words of a reference ask once, and by lengths FETCH times a power of two, so that a
    reference of many is cut a number of times that its own length bounds.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = np.array(stretches(*_places(batch.column(1)[i].values), window), dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asked), batch.column(0)[i].as_py(), np.int64)), *(pa.array(asked[:, j]) for j in range(4))], names=["id", "at", "ref", "ref_at", "n"])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ws, parts = split(batch.column(1)[i].as_py()), batch.column(2)[i].values
                for j in range(0, len(parts), 1024):
                    at, n = (parts.field(k).to_numpy(zero_copy_only=False)[j : j + 1024] for k in (0, 1))
                    cut_out = [b" ".join(ws[a : a + b]) for a, b in zip(at.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64)), pa.array(at), pa.array(n), pa.array(cut_out, pa.binary())], names=["ref", "ref_at", "n", "words"])

    asked, _ = stored(found.mapInArrow(ask, "id long, at long, ref long, ref_at long, n long"), "asked")
    wanted = asked.select("ref", "ref_at", "n").distinct().groupBy("ref").agg(F.collect_list(F.struct("ref_at", "n")).alias("parts"))
    given = rows.join(wanted, rows["id"] == wanted["ref"]).select("ref", "text", "parts").mapInArrow(give, "ref long, ref_at long, n long, words binary")
    got, _ = stored(asked.join(given, ["ref", "ref_at", "n"]).select("id", "at", "words"), "fetched")
    return got.groupBy("id").agg(F.collect_list(F.struct("at", "words")).alias("fetched"))


FOUND, FETCHED = "array<struct<at:int,ref:bigint,ref_at:int>>", "array<struct<at:bigint,words:binary>>"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _places(found) -> list[np.ndarray]:
    return [found.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in range(3)]


def _words(fetched) -> dict[int, list[list[bytes]]]:
    out: dict[int, list[list[bytes]]] = {}
    for at, words in zip(fetched.field(0).to_pylist(), fetched.field(1).to_pylist(), strict=True):
        out.setdefault(at, []).append(words.split())
    return out


def kept_words(text: str | None, places: list[np.ndarray], fetched: dict[int, list[list[bytes]]], window: int) -> tuple[list[bytes], list[bytes]]:
    """(words, those outside every factor). Rows of one id share their places; a shorter row ignores those past its end."""
    ws = split(text)
    gone = spans(parse(ws, *places, fetched, window), len(ws))
    return ws, [w for w, g in zip(ws, gone.tolist(), strict=True) if not g]


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, start, length, ref, ref_start): the factors of ``window`` words or more, copies as one factor each."""
    rows = _rows(docs, id_col, text_col)
    stats = cut(statistics(rows))
    copies = cut(copies_of(stats, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                fs = np.array(parse(split(batch.column(1)[i].as_py()), *_places(batch.column(2)[i].values), _words(batch.column(3)[i].values), window), dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fs), batch.column(0)[i].as_py(), np.int64)), *(pa.array(fs[:, j]) for j in range(4))], names=["id", "start", "length", "ref", "ref_start"])

    parsed = rows.join(matches(rows, copies, window), "id").mapInArrow(run, "id long, start long, length long, ref long, ref_start long")
    whole = copies.join(stats, "id").select("id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length"), "ref", F.lit(0).cast("long").alias("ref_start")).distinct()
    return parsed.unionByName(whole)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) for every row: what is left when duplicate spans go."""
    stats = cut(statistics(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))))
    copies = cut(copies_of(stats, window))
    rows = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ws, kept = kept_words(batch.column(1)[i].as_py(), _places(batch.column(2)[i].values), _words(batch.column(3)[i].values), window)
                out.append((batch.column(0)[i].as_py(), len(ws), len(ws) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "n_words", "n_removed", "kept_sha256"), x, strict=True)) for x in out], schema=pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))

    parsed = cut(rows.join(matches(rows, copies, window), "id").mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string"))
    whole = stats.join(copies.select("id"), "id", "left_semi").select("id", "n_words", F.col("n_words").alias("n_removed"), F.lit(EMPTY_SHA).alias("kept_sha256"))
    rest = stats.join(copies.select("id").union(parsed.select("id")), "id", "left_anti").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lower(F.hex("sha")).alias("kept_sha256"))
    return parsed.unionByName(whole).unionByName(rest)


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with duplicate spans cut from the texts: what is left of a text that has some is its words joined by single
    spaces; texts without any stay as they are; copies become empty."""
    rows = _rows(docs, id_col, text_col)
    copies = cut(copies_of(cut(statistics(rows)), window))
    marks = matches(rows, copies, window).unionByName(copies.select("id", F.lit(None).cast(FOUND).alias("found"), F.lit(None).cast(FETCHED).alias("fetched")))
    marks = marks.select(F.col("id").alias("_l_id"), F.col("found").alias("_l_found"), F.col("fetched").alias("_l_fetched"), F.lit(True).alias("_l_hit"))

    @F.arrow_udf("string")
    def cut_text(text: pa.Array, found: pa.Array, fetched: pa.Array, hit: pa.Array) -> pa.Array:
        out = []
        for t, f, w, h in zip(text, found, fetched, hit, strict=True):
            if not h.as_py():
                out.append(t.as_py())
            elif f.values is None:
                out.append("")
            else:
                out.append(b" ".join(kept_words(t.as_py(), _places(f.values), _words(w.values), window)[1]).decode("utf-8", "surrogatepass"))
        return pa.array(out, pa.string())

    joined = docs.join(marks, docs[id_col].cast("long") == F.col("_l_id"), "left")
    return joined.select(*[cut_text(F.col(text_col), F.col("_l_found"), F.col("_l_fetched"), F.col("_l_hit")).alias(c) if c == text_col else docs[c] for c in docs.columns])
