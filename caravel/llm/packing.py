"""Packing by minimum bin slack.

Texts become ids, ended by END, and are cut into pieces of at most CAPACITY ids: whole windows and one remainder each.
The multiset of piece lengths, at most CAPACITY numbers whatever the input, is all that the driver needs: the largest
length left opens a window, and a bitset of subset sums over the lengths left (bounded multiplicities by binary
splitting) finds the multiset that fills it closest to capacity; the counts are backtracked and the window is repeated
as often as they last.  Pieces take their places by their rank among pieces of equal length, which is found without
bringing equal lengths together: counts by (length, salt) are summed up, and ranks within a salt are added.

Results in unusual cases: null and empty texts are one piece, the end id; rows of one id, null ids too, are each packed
as a document of their own, ordered by their ids' checksum; an empty table gives an empty result; no text is truncated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .tokens import END, default_vocabulary, encoder

CAPACITY = 4096
#: Ids that a task holds before it hands pieces on.
FLUSH = 1 << 20


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids binary little-endian uint32]) of every piece."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            rows, held = [], 0
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode_column(batch.column(1), END), strict=True):
                ids = ids.astype("<u4", copy=False)
                for at in range(0, len(ids), capacity):
                    raw = ids[at : at + capacity]
                    rows.append((key, at, len(raw), zlib.crc32(raw), len(ids), raw.tobytes() if with_ids else None))
                    held += len(raw)
                if held > FLUSH or len(rows) > FLUSH // 256:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + ([pa.array(cols[5], pa.binary())] if with_ids else [])
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is the largest that ``room`` holds; larger lengths first."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            take = min(k, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & full
            left, k = left - take, 2 * k
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            out[length] = out.get(length, 0) + take
    return out


def windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: count}) of the windows that pack all lengths of a histogram."""
    left, out = dict(histogram), []
    while left:
        top = max(left)
        left[top] -= 1
        got = fill(capacity - top, {k: v for k, v in left.items() if v}) if top < capacity else {}
        left[top] += 1
        got[top] = got.get(top, 0) + 1
        times = min(left[k] // v for k, v in got.items())
        for k, v in got.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
        out.append((times, got))
    return out


def places(plan: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """Sorted keys (length << 40 | first rank) with each entry's count a window, first window and offset."""
    rows, ranks, sequence = [], {}, 0
    for times, got in plan:
        offset = 0
        for length in sorted(got, reverse=True):
            first = ranks.get(length, 0)
            rows.append(((length << 40) | first, got[length], sequence, offset))
            ranks[length] = first + got[length] * times
            offset += got[length] * length
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4


def ranked(found: DataFrame) -> DataFrame:
    """Pieces with ``rank``, 0, 1, ... among those of equal length."""
    salts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return salted.withColumn("within", F.row_number().over(within) - 1).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("within")).drop("salt", "within", "base")


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset; ``found`` must be cheap to read more than once."""
    histogram = {int(r["length"]): int(r["n"]) for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, counts, sequences, offsets = places(windows(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def locate(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy().astype(np.int64), rank.to_numpy().astype(np.int64)
        e = np.searchsorted(keys, (n << 40) | r, side="right") - 1
        k = r - (keys[e] & ((1 << 40) - 1))
        return pd.DataFrame({"sequence_id": sequences[e] + k // counts[e], "offset": offsets[e] + (k % counts[e]) * n})

    placed = ranked(found).withColumn("_p", locate("length", "rank"))
    return placed.select(*found.columns, F.col("_p.sequence_id").alias("sequence_id"), F.col("_p.offset").alias("offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; ``with_ids`` adds each piece's ids."""
    return place(cut(pieces(docs, id_col, text_col, capacity, vocabulary, with_ids)), capacity)
