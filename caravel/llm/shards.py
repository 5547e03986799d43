"""Deterministic sharded files: equal ranges of a key, files written under temporary names and listed in a manifest.

A task writes each file under a name of its attempt and renames it when whole; what a name holds depends on the rows
alone, so a task that runs again after a lost executor replaces a file by the same bytes.  The manifest is written
after all tasks succeeded, and readers take files from it only.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from decimal import Decimal

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least cells of a histogram that the driver sees at once; with many shards, so many a shard.
CELLS, CELLS_A_SHARD = 2048, 4
#: Shards grow with the table beyond so many, which bounds the cells that the driver holds.
MAX_SHARDS = 1 << 15


def shard_count(total: int, shard_bytes: int) -> int:
    return min(MAX_SHARDS, max(1, -(-total // shard_bytes)))


def balanced_cuts(df: DataFrame, key: str, weight: Column, n: int) -> list[int]:
    """At most n - 1 ascending cuts of an integral key, so that the ranges between them weigh about the same.

    A histogram over equal cells of the key's range; all cells heavier than half a shard are divided again, together in
    one job a level, down to one value.  There are at most 2 n heavy cells, whose starts are broadcast, and the driver
    holds some CELLS + 8 n rows a level.  Exact sums over all rows, so equal tables have equal cuts.  Null keys weigh
    nothing.
    """
    at = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), weight.cast("double").alias("w"))
    low, high, total = at.agg(F.min("k"), F.max("k"), F.sum("w")).collect()[0]
    if low is None or n <= 1:
        return []
    share, cells, budget = (total or 0) / n, [], CELLS + CELLS_A_SHARD * n
    # cells are named by their first key, as a place from ``low``: decimal, since the range may not fit a long
    rows, start, width, heavy = at.select((F.col("k").cast("decimal(20,0)") - F.lit(low)).alias("k"), "w"), F.lit(0).cast("decimal(20,0)"), high - low + 1, [0]
    while heavy:
        parts = max(2, budget // len(heavy))
        width = max(1, -(-width // parts))
        within = F.expr(f"cast((k - _start) div {width} as decimal(20,0)) * {width}")
        rows = rows.withColumn("_start", start).withColumn("_start", (F.col("_start") + within).cast("decimal(20,0)"))
        found = [(int(r["_start"]), r["w"]) for r in rows.groupBy("_start").agg(F.sum("w").alias("w")).collect()]
        heavy = sorted(a for a, w in found if w > share / 2 and width > 1)
        cells += _light(found, heavy)
        if heavy:
            keys = rows.sparkSession.createDataFrame([(a,) for a in map(Decimal, heavy)], "_start decimal(20,0)")
            rows, start = rows.join(F.broadcast(keys), "_start", "left_semi"), F.col("_start")
    cuts, held = [], 0.0
    for a, w in sorted(cells):
        if held >= share and len(cuts) < n - 1:
            cuts.append(low + a)
            held = 0.0
        held += w
    return cuts


def _light(found: list[tuple[int, float]], heavy: list[int]) -> list[tuple[int, float]]:
    gone = set(heavy)
    return [x for x in found if x[0] not in gone]


def dealt(df: DataFrame, shards: int) -> DataFrame:
    """``df``, which has a column ``shard`` from 0 to shards - 1, with each shard in a partition of its own."""
    return df.repartitionById(shards, F.col("shard").cast("int"))


def shard_of(cuts: list[int], key: int | None) -> int:
    return 0 if key is None else bisect_right(cuts, key)


def shards_of(cuts: list[int], keys: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array(cuts, dtype=np.int64), keys, side="right").astype(np.int32)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI or an absolute path; what pyarrow knows: local, HDFS, S3, GCS."""
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that has its name only when whole; knows its size and SHA-256."""

    def __init__(self, folder: str, name: str):
        self.fs, base = open_fs(folder)
        self.fs.create_dir(base, recursive=True)
        self.name, self.path, self.part = name, f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}.part"
        self.out, self.sha, self.size = self.fs.open_output_stream(self.part), hashlib.sha256(), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)

    def abort(self) -> None:
        self.out.close()
        self.fs.delete_file(self.part)


def write_manifest(rows: DataFrame, folder: str) -> DataFrame:
    """Runs the writing tasks, whose rows name their files, and commits the rows as the folder's manifest."""
    path = f"{folder}/manifest"
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.parquet(path)
