"""Token ids in binary shards, each document compressed on its own with one shared zstandard dictionary.

A folder holds ``dictionary-<sha256>.zdict``, shards ``ids-00000.zid`` in ascending ranges of document ids, and a
manifest.  A shard is MAGIC, the dictionary's SHA-256, a byte for the width of an id (2 where the vocabulary has at
most 65,536 ids, else 4), the frames, then an index entry a document (id, whether it is null, offset, size, number of
ids) and a trailer with the index's place and length.  So one document is read by its entry alone.

Results in unusual cases: null and empty texts hold the end id only; rows of one id are kept one by one, ordered by
number of ids and content; null ids come first; an empty table writes a dictionary and no shard.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shards import AtomicFile, balanced_cuts, dealt, open_fs, shard_count, shards_of, write_manifest
from .tokens import END, default_vocabulary, encoder

MAGIC = b"CARAVID1"
ENTRY, ENTRY_SIZE = "<qBQIQ", 29
TRAILER, TRAILER_SIZE = "<QQ8s", 24
#: The dictionary is trained on the ids of at most so many documents, each up to so many bytes, and has so many bytes.
TRAIN_DOCS, TRAIN_BYTES, DICTIONARY_BYTES = 256, 1 << 15, 1 << 16
LEVEL = 3
#: About so many bytes of text go to a shard.
SHARD_BYTES = 32 << 20
#: Bytes of frames that a task holds before it hands them on.
FLUSH = 4 << 20


def _width(vocabulary: str) -> int:
    return 2 if encoder(vocabulary).vocabulary_size <= 1 << 16 else 4


def _ids(vocabulary: str, texts: pa.Array, width: int) -> Iterator[bytes]:
    return (x.astype(f"<u{width}").tobytes() for x in encoder(vocabulary).encode_column(texts, END))


def train(docs: DataFrame, vocabulary: str, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the documents (id, text) whose ids' hashes are least; raw ids of one where there is too little to train on."""
    pick = [r.id for r in docs.where("id is not null").select("id").orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCS).collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _width(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[:TRAIN_BYTES] for x in _ids(vocabulary, batch.column(1), width)], pa.binary())], names=["id", "ids"])

    rows = docs.where(F.col("id").isin(pick)).mapInArrow(run, "id long, ids binary").distinct().orderBy("id", "ids").limit(TRAIN_DOCS).collect() if pick else []
    samples = [bytes(r.ids) for r in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size] or b"\0" * 16


def _save(folder: str, name: str, data: bytes) -> None:
    out = AtomicFile(folder, name)
    out.write(data)
    out.commit()


def load(folder: str, name: str) -> bytes:
    fs, base = open_fs(folder)
    with fs.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the ids of all documents and returns the manifest (shard, name, n_docs, n_tokens, bytes, sha256, dictionary)."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dictionary = train(rows, path)
    digest = hashlib.sha256(dictionary).hexdigest()
    _save(folder, f"dictionary-{digest}.zdict", dictionary)
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = rows.agg(F.sum(weight)).collect()[0][0] or 0
    cuts = balanced_cuts(rows, "id", weight, shard_count(total, shard_bytes))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, shared = _width(path), zstandard.ZstdCompressionDict(load(folder, f"dictionary-{digest}.zdict"))
        shared.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        for batch in batches:
            ids, at, frames, sizes, held = batch.column(0), 0, [], [], 0
            shard = np.where(ids.is_valid().to_numpy(zero_copy_only=False), shards_of(cuts, ids.fill_null(0).to_numpy()), 0).astype(np.int32)
            for i, raw in enumerate(_ids(path, batch.column(1), width)):
                frames.append(packer.compress(raw))
                sizes.append(len(raw) // width)
                held += len(frames[-1])
                if held > FLUSH or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(shard[at : i + 1]), ids[at : i + 1], pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())], names=["shard", "id", "n", "frame"])
                    at, frames, sizes, held = i + 1, [], [], 0

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, shard, index, tokens = ["shard", "name", "n_docs", "n_tokens", "bytes", "sha256", "dictionary"], None, None, [], 0

        def close() -> pa.RecordBatch:
            place = out.size
            for i in range(0, len(index), 4096):
                out.write(b"".join(struct.pack(ENTRY, *e) for e in index[i : i + 4096]))
            out.write(struct.pack(TRAILER, place, len(index), MAGIC))
            out.commit()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (shard, out.name, len(index), tokens, out.size, out.sha.hexdigest(), digest)], names=names)

        try:
            for batch in batches:
                for s, key, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if s != shard:
                        if out is not None:
                            yield close()
                        out, shard, index, tokens = AtomicFile(folder, f"ids-{s:05d}.zid"), s, [], 0
                        out.write(MAGIC + bytes.fromhex(digest) + bytes([width]))
                    index.append((key or 0, key is None, out.size, len(frame), n))
                    out.write(frame)
                    tokens += n
            if out is not None:
                last, out = close(), None
                yield last
        finally:
            if out is not None:
                out.abort()

    width = _width(path)
    framed = rows.mapInArrow(compress, "shard int, id long, n long, frame binary")
    sorted_rows = dealt(framed, len(cuts) + 1).sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "n", "frame")
    return write_manifest(sorted_rows.mapInArrow(save, "shard long, name string, n_docs long, n_tokens long, bytes long, sha256 string, dictionary string"), folder)


class Shard:
    """Random access to one shard."""

    def __init__(self, folder: str, name: str, dictionary: bytes):
        fs, base = open_fs(folder)
        self.file = fs.open_input_file(f"{base}/{name}")
        size = self.file.size()
        place, n, magic = struct.unpack(TRAILER, self.file.read_at(TRAILER_SIZE, size - TRAILER_SIZE))
        head = self.file.read_at(len(MAGIC) + 33, 0)
        if magic != MAGIC or head[:8] != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} is not a shard of this dictionary")
        self.width, self.n = head[40], n
        self.entries = np.frombuffer(self.file.read_at(n * ENTRY_SIZE, place), dtype=np.dtype([("id", "<i8"), ("null", "u1"), ("at", "<u8"), ("size", "<u4"), ("n", "<u8")]))
        self.open = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, i: int) -> np.ndarray:
        e = self.entries[i]
        raw = self.open.decompress(self.file.read_at(int(e["size"]), int(e["at"])), max_output_size=int(e["n"]) * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that the manifest lists."""
    manifest = spark.read.parquet(f"{folder}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, digest, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = Shard(folder, name, load(folder, f"dictionary-{digest}.zdict"))
                for at in range(0, f.n, 2048):
                    e = f.entries[at : at + 2048]
                    n = e["n"].astype(np.int64)
                    crc = [zlib.crc32(f.ids(i).astype("<u4")) for i in range(at, at + len(e))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(e["id"].astype(np.int64), mask=e["null"].astype(bool)), pa.array(base + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    base += int(n.sum())
                f.close()

    # a row a file, MAX_SHARDS at most: the running sum over the manifest is a window over few rows, and a task reads a file
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("shard", "name", "dictionary", base.alias("base"))
    return dealt(files, max(1, _shards(manifest))).select("name", "dictionary", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shards(manifest: DataFrame) -> int:
    return (manifest.agg(F.max("shard")).collect()[0][0] or 0) + 1
