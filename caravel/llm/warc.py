"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by page id and dealt to shards by ranges of equal payload; a shard's files are rolled when their
compressed size passes a limit.  Headers and digests are made anew from the payload.  Every record is a gzip member of
its own, so a record is read by its offset.  Files are written under temporary names, renamed when whole, and count
only once the manifest lists them.

Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is a response and the others
are revisits that refer to it and hold no payload.

Results in unusual cases: a null payload is empty; a null URL is written as ``urn:caravel:page:<id>``; rows with a null
id are not archived; of rows with one id each is a record, and those with equal payloads refer to no other than the
largest id (a row with that id is a response); an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, with_aggregates
from .shards import AtomicFile, balanced_cuts, dealt, open_fs, shard_count, shards_of, write_manifest

#: Files are rolled at so many compressed bytes; a shard holds about so many bytes of payload.
ROLL_BYTES, SHARD_BYTES = 16 << 20, 16 << 20
#: WARC-Date of every record, so that equal tables give equal bytes.
DATE = "1970-01-01T00:00:00Z"
_SPACE = 0x6361726176656C70 << 64


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=_SPACE | (page_id & (1 << 64) - 1))}>"


def page_of(record: str) -> int:
    low = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP header only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = (url or f"urn:caravel:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
        ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
        *([("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(id, sha, refers_to) of rows (id, sha, bytes) whose payload a larger id has too; a very common payload's largest id is broadcast."""
    large = cut(rows.where(F.col("bytes") >= min_bytes).select("id", "sha"))
    return with_aggregates(large, ["sha"], [F.max("id").alias("refers_to")], "id").where("id < refers_to").distinct()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the archives and returns the manifest (shard, part, name, n_records, bytes, sha256)."""
    weight = F.coalesce(F.octet_length(F.col(payload_col)), F.lit(0)) + 512
    total = pages.agg(F.sum(weight)).collect()[0][0] or 0
    cuts = balanced_cuts(pages, id_col, weight, shard_count(total, shard_bytes))
    cut_at = F.pandas_udf(lambda ids: pd.Series(shards_of(cuts, ids.to_numpy())), "int")
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("n_records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, part, n = None, None, 0, 0

        def close() -> pa.RecordBatch:
            out.commit()
            return pa.RecordBatch.from_pylist([{"shard": shard, "part": part, "name": out.name, "n_records": n, "bytes": out.size, "sha256": out.sha.hexdigest()}], schema=schema)

        at, refers_to = None, None
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    s, key, sha, is_page, url, payload, to = (c[i].as_py() for c in batch.columns)
                    if not is_page:  # stands before the pages that it is about
                        at, refers_to = (key, sha), to
                        continue
                    ref = refers_to if at == (key, sha) else None
                    if out is not None and (s != shard or out.size >= roll_bytes):
                        yield close()
                        out, part = None, part + 1
                    if out is None:
                        part = part if s == shard else 0
                        shard, n = s, 0
                        out = AtomicFile(folder, f"pages-{shard:05d}-{part:05d}.warc.gz")
                    out.write(member(key, url, payload, ref))
                    n += 1
            if out is not None:
                last, out = close(), None
                yield last
        finally:
            if out is not None:
                out.abort()

    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(payload, 256)).alias("sha"), F.col(url_col).alias("url"), payload.alias("payload"))
    refs = revisits(rows.select("id", "sha", F.octet_length("payload").alias("bytes")), min_bytes)
    # payloads are dealt once: what a page refers to comes to its shard as a row of its own
    both = rows.select("id", "sha", F.lit(True).alias("is_page"), "url", "payload", F.lit(None).cast("long").alias("refers_to")).unionByName(refs.select("id", "sha", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to"))
    keys = ["shard", "id", "sha", "is_page"]
    sorted_rows = dealt(both.withColumn("shard", cut_at("id")).select(*keys, "url", "payload", "refers_to"), len(cuts) + 1).sortWithinPartitions(*keys, "url")
    return write_manifest(sorted_rows.mapInArrow(save, "shard int, part int, name string, n_records long, bytes long, sha256 string"), folder)


def records(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a stream of gzip members."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=data))
    while True:
        line = f.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := f.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8", "surrogatepass").partition(": ")
            fields[k] = v
        block = f.read(int(fields["Content-Length"]))
        if fields.get("WARC-Block-Digest") != "sha1:" + sha1_base32(block):
            raise ValueError(f"block digest of {fields.get('WARC-Record-ID')} does not hold")
        yield fields, block


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to[, payload]) from the files of the manifest."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), *([("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, base = open_fs(folder)
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for fields, block in records(f):
                        head, _, body = block.partition(b"\r\n\r\n")
                        http = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest != sha1_base32(body):
                            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not hold")
                        rows.append({"page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": kind, "payload_digest": digest, "payload_bytes": int(http["Content-Length"]), "refers_to": page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None} | ({"payload": body} if payloads else {}))
                        if len(rows) >= 512:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ddl = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads
    return manifest.select("name").repartition(n).mapInArrow(run, ddl)
