"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprints: 64 bits a text, from the XXH64 of its word shingles.
2. Equal fingerprints become one node, the least id with it; copies cost one aggregation.
3. Bits that correlate on a bounded sample of fingerprints are grouped into partitions.  If a pair differs in at most
   T bits and the thresholds t_i >= -1 of the partitions sum to T - m + 1, the pair differs in at most t_i bits of
   some partition i.  A dynamic programme over the partitions allots the t_i, so that the estimated cost of probes and
   candidates is least; the number of partitions m is chosen by the same estimate.
4. Each node stands once in every partition's index under its exact bits, and probes all values within t_i bits.  Of
   two nodes only that with the smaller value probes.  A pair that meets is verified on all 64 bits inside the join.
5. Index buckets over HOT nodes are dealt in blocks: every pair of blocks is compared as a matrix by one group, which
   returns a spanning forest of its links, not the links.  So no bucket is collected whole and none is capped.
6. Components of the links, by stars.

Where a similarity is asked for (``similar_groups``), fingerprints only say which pairs are looked at first, by keys of
their bits and without steps 3 to 5; setjoin.py finds every other pair of at least that Jaccard similarity of shingle sets.

Results in unusual cases: texts without a word (null, empty or blank) have fingerprint zero and are linked like any
other; repeated rows of an id all get that id's component; rows with a null id get a fingerprint, no component and
link nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, stored, with_aggregates
from .graph import connected_components
from .setjoin import shingle_set, similar_pairs, verified

BITS = 64
#: Fingerprints sampled for correlations and candidate counts; a bound on what the driver holds.
SAMPLE = 4096
#: Index buckets with more nodes than this are compared in blocks of at most BLOCK nodes.
HOT, BLOCK = 64, 1024
#: ... and than so many times the mean bucket.
HOT_MEANS = 4
#: Bins of the sketches that discard pairs whose estimate is by SLACK below the similarity asked for: 5.6 standard errors at 0.8.
SKETCH, SLACK = 128, 0.2
#: Relative costs: a probe is shuffled and sorted, a candidate is one comparison within a join.
PROBE_COST, CANDIDATE_COST = 100.0, 1.0
#: Where a similarity is asked for, pairs within so few bits are linked first; the prefixes find all others.
FIRST_RADIUS = 5
#: For that first look, fingerprints have one key for each KEYED of their BLOCKS of bits, so KEYED bits apart they still share one.
BLOCKS, KEYED = 6, 3


def fingerprint(text: str | None, shingle: int = 4, chunk: int = 1 << 15) -> int:
    """The unsigned 64-bit SimHash of a text: A-Z lower-cased, shingles with repeats, the whole sequence if shorter."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    data = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(ws) - shingle + 1)
    a, b = starts[:n].tolist(), ends[min(shingle, len(ws)) - 1 :].tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, chunk):
        hs = np.array([h(data[x:y], 42) for x, y in zip(a[at : at + chunk], b[at : at + chunk], strict=True)], dtype="<u8")
        bits = np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for i in range(0, len(bits), 255):
            ones += bits[i : i + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp long) for every row; fp holds the fingerprint's 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def sketch(g: np.ndarray) -> bytes:
    """One-permutation MinHash of a shingle set: SKETCH bins of 16 bits, 0 where a bin is empty."""
    out = np.zeros(SKETCH, dtype="<u2")
    if len(g):
        bins = (g >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        out[bins[first]] = (g[first] & np.uint64(0xFFFF)).astype("<u2") | 1
    return out.tobytes()


def profiles(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, fp, set, sketch) for every row of docs (id, text); ``set`` is 128 bits of hash of the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, keys, held = [], [], []
            for t in batch.column(1):
                text = t.as_py()
                g = shingle_set(text, shingle)
                fps.append(fingerprint(text, shingle))
                keys.append(xxhash.xxh128_digest(g.tobytes()))
                held.append(sketch(g))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(keys, pa.binary()), pa.array(held, pa.binary())], names=["id", "fp", "set", "sketch"])

    return docs.mapInArrow(run, "id long, fp long, set binary, sketch binary")


def similarities(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarities of rows of sketches; those without a shingle are equal."""
    either = (x > 0) | (y > 0)
    n = either.sum(axis=1)
    return np.where(n > 0, ((x == y) & either).sum(axis=1) / np.maximum(n, 1), 1.0)


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """m groups of 64 // m bits or one more: each starts at the first bit left and takes those most correlated to it."""
    with np.errstate(all="ignore"):
        c = np.nan_to_num(np.abs(np.corrcoef(bits.T))) if len(bits) > 1 else np.zeros((BITS, BITS))
    left, groups = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        group = [left.pop(0)]
        while len(group) < width:
            best = max(left, key=lambda b: (c[b, group].sum(), -b))
            left.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum ``total`` of least cost; costs[i][t + 1] is that of t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for j, c in enumerate(row):
                if used + j not in step or cost + c < step[used + j][0]:
                    step[used + j] = (cost + c, [*ts, j - 1])
        best = step
    return best[total + len(costs)]


def plan(sample: np.ndarray, nodes: int, radius: int) -> list[tuple[int, int]]:
    """(mask, threshold) of each partition that is probed, from sampled fingerprints and the number of nodes."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(sample) else np.zeros((0, BITS))
    other = np.roll(sample, 1) if len(sample) else sample
    best: tuple[float, list] = (float("inf"), [])
    for m in range(2, radius + 2):
        masks = [sum(1 << b for b in g) for g in group_bits(bits, m)]
        costs = []
        for mask in masks:
            width, row = mask.bit_count(), [0.0]
            dist = np.concatenate([np.bitwise_count((sample ^ np.roll(other, k)) & np.uint64(mask)) for k in range(64)]) if len(sample) > 128 else np.zeros(0)
            for t in range(radius - m + 2):
                ball = sum(comb(width, j) for j in range(t + 1))
                share = max(ball / 2.0**width, float((dist <= t).mean()) if len(dist) else 0.0)
                row.append(PROBE_COST * (1 + ball) / 2 + CANDIDATE_COST * share * nodes / 2)
            costs.append(row)
        cost, ts = allot(costs, radius - m + 1)
        if cost < best[0]:
            best = (cost, [(x, t) for x, t in zip(masks, ts, strict=True) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(mask: int, t: int) -> list[int]:
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [_signed(sum(c)) for k in range(t + 1) for c in combinations(bits, k)]


def _block_links(radius: int):
    """For a pair of blocks: the links between index and probing nodes, as a forest of (node, least node reached)."""

    def run(pdf):
        home, probe = pdf[pdf["home"]], pdf[~pdf["home"]]
        if home.empty or probe.empty:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        x, y = probe["fp"].to_numpy().view(np.uint64), home["fp"].to_numpy().view(np.uint64)
        near = np.concatenate([np.bitwise_count(x[k : k + 64, None] ^ y[None, :]) <= radius for k in range(0, len(x), 64)])
        lx, ly, top = probe["node"].to_numpy().copy(), home["node"].to_numpy().copy(), np.iinfo(np.int64).max
        while True:
            nx = np.minimum(lx, np.where(near, ly[None, :], top).min(axis=1))
            ny = np.minimum(ly, np.where(near, nx[:, None], top).min(axis=0))
            if (nx == lx).all() and (ny == ly).all():
                break
            lx, ly = nx, ny
        out = pd.DataFrame({"a": np.concatenate([probe["node"], home["node"]]), "b": np.concatenate([lx, ly])})
        return out[out["a"] != out["b"]].drop_duplicates()

    return run


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that connect the nodes (node, fp), distinct fingerprints, exactly as all pairs within ``radius`` bits do."""
    own_cols = ["node", "fp"]
    count = nodes.count()
    sample = np.array([r.fp for r in nodes.orderBy(F.xxhash64("fp")).limit(SAMPLE).select("fp").collect()], dtype=np.int64).view(np.uint64)
    parts = [(i, mask, t) for i, (mask, t) in enumerate(plan(sample, count, radius))]
    masked = lambda mask: F.col("fp").bitwiseAND(F.lit(_signed(mask)))
    home = nodes.select(*own_cols, F.explode(F.array(*[F.struct(F.lit(i).alias("part"), masked(m).alias("value")) for i, m, _ in parts])).alias("k")).select(*own_cols, "k.part", "k.value")
    # of two nodes the one with the smaller value in the partition probes; equal values meet in the index
    def around(i: int, mask: int, t: int):
        values = F.transform(F.array(*[F.lit(x) for x in _flips(mask, t)]), lambda x: F.struct(F.lit(i).alias("part"), masked(mask).bitwiseXOR(x).alias("value")))
        return F.filter(values, lambda s: s["value"] >= masked(mask))

    arrays = [around(*p) for p in parts]
    probes = nodes.select(*own_cols, F.explode(F.concat(*arrays)).alias("k")).select(*own_cols, "k.part", "k.value")
    sizes = home.groupBy("part", "value").agg(F.count("*").alias("n"))
    mean = F.element_at(F.create_map(*[c for i, m, _ in parts for c in (F.lit(i), F.lit(HOT + HOT_MEANS * count / 2.0 ** m.bit_count()))]), F.col("part"))
    hot = cut(sizes.where(F.col("n") > mean))
    some_hot = bool(hot.take(1))
    cold = home.join(hot.select("part", "value"), ["part", "value"], "left_anti") if some_hot else home
    own = F.element_at(F.create_map(*[c for i, m, _ in parts for c in (F.lit(i), F.col("p.fp").bitwiseAND(F.lit(_signed(m))))]), F.col("h.part"))
    met = (F.col("h.part") == F.col("p.part")) & (F.col("h.value") == F.col("p.value"))
    close = F.bit_count(F.col("h.fp").bitwiseXOR(F.col("p.fp"))) <= radius
    once = (own < F.col("p.value")) | (F.col("p.node") < F.col("h.node"))
    found = probes.alias("p").join(cold.alias("h"), met & close & once).select(F.col("p.node").alias("a"), F.col("h.node").alias("b"))
    if not some_hot:
        return found
    # a hot bucket of n nodes and p probes: ceil(n / BLOCK) x ceil(p / BLOCK) groups
    there = hot.select("part", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"))
    asked = probes.join(there, ["part", "value"])
    pb = cut(asked.groupBy("part", "value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("pb"))).join(there, ["part", "value"])
    block = lambda n: F.pmod(F.xxhash64("fp", F.lit("block")), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["part", "value", "i", "j", *own_cols]
    left = home.join(pb, ["part", "value"]).withColumn("i", block("nb")).withColumn("j", all_of("pb")).select(*cols, F.lit(True).alias("home"))
    right = probes.join(pb, ["part", "value"]).withColumn("j", block("pb")).withColumn("i", all_of("nb")).select(*cols, F.lit(False).alias("home"))
    forest = left.union(right).groupBy("part", "value", "i", "j").applyInPandas(_block_links(radius), "a long, b long")
    return found.union(forest)


def first_keys(nodes: DataFrame) -> DataFrame:
    """(node, fp, part, value) of nodes (node, fp): a row for each KEYED of the BLOCKS of bits, however many nodes there are."""
    blocks = [sum(1 << b for b in range(i, BITS, BLOCKS)) for i in range(BLOCKS)]
    keys = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(sum(c)))).alias("value")) for i, c in enumerate(combinations(blocks, KEYED))]
    return nodes.select("node", "fp", F.explode(F.array(*keys)).alias("k")).select("node", "fp", "k.part", "k.value")


def first_pairs(nodes: DataFrame, radius: int) -> tuple[DataFrame, str]:
    """Pairs (a, b) of nodes (node, fp) within ``radius`` bits: every node with the least of those that share a key with it.
    And the path of their table.

    Not all pairs within the radius: what they leave out is for the search by similarity that follows.
    """
    keys, place = stored(first_keys(nodes), "keys")
    least = F.min(F.struct("node", "fp")).alias("least")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("least.fp"))) <= radius
    met = with_aggregates(keys, ["part", "value"], [least], "node").where((F.col("least.node") < F.col("node")) & close)
    pairs, at = stored(met.select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct(), "first")
    drop(nodes.sparkSession, place)
    return pairs, at


def _plausible(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that the sketches' estimates do not put far below the similarity."""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(v), "<u2").reshape(len(v), SKETCH) for v in (x, y))
        return pd.Series(similarities(a, b) >= similarity - SLACK)

    one = known.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    other = known.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(one, "a").join(other, "b").where(similar("x", "y")).select("a", "b")


def _least(pairs: DataFrame) -> DataFrame:
    """For every node of the pairs that with its least neighbour: so few are enough to connect most of a dense group."""
    return pairs.union(pairs.select("b", "a")).groupBy("a").agg(F.min("b").alias("b"))


def similar_groups(rows: DataFrame, nodes: DataFrame, radius: int, shingle: int, similarity: float) -> DataFrame:
    """(node, component) of nodes (node, fp, set, sketch), linked by the similarity of the shingles of rows (id, text)."""
    known = nodes.select("node", "sketch")
    edges = lambda c: c.select(F.col("node").alias("a"), F.col("component").alias("b"))
    close, place = first_pairs(nodes.select("node", "fp"), min(radius, FIRST_RADIUS))
    first = cut(connected_components(verified(_least(close), rows, shingle, similarity)))
    drop(rows.sparkSession, place)
    apart = cut(nodes.select("node").distinct().join(first, "node", "left").select("node", F.coalesce("component", "node").alias("comp")))
    pairs, held = similar_pairs(rows, apart, shingle, similarity)
    pairs, place = stored(_plausible(pairs, known, similarity), "pairs")
    # least neighbours first: what they connect needs no comparison of all its pairs
    some = verified(_least(pairs), rows, shingle, similarity).union(edges(first))
    most = cut(connected_components(some.union(held) if held is not None else some))
    comp = lambda x: apart.join(most, "node", "left").select(F.col("node").alias(x), F.coalesce("component", "node").alias(f"of_{x}"))
    rest = pairs.join(comp("a"), "a").join(comp("b"), "b").where("of_a <> of_b").select("a", "b")
    found = connected_components(verified(rest, rows, shingle, similarity).union(edges(most)))
    drop(rows.sparkSession, place)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, similarity: float | None = None) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``: component_id is the least id reachable over links.

    With a ``similarity``, the links are the pairs whose sets of shingles have at least that Jaccard similarity, however
    many bits apart; fingerprints within ``radius`` bits, FIRST_RADIUS at most, are only looked at first.
    """
    if similarity is None:
        prints, key = cut(fingerprints(docs, id_col, text_col, shingle)), "fp"
        nodes = cut(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("node")))
        found = connected_components(links(nodes, radius))
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        prints, key = cut(profiles(rows, shingle)), "set"
        nodes = cut(prints.where("id is not null").groupBy("set").agg(F.min("id").alias("node"), F.min("fp").alias("fp"), F.min("sketch").alias("sketch")))
        found = similar_groups(rows, nodes, radius, shingle, similarity)
    of = nodes.join(found, "node", "left").select(key, F.coalesce("component", "node").alias("component_id"))
    return prints.join(of, key, "left").select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 9, shingle: int = 5, similarity: float | None = 0.8) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its near-duplicates; rows without an id stay."""
    gone = near_duplicates(docs, id_col, text_col, radius, shingle, similarity).where("component_id < id").select(F.col("id").alias("_s_id")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_s_id"], "left_anti")
