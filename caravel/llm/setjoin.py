"""Pairs of documents whose shingle sets have a Jaccard similarity t or more, none left out.

All sets are put in one order; two similar sets share one of the first n - ceil(t n) + 1 shingles of each, their
prefixes.  Shingles that many documents of a bounded sample hold come last, which decides the cost alone.

A shingle in the prefixes of more than HOT nodes would give the square of its nodes in pairs.  Such nodes are held
against a pivot instead, that with the fewest shingles that are not common, hence the one with the least of its own; so
all shingles of a passage have the same pivot:

* A node similar to the pivot is linked to it, and nodes linked to it need no link to each other.
* Otherwise write a set as its difference from the pivot's: the shingles it adds and those it lacks.  With p shingles
  in the pivot, a added and d lacking, let c = d + t a; the node is similar to the pivot if c <= (1 - t) p.  Nodes x and
  y are similar if and only if their differences share at least (c_x + c_y - (1 - t) p) / (1 + t) shingles.  Where x is
  not similar to the pivot that is more than c_y / (1 + t), about half of y's difference, so the prefix of y's difference
  holds one of them.  What nodes of a group have in common is in no difference, so few pairs meet.
* By the triangle inequality a pair with a node within distance 2 (1 - t) of the pivot lies within 3 (1 - t) of it;
  nodes farther than 2 (1 - t) from it go on to a next pivot.  After ROUNDS pivots those left meet by their prefixes.

Every pair that meets is yet to be verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, stored, with_aggregates
from .texthash import gram_hashes, word_hashes

#: Documents sampled for common shingles, how many of them hold a common one, and a bound on their number.
COMMON_SAMPLE, COMMON, COMMON_MOST = 8000, 4, 1 << 18
#: Ids of at most so many documents are broadcast to their texts, and sets of pivots of at most so many bytes to their nodes.
BROADCAST_IDS, BROADCAST_BYTES = 1_000_000, 32 << 20
#: Prefixes of more nodes than HOT are held against pivots, of which there are ROUNDS one after another.
HOT, ROUNDS = 64, 2


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles, of the whole sequence if that is shorter."""
    wh = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    return np.unique(gram_hashes(wh, min(shingle, max(1, len(wh)))))


def texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """rows (id, text) with the columns of those nodes whose id is theirs."""
    side = F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes
    return rows.join(side, rows["id"] == side["node"]).drop("id")


def _sets(rows: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the shingle sets of rows (id, text) whose id is a node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([shingle_set(t.as_py(), shingle).tobytes() for t in part.column(0)], pa.binary())], names=["node", "set"])

    return texts_of(rows, nodes).select("text", "node").mapInArrow(run, "node long, set binary")


def verified(pairs: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least the Jaccard similarity, by the whole sets of shingles of rows (id, text)."""

    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y, strict=True):
            both = np.sort(np.concatenate([np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8")]))
            shared = int((both[1:] == both[:-1]).sum())
            out.append(len(both) == 0 or shared / (len(both) - shared) >= similarity)
        return pa.array(out, pa.bool_())

    asked, at = stored(pairs, "asked")
    ids = cut(asked.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    sets, place = stored(_sets(rows, ids, shingle), "sets")
    one, other = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    found, _ = stored(asked.join(one, "a").join(other, "b").where(similar("x", "y")).select("a", "b"), "verified")
    drop(rows.sparkSession, place)
    drop(rows.sparkSession, at)
    return found


def common_shingles(texts: DataFrame, nodes: int, shingle: int) -> np.ndarray:
    """Sorted hashes of shingles that COMMON or more documents of a bounded sample hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py(), shingle).view(np.int64))], names=["h"])

    sample = texts.where(F.pmod(F.xxhash64("node"), F.lit(max(1, nodes // COMMON_SAMPLE))) == 0)
    counts = sample.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    return np.sort(np.array([r.h for r in counts.orderBy(F.desc("n"), "h").limit(COMMON_MOST).collect()], dtype=np.int64).view(np.uint64))


def among(g: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which values of g stand in the sorted values ``common``."""
    if not len(common):
        return np.zeros(len(g), dtype=bool)
    return common[np.minimum(np.searchsorted(common, g), len(common) - 1)] == g


def prefix(g: np.ndarray, late: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(similarity n) + 1 of n shingles in the order of all sets: common ones late, else by hash."""
    n = len(g) - int(np.ceil(similarity * len(g) - 1e-9)) + 1 if len(g) else 0
    return np.concatenate([g[~late], g[late]])[:n]


def similar_pairs(rows: DataFrame, nodes: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b) of nodes (node, comp), to be verified, and links (a, b) that hold.

    Every pair of nodes of different components that has the similarity is among the pairs or connected by the links.
    """
    texts = texts_of(rows, nodes)
    common = common_shingles(texts, nodes.count(), shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, comps = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for i in range(0, batch.num_rows, 256):
                sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)[i : i + 256]]
                late = [among(g, common) for g in sets]
                heads = [prefix(g, x, similarity) for g, x in zip(sets, late, strict=True)]
                own = np.array([len(x) - int(x.sum()) for x in late], dtype=np.int32)
                k = np.array([len(x) for x in heads], dtype=np.int64)
                n = np.repeat(np.array([len(g) for g in sets], dtype=np.int32), k)
                at = np.arange(k.sum(), dtype=np.int32) - np.repeat(np.cumsum(k) - k, k).astype(np.int32)
                cols = [np.concatenate(heads).view(np.int64), np.repeat(ids[i : i + 256], k), np.repeat(comps[i : i + 256], k), n, np.repeat(own, k), at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "node", "comp", "n", "own", "at"])

    held, place = stored(texts.select("text", "node", "comp").mapInArrow(run, "h long, node long, comp long, n int, own int, at int"), "prefixes")
    spark, found, links, todo, rest, keep = rows.sparkSession, [], [], held, ROUNDS, [place]
    while True:
        first = F.min(F.struct("own", (-F.col("n")).alias("n"), "node"))["node"]
        known = with_aggregates(todo, ["h"], [F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), first.alias("pivot")], "node").where("c0 < c1")
        known, at = stored(known.drop("c0", "c1"), "known")
        drop(spark, keep.pop())
        keep.append(at)
        hot = known.where(F.col("m") > HOT)
        more = rest > 0 and bool(hot.take(1))
        found.append(stored(_met(known.where(F.col("m") <= HOT) if more else known, similarity).distinct(), "met")[0])
        if not more:
            break
        compared, differences = _against_pivots(hot, rows, shingle, common, similarity)
        links.append(cut(compared.where(F.col("linked") & F.col("e").isNull()).select(F.col("node").alias("a"), F.col("pivot").alias("b"))))
        found.append(stored(_alike_differences(compared, similarity), "met")[0])
        far = compared.where(F.col("e").isNull() & ~F.col("near")).select("pivot", "node")
        todo, place = stored(hot.join(far, ["pivot", "node"], "left_semi").select("h", "node", "comp", "n", "own", "at"), "far")
        drop(spark, differences)
        drop(spark, keep.pop())
        keep.append(place)
        rest -= 1
    drop(spark, keep.pop())
    return reduce(DataFrame.union, found).distinct(), reduce(DataFrame.union, links) if links else None


def _met(held: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of different components whose prefixes (h, node, comp, n, at) meet, with enough shingles behind.

    Of a pair, the larger set is looked up by its prefix in the smaller one's, which is shorter still.
    """
    c, least = F.col, similarity / (1 + similarity)
    x, y = held.alias("x"), held.where(c("at") <= c("n") - F.ceil(2 * least * c("n") - 1e-9)).alias("y")
    smaller = (c("y.n") < c("x.n")) | ((c("y.n") == c("x.n")) & (c("y.node") < c("x.node")))
    rest = F.least(c("x.n") - c("x.at"), c("y.n") - c("y.at"))
    enough = (c("y.n") >= similarity * c("x.n") - 1e-9) & (rest >= least * (c("x.n") + c("y.n")) - 1e-9)
    met = x.join(y, (c("x.h") == c("y.h")) & (c("x.comp") != c("y.comp")) & smaller & enough)
    return met.select(c("x.node").alias("a"), c("y.node").alias("b"))


def difference(g: np.ndarray, pivot: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int]:
    """(shingles that only one of two sets holds, how many of them g adds), in one order for all sets against a pivot:
    added ones first, common ones among them later, then those lacking."""
    added, lacking = g[~np.isin(g, pivot, assume_unique=True)], pivot[~np.isin(pivot, g, assume_unique=True)]
    late = among(added, common)
    return np.concatenate([added[~late], added[late], lacking]), len(added)


def _against_pivots(hot: DataFrame, rows: DataFrame, shingle: int, common: np.ndarray, similarity: float) -> tuple[DataFrame, str]:
    """(pivot, node, comp, linked, near, c, p, size, e, at): for every node of a hot shingle and its pivot a row with e
    null, and the differences of the nodes within 3 (1 - t) of it; of linked ones only the prefixes.  And the table's path."""
    pairs = cut(hot.where("node <> pivot").groupBy("pivot", "node").agg(F.min("comp").alias("comp")))
    ids = cut(pairs.select(F.explode(F.array("pivot", "node")).alias("node")).distinct())
    sets, place = stored(_sets(rows, ids, shingle), "sets")
    pivots = cut(sets.join(pairs.select(F.col("pivot").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("pivot"), F.col("set").alias("of")))
    size = pivots.agg(F.sum(F.octet_length("of"))).collect()[0][0] or 0
    names, away = ["pivot", "node", "comp", "linked", "near", "c", "p", "size", "e", "at", "probe"], 1 - similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows_held = [], 0
            for i in range(batch.num_rows):
                pivot, node, comp = (batch.column(k)[i].as_py() for k in range(3))
                g, of = (np.frombuffer(batch.column(k)[i].as_buffer(), "<u8") for k in (3, 4))
                d, added = difference(g, of, common)
                lacking = len(d) - added
                shared = len(of) - lacking
                jaccard = shared / max(1, shared + len(d))
                linked, near, c = jaccard >= similarity, 1 - jaccard <= 2 * away + 1e-9, lacking + similarity * added
                least = int(np.floor(c / (1 + similarity) + 1e-9)) + 1
                probe = max(0, len(d) - least + 1)
                e = d[:0] if 1 - jaccard > 3 * away + 1e-9 else d[:probe] if linked else d
                at = np.arange(-1, len(e))
                held.append((pivot, node, comp, linked, near, c, len(of), len(d), e, at, (at >= 0) & (at < probe)))
                rows_held += len(e) + 1
                if rows_held > 1 << 16 or i + 1 == batch.num_rows:
                    yield flush(held)
                    held, rows_held = [], 0

    def flush(held: list) -> pa.RecordBatch:
        n = [len(x[9]) for x in held]
        one = [pa.array(np.repeat(np.array([x[k] for x in held], kind), n)) for k, kind in enumerate((np.int64, np.int64, np.int64, bool, bool, float, np.int64, np.int64))]
        e = np.concatenate([np.concatenate([np.zeros(1, np.uint64), x[8]]) for x in held]).view(np.int64)
        at = np.concatenate([x[9] for x in held])
        return pa.RecordBatch.from_arrays([*one, pa.array(e, mask=at < 0), pa.array(at), pa.array(np.concatenate([x[10] for x in held]))], names=names)

    joined = pairs.join(sets, "node").join(F.broadcast(pivots) if size <= BROADCAST_BYTES else pivots, "pivot").select("pivot", "node", "comp", "set", "of")
    out, at = stored(joined.mapInArrow(run, "pivot long, node long, comp long, linked boolean, near boolean, c double, p long, size long, e long, at long, probe boolean"), "differences")
    drop(rows.sparkSession, place)
    return out, at


def _alike_differences(compared: DataFrame, similarity: float) -> DataFrame:
    """(a, b): nodes a, not similar to their pivot, and b whose differences from it may share enough shingles."""
    c, held = F.col, compared.where(F.col("e").isNotNull())
    x, y = held.where(~c("linked")).alias("x"), held.where("probe").alias("y")
    need = (c("x.c") + c("y.c") - (1 - similarity) * c("x.p")) / (1 + similarity)
    enough = F.least(c("x.size") - c("x.at"), c("y.size") - c("y.at")) >= need - 1e-9
    met = x.join(y, (c("x.pivot") == c("y.pivot")) & (c("x.e") == c("y.e")) & (c("x.comp") != c("y.comp")) & enough)
    return met.select(F.greatest(c("x.node"), c("y.node")).alias("a"), F.least(c("x.node"), c("y.node")).alias("b")).distinct()
