"""Language identification by a linear-chain conditional random field over words.

A word's features are itself (lexicon), its prefixes and suffixes of up to three letters and its letter bigrams and
trigrams, hashed to BUCKETS weights a language; languages follow each other with learned transitions.  The chain is
trained by AdaGrad on the exact log-likelihood, and forward-backward gives every word's marginal probabilities, so
texts that switch languages get a label a word (``label_words``).  A text's language is the one with the largest sum of
marginals over its words with a letter; the score is its share of that sum.  Chains hold at most CHAIN words.  A word of
more than LONG characters, as in scripts without spaces, stands in a chain as runs of RUN characters, so that all of it counts.

Training sees at most TRAIN_DOCS rows a language, each with at most TRAIN_CHAINS chains spread over its text, of
documents with a language whose crc32(id as text) mod FOLDS is not HELD_OUT; nothing else of a document than text and
language is read, and a prediction reads the text alone.

Results in unusual cases: null texts and texts without a letter are ``und`` with score 0, and so is every text where
nothing could be learnt; every language that a row of the training folds has is learnt, however many there are; rows
with a null id are not trained on and count as not held out; repeated rows are predicted row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .tokens import gather

FOLDS, HELD_OUT = 3, 1
TRAIN_DOCS, TRAIN_CHAINS, CHAIN = 160, 4, 48
BUCKETS = 1 << 16
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.3, 1e-6
#: Distinct cores that one Python worker remembers, bytes of text predicted at once, and marginals held at once.
CACHE_CORES, CHUNK, MARGINALS = 500_000, 2 << 20, 1 << 22
PUNCTUATION = ".,;:!?\"'()[]{}"
#: Words of more than LONG characters, as in scripts without spaces, are dealt to chain positions of RUN characters each.
LONG, RUN = 40, 8


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word; words without a letter have the bias alone."""
    if not any(c.isalpha() for c in word):
        return [0]
    s, n = f"^{word}$", len(word) + 2
    keys = {"w" + word, *("p" + word[:k] for k in (1, 2, 3)), *("s" + word[-k:] for k in (1, 2, 3)), *(s[i : i + 2] for i in range(n - 1)), *(s[i : i + 3] for i in range(n - 2))}
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) + 1 for k in keys]


def runs(word: str) -> list[str]:
    """A word's chain positions: itself, or runs of RUN characters where it is longer than LONG."""
    return [word] if len(word) <= LONG else [word[i : i + RUN] for i in range(0, len(word), RUN)]


def core(position: str) -> str:
    """What features are taken of: positions that differ in case and punctuation at their ends alone are scored alike."""
    return position.lower().strip(PUNCTUATION)


def positions(text: str) -> list[str]:
    """The chain positions of a text."""
    return list(chain.from_iterable(runs(w.decode("utf-8", "surrogatepass")) for w in text.encode("utf-8", "surrogatepass").split()))


def forward_backward(em: np.ndarray, mask: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Node marginals (S, T, L) of chains with scores em (S, T, L), masked to their lengths, and the sum of pair marginals."""
    s, t, n = em.shape
    b, a = np.exp(em - em.max(axis=2, keepdims=True)), np.exp(trans - trans.max())
    alpha, beta = np.empty_like(b), np.ones_like(b)
    alpha[:, 0] = b[:, 0] / b[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ a) * b[:, i]
        x /= x.sum(axis=1, keepdims=True)
        alpha[:, i] = np.where(mask[:, i, None], x, alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        x = (b[:, i + 1] * beta[:, i + 1]) @ a.T
        x /= x.sum(axis=1, keepdims=True)
        beta[:, i] = np.where(mask[:, i + 1, None], x, 1.0)
    node = alpha * beta
    node /= node.sum(axis=2, keepdims=True)
    if not pairs:
        return node, None
    total = np.zeros((n, n))
    for i in range(1, t):
        p = alpha[:, i - 1, :, None] * a * (b[:, i] * beta[:, i])[:, None, :]
        total += (p / p.sum(axis=(1, 2), keepdims=True))[mask[:, i]].sum(axis=0)
    return node, total


class Crf:
    """weights (BUCKETS, L), transitions (L, L) and the languages' names."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray):
        self.labels, self.weights, self.trans = labels, weights, trans
        self.forget()

    def forget(self) -> None:
        self.cores: dict[str, int] = {}
        self.scores, self.letter = np.zeros((1 << 14, len(self.labels)), np.float32), np.zeros(1 << 14, bool)

    def __reduce__(self):
        return Crf, (self.labels, self.weights, self.trans)

    def _learn(self, new: list[str]) -> None:
        found = [features(c) for c in new]
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64)
        first = np.cumsum([0, *map(len, found[:-1])])
        n = len(self.cores)
        while n + len(new) > len(self.scores):
            self.scores, self.letter = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.letter, np.zeros_like(self.letter)])
        self.scores[n : n + len(new)] = np.add.reduceat(self.weights[flat], first, axis=0)
        self.letter[n : n + len(new)] = [f != [0] for f in found]
        self.cores.update(zip(new, range(n, n + len(new)), strict=True))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The places in the scores of all texts' positions, and where each text's begin (and the last's end)."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = [runs(w) if w else [] for w in distinct]
        flat = list(map(core, chain.from_iterable(parts)))
        missing = list(dict.fromkeys(c for c in flat if c not in self.cores))
        if missing:
            if len(self.cores) + len(missing) > CACHE_CORES and self.cores:
                self.forget()
                missing = list(dict.fromkeys(flat))
            self._learn(missing)
        at = np.fromiter(map(self.cores.__getitem__, flat), np.int64, len(flat))
        ends = np.cumsum([0, *map(len, parts)])
        w = words.indices.to_numpy()
        found, size = gather(at, ends[:-1][w], np.diff(ends)[w])
        off = split.offsets.to_numpy()
        return found, np.concatenate([[0], np.cumsum(size)])[off - off[0]]

    def chains(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text of each chain, positions, their marginals), in blocks of a bounded number of marginals."""
        ids, bounds = self.ids(texts)
        sizes = np.diff(bounds)
        n = -(-sizes // CHAIN)
        owner = np.repeat(np.arange(len(sizes)), n)
        first = bounds[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * CHAIN
        block = max(1, MARGINALS // (CHAIN * len(self.labels)))
        for i in range(0, len(owner), block):
            at = first[i : i + block, None] + np.arange(CHAIN)
            grid = np.where(at < bounds[1:][owner[i : i + block], None], ids[np.minimum(at, len(ids) - 1)], -1)
            mask = grid >= 0
            yield owner[i : i + block], grid, forward_backward(np.where(mask[:, :, None], self.scores[grid], 0).astype(np.float64), mask, self.trans)[0]

    def predict(self, texts: pa.Array) -> list[tuple[str, float]]:
        total = np.zeros((len(texts), len(self.labels)))
        for owner, grid, node in self.chains(texts) if self.labels else ():
            counted = (grid >= 0) & self.letter[grid]
            np.add.at(total, owner, (node * counted[:, :, None]).sum(axis=1))
        every, best = total.sum(axis=1), total.argmax(axis=1) if self.labels else []
        return [(self.labels[b], float(min(1.0, t[b] / e))) if e > 0 else ("und", 0.0) for t, e, b in zip(total, every, best, strict=True)] if self.labels else [("und", 0.0)] * len(texts)


def train(chains: list[tuple[list[str], int]], labels: list[str], seed: int = 7) -> Crf:
    """A CRF from chains of words with one label each; deterministic."""
    n, rng = len(labels), np.random.default_rng(seed)
    weights, trans = np.zeros((BUCKETS, n)), np.zeros((n, n))
    if not chains or n == 0:
        return Crf(labels if chains else [], weights.astype(np.float32), trans)
    known: dict[str, np.ndarray] = {}
    for words, _ in chains:
        for w in words:
            if w not in known:
                known[w] = np.array(features(w))
    gw, gt = np.full((BUCKETS, n), 1e-6), np.full((n, n), 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(chains))
        for at in range(0, len(chains), BATCH):
            part = [chains[i] for i in order[at : at + BATCH]]
            longest = max(len(w) for w, _ in part)
            mask = np.zeros((len(part), longest), bool)
            for i, (w, _) in enumerate(part):
                mask[i, : len(w)] = True
            feats = [known[w] for ws, _ in part for w in ws]
            flat, sizes = np.concatenate(feats), np.array([len(f) for f in feats])
            first = np.cumsum(sizes) - sizes
            em = np.zeros((*mask.shape, n))
            em[mask] = np.add.reduceat(weights[flat], first, axis=0)
            node, pair = forward_backward(em, mask, trans, pairs=True)
            gold = np.zeros_like(node)
            ys = np.array([y for _, y in part])
            gold[np.arange(len(part)), :, ys] = 1
            diff = np.repeat((gold - node)[mask], sizes, axis=0)
            grad = np.stack([np.bincount(flat, weights=diff[:, k], minlength=BUCKETS) for k in range(n)], axis=1) / len(part)
            grad -= DECAY * weights
            pairs = np.zeros((n, n))
            np.add.at(pairs, (ys, ys), mask.sum(axis=1) - 1)
            step = (pairs - pair) / len(part)
            gw += grad**2
            gt += step**2
            weights += RATE * grad / np.sqrt(gw)
            trans += RATE * step / np.sqrt(gt)
    return Crf(labels, weights.astype(np.float32), trans)


def held_out(key) -> F.Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    """Trains on a bounded, deterministic sample: of every language the TRAIN_DOCS rows whose ids' hashes are least."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(~held_out(F.col("id")) & F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one pass counts the languages, one takes the rows of least hashes: only some 4 TRAIN_DOCS a language are shuffled
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    least = rows.join(F.broadcast(counts), "lang").where((F.xxhash64("id") / 2.0**64 + 0.5) * F.col("n") < 4.0 * TRAIN_DOCS)
    best = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    picked = cut(least.withColumn("place", F.row_number().over(best)).where(F.col("place") <= TRAIN_DOCS).select("text", "lang"))
    labels = sorted(r.lang for r in picked.select("lang").distinct().collect())
    if not labels:
        return train([], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, chains = [], []
            for text, name in zip(batch.column(0), batch.column(1), strict=True):
                ws = positions(text.as_py() or "")
                n = -(-len(ws) // CHAIN)
                for c in sorted({i * n // TRAIN_CHAINS for i in range(TRAIN_CHAINS)} if n else ()):
                    chains.append([core(w) for w in ws[c * CHAIN : (c + 1) * CHAIN]])
                    lang.append(name.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(chains, pa.list_(pa.string()))], names=["lang", "words"])

    got = picked.mapInArrow(run, "lang string, words array<string>").orderBy("lang", "words").collect()
    place = {x: i for i, x in enumerate(labels)}
    return train([(r.words, place[r.lang]) for r in got if r.words and r.lang in place], labels)


def identify(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in batches:
            text = pc.fill_null(batch.column(2), "")
            stops, i = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(stops, (stops[i - 1] if i else 0) + CHUNK, side="right")))
                found = crf.predict(text[i:j])
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
                i = j

    key = F.col(id_col).cast("long")
    return docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(text: str | None, model: Crf) -> list[tuple[str, str, float]]:
    """(word, language, probability) of every word of a text: the labels of code-switched text."""
    words = [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]
    parts = [(grid[grid >= 0], node[grid >= 0]) for _, grid, node in model.chains(pa.array([text or ""], pa.string()))] if words else []
    ids, nodes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros((0, 1)))
    out, at, letter = [], 0, model.letter[ids]
    for w in words:
        # a long word's probabilities are the mean of those of its positions with a letter
        mine = slice(at, at + len(runs(w)))
        at, has = mine.stop, letter[mine]
        p = nodes[mine][has].mean(axis=0) if has.any() else None
        out.append((w, "und" if p is None else model.labels[int(p.argmax())], 0.0 if p is None else float(p.max())))
    return out
