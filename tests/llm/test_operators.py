"""Each operator against brute force on a small fixture that holds the unusual cases: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from caravel.llm import chat, decontaminate, idfiles, langid, licenses, packing, quality, setjoin, shards, simhash, substring, texthash, tokens, warc
from caravel.llm.common import scratch
from caravel.llm.graph import connected_components

R = random.Random(5)
VOCAB = ["".join(R.choice("abcdefghijklmnop") for _ in range(R.randint(2, 7))) for _ in range(400)]


def prose(n, vocab=VOCAB):
    return " ".join(R.choice(vocab) for _ in range(n))


BASE = prose(200)
SHARED = prose(60)


def near(text, k):
    w = text.split()
    for _ in range(k):
        w[R.randrange(len(w))] = "x%d" % R.randrange(9999)
    return " ".join(w)


TEXTS = [None, "", " \n\t", "one", "one two three", BASE, BASE, BASE + " ", near(BASE, 1), near(BASE, 2), prose(30) + " " + SHARED + " " + prose(20), SHARED + " " + prose(40), prose(12), "a " * 300, "é ü\x0bß\x1fz\xa0k " * 9, "\n".join(["same line here"] * 9), prose(20000)]
TEXTS += [prose(R.randint(13, 80)) for _ in range(30)] + [near(BASE, 3) for _ in range(10)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 1, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(4, TEXTS[1], "again", 8), (None, BASE, "null id", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, id int").repartition(5).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture
def none(docs):
    return docs.where("false")


def words(t):
    return (t or "").encode().split()


# 1
def brute_fingerprint(t):
    w = words((t or "").encode().lower().decode())
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs, rows, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = {}
    for k, t in rows:
        fps.setdefault(k, []).append(brute_fingerprint(t))
    keyed = [(k, f) for k, fs in fps.items() if k is not None for f in fs]
    pairs = [(a, b) for a, f in keyed for b, g in keyed if a < b and (f ^ g).bit_count() <= 4]
    want = brute_components({k for k, _ in keyed}, pairs)
    assert len(pairs) > 10
    for r in got:
        assert r.fp % (1 << 64) in fps[r.id] and r.component_id == (want[r.id] if r.id is not None else None)
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_hot_buckets(spark, monkeypatch):
    """A ball of fingerprints: every pair path goes through the blocks."""
    monkeypatch.setattr(simhash, "HOT", 4)
    monkeypatch.setattr(simhash, "HOT_MEANS", 0)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    centre, rng = 0x0123456789ABCDEF, random.Random(1)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(300)})
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    got = {r.node: r.component for r in connected_components(simhash.links(nodes)).collect()}
    want = brute_components(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert all(got.get(i, i) == want[i] for i in want) and len(set(want.values())) < len(want)


def test_pigeonhole_thresholds():
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for radius in (2, 4, 8):
        for nodes in (100, 10**6, 10**9):
            parts = simhash.plan(sample, nodes, radius)
            masks = [m for m, _ in parts]
            assert sum(m.bit_count() for m in masks) <= 64 and not any(a & b for i, a in enumerate(masks) for b in masks[:i])
            # of the T + 1 differing bits that no partition may hold alone, the thresholds hold T + 1 - m + m
            assert sum(t + 1 for _, t in parts) == radius + 1
    assert simhash.allot([[0, 1, 9], [0, 5, 6], [0, 2, 4]], -1) == (3, [0, -1, 0])


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 1), (3, 1), (7, 8)] + [(100, i) for i in range(101, 160)], "a long, b long")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert [got[x] for x in (1, 2, 3, 5, 7, 8, 9, 159)] == [1, 1, 1, 5, 7, 7, 7, 100]
    assert connected_components(e.where("false")).collect() == []


def test_near_dedup_keeps_one_of_each_group(docs):
    kept = simhash.deduplicate(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(None) == 1
    copies = [i * 3 + 1 for i, t in enumerate(TEXTS) if t is not None and len(set(t.split()) & set(BASE.split())) > 0.97 * len(set(BASE.split())) and len(t.split()) == 200]
    assert len(copies) >= 5 and sum(c in ids for c in copies) == 1


# 2
def edited(text, share):
    return " ".join("e%d" % R.randrange(10**6) if R.random() < share else w for w in text.split())


def brute_shingles(t, k=5):
    w = words(t.lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


@pytest.fixture(scope="module")
def similar():
    """Texts of all lengths in pairs on both sides of 0.8, with a passage that many hold, and the similarities of all pairs."""
    vocab = ["v%d" % i for i in range(5000)]
    line, texts = prose(40, vocab), []
    for n in (6, 25, 60, 200, 600):
        for share in (0.005, 0.01, 0.015, 0.02, 0.025, 0.03) * 3:
            base = prose(n, vocab) + (" " + line if R.random() < 0.5 else "")
            texts += [base, edited(base, share)]
    sets = [brute_shingles(t) for t in texts]
    return texts, {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(len(texts)) for b in range(a + 1, len(texts))}


@pytest.mark.parametrize("hot", [64, 3])
def test_every_similar_pair_is_met(spark, similar, monkeypatch, hot):
    """Alike pairs are among the pairs, or connected by the links where shingles are held against pivots."""
    monkeypatch.setattr(setjoin, "COMMON", 5)
    monkeypatch.setattr(setjoin, "HOT", hot)
    texts, alike = similar
    close = {p for p, s in alike.items() if 0.8 <= s < 1}
    assert sum(alike[p] < 0.9 for p in close) > 10
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    pairs, links = setjoin.similar_pairs(d, d.select(F.col("id").alias("node"), F.col("id").alias("comp")), 5, 0.8)
    found, held = {(min(p), max(p)) for p in pairs.collect()}, [tuple(x) for x in links.collect()] if links is not None else []
    of = brute_components(range(len(texts)), held)
    assert all(alike[min(p), max(p)] >= 0.8 for p in held)
    assert all(p in found or of[p[0]] == of[p[1]] for p in close) and len(found) < len(alike) / 10


def test_the_first_look_of_near_dedup_takes_the_same_rows_for_every_node(spark, monkeypatch):
    rng = random.Random(5)
    for n in (40, 1000):
        far = [rng.getrandbits(64) for _ in range(n // 2)]
        near = [far[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for _ in range(n // 2)]
        nodes = {i: fp for i, fp in enumerate(far + near)}
        df = spark.createDataFrame([(i, simhash._signed(fp)) for i, fp in nodes.items()], "node long, fp long")
        assert simhash.first_keys(df).count() == 20 * len(nodes)
        pairs, _ = simhash.first_pairs(df, 5)
        got = {(r.a, r.b) for r in pairs.collect()}
        assert all(b < a and (nodes[a] ^ nodes[b]).bit_count() <= 5 for a, b in got)
        # node 0 is the least of every bucket it is in, and within 3 bits of it some key agrees
        assert {a for a in nodes if 0 < (nodes[a] ^ nodes[0]).bit_count() <= 3} <= {a for a, b in got if b == 0}
    # neither thresholds by the number of nodes nor probes are left in the search by similarity
    monkeypatch.setattr(simhash, "plan", None)
    texts = [" ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59)), "some other words that are here alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.near_duplicates(docs, radius=9, shingle=5, similarity=0.8)
    assert {r.id: r.component_id for r in found.collect()} == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_a_group_on_both_sides_of_the_similarity(spark, monkeypatch, rounds):
    """Copies of two texts by words replaced, put in and left out, with lines that others hold: as brute force has it."""
    monkeypatch.setattr(setjoin, "HOT", 4)
    monkeypatch.setattr(setjoin, "ROUNDS", rounds)
    monkeypatch.setattr(setjoin, "COMMON", 5)
    rng, vocab = random.Random(3), ["v%d" % i for i in range(3000)]
    first, line = [rng.choice(vocab) for _ in range(130)], [rng.choice(vocab) for _ in range(25)]
    second = first[:65] + [rng.choice(vocab) for _ in range(60)]
    texts = [" ".join(line), " ".join(line * 2)]
    for i in range(160):
        out = []
        for w in second if i % 4 == 0 else first:
            x = rng.random()
            out += [] if x < 0.002 else [w, rng.choice(vocab)] if x < 0.004 else [rng.choice(vocab)] if x < 0.006 + 0.01 * (i % 3) else [w]
        texts.append(" ".join(out[: len(out) - rng.choice([0, 0, 0, 0, 6, 12])] + rng.choice([[], [], [], line])))
    sets, n = [brute_shingles(t) for t in texts], len(texts)
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(n) for b in range(a + 1, n)}
    want = brute_components(range(n), [p for p, x in alike.items() if x >= 0.8])
    assert 10 < len(set(want.values())) < n - 30 and sum(0.7 < x < 0.8 for x in alike.values()) > 300
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    pairs, links = setjoin.similar_pairs(d, d.select(F.col("id").alias("node"), F.col("id").alias("comp")), 5, 0.8)
    met = [(min(p), max(p)) for p in pairs.collect()]
    got = brute_components(range(n), [p for p in met if alike[p] >= 0.8] + ([tuple(x) for x in links.collect()] if links is not None else []))
    assert got == want
    print(rounds, len(met), len(alike))
    assert {r.id: r.component_id for r in simhash.near_duplicates(d.withColumnRenamed("id", "doc_id"), radius=9, shingle=5, similarity=0.8).collect()} == want


def test_near_dedup_compares_whole_sets(spark, similar):
    texts, alike = similar
    assert sum(0.6 < s < 0.8 for s in alike.values()) > 10
    want = brute_components(range(len(texts)), [p for p, s in alike.items() if s >= 0.8])
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.id: r.component_id for r in simhash.near_duplicates(d, radius=9, shingle=5, similarity=0.8).collect()} == want


def test_near_dedup_of_a_dense_group(spark, monkeypatch):
    """Every pair path goes through the blocks, and comes out as brute force has it."""
    monkeypatch.setattr(simhash, "HOT", 2)
    monkeypatch.setattr(simhash, "HOT_MEANS", 0)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    base = prose(120, ["v%d" % i for i in range(3000)])
    texts = [edited(base, 0.02) for _ in range(120)]
    sets = [brute_shingles(t) for t in texts]
    want = brute_components(range(120), [(a, b) for a in range(120) for b in range(a + 1, 120) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8])
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.id: r.component_id for r in simhash.near_duplicates(d, radius=9, shingle=5, similarity=0.8).collect()} == want


ITEM = "The train from Paris leaves at 7 and runs 120 km in 3 hours, how fast does it go on average today?"


def test_decontamination(spark):
    same = prose(50) + " " + ITEM.lower().replace("paris", "Paris") + " " + prose(30)
    other = prose(40) + ". " + ITEM.replace("Paris", "Lyon").replace("120", "480").replace("3 hours", "6 hours")
    mixed = "x. " + ITEM.replace("7", "8")
    clean = [prose(60), "The train from Paris leaves at 7.", None, "", "a b"]
    bench = spark.createDataFrame([(0, ITEM), (1, "too short"), (2, None), (3, "one two one two 5 5 5 5 one two"), (None, ITEM)], "item_id long, text string")
    d = spark.createDataFrame(list(enumerate([same, other, mixed, "so one two one two 5 5 5 6 one two", *clean])), "doc_id long, text string").withColumn("item_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(d, bench).collect()}
    # in document 3 one value of the item stands for two: no re-parameterised copy
    assert got == {(0, 0): "exact", (1, 0): "reparameterised", (2, 0): "reparameterised"}
    assert sorted(r.doc_id for r in decontaminate.decontaminate(d, bench).collect()) == [3, 4, 5, 6, 7, 8]
    assert decontaminate.contaminated(d, bench.where("false")).collect() == [] and decontaminate.contaminated(d.where("false"), bench).collect() == []


def test_decontamination_shuffles_large_benchmarks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    d = spark.createDataFrame([(1, prose(9) + " " + ITEM)], "doc_id long, text string")
    assert [r.item_id for r in decontaminate.contaminated(d, spark.createDataFrame([(5, ITEM)], "item_id long, text string")).collect()] == [5]


def test_decontamination_of_names_at_sentence_starts(spark):
    tom = "Tom has 5 apples. Tom buys 3 more. How many does Tom have to eat?"
    items = [tom, "What is the largest prime below?", "how does water boil up there", "What is pi?", "Name 7 seas", "Rain falls here. The cat sat on a mat. The dog ran off to town now with nothing else in its mouth but a stick of old wood and some very wet leaves"]
    texts = [tom.replace("Tom", "Sam"), "x. " + tom.replace("Tom buys", "Sam buys").replace("5", "6"), "Question - What is the largest prime below?", '"so" what is the largest prime below', "He said. How does Water boil up there", "so what is pi", "what is e", "Name 8 seas", "we name 7 seas", items[5].replace("The dog", "That dog"), None, ""]
    bench, d = spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(d, bench).collect()}
    assert got == {(0, 0): "reparameterised", (2, 1): "exact", (3, 1): "exact", (4, 2): "exact", (5, 3): "exact", (8, 4): "exact", (9, 5): "exact"}


# 3
def test_licenses(spark):
    ready = licenses.compiled(licenses.TEMPLATES)
    texts, want = [None, "", prose(50), prose(3)], set()
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        for lead in (0, 1, 7, 40):
            want.add((len(texts), i, lead, len(ready[i].words)))
            texts.append(" ".join([*prose(lead).split(), *text.upper().split(), *prose(R.randint(0, 30)).split()]))
    long = licenses.TEMPLATES[1][1].split()
    long[3] = "changed"
    texts.append(" ".join(long))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("license", F.lit("x"))
    got = {(r.doc_id, r.template, r.start, r.n_words) for r in licenses.scan_licenses(d).collect()}
    assert want <= got and any(g[0] == len(texts) - 1 for g in got)
    assert {g[0] for g in got} == {w[0] for w in want} | {len(texts) - 1}
    assert licenses.scan_licenses(d.where("false")).collect() == []
    for t in ready:
        n, rows = t.bands()
        s = len(t.shingles)
        j = 0.8 * s / (t.width + 0.2 * s)
        assert 1 - (1 - j**rows) ** n >= licenses.PROBABILITY


# 4
def test_language_identification(spark):
    make = {"xx": ["abra", "kadab", "brak", "adab"], "yy": ["wemo", "lowi", "miwo", "olim"]}
    word = lambda lang: "".join(R.choice(make[lang]) for _ in range(R.randint(1, 2)))
    data = [(i, " ".join(word(lang) for _ in range(R.randint(5, 90))), lang) for i, lang in enumerate(["xx", "yy"] * 150)]
    extra = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 --- 5", None), (1003, data[0][1] * 50, None), (None, data[1][1], "yy")]
    d = spark.createDataFrame(data + extra, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.fit(d)
    got = {r.doc_id: r for r in langid.identify(d, model).collect()}
    for i, _, lang in data:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1
    held = [i for i, _, _ in data if got[i].held_out]
    assert sum(got[i].lang_pred == data[i][2] for i in held) / len(held) > 0.95
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "xx", "yy"] and got[None].held_out is False
    switched = langid.label_words(" ".join([word("xx") for _ in range(6)] + [word("yy") for _ in range(6)]), model)
    assert [x[1] for x in switched] == ["xx"] * 6 + ["yy"] * 6
    assert langid.identify(d.where("false"), model).collect() == []
    untrained = langid.fit(d.where("false"))
    assert {r.lang_pred for r in langid.identify(d.limit(5), untrained).collect()} == {"und"}


def test_language_of_text_without_spaces(spark):
    """A title of one language before a long run of another does not decide; words of all lengths keep their place."""
    make = {"xx": "abcdefg", "yy": "日本語文字列処理言"}
    run = lambda lang, n: "".join(R.choice(make[lang]) for _ in range(n))
    data = [(i, " ".join(run(lang, R.choice([5, 60])) for _ in range(30)), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    mixed = [(1000, run("xx", 45) + run("yy", 900), None), (1001, run("yy", 45) + run("xx", 900), None)]
    d = spark.createDataFrame(data + mixed, "doc_id long, text string, lang string")
    model = langid.fit(d)
    got = {r.doc_id: r for r in langid.identify(d, model).collect()}
    assert [got[i].lang_pred for i in (1000, 1001)] == ["yy", "xx"] and got[1000].score > 0.8
    assert [x[1] for x in langid.label_words(run("xx", 99) + " 12 " + run("yy", 7), model)] == ["xx", "und", "yy"]


def test_forward_backward_is_exact():
    rng, n, t = np.random.default_rng(3), 3, 4
    em, trans = rng.normal(size=(1, t, n)), rng.normal(size=(n, n))
    node, pair = langid.forward_backward(em, np.ones((1, t), bool), trans, pairs=True)
    total, want, wp = 0.0, np.zeros((t, n)), np.zeros((n, n))
    for path in np.ndindex(*[n] * t):
        w = np.exp(sum(em[0, i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        for i, y in enumerate(path):
            want[i, y] += w
        for a, b in zip(path, path[1:], strict=False):
            wp[a, b] += w
    assert np.allclose(node[0], want / total) and np.allclose(pair, wp / total)


# 5
def test_warc(spark):
    pages = [(i, f"http://h/{i % 4}", h) for i, h in enumerate(["<p>a</p>", "<p>a</p>", None, "", "<p>é\r\n\r\nx</p>", "<p>a</p>", "y" * 300000, "y" * 300000, "z" * 5000])] + [(11, None, "u"), (-5, "http://x\r\ny", "<p>a</p>"), (11, "again", "u"), (None, "n", "u")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("shard", F.lit(1)).repartition(3)
    folder = scratch(spark, "warc-test")
    manifest = warc.write(d, folder, roll_bytes=4000, shard_bytes=100000)
    names = [r.name for r in manifest.collect()]
    assert len(names) > 2 and sum(r.n_records for r in manifest.collect()) == 12
    got = warc.read(spark, folder, payloads=True).collect()
    top = defaultdict(lambda: -(10**9))
    for i, _, h in pages:
        if i is not None:
            top[h or ""] = max(top[h or ""], i)
    assert Counter(r.page_id for r in got) == Counter(i for i, _, _ in pages if i is not None)
    for r in got:
        h = next(h or "" for i, _, h in pages if i == r.page_id)
        assert r.payload_bytes == len(h.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if top[h] == r.page_id else ("revisit", top[h]))
        assert r.record_type == "revisit" or r.payload == h.encode()
    again = scratch(spark, "warc-test")
    m2 = warc.write(d.repartition(7), again, roll_bytes=4000, shard_bytes=100000)
    assert sorted((r.name, r.sha256) for r in manifest.collect()) == sorted((r.name, r.sha256) for r in m2.collect())
    assert warc.read(spark, folder).where("record_type = 'response'").count() == 7
    empty = scratch(spark, "warc-test")
    warc.write(d.where("false"), empty)
    assert warc.read(spark, empty).collect() == []
    only = scratch(spark, "warc-test")
    warc.write(d, only, min_bytes=6000)
    assert warc.read(spark, only).where("record_type = 'revisit'").select("page_id").collect()[0][0] == 6


# 6
def test_chat(spark):
    odd = ["", "<|im_end|><|im_start|>assistant ok", "\\<|", "a\nb", "\\n", "<", "|>", "\\\\", "𝄞é"]
    data = [(c, t, role, R.choice(odd)) for c in range(40) for t, role in enumerate(R.choice([["system", "user", "assistant"], ["user", "assistant"] * 3, ["user"], ["assistant", "a\nb", "<|x"]]))]
    data += [(99, 0, "user", None), (99, None, None, "first"), (99, 1, "assistant", None), (98, 1, "assistant", "b"), (98, 1, "assistant", "a"), (None, 0, "assistant", "n")]
    d = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0)).repartition(4)
    made = chat.format_conversations(d)
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    by = defaultdict(list)
    for c, t, role, x in data:
        by[c].append((t is not None, t or 0, role or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss)) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    text = {r.conv_id: r.formatted for r in made.collect()}
    for e in chat.examples(made).collect():
        turns = chat.parse(e.context + e.target)
        assert text[e.conv_id].startswith(e.context + e.target) and turns[-1][0] == "assistant"
        assert chat.unescape(e.target[e.loss_start : e.loss_end]) == turns[-1][1]
    assert chat.digests(chat.format_conversations(d.where("false"))).collect() == []
    folder = scratch(spark, "chat-test")
    chat.write(made, folder)
    assert sorted(map(str, chat.digests(chat.read(spark, folder)).collect())) == sorted(map(str, got.values()))


def test_long_conversation(spark):
    """Thousands of turns: examples are kept by reference, so the stored text grows with the turns alone."""
    n = 3000
    d = spark.createDataFrame([(5, i, "assistant" if i % 2 else "user", "t%d" % i) for i in range(n)], "conv_id long, turn long, role string, text string").repartition(4)
    r = chat.digests(chat.format_conversations(d)).collect()
    assert len(r) == 1 and r[0].n_turns == n and r[0].loss_sha256 == hashlib.sha256("".join("t%d" % i for i in range(1, n, 2)).encode()).hexdigest()
    assert r[0].formatted_chars < n * 50


# 7
def brute_quality(t):
    w, t = [x.decode() for x in words(t)], t or ""
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    covered = {p + j for v in seen.values() if len(v) > 1 for p in v for j in range(8)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_quality(spark, docs, rows, none):
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate([" ".join(R.choice("ab") for _ in range(R.randint(0, 60))) for _ in range(60)] + ["# $ % " * 40, "1 2 3 " * 3 + prose(30), "x" * 50 + " " + " ".join(["y" * 40] * 30)])], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(more)
    for r in quality.quality(d.withColumn("base_failed", F.lit(1)).withColumn("t", F.col("text")).drop("kept")).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(r.t)
        assert not (r.base_failed and r.kept)
    verdicts = {(r.doc_id, r.text): r.kept for r in quality.quality(d).collect()}
    assert verdicts == {(r.doc_id, r.text): r.kept for r in quality.judge(d).collect()}
    assert any(verdicts.values()) and not all(verdicts.values())
    assert quality.quality(none).collect() == [] and quality.judge(none).collect() == []
    held = quality.sampled(d, "text", 50).select("t", quality.words(F.col("t")).alias("w")).cache()
    n, v = held.count(), quality.view(F.col("t"), F.col("w"))
    order = quality.order_rules(held, quality.RULES + quality.BASE_RULES, v)
    gain = [(x[2] + 0.5 / n) / x[1] for x in order]
    assert 20 < n <= 50 and gain == sorted(gain, reverse=True) and {x[0].name for x in order} == {x.name for x in quality.RULES + quality.BASE_RULES}
    # a rule that does far more than the others costs more
    slow = quality.Rule("slow", lambda v: F.levenshtein(F.lpad(F.coalesce(v.text, F.lit("")), 1500, "x"), F.lit("ab" * 500)) < 0)
    cost = {x[0].name: x[1] for x in quality.order_rules(held, [slow, quality.RULES[0]], v)}
    assert cost["slow"] > cost["symbols"]


# 8 and 10
@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(tokens.default_vocabulary(), cache_units=500, chunk=3000)


ODD = ["it's I'M don't 12,345. ... İstanbul Σίσυφος ΟΔΟΣ, é é́ a\xa0b c\x1fd <|endoftext|> x<|endoftext|>y ǅ ﬁ, 한국어. 한 ,. a,. b.,", "\x00 \x01a", "'s 't", "ſ ß ẞ. Ⅷ, ª", "2×3÷4 É×É,, ÀÇ.Ñ ŽĲŐ,ȿ ŉȺȾ. İI H̱ É <|ENDOFTEXT|> a<|b |<| x¡y ½ ²a", "\x1c\x1d a\x85b c\u2028d e\u3000f ## ##a1b22,,.3 %%%", "ab12CD,.EF", " "]


def test_encoder_equals_the_library(encoder):
    texts = [t or "" for t in TEXTS] + ODD + [prose(R.randint(1, 50)) + R.choice([".", ",", "!", "é"]) for _ in range(100)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t.encode()).tolist() for t in texts] == want
    for size in (1, 7, len(texts)):
        got = [x.tolist() for i in range(0, len(texts), size) for x in encoder.encode_column(pa.array([None if t == "" else t for t in texts[i : i + size]], pa.string()), 2)]
        assert got == [[*x, 2] for x in want]
    assert encoder.by_units and list(encoder.encode_column(pa.array([], pa.string()))) == []


def test_encoder_with_other_rules():
    """A vocabulary whose words are not independent gets whole texts."""
    import public_tokenizers

    other = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for t in TEXTS[:12]] + ODD
    assert not other.by_units
    assert [x.tolist() for x in other.encode_column(pa.array(texts, pa.string()))] == [e.ids for e in other.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("keys", [list(range(5000)), [2**63 - 1, -(2**63), 0, 1] * 50 + list(range(10**12, 10**12 + 900)), [7] * 100, [None, 3]])
def test_balanced_cuts(spark, keys):
    d = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    cuts = shards.balanced_cuts(d, "k", F.lit(10), 8)
    assert cuts == sorted(set(cuts)) and len(cuts) < 8
    size = Counter(shards.shard_of(cuts, k) for k in keys if k is not None)
    most = max(Counter(keys).values())
    assert max(size.values()) <= 2 * len(keys) / 8 + most


def test_packing(docs, rows, none, encoder):
    got = packing.pack(docs).collect()
    want = defaultdict(list)
    for k, t in rows:
        want[k].append(encoder.encode((t or "").encode(), 2).astype("<u4"))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
        ids = next(x for x in want[r.doc_id] if len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32)
        assert r.start + r.length <= len(ids)
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    total = sum(len(x) for v in want.values() for x in v)
    assert sum(r.length for r in got) == total and len(by) == -(-total // 4096)
    assert packing.pack(none).collect() == []
    assert all(len(r.ids) == 4 * r.length for r in packing.pack(docs, with_ids=True).collect())


def test_subset_sums():
    for _ in range(200):
        counts = {R.randint(1, 40): R.randint(1, 4) for _ in range(R.randint(1, 6))}
        room = R.randint(0, 90)
        got = packing.fill(room, counts)
        reach = {0}
        for k, n in counts.items():
            reach = {s + k * i for s in reach for i in range(n + 1)}
        assert sum(k * v for k, v in got.items()) == max(s for s in reach if s <= room) and all(v <= counts[k] for k, v in got.items())
    histogram = {R.randint(1, 4096): R.randint(1, 30) for _ in range(500)}
    plan = packing.windows(histogram)
    total = Counter()
    for times, bins in plan:
        assert sum(k * v for k, v in bins.items()) <= 4096
        for k, v in bins.items():
            total[k] += v * times
    assert total == Counter(histogram)


def test_token_files(spark, docs, rows, none, encoder):
    folder = scratch(spark, "ids-test")
    manifest = idfiles.write(docs, folder, shard_bytes=20000).collect()
    got = sorted(idfiles.read(spark, folder).collect(), key=lambda r: r.start)
    assert len(manifest) > 1 and len(got) == len(rows)
    want = sorted((k is not None, k or 0, len(x), zlib.crc32(x.tobytes())) for k, t in rows for x in [encoder.encode((t or "").encode(), 2).astype("<u4")])
    at = 0
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) == w and r.start == at
        at += r.n_tokens
    name = manifest[0]["name"]
    shard = idfiles.Shard(folder, name, idfiles.load(folder, f"dictionary-{manifest[0]['dictionary']}.zdict"))
    assert shard.ids(shard.n - 1)[-1] == 2
    shard.close()
    with pytest.raises(ValueError, match="dictionary"):
        idfiles.Shard(folder, name, b"other")
    empty = scratch(spark, "ids-test")
    idfiles.write(none, empty)
    assert idfiles.read(spark, empty).collect() == []


# 9
def test_substring(docs, rows, none):
    seen = {}
    for k, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for i in range(len(w) - 12):
            seen.setdefault(tuple(w[i : i + 13]), k)
    got = substring.digests(docs).collect()
    assert len(got) == len(rows)
    left = {}
    for k, t in rows:
        w = words(t)
        gone = {i + j for i in range(len(w) - 12) if k is not None and seen[tuple(w[i : i + 13])] < k for j in range(13)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        left[k, t] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter((k, *left[k, t][:3]) for k, t in rows)
    cut = substring.remove_duplicates(docs)
    assert cut.columns == docs.columns
    want = {(k, left[k, t][3] if left[k, t][1] else t) for k, t in rows}
    assert {(r.doc_id, r.text) for r in cut.collect()} == want
    assert substring.digests(none).collect() == [] and substring.remove_duplicates(none).collect() == []
    f = substring.factors(docs).collect()
    text = {k: words(t) for k, t in rows if k is not None}
    for r in f:
        assert r.ref < r.id and text[r.id][r.start : r.start + r.length] == text[r.ref][r.ref_start : r.ref_start + r.length] and r.length >= 13


def test_factors_are_greedy_and_verified():
    """A long copy stays one factor though the index names another reference for its middle; equal hashes of other words give none."""
    ref = [b"r%d" % i for i in range(60)]
    doc = [b"a", b"b", *ref[5:50], b"z", *ref[20:40], b"y"] + [b"q%d" % i for i in range(20)]
    # the windows of words 20 to 35 of the reference stand in document 1 first, at 100
    place = lambda i: (1, 100 + i - 20) if 20 <= i <= 22 else (3, i)
    found = [(2 + i, *place(5 + i)) for i in range(45 - 12)] + [(48 + i, *place(20 + i)) for i in range(8)] + [(69, 9, 0), (70, 9, 1)]
    places, r, r_at = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
    first = ref[20:35] + [b"other"] * 30
    source = {1: [b"x"] * 100 + first, 3: ref, 9: [b"w%d" % i for i in range(30)]}
    asked = substring.stretches(places, r, r_at, 13)
    fetched = {}
    for at, k, k_at, n in asked:
        fetched.setdefault(at, []).append(source[k][k_at : k_at + n])
    got = substring.parse(doc, places, r, r_at, fetched, 13)
    assert got == [(2, 45, 3, 5), (48, 15, 1, 100), (51, 17, 3, 23)]
    # the index alone would take the words after 69 as well
    assert substring.spans([(int(x), 13) for x in places], len(doc)).sum() > substring.spans(got, len(doc)).sum() == 65
    assert substring.parse(doc[:30], places, r, r_at, fetched, 13) == [(2, 28, 3, 5)] and substring.parse([], places[:0], r[:0], r_at[:0], {}, 13) == []


def test_factors_do_not_depend_on_the_partitions(spark):
    passage = prose(40)
    d = spark.createDataFrame([(i, prose(20) + " " + passage + " " + prose(5) + " " + passage) for i in range(6)], "doc_id long, text string")
    assert sorted(substring.factors(d.repartition(5)).collect()) == sorted(substring.factors(d.coalesce(1)).collect())


def test_minimizers_meet_every_window():
    w = np.array([R.randrange(50) for _ in range(500)], dtype=np.uint64)
    g = texthash.gram_hashes(texthash.mix(w), 5)
    at = set(texthash.minimizers(g, 9).tolist())
    assert all(at & set(range(i, i + 9)) for i in range(len(g) - 8))
    assert texthash.word_hashes(b"  a b\n\x0ba ").tolist()[0] == texthash.word_hashes(b"a").tolist()[0] and len(texthash.word_hashes(b"")) == 0 == len(texthash.word_hashes(b" \t"))


def test_hot_keys_go_another_way(spark, monkeypatch):
    from caravel.llm import common

    monkeypatch.setattr(common, "HOT_SAMPLE", 1)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("long").alias("k"))
    got = common.with_aggregates(df, ["k"], [F.min("id").alias("lo"), F.count("*").alias("n")], "id")
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    want = df.join(df.groupBy("k").agg(F.min("id").alias("lo"), F.count("*").alias("n")), "k")
    assert sorted(map(tuple, got.select("id", "k", "lo", "n").collect())) == sorted(map(tuple, want.select("id", "k", "lo", "n").collect()))
