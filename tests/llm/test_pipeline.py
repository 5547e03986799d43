"""The pipeline's stages against brute force, on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline as P
from caravel.llm import queries, tokens
from test_operators import brute_quality

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_stages(spark, tmp_path):
    docs, names = spark.read.parquet(f"{SF}/documents.parquet"), [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "packing"]
    at, frames = docs, {}
    for name, stage in P.STAGES:
        stage(spark, at, SF).write.parquet(str(tmp_path / name))
        at = frames[name] = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or at.columns == docs.columns
    text = {n: {r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for n, f in frames.items() if n != "packing"}
    source = {r.doc_id: r.text for r in docs.collect()}
    # what stays passes the base rules; what goes and passes them breaks one of the others
    assert all(not brute_quality(t)[5] for t in text["quality_rules"].values())
    lost = [t for k, t in source.items() if k not in text["quality_rules"] and not brute_quality(t)[5]]
    assert all(brute_quality(t)[2] > brute_quality(t)[0] or 2 * brute_quality(t)[3] > len([x for x in t.split("\n") if x.strip()]) for t in lost)
    # a document that goes has a near-duplicate, and one of two equal texts stays
    kept, seen = text["near_dedup"], text["quality_rules"]
    for k in set(seen) - set(kept):
        assert max(len(shingles(seen[k]) & shingles(o)) / len(shingles(seen[k]) | shingles(o)) for j, o in seen.items() if j != k) > 0.7
    assert len(set(kept.values())) == len(kept)
    # no thirteen words stand twice in different documents
    owner = {}
    for k in sorted(text["substring_dedup"]):
        w = kept[k].split()
        for i in range(len(w) - 12):
            owner.setdefault(tuple(w[i : i + 13]), k)
    for k, t in text["substring_dedup"].items():
        w = kept[k].split()
        gone = {i + j for i in range(len(w) - 12) if owner[tuple(w[i : i + 13])] < k for j in range(13)}
        assert t == (" ".join(x for i, x in enumerate(w) if i not in gone) if gone else kept[k])
    bench = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for t in text["decontamination"].values():
        w = " ".join(t.lower().split())
        assert not any(" ".join(b) in w for b in bench if len(b) > 5)
    enc = tokens.encoder(tokens.default_vocabulary())
    assert sum(r.length for r in frames["packing"].collect()) == sum(len(enc.encode((t or "").encode(), 2)) for t in text["decontamination"].values())


def test_run(spark):
    assert P.ORACLE_SQL is None and queries.QUERIES["pipeline"](spark, SF).count() > 0
