"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Words are lower-cased and lose punctuation at their ends.  A template of n words has shingles of five words (all its
words where it has fewer).  Texts are cut into windows of n + ceil(n / 2) words every ceil(n / 2) words, so that every
place of n words lies whole in some window.  A window that holds 0.8 of a template's shingles has a Jaccard similarity
with it of at least a known bound, from which bands and rows are set so that it collides with probability PROBABILITY
or more.  A candidate window is verified on the words themselves: at least 0.8 of the template's distinct shingles.

Results in unusual cases: null and empty texts match nothing; repeated rows and null ids are scanned row by row;
overlapping matches of a template are one; equal matches of different templates are each reported; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texthash import MULT, gram_hashes, word_hashes

SHINGLE, CONTAINED, PROBABILITY = 5, 0.8, 0.999
MAX_HASHES = 64

# Notices by which texts name their license.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("all-rights-reserved", "All rights reserved."),
]

_EDGE = re.compile(rb"[!-/:-@\[-`{-~]+(?=\s|$)|(?:(?<=\s)|^)[!-/:-@\[-`{-~]+")


def normal(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and ASCII punctuation at the ends of words gone."""
    return _EDGE.sub(b"", (text or "").encode("utf-8", "surrogatepass").lower())


def bands(similarity: float, probability: float = PROBABILITY, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): most rows whose bands, at most ``hashes`` hashes in all, collide with the probability at the similarity."""
    best = (max(1, math.ceil(math.log(1 - probability) / math.log1p(-similarity))) if similarity < 1 else 1, 1)
    for rows in range(2, 9):
        p = similarity**rows
        n = math.ceil(math.log(1 - probability) / math.log1p(-p)) if p < 1 else 1
        if n * rows <= hashes:
            best = (n, rows)
    return best


def _minhash(g: np.ndarray, i: int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3)) & 0xFFFFFFFFFFFFFFFF)
    x = (g ^ seed) * MULT[1]
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    words: tuple[bytes, ...]

    @property
    def k(self) -> int:
        return min(SHINGLE, len(self.words))

    @property
    def stride(self) -> int:
        return -(-len(self.words) // 2)

    @property
    def shingles(self) -> frozenset:
        return frozenset(self.words[i : i + self.k] for i in range(len(self.words) - self.k + 1))

    @property
    def width(self) -> int:
        """Shingles in a window."""
        return len(self.words) + self.stride - self.k + 1

    def bands(self) -> tuple[int, int]:
        s = len(self.shingles)
        return bands(CONTAINED * s / (self.width + (1 - CONTAINED) * s))


def compiled(templates: list[tuple[str, str]]) -> list[Template]:
    return [Template(name, i, tuple(normal(text).split())) for i, (name, text) in enumerate(templates) if normal(text).split()]


def _windows(t: Template, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) in shingles of all windows of texts whose words begin at ``first``."""
    m = np.maximum(sizes - t.k + 1, 0)
    n = np.where(m > 0, np.maximum(1, -(-(m - t.width + t.stride) // t.stride)), 0)
    text = np.repeat(np.arange(len(sizes)), n)
    starts = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * t.stride
    return text, starts, np.minimum(starts + t.width, first[text] + m[text])


def scan(texts: list[str | None], templates: list[Template]) -> list[list[tuple[str, int, int, int, float]]]:
    """For each text (license, template, start, n_words, containment) of its matches; start and n_words count words."""
    data = [normal(t) for t in texts]
    split = [d.split() for d in data]
    sizes = np.array([len(x) for x in split], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    wh, grams, mins, out = word_hashes(b" ".join(data)), {}, {}, [[] for _ in texts]
    for t in templates:
        if t.k not in grams:
            grams[t.k] = gram_hashes(wh, t.k)
        text, starts, ends = _windows(t, first, sizes)
        if not len(text):
            continue
        cuts = np.stack([starts, ends], axis=1).ravel()
        # only the last window can end with the last text, which reduceat takes as the end where no index follows
        cuts = cuts[:-1] if cuts[-1] == len(grams[t.k]) else cuts
        own = np.unique(gram_hashes(word_hashes(b" ".join(t.words)), t.k))
        n, rows = t.bands()
        hit = np.zeros(len(text), dtype=bool)
        for band in range(n):
            same = np.ones(len(text), dtype=bool)
            for i in range(band * rows, (band + 1) * rows):
                if (t.k, i) not in mins:
                    mins[t.k, i] = _minhash(grams[t.k], i)
                same &= np.minimum.reduceat(mins[t.k, i], cuts)[::2] == _minhash(own, i).min()
            hit |= same
        for d in np.unique(text[hit]).tolist():
            at = hit & (text == d)
            out[d] += _verified(t, split[d], starts[at] - first[d], ends[at] - first[d])
    return out


def _verified(t: Template, words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> list:
    goal, spans = t.shingles, []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        at = [i for i in range(a, b) if tuple(words[i : i + t.k]) in goal]
        share = len({tuple(words[i : i + t.k]) for i in at}) / len(goal)
        if share >= CONTAINED:
            first, last = at[0], at[-1] + t.k
            if spans and first < spans[-1][1]:
                spans[-1] = (min(spans[-1][0], first), max(spans[-1][1], last), max(spans[-1][2], share))
            else:
                spans.append((first, last, share))
    return [(t.license, t.number, a, b - a, share) for a, b, share in spans]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, license, template, start, n_words, containment): a row a match."""
    ready = compiled(templates)
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found = zip(part.column(0).to_pylist(), scan(part.column(1).to_pylist(), ready), strict=True)
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (key, *m), strict=True)) for key, ms in found for m in ms], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, license string, template int, start long, n_words long, containment double")
