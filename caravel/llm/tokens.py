r"""Token ids by the tokenizers library, which sees each distinct unit of text once while it stays in a bounded cache.

A unit is what the vocabulary's pre-tokenizer cuts from a word (``[^\x20\x09-\x0D]+``): a run of letters, a digit, or a
run of other characters.  Words of ASCII and of the Latin letters from U+00C0 to U+023F are cut into units here, by
columns of bytes; words with anything else in them (other scripts, combining marks, control characters, apostrophes,
the added tokens' ``<|``) are a unit each, as they stand.  No pre-token reaches across such a border, so a text's ids are
those of its units one after another.  A vocabulary with another normaliser or pre-tokenizer than that of RULES gets
whole texts encoded by the library.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import threading
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = 2
#: Distinct units that one Python worker remembers; beyond it the cache starts anew.
CACHE_UNITS = 300_000
#: Seconds without a text after which a worker gives its encoder back.
IDLE = 8.0
_held: dict[str, WordEncoder] = {}
#: Bytes of text that are encoded at once; longer texts are cut at white space.
CHUNK = 2 << 20
# The normaliser and the pre-tokenizer's pattern under which units are independent, and the end-of-word mark.
RULES = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "suffix": "</w>",
}
#: Classes of bytes: letters, digits, other printable ASCII, and those whose words stay whole.
LETTER, DIGIT, OTHER, WHOLE = 1, 2, 3, 4
_CLASS = np.full(256, WHOLE, dtype=np.uint8)
_CLASS[33:127] = OTHER
_CLASS[ord("'")] = WHOLE
for _a, _b in ((65, 91), (97, 123), (0x80, 0xC0), (0xC3, 0xC9)):  # A-Z, a-z, later bytes, first bytes of U+00C0 to U+023F
    _CLASS[_a:_b] = LETTER
_CLASS[48:58] = DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: How a byte-level pre-tokenizer shows bytes to the model: bytes without a visible Latin-1 character as those from U+0100 on.
_HIDDEN = [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x)]
_VISIBLE = {x: 256 + i for i, x in enumerate(_HIDDEN)}
_GAP = re.compile(rb"[ \t-\r]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def units(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(units, units a word, which units are whole words to be left as they are) of a binary array of words."""
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    a = np.frombuffer(words.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    kind = _CLASS[a]
    # the two signs among the letters, the letter that becomes two characters in lower case, and the added tokens' mark
    for first, second in ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (ord("<"), ord("|"))):
        kind[1:][(a[1:] == second) & (a[:-1] == first)] = WHOLE
    # a character's later bytes are of its first byte's class, so a change of class is never within one
    begins = np.ones(len(a) + 1, dtype=bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    begins[off[:-1][off[:-1] < len(a)]] = True
    odd = np.flatnonzero(kind == WHOLE)
    if len(odd):
        whole = np.unique(np.searchsorted(off, odd, side="right") - 1)
        size = off[whole + 1] - off[whole]
        inside = np.repeat(off[whole] - np.cumsum(size) + size, size) + np.arange(size.sum())
        begins[inside] = False
        begins[off[whole]] = True
        small = _LOWER[a]
        small[inside] = a[inside]
    else:
        whole, small = np.zeros(0, np.int64), _LOWER[a]
    starts = np.flatnonzero(begins)  # the end of the bytes is the last
    before = np.searchsorted(starts, off)
    left = np.zeros(len(starts) - 1, dtype=bool)
    left[before[whole]] = True
    return _binary(starts, small), np.diff(before), left


class WordEncoder:
    """Texts -> uint32 ids, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, vocabulary: str, cache_units: int = CACHE_UNITS, chunk: int = CHUNK):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.chunk = Tokenizer.from_file(vocabulary), cache_units, chunk
        self.by_units = self._independent()
        self.at = time.monotonic()
        self.reset()

    def _independent(self) -> bool:
        """Whether the vocabulary's rules are those under which units are encoded on their own."""
        rules = json.loads(self.tokenizer.to_str())
        norm, pre, model = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}, rules["model"]
        cuts = (pre.get("pretokenizers") or [{}])[0]
        added = [t["content"] for t in rules["added_tokens"]]
        return (
            norm.get("normalizers") == RULES["normalizers"]
            and [x.get("type") for x in pre.get("pretokenizers") or []] == ["Split", "ByteLevel"]
            and (cuts.get("pattern"), cuts.get("behavior"), cuts.get("invert")) == ({"Regex": RULES["pattern"]}, "Removed", True)
            and not pre["pretokenizers"][1].get("add_prefix_space")
            and not pre["pretokenizers"][1].get("use_regex")
            and model.get("end_of_word_suffix") == RULES["suffix"]
            and not model.get("dropout")
            and all(t.startswith("<|") and not _GAP.search(t.encode()) for t in added)
        )

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.offset, self.used, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0, 0

    @property
    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _keep(self, new: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) + 1 > len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros_like(self.offset)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.offset[self.n + 1 : self.n + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.index.update(zip(new, range(self.n, self.n + len(sizes)), strict=True))
        self.used += len(ids)
        self.n += len(sizes)

    def _learn(self, cut: list[bytes], whole: list[bytes]) -> None:
        """Units cut here are what the pre-tokenizer gives its model; words left whole take the library's way."""
        model, part, ids, sizes = self.tokenizer.model, 1 << 16, [], []
        for i in range(0, len(cut), part):
            for unit in cut[i : i + part]:
                found = [t.id for t in model.tokenize(unit.decode() if unit.isascii() else unit.decode().lower().encode().decode("latin-1").translate(_VISIBLE))]
                ids += found
                sizes.append(len(found))
            self._keep(cut[i : i + part], np.array(ids, dtype=np.uint32), np.array(sizes, dtype=np.int64))
            ids, sizes = [], []
        for i in range(0, len(whole), part):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in whole[i : i + part]], add_special_tokens=False)]
            self._keep(whole[i : i + part], np.array([x for ids in found for x in ids], dtype=np.uint32), np.array(list(map(len, found)), dtype=np.int64))

    def _places(self, distinct: pa.Array, whole: np.ndarray) -> np.ndarray:
        """Where each distinct unit stands in the cache, after the missing ones were learnt."""
        keys = distinct.to_numpy(zero_copy_only=False).tolist()
        at = list(map(self.index.get, keys))
        missing = [i for i, x in enumerate(at) if x is None]
        if missing:
            if len(self.index) + len(missing) > self.limit and self.index:
                self.reset()
                missing = range(len(keys))
            left = whole.tolist()
            self._learn([keys[i] for i in missing if not left[i]], [keys[i] for i in missing if left[i]])
            for i in missing:
                at[i] = self.index[keys[i]]
        return np.array(at, dtype=np.int64)

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a string array without nulls, and where each text's begin (and the last's end)."""
        self.at = time.monotonic()
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().cast(pa.binary()).dictionary_encode()
        cut, per_word, left = units(words.dictionary)
        cut = cut.dictionary_encode()
        which = cut.indices.to_numpy()
        whole = np.zeros(len(cut.dictionary), dtype=bool)
        whole[which[left]] = True
        at = self._places(cut.dictionary, whole)[which]
        # distinct words' ids, then all words'
        flat, size = gather(self.flat, self.offset[at], self.offset[at + 1] - self.offset[at])
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_word)])]
        w = words.indices.to_numpy()
        ids, size = gather(flat, ends[:-1][w], np.diff(ends)[w])
        off = split.offsets.to_numpy()
        return ids, np.concatenate([[0], np.cumsum(size)])[off - off[0]]

    def _long(self, data: bytes) -> np.ndarray:
        out, at = [], 0
        while at < len(data):
            gap = _GAP.search(data, at + self.chunk)
            stop = gap.start() if gap else len(data)
            out.append(self._ids(pa.array([data[at:stop]], pa.binary()).cast(pa.string()))[0])
            at = stop
        return np.concatenate(out)

    def encode_column(self, texts: pa.Array, end: int | None = None) -> Iterator[np.ndarray]:
        """The ids of each text of a string array, with ``end`` after it; nulls are empty."""
        self.at = time.monotonic()
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = pc.fill_null(texts.cast(pa.string()), "")
        tail, sizes = np.array([] if end is None else [end], dtype=np.uint32), pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        stops, i = np.cumsum(sizes), 0
        while i < len(sizes):
            done = stops[i] - sizes[i]
            j = max(i + 1, int(np.searchsorted(stops, done + self.chunk, side="right")))
            if not self.by_units:
                for e in self.tokenizer.encode_batch_fast(texts[i:j].to_pylist(), add_special_tokens=False):
                    yield np.concatenate([np.array(e.ids, dtype=np.uint32), tail])
            elif sizes[i] > self.chunk:
                yield np.concatenate([self._long(texts[i].as_py().encode()), tail])
            else:
                ids, bounds = self._ids(texts[i:j])
                if len(tail):
                    ids, bounds = np.insert(ids, bounds[1:], tail[0]), bounds + np.arange(len(bounds))
                for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                    yield ids[a:b]
            i = j

    def encode(self, data: bytes, end: int | None = None) -> np.ndarray:
        return next(self.encode_column(pa.array([data], pa.binary()).cast(pa.string()), end))


def gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[first : first + size] one after another, and their sizes."""
    stops = np.cumsum(size)
    return flat[np.repeat(first - stops + size, size) + np.arange(int(stops[-1]) if len(stops) else 0)], size


def _give_back(vocabulary: str) -> None:
    """Drops the encoder of a worker once it was idle for IDLE seconds: such workers live on, and count as the executor's memory."""
    while time.monotonic() - _held[vocabulary].at < IDLE:
        time.sleep(IDLE / 4)
    del _held[vocabulary]
    gc.collect()
    getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def encoder(vocabulary: str) -> WordEncoder:
    """One encoder a Python worker, kept between its tasks as long as these follow one another."""
    held = _held.get(vocabulary)
    if held is None:
        held = _held[vocabulary] = WordEncoder(vocabulary)
        threading.Thread(target=_give_back, args=(vocabulary,), daemon=True).start()
    held.at = time.monotonic()
    return held
