"""Benchmark decontamination by SimHash over item-sized windows.

A text is read through windows as long (in words) as each benchmark item.
Windows and items get a 64-bit SimHash of their weighted word shingles; a
multi-index (four blocks of sixteen bits) finds every item within ``RADIUS`` bits
of a window: if two fingerprints differ in at most 4 * (t + 1) - 1 bits, some
block differs in at most t.  Every item stands in a block's posting list under
all values up to two bits away, and a window asks for its value and those the
other t - 2 bits away, so about 4 % of chance pairs become candidates.  They
must lie within the radius and are then verified by the exact weighted Jaccard
similarity of their shingles (weight: occurrences).  The radius keeps 98 % or more
of the pairs at similarity 0.8, and all from 0.9 on (measured in the tests).

A window of a shingles reaches similarity s with an item of b only if they share
s * (a + b) / (1 + s), so windows are only laid where so many shingles of the
benchmark occur; all others are below s with every item.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
MAX_ITEM_BYTES = 16 << 20       # of benchmark text broadcast at once
BLOCKS, BLOCK_BITS = 4, 16
STORED = 2                      # bits of difference that the posting lists hold

# number of set bits of every byte
POP8 = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Mixed 64-bit hash of every run of k words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for j in range(k):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits((sums > 0).astype(np.uint8), axis=1)


def masks(bits: int) -> np.ndarray:
    """All block values with at most ``bits`` bits set."""
    return np.array([sum(1 << i for i in some) for n in range(bits + 1)
                     for some in itertools.combinations(range(BLOCK_BITS), n)], dtype=np.uint16)


class Postings:
    """Fingerprints (rows of eight bytes) by the values of their blocks."""

    def __init__(self, fps: np.ndarray, radius: int):
        near = radius // BLOCKS                 # some block differs in at most so many bits
        stored = masks(min(STORED, near))
        self.fps, self.radius, self.probes = fps, radius, masks(near - min(STORED, near))
        self.lists = []
        for b in range(BLOCKS):
            value = (self._blocks(fps)[:, b, None] ^ stored[None]).ravel()
            order = np.argsort(value, kind="stable")
            self.lists.append((value[order], (order // len(stored)).astype(np.int32)))

    @staticmethod
    def _blocks(fps: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(fps).view(">u2").astype(np.uint16).reshape(-1, BLOCKS)

    def candidates(self, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``got``, item), each pair once: all pairs with a block near enough."""
        pairs = []
        n = len(self.fps)
        for b, own in enumerate(self._blocks(got).T):
            value, item = self.lists[b]
            ask = (own[:, None] ^ self.probes[None]).ravel()
            low, high = np.searchsorted(value, ask, "left"), np.searchsorted(value, ask, "right")
            size = high - low
            at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
            row = np.repeat(np.arange(len(ask)) // len(self.probes), size)
            pairs.append(np.unique(row * n + item[at]))
        return np.divmod(np.unique(np.concatenate(pairs)), n)

    def within(self, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, item = self.candidates(got)
        near = POP8[got[row] ^ self.fps[item]].sum(axis=1, dtype=np.int64) <= self.radius
        return row[near], item[near]


class Index:
    """Items grouped by their number of words; items without a word match nothing."""

    def __init__(self, items: list[tuple[object, str | None]], shingle: int = SHINGLE,
                 similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity, self.radius = similarity, radius
        self.postings: dict[int, Postings] = {}     # made where they are first asked
        groups = defaultdict(list)
        for key, text in items:
            w = tokens(text)
            if w:
                groups[len(w)].append((key, w))
        self.groups, known = [], defaultdict(list)
        for n, members in sorted(groups.items()):
            k = min(shingle, n)
            sh = [shingle_hashes(word_hashes(w), k) for _, w in members]
            known[k] += sh
            fps = np.concatenate([_pack(2 * _bits(x).sum(0, dtype=np.int32)[None] - len(x)) for x in sh])
            self.groups.append((n, k, fps, [m[0] for m in members],
                                [Counter(zip(*[w[j:] for j in range(k)])) for _, w in members]))
        self.known = {k: np.unique(np.concatenate(v)) for k, v in known.items()}
        self.maybe = {}
        for k, v in self.known.items():
            m = np.zeros(1 << 20, bool)
            m[(v >> np.uint64(44)).astype(np.int64)] = True
            self.maybe[k] = m

    def _hits(self, k: int, sh: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.maybe[k][(sh >> np.uint64(44)).astype(np.int64)])
        v = self.known[k]
        pos = np.minimum(np.searchsorted(v, sh[at]), len(v) - 1)
        return at[v[pos] == sh[at]]

    def scan(self, text: str | None) -> list[tuple[object, float, int, int]]:
        """(item, similarity, first word, words) of the best window per item."""
        words = tokens(text)
        if not words:
            return []
        h = word_hashes(words)
        best: dict = {}
        cache = {}
        for n, k, fps, keys, counts in self.groups:
            if k not in cache:
                sh = shingle_hashes(h, k)
                hits = self._hits(k, sh) if len(sh) else np.zeros(0, np.int64)
                cache[k] = sh, hits
            sh, hits = cache[k]
            if not len(hits):
                continue
            m = min(n - k + 1, len(sh))         # shingles of a window; short texts are one window
            starts = self._starts(hits, m, n - k + 1, len(sh) - m)
            if not len(starts):
                continue
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 4 * m) + 1):
                self._windows(words, sh, run, m, n, k, fps, keys, counts, best)
        return [(key, *v) for key, v in best.items()]

    def _starts(self, hits: np.ndarray, m: int, full: int, last: int) -> np.ndarray:
        """Starts of the windows of m shingles with enough hits to be like an item of ``full``."""
        need = int(np.ceil(self.similarity * (m + full) / (1 + self.similarity) - 1e-9))
        if len(hits) < need:
            return np.zeros(0, np.int64)
        # of ``need`` hits in a row within m places, the windows that hold them all
        first, end = hits[:len(hits) - need + 1], hits[need - 1:]
        ok = end - first < m
        low, high = np.maximum(end[ok] - m + 1, 0), np.minimum(first[ok], last)
        size = np.maximum(high - low + 1, 0)
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.unique(at)

    def _windows(self, words, sh, run, m, n, k, fps, keys, counts, best):
        if n not in self.postings:
            self.postings[n] = Postings(fps, self.radius)
        for i in range(0, len(run), 1024):      # bounded memory
            part = run[i:i + 1024]
            base = int(part[0])
            bits = _bits(sh[base:int(part[-1]) + m])
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
            got = _pack(2 * (sums[part - base + m] - sums[part - base]) - m)
            for p, q in zip(*(x.tolist() for x in self.postings[n].within(got))):
                p = int(part[p])
                win = words[p:p + m + k - 1]
                mine = Counter(zip(*[win[j:] for j in range(k)]))
                both = sum((mine & counts[q]).values())
                sim = both / (sum(mine.values()) + sum(counts[q].values()) - both)
                old = best.get(keys[q])
                if sim >= self.similarity and (old is None or sim > old[0] or (sim == old[0] and p < old[1])):
                    best[keys[q]] = (sim, p, len(win))


def item_slices(items: DataFrame, id_col: str, text_col: str, most: int = MAX_ITEM_BYTES) -> list[DataFrame]:
    """The items in parts of about ``most`` bytes of text, by a hash of the id:
    one pass over the documents each.  A benchmark of usual size is one part."""
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, -(-size // most))
    return [items.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(n)) == i) for i in range(n)]


def _indexes(docs, items, item_id, text_col, **kw):
    sc = docs.sparkSession.sparkContext
    for part in item_slices(items, item_id, text_col):
        # bounded by MAX_ITEM_BYTES
        yield sc.broadcast(Index([(r[0], r[1]) for r in part.select(item_id, text_col).collect()], **kw))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", **kw) -> DataFrame:
    """(id, item_id, similarity, first_word, n_words): the best window of every
    row and item at ``similarity`` or more; clean rows do not appear.

    NULL and empty texts and items match nothing; items of fewer than five words
    are compared as one shingle.  Repeated rows, and rows without an id, are rows
    of their own.  Of windows of equal similarity the first is returned.  Very
    long texts are read whole, their windows in bounded parts.
    """
    out = None
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"_id {id_type(docs, id_col)}, item {id_type(items, item_id)}, similarity double, first_word long, n_words long"
    for index in _indexes(docs, items, item_id, text_col, **kw):
        def run(batches, index=index):
            ix = index.value
            for b in batches:
                ids, at, found = b.column(0), [], []
                for i, t in enumerate(b.column(1).to_pylist()):
                    for x in ix.scan(t):
                        at.append(i)
                        found.append(x)
                if at:
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array(cols[0], ITEM), pa.array(cols[1], pa.float64()),
                         pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                        ["_id", "item", "similarity", "first_word", "n_words"])
        ITEM = pa.int64() if "int" in id_type(items, item_id) else pa.string()
        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"_id": id_col, "item": item_id})


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", **kw) -> DataFrame:
    """The rows without any match, all their columns unchanged."""
    def flag(shared):
        @F.pandas_udf("boolean")
        def leaks(t: pd.Series) -> pd.Series:
            return t.map(lambda x: bool(shared.value.scan(x))).astype(bool)
        return leaks(F.coalesce(F.col(text_col), F.lit("")))

    for index in _indexes(docs, items, item_id, text_col, **kw):
        docs = docs.filter(~flag(index))
    return docs
