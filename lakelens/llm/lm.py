"""Language-model scores from a log-frequency Bloom filter.

Counting.  Each block of texts sends its distinct word and bigram hashes, with
counts, to buckets by hash as packed arrays (one row per block and bucket).  A
bucket adds them up: exact word counts, and a segment of the Bloom filter.

The filter stores an n-gram of count c as the keys (n-gram, 1) ... (n-gram, q)
with q = 1 + floor(log_BASE c).  A reader probes j = 1, 2, ... until a key is
missing; the last hit gives the quantised count.  The model interpolates:
P(w|h) = (1 - LAMBDA) * P(w) + LAMBDA * c(h w) / c(h), with P(w) smoothed as in
the base score and all counts read from the filter.

The filter is broadcast, in slices of at most ``slice_bytes``: with one slice a
text is scored in one pass; with more, one slice at a time answers the probes
that belong to it, and the stored answers are put together per text.

Words are told apart by a 64-bit hash throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, id_type, staged

BASE = 2.0              # quantisation
LAMBDA = 0.5            # share of the bigram estimate
PROBES = 8              # hash functions per key
BITS_PER_KEY = 11.55    # PROBES / ln 2: about 0.4 % false positives
FOLDS = 10
BUCKET_BYTES = 16 << 20         # of text per counting bucket
SEND_BYTES = 2 << 20            # of packed arrays sent at once
SLICE_BYTES = 512 << 20         # of filter broadcast at once
BLOCK_BYTES = 1 << 20           # of text made tokens at once, or whose answers travel together
HEAD = 1 << 16          # words with count >= N / HEAD, at most HEAD of them
END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def tokens(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words (A-Z lower-cased), then the end token."""
    w = (text or b"").lower().split()
    out = np.empty(len(w) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
    out[-1] = END
    return out


_P = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[list(b" \t\n\r\x0b\x0c")] = False


def _rotl(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def _xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of data[start:start + size] for every word, all words of a length side by side."""
    out = np.empty(len(start), np.uint64)
    eights = np.concatenate([data, np.zeros(24 - len(data) % 8, np.uint8)]).view("<u8")

    def lane(at):
        """Eight bytes from each place, the first one lowest."""
        i, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        return (eights[i] >> shift) | np.where(shift > 0, eights[i + 1] << (np.uint64(64) - shift & np.uint64(63)), np.uint64(0))

    kind = np.minimum(size, 32).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    edge = np.searchsorted(kind[order], np.arange(34))
    for n in np.flatnonzero(np.diff(edge)).tolist():
        own = order[edge[n]:edge[n + 1]]
        at = start[own]
        if n == 32:         # as long or longer
            out[own] = np.fromiter((xxhash.xxh64_intdigest(data[a:a + k]) for a, k in zip(at.tolist(), size[own].tolist())),
                                   np.uint64, len(own))
            continue
        h = np.full(len(own), _P[4] + np.uint64(n), np.uint64)
        for _ in range(n // 8):
            h = _rotl(h ^ _rotl(lane(at) * _P[1], 31) * _P[0], 27) * _P[0] + _P[3]
            at = at + 8
        left = n % 8
        rest = lane(at) if left else None
        if left >= 4:
            h = _rotl(h ^ (rest & np.uint64(0xFFFFFFFF)) * _P[0], 23) * _P[1] + _P[2]
            rest = rest >> np.uint64(32)
            left -= 4
        for _ in range(left):
            h = _rotl(h ^ (rest & np.uint64(0xFF)) * _P[4], 11) * _P[0]
            rest = rest >> np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * _P[1]
        h = (h ^ (h >> np.uint64(29))) * _P[2]
        out[own] = h ^ (h >> np.uint64(32))
    return out


def token_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(``tokens`` of all the texts, first token of every text)."""
    texts = texts.fill_null(b"") if texts.null_count else texts
    off = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_binary(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off -= off[0]
    data = _LOWER[data]
    edge = np.ones(len(data) + 1, bool)         # places where a word cannot go on
    np.logical_not(_WORD[data], out=edge[:-1])
    word = ~edge[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    start = np.flatnonzero(word & (np.concatenate([[True], edge[:-2]]) | cut[:-1])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(word & (edge[1:] | cut[1:])) + 1
    count = np.diff(np.searchsorted(start, off))
    first = np.cumsum(count + 1) - count - 1
    out = np.full(len(start) + len(texts), END, np.uint64)
    out[np.arange(len(start)) + np.repeat(np.arange(len(texts)), count)] = _xxh64(data, start, end - start)
    return out, first


def bigrams(t: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of (previous token, token) for every token of some texts."""
    before = np.concatenate([[BEGIN], t[:-1]])
    before[first] = BEGIN
    before *= _GOLD
    before += t
    return _mix(before)


def unigram_key(t: np.ndarray) -> np.ndarray:
    return _mix(t ^ _GOLD)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _split(keys: np.ndarray, counts: np.ndarray, n: int):
    """(bucket, keys, counts) of sorted distinct keys."""
    b = _bucket(keys, n)
    order = np.argsort(b, kind="stable")
    edge = np.searchsorted(b[order], np.arange(n + 1))
    for i in np.flatnonzero(np.diff(edge)).tolist():
        at = order[edge[i]:edge[i + 1]]
        yield i, keys[at], counts[at]


def blobs(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    """The binary values of a column as arrays of ``kind``, not copied."""
    return [np.frombuffer(x.as_buffer(), kind) for c in column.chunks for x in c]


def packed(rows, fields: list[tuple]):
    """Record batches of the rows, each sent as soon as it holds SEND_BYTES."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], [n for n, _ in fields])
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes))
        if size >= SEND_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _total(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = np.concatenate(keys)
    order = np.argsort(k)
    k = k[order]
    n = np.concatenate(counts)[order]
    del order
    edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[edge], np.add.reduceat(n, edge, dtype=np.int64)


def quantise(c: np.ndarray) -> np.ndarray:
    """1 + floor(log_BASE c), exact at the powers."""
    q = np.floor(np.log(c) / np.log(BASE)).astype(np.int64)
    q += (BASE ** (q + 1) <= c).astype(np.int64) - (BASE ** q > c).astype(np.int64)
    return q + 1


def expected(q: np.ndarray) -> np.ndarray:
    """Mean count of a level (0: none)."""
    return np.where(q > 0, (BASE ** (q - 1) + np.maximum(BASE ** q - 1, BASE ** (q - 1))) / 2, 0.0)


_EXPECTED = expected(np.arange(256))


def _pair(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    a = _mix(keys + np.uint64(level * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
    return a, _mix(a ^ _GOLD) | np.uint64(1)


def _places(keys: np.ndarray, level: int, bits: np.ndarray):
    """The keys' bits, one probe after the other."""
    a, b = _pair(keys, level)
    for i in range(PROBES):
        yield (a + np.uint64(i) * b) % bits


def segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Bloom filter bits of the keys of one bucket."""
    q = quantise(counts)
    bits = np.uint64(max(64, int(np.ceil(q.sum() * BITS_PER_KEY / 8)) * 8))
    out = np.zeros(int(bits) // 8, np.uint8)
    for level in range(1, int(q.max(initial=0)) + 1):
        for p in _places(keys[q >= level], level, bits):
            np.bitwise_or.at(out, (p >> np.uint64(3)).astype(np.int64),
                             (np.uint64(1) << (p & np.uint64(7))).astype(np.uint8))
    return out.tobytes()


class Filter:
    """Segments of the buckets from ``first`` on, one after the other.  With
    ``size``, the bytes of each, ``segments`` may come as (place, bits) pairs of
    those that hold any."""

    def __init__(self, buckets: int, first: int, segments, size: np.ndarray | None = None):
        if size is None:
            size, segments = np.array([len(s) for s in segments], np.int64), enumerate(segments)
        self.buckets, self.first, self.last = buckets, first, first + len(size)
        self.start = (np.cumsum(size) - size).astype(np.uint64)
        self.bits = np.maximum(size, 1).astype(np.uint64) * np.uint64(8)
        self.size = size
        self.data = np.zeros(max(1, int(size.sum())), np.uint8)
        for i, s in segments:
            self.data[int(self.start[i]):int(self.start[i]) + len(s)] = np.frombuffer(s, np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Quantised count of each key; 0 also where another slice holds it."""
        out = np.zeros(len(keys), np.int64)
        b = _bucket(keys, self.buckets) - self.first
        live = np.flatnonzero((b >= 0) & (b < self.last - self.first))
        live = live[self.size[b[live]] > 0]
        b = b[live]
        # keys of a bucket side by side: one segment fits a cache, the whole filter does not
        by = np.argsort(b.astype(np.uint16) if len(self.size) <= 1 << 16 else b, kind="stable")
        live, b = live[by], b[by]
        key, bits, start = keys[live], self.bits[b], self.start[b]
        level = 1
        while len(live):
            at, ok = None, np.ones(len(live), bool)
            x, y = _pair(key, level)
            m, s = bits, start
            for i in range(PROBES):
                p = (x + np.uint64(i) * y) % m
                ok &= (self.data[(s + (p >> np.uint64(3))).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
                if np.count_nonzero(ok) < 0.75 * len(ok):       # the others need no more probes
                    at = np.flatnonzero(ok) if at is None else at[ok]
                    x, y, m, s = x[ok], y[ok], m[ok], s[ok]
                    ok = np.ones(len(x), bool)
            at = np.flatnonzero(ok) if at is None else at[ok]
            live, key, bits, start = live[at], key[at], bits[at], start[at]
            out[live] = level
            level += 1
        return out


CHUNK_BYTES = 3 << 20   # of text looked up together
ROWS = 4096             # texts counted together


def chunks(texts: pa.Array, most: int = CHUNK_BYTES):
    """(row of the first text, tokens, first token of every text) of as many texts
    as hold ``most`` bytes, or of one longer text."""
    size = np.cumsum(pc.binary_length(texts.fill_null(b"")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield at, *token_rows(texts.slice(at, end - at))
        at = end


def gathered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of every text) of all the texts, made a chunk at a time."""
    held = [(t, first) for _, t, first in chunks(texts, BLOCK_BYTES)]
    size = np.cumsum([0, *(len(t) for t, _ in held)])
    return np.concatenate([t for t, _ in held]), np.concatenate([f + at for (_, f), at in zip(held, size)])


def parts(batches):
    """Arrow batches in parts of at most ROWS rows: bounds what a task holds."""
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def codes(t: np.ndarray, first: np.ndarray, f: Filter) -> np.ndarray:
    """Levels of (word, context, bigram) for every token of some texts: a 3 x n
    array.  Every distinct n-gram is probed once; the context of a text's first
    token has level 0."""
    d = pa.array(t).dictionary_encode()
    word = f.levels(unigram_key(d.dictionary.to_numpy()))[d.indices.to_numpy()].astype(np.uint8)
    u, back = np.unique(bigrams(t, first), return_inverse=True)
    return with_context(word, f.levels(u).astype(np.uint8)[back], first)


def with_context(word: np.ndarray, both: np.ndarray, first: np.ndarray) -> np.ndarray:
    context = np.concatenate([np.zeros(1, np.uint8), word[:-1]])
    context[first] = 0
    return np.stack([word, context, both])


def log_probs(c: np.ndarray, first: np.ndarray, total: int, vocabulary: int, begins: int) -> np.ndarray:
    """log10 probability of each text from the levels of its tokens."""
    word, before, both = _EXPECTED[c[0]], _EXPECTED[c[1]], _EXPECTED[c[2]]
    before[first] = begins      # the context of the first token: one per training text
    p1 = (word + 0.1) / (total + 0.1 * (vocabulary + 1))
    p2 = np.minimum(1.0, both / np.maximum(before, 1.0))
    p = np.where(before > 0, (1 - LAMBDA) * p1 + LAMBDA * p2, p1)
    return np.add.reduceat(np.log10(p), first)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"),
                       (fold(F.col(id_col), FOLDS) != 0).alias("_train"),
                       F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("_doc"))


def count(rows: DataFrame, buckets: int) -> DataFrame:
    """(_b, words, counts, segment, n, v, begins) per bucket of the training rows."""
    def pack(b):
        own = b.column(0).filter(b.column(1))
        if not len(own):
            return
        yield 0, 2, b"", b"", len(own)
        t, first = gathered(own)
        keys, n = np.unique(t, return_counts=True)
        k = unigram_key(keys)           # a word goes where the filter keeps it
        order = np.argsort(k)
        keys, n, at = keys[order], n[order].astype(np.uint32), _bucket(k[order], buckets)
        for i in np.unique(at).tolist():
            yield i, 0, keys[at == i].tobytes(), n[at == i].tobytes(), 0
        del keys, n, k, order, at       # one kind's counts at a time
        keys, n = np.unique(bigrams(t, first), return_counts=True)
        for i, k, c in _split(keys, n.astype(np.uint32), buckets):
            yield i, 1, k.tobytes(), c.tobytes(), 0

    def send(batches):
        for b in parts(batches):
            yield from packed(pack(b), [("_b", pa.int64()), ("_kind", pa.int32()), ("_k", pa.binary()),
                                        ("_c", pa.binary()), ("_n", pa.int64())])

    def add(table: pa.Table) -> pa.Table:
        kind = table.column("_kind").to_numpy()
        begins = int(table.column("_n").to_numpy().sum())
        k, c = blobs(table.column("_k"), np.uint64), blobs(table.column("_c"), np.uint32)
        (words, wn), (grams, gn) = (_total([k[i] for i in at], [c[i] for i in at])
                                    for at in (np.flatnonzero(kind == x).tolist() for x in (0, 1)))
        seg = segment(np.concatenate([unigram_key(words), grams]), np.concatenate([wn, gn]))
        return pa.table({"_b": pa.array([table.column("_b")[0].as_py()], pa.int64()),
                         "_words": pa.array([words.tobytes()], pa.binary()), "_counts": pa.array([wn.tobytes()], pa.binary()),
                         "_seg": pa.array([seg], pa.binary()), "_n": pa.array([int(wn.sum())], pa.int64()),
                         "_v": pa.array([len(words)], pa.int64()), "_begins": pa.array([begins], pa.int64())})

    sent = rows.select("_text", "_train").mapInArrow(send, "_b long, _kind int, _k binary, _c binary, _n long")
    return sent.groupBy("_b").applyInArrow(
        add, "_b long, _words binary, _counts binary, _seg binary, _n long, _v long, _begins long")


def filter_slices(counted: DataFrame, buckets: int, slice_bytes: int) -> list[list[int]]:
    """[first, last) bucket ranges whose segments fit ``slice_bytes`` together."""
    size = {r["_b"]: r["s"] for r in counted.select("_b", F.octet_length("_seg").alias("s")).collect()}
    out, first, held = [], 0, 0
    for b in range(buckets):
        s = size.get(b, 0)
        if held and held + s > slice_bytes:
            out.append([first, b])
            first, held = b, 0
        held += s
    return [*out, [first, buckets]]


def load_slice(counted: DataFrame, buckets: int, first: int, last: int) -> Filter:
    own = counted.filter(F.col("_b").between(first, last - 1))
    size = np.zeros(last - first, np.int64)
    for r in own.select("_b", F.octet_length("_seg").alias("s")).collect():
        size[r["_b"] - first] = r["s"]
    # put in its place as it comes: the driver holds the slice once
    return Filter(buckets, first, ((r["_b"] - first, r["_seg"]) for r in own.select("_b", "_seg").toLocalIterator()), size)


def _head(counted: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with count >= total / HEAD (at most HEAD of them) and their counts."""
    def pick(batches):
        for b in batches:
            w = np.concatenate([np.frombuffer(x, np.uint64) for x in b.column(0).to_pylist()] or [np.zeros(0, np.uint64)])
            c = np.concatenate([np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()] or [np.zeros(0, np.int64)])
            at = c * HEAD >= max(1, total)
            yield pa.RecordBatch.from_arrays([pa.array(w[at].view(np.int64)), pa.array(c[at])], ["w", "c"])
    got = counted.select("_words", "_counts").mapInArrow(pick, "w long, c long").toPandas()
    w = got["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(w)
    return w[order], got["c"].to_numpy(np.int64)[order]


def _tail_sums(rows: DataFrame, counted: DataFrame, head, buckets: int) -> DataFrame:
    """(_doc, part, known): base score terms of the words outside the head.

    A block of texts sends (word, text, times) to the word's bucket, where the
    exact counts are; sums per text go back to the block.
    """
    def pack(b, hw, where, turn):
        docs = b.column(1).to_numpy(zero_copy_only=False)
        block = xxhash.xxh64_intdigest(docs.tobytes(), where * 1_000_003 + turn) >> 1
        t, first = gathered(b.column(0))
        mine = np.zeros(len(docs), bool)
        mine[np.unique(docs, return_index=True)[1]] = True      # a repeated row has the same sums
        rows = np.repeat(np.arange(len(docs), dtype=np.int32), np.diff(np.append(first, len(t))))
        words = pa.array(t).dictionary_encode()
        del t, first                    # the lists and the sorted copies are not held together
        u, place = words.dictionary.to_numpy(), words.indices.to_numpy()
        keep = np.ones(len(u), bool)
        if len(hw):
            keep = hw[np.minimum(np.searchsorted(hw, u), len(hw) - 1)] != u
        k = _bucket(unigram_key(u), buckets).astype(np.int32)
        order = np.lexsort((u, k))
        turn = np.empty(len(u), np.int64)       # of each word by bucket, then by hash
        turn[order] = np.arange(len(u))
        own = keep[place] & mine[rows]
        key = turn[place[own]]          # one number a token: its word's turn, then its text
        key *= len(docs)
        key += rows[own]
        del rows, place, words, own
        key, f = np.unique(key, return_counts=True)
        f = f.astype(np.uint32)
        word, a = key // len(docs), (key % len(docs)).astype(np.int32)
        del key
        w, edge = u[order][word], np.searchsorted(k[order][word], np.arange(buckets + 1))
        del word
        for i in np.flatnonzero(np.diff(edge)).tolist():
            s = slice(edge[i], edge[i + 1])
            u, m = np.unique(w[s], return_counts=True)
            own, place = np.unique(a[s], return_inverse=True)
            yield (i, block, u.tobytes(), m.astype(np.uint32).tobytes(), docs[own].tobytes(),
                   place.astype(np.uint32).tobytes(), f[s].tobytes())

    def send(batches):
        where = TaskContext.get().partitionId()
        for turn, b in enumerate(parts(batches)):
            yield from packed(pack(b, head.value[0], where, turn), [
                ("_b", pa.int64()), ("_block", pa.int64()), *[(c, pa.binary()) for c in ("_u", "_m", "_d", "_a", "_f")]])

    def look_up(mine: pa.Table, exact: pa.Table) -> pa.Table:
        # a bucket has one row of counts; a bucket of held-out words alone has none
        words, n = (np.concatenate([np.zeros(0, t), *blobs(exact.column(c), t)])
                    for c, t in (("_words", np.uint64), ("_counts", np.int64)))
        out = []
        for block, u, m, d, a, f in zip(mine.column("_block").to_pylist(), *(
                blobs(mine.column(c), t) for c, t in (("_u", np.uint64), ("_m", np.uint32), ("_d", np.int64),
                                                      ("_a", np.uint32), ("_f", np.uint32)))):
            c = np.zeros(len(u), np.int64)
            if len(words):
                p = np.minimum(np.searchsorted(words, u), len(words) - 1)
                c = np.where(words[p] == u, n[p], 0)
            c = np.repeat(c, m)
            f = f.astype(np.float64)
            part = np.bincount(a, weights=f * np.log10(c + 0.1), minlength=len(d))
            known = np.bincount(a, weights=f * (c > 0), minlength=len(d))
            out.append((block, d.tobytes(), part.tobytes(), known.tobytes()))
        cols = list(zip(*out)) or [()] * 4
        return pa.table({"_block": pa.array(cols[0], pa.int64()), **{
            k: pa.array(c, pa.binary()) for k, c in zip(("_d", "_part", "_known"), cols[1:])}})

    def gather(table: pa.Table) -> pa.Table:
        docs, part, known = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in
                             (("_d", np.int64), ("_part", np.float64), ("_known", np.float64)))
        u, back = np.unique(docs, return_inverse=True)
        return pa.table({"_doc": pa.array(u), "part": pa.array(np.bincount(back, weights=part, minlength=len(u))),
                         "known": pa.array(np.bincount(back, weights=known, minlength=len(u)).astype(np.int64))})

    sent = rows.select("_text", "_doc").mapInArrow(
        send, "_b long, _block long, _u binary, _m binary, _d binary, _a binary, _f binary")
    sums = (sent.groupBy("_b").cogroup(counted.select("_b", "_words", "_counts").groupBy("_b"))
            .applyInArrow(look_up, "_block long, _d binary, _part binary, _known binary"))
    per = sums.groupBy("_block").applyInArrow(gather, "_doc long, part double, known long")
    # a repeated row of another block has the same sums
    return per.groupBy("_doc").agg(F.max("part").alias("part"), F.max("known").alias("known"))


def _scored(rows: DataFrame, kind: str, head, f, total: int, vocabulary: int, begins: int) -> DataFrame:
    """Per row: token count, base terms of head words and, with a whole filter
    ``f``, the model's score."""
    def run(batches):
        hw, hc = head.value
        lm = f.value if f is not None else None
        for b in batches:
            n, part, known, score = ([np.zeros(0, k)] for k in (np.int64, float, np.int64, float))
            for _, x, first in chunks(b.column(1)):
                score.append(log_probs(codes(x, first, lm), first, total, vocabulary, begins) if lm
                             else np.full(len(first), np.nan))
                c = np.zeros(len(x), np.int64)
                inside = np.zeros(len(x), bool)
                if len(hw):
                    p = np.minimum(np.searchsorted(hw, x), len(hw) - 1)
                    inside = hw[p] == x
                    c = hc[p]
                n.append(np.diff(np.append(first, len(x))))
                part.append(np.add.reduceat(np.where(inside, np.log10(c + 0.1), 0.0), first))
                known.append(np.add.reduceat((inside & (c > 0)).astype(np.int64), first))
            n, part, known, score = map(np.concatenate, (n, part, known, score))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(part, pa.float64()),
                 pa.array(known, pa.int64()), pa.array(score, pa.float64())],
                ["_id", "_doc", "n_tokens", "_part", "_known", "score"])
    return rows.select("_id", "_text", "_doc").mapInArrow(
        run, f"_id {kind}, _doc long, n_tokens long, _part double, _known long, score double")


def _sliced_scores(rows: DataFrame, counted: DataFrame, buckets: int, ranges: list, total: int, vocabulary: int,
                   begins: int) -> DataFrame:
    """(_doc, score) when the filter takes several slices: one is loaded,
    broadcast, asked and released before the next.  A block of texts stores the
    levels that a slice gives to its words and bigrams; the answers of all slices
    are put together per block."""
    def probe(f, number):
        def run(batches):
            for b in batches:
                docs = b.column(1).to_numpy(zero_copy_only=False)
                for at, t, first in chunks(b.column(0), BLOCK_BYTES):
                    own = docs[at:at + len(first)].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([xxhash.xxh64_intdigest(own) >> 1], pa.int64()), pa.array([number], pa.int32()),
                         pa.array([own], pa.binary()), pa.array([first.astype(np.int64).tobytes()], pa.binary()),
                         pa.array([codes(t, first, f.value)[::2].tobytes()], pa.binary())],
                        ["_block", "_slice", "_docs", "_first", "_codes"])
        return rows.select("_text", "_doc").mapInArrow(
            run, "_block long, _slice int, _docs binary, _first binary, _codes binary")

    def join(table: pa.Table) -> pa.Table:
        if set(table.column("_slice").to_pylist()) != set(range(len(ranges))):
            raise RuntimeError("a block of texts was not asked in every slice")
        both = None
        for c in blobs(table.column("_codes"), np.uint8):       # one block at a time
            both = c.copy() if both is None else np.maximum(both, c, out=both)
        word, gram = both.reshape(2, -1)
        docs, first = (blobs(table.column(x), np.int64)[0] for x in ("_docs", "_first"))
        return pa.table({"_doc": pa.array(docs), "score": pa.array(
            log_probs(with_context(word, gram, first), first, total, vocabulary, begins))})

    asked = None
    for number, (first, last) in enumerate(ranges):
        f = rows.sparkSession.sparkContext.broadcast(load_slice(counted, buckets, first, last))
        got = staged(probe(f, number), "lm-codes")
        f.destroy()
        asked = got if asked is None else asked.unionByName(got)
    per = asked.groupBy("_block").applyInArrow(join, "_doc long, score double")
    # a repeated row has the same score
    return per.groupBy("_doc").agg(F.max("score").alias("score"))


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row's id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    NULL and empty texts have one token, the end.  Rows with crc32(id as text)
    mod 10 = 0 are held out; a NULL id counts as remainder 0.  Without training
    rows every base term is log10(1) = 0.
    """
    kind = id_type(docs, id_col)
    rows = _rows(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(8, -(-size // bucket_bytes))
    counted = staged(count(rows, buckets), "lm-counts")
    total, vocabulary, begins = (x or 0 for x in counted.agg(F.sum("_n"), F.sum("_v"), F.sum("_begins")).first())
    sc = docs.sparkSession.sparkContext
    head = sc.broadcast(_head(counted, total))      # at most HEAD words
    ranges = filter_slices(counted, buckets, slice_bytes)
    # one slice is at most slice_bytes (or one bucket), and only one is alive at a time
    whole = sc.broadcast(load_slice(counted, buckets, *ranges[0])) if len(ranges) == 1 else None
    out = _scored(rows, kind, head, whole, total, vocabulary, begins)
    if whole is None:
        out = out.drop("score").join(_sliced_scores(rows, counted, buckets, ranges, total, vocabulary, begins), "_doc")
    out = out.join(_tail_sums(rows, counted, head, buckets), "_doc", "left")
    rate = float(np.log10(total + 0.1 * (vocabulary + 1)))
    return out.select(
        F.col("_id").alias(id_col), (fold(F.col("_id"), FOLDS) == 0).alias("held_out"), "n_tokens",
        (F.col("_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("_part") + F.coalesce("part", F.lit(0.0)) - F.col("n_tokens") * F.lit(rate)).alias("base_score"),
        "score")
