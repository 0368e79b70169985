"""Exact repeated-substring removal with a suffix array by linear grouping.

A byte goes when a ``LENGTH``-byte string that covers it also starts somewhere
else.  The work is cut up by content:

1. Every text is covered by anchors: the position of the smallest 32-byte-gram
   hash in each window of LENGTH - 31 grams.  Equal LENGTH-byte strings choose
   the same gram as their anchor, so they meet under its hash.
2. Anchors that occur once cannot belong to a repeat.  For the others, the
   context (the strings that chose the anchor) is sent to the anchor's bucket.
3. In a bucket, contexts are cut into 8-byte symbols counted from their anchor,
   so equal strings are cut alike and hold 24 equal symbols.  A suffix array of
   the symbols is built by grouping; strings whose 24 symbols equal a neighbour's
   in suffix order are compared on their remaining 8 bytes.  Exact throughout.
4. Contexts of an anchor with very many of them are cut into parts first: the
   strings whose anchor lies in the same RANGE places.  They all hold the same
   core of LENGTH - RANGE + 1 bytes, whose hash is the part's group, so a common
   anchor falls apart into groups of equal cores.  Equal contexts are counted and
   one of each is cut, equal parts are counted and one of each goes to the group's
   suffix array.  The strings of a part all hold its core, those of a context its
   anchor, so the repeated ones cover one span, which is joined back to all
   places of the context.  A group whose *different* parts are still very many (a passage's edge in
   many documents) is finished string by string on those parts.

Texts, contexts, parts and such strings are told apart by MD5, everything else by bytes.
Equal texts are worked on once; their strings are repeated by definition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

LENGTH = 200
GRAM = 32
HOT = 512               # contexts of an anchor, or different parts of a group, that are sorted as they are
RANGE = 24              # places of the anchor in the strings of one part
CHUNK = 4 << 20         # bytes of contexts of one suffix array
SYMBOL = 8

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _rng.integers(0, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def gram_hashes(b: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of b[i:i+length] for every i, by doubling."""
    if len(b) < length:
        return np.zeros(0, np.uint64)
    cur, size, out, done = _BYTE[b], 1, None, 0
    n = len(b) - length + 1
    for j in range(length.bit_length()):
        if length >> j & 1:     # the binary parts of the length, smallest first
            part = cur[done:done + n]
            out = part.copy() if out is None else out * _ODD[8] + part * _ODD[j]
            done += size
        if length >> (j + 1):
            cur = cur[:-size] * _ODD[j] + cur[size:]
            size *= 2
            if size == 8:
                cur = _mix(cur)
    return _mix(out)


def window_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the smallest value (by its upper 44 bits, then leftmost) in
    every window of w values."""
    if len(h) > 1 << 20:        # long texts in overlapping parts
        step = (1 << 20) - w
        return np.concatenate([window_argmin(h[i:i + step + w - 1], w) + i
                               for i in range(0, len(h) - w + 1, step)])
    n, low = len(h), np.uint64((1 << 20) - 1)
    x = np.full(n + -n % w, np.iinfo(np.uint64).max, np.uint64)
    x[:n] = (h & ~low) | np.arange(n, dtype=np.uint64)
    x = x.reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - w + 1
    return (np.minimum(right[:m], left[w - 1:w - 1 + m]) & low).astype(np.int64)


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first and last start of the strings that chose it) per anchor."""
    b = np.frombuffer(text, np.uint8)
    if len(b) < length:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z, z, z
    h = gram_hashes(b, min(GRAM, length))
    own = window_argmin(h, length - min(GRAM, length) + 1)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.append(first[1:], len(own)) - 1
    return h[own[first]], own[first], first, last


def suffix_array(text: bytes | np.ndarray) -> list[int]:
    """Suffix array of bytes, or of small non-negative integers, by grouping;
    linear in the text.

    Suffixes are kept in groups of equal Lyndon prefix, in order.  Groups are
    taken from the highest down: each member looks up its nearest previous
    position in a lower group (following earlier pointers), and positions found
    k times extend their prefix by k copies of the group's prefix, which moves
    them to the back of their own group, the larger k the further.  The second
    pass emits suffixes in ascending order: an emitted suffix places those that
    it ends the prefix of in the next free slots of their groups.
    """
    n = len(text)
    if n == 0:
        return []
    b = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text
    order = np.argsort(b, kind="stable")
    sa = order.tolist()
    pos_a = np.empty(n, np.int64)
    pos_a[order] = np.arange(n)
    pos = pos_a.tolist()                # place of a suffix in sa
    count = np.bincount(b)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]])
    group = begin[b].tolist()           # first place of a suffix's group
    size = [0] * (n + 1)                # of the group that starts at a place
    for c in np.flatnonzero(count).tolist():
        size[int(begin[c])] = int(count[c])
    prev = [-1] * n
    end = n
    while end > 0:
        g = group[sa[end - 1]]
        members = sa[g:end]
        if end - g > 1:
            members.sort()
        times: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if times:
            if len(times) == len(members):
                batches = [list(times)]
            else:
                by: dict[int, list[int]] = {}
                for p, k in times.items():
                    by.setdefault(k, []).append(p)
                batches = [by[k] for k in sorted(by, reverse=True)]
            for batch in batches:
                for p in batch:         # to the back of its group
                    s = group[p]
                    size[s] -= 1
                    last = s + size[s]
                    a, q = pos[p], sa[last]
                    sa[a], sa[last] = q, p
                    pos[q], pos[p] = a, last
                # the moved ones form a new group
                for p, new in zip(batch, [group[p] + size[group[p]] for p in batch]):
                    group[p] = new
                    size[new] += 1
        end = g
    out = [0] * n
    free: dict[int, int] = {}
    placed = bytearray(n)
    j = n - 1                           # the empty suffix comes before all
    while j >= 0:
        s = group[j]
        at = free.get(s, s)
        out[at] = j
        free[s] = at + 1
        placed[j] = 1
        j = prev[j]
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            s = group[j]
            at = free.get(s, s)
            out[at] = j
            free[s] = at + 1
            placed[j] = 1
            j = prev[j]
    return out


def _words_at(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte numbers at the places ``at`` of a byte array."""
    out = np.zeros(len(at), np.uint64)
    for j in range(SYMBOL):
        out = (out << np.uint64(8)) | b[at + j]
    return out


def _symbol_hashes(x: np.ndarray, count: int) -> np.ndarray:
    """64-bit hash of x[i:i+count] for every i (zeros after the end)."""
    v = _mix(np.append(x, np.zeros(count, x.dtype)).astype(np.uint64) * _ODD[9] + _ODD[10])
    out = np.zeros(len(x), np.uint64)
    for j in range(count):
        out = out * _ODD[11] + v[j:j + len(x)]
    return _mix(out)


def repeated_starts(contexts: list[tuple[bytes, int]], length: int = LENGTH) -> list[np.ndarray]:
    """For every (bytes, place of the anchor) the flags of its strings, by start,
    that occur more than once among all contexts of the list."""
    own: dict[tuple[bytes, int], int] = {}
    which = [own.setdefault((t, p % SYMBOL), len(own)) for t, p in contexts]
    copies = np.bincount(which, minlength=len(own))
    inner = length // SYMBOL - 1                # whole symbols inside any string, besides 8 bytes
    texts = list(own)
    pad = b"\0" * 2 * SYMBOL
    whole = np.frombuffer(pad + pad.join(t for t, _ in texts) + pad + pad, np.uint8)
    size = np.array([len(t) for t, _ in texts], np.int64)
    begin = np.cumsum(size + len(pad)) - size   # of every text in whole
    strings = size - length + 1
    base = np.cumsum(strings) - strings
    flat = np.repeat(copies > 1, strings)
    flags = np.split(flat, base[1:])            # views: one flag per string
    # symbols: first boundary at or after the start, then every 8 bytes
    phase = np.array([p for _, p in texts], np.int64)
    n_sym = (size - phase) // SYMBOL
    first = np.cumsum(n_sym + 1) - (n_sym + 1)  # of every text's symbols, one separator each
    total = int((n_sym + 1).sum())
    k = np.repeat(np.arange(len(texts)), n_sym + 1)
    i = np.arange(total) - first[k]
    at = begin[k] + phase[k] + i * SYMBOL       # place of a symbol in whole
    sep = i == n_sym[k]
    value = _words_at(whole, np.where(sep, 0, at))
    rank = np.unique(value, return_inverse=True)[1] + 1
    rank[sep] = 0
    # places whose next ``inner`` symbols hold no separator, and that are inside some string
    start_ok = (i + inner <= n_sym[k]) & ~sep
    # a run of symbols whose hash occurs once repeats nothing: only the others are sorted
    h = _symbol_hashes(rank, inner)
    h = h[start_ok]
    maybe = np.zeros(total, bool)
    _, back, n = np.unique(h, return_inverse=True, return_counts=True)
    maybe[np.flatnonzero(start_ok)[n[back] > 1]] = True
    if not maybe.any():
        return [flags[w] for w in which]
    step = np.zeros(total + inner, np.int32)
    step[np.flatnonzero(maybe)] += 1
    step[np.flatnonzero(maybe) + inner] -= 1
    need = np.cumsum(step)[:total] > 0
    kept = np.flatnonzero(need | np.concatenate([[False], need[:-1]]))     # one separator after each run
    order = kept[np.array(suffix_array(np.where(need[kept], rank[kept], 0)), np.int64)]
    order = order[maybe[order]]
    view = np.lib.stride_tricks.sliding_window_view(np.append(rank, np.zeros(inner, rank.dtype)), inner)
    new = np.ones(len(order), bool)
    for c in range(1, len(order), 1 << 15):     # neighbours in suffix order, bounded memory
        d = min(len(order), c + (1 << 15))
        new[c:d] = (view[order[c:d]] != view[order[c - 1:d - 1]]).any(axis=1)
    group = np.cumsum(new)
    shared = np.bincount(group)[group] > 1
    order, group = order[shared], group[shared]
    a, t0 = at[order], k[order]
    before, after = _words_at(whole, a - SYMBOL), _words_at(whole, a + inner * SYMBOL)
    for t in range(SYMBOL):                     # the string starts t bytes before the boundary
        start = a - t - begin[t0]
        live = (start >= 0) & (start < strings[t0])
        if not live.any():
            continue
        bits = np.uint64(8 * t)
        key = after[live] >> bits
        if t:
            key |= before[live] << (np.uint64(64) - bits)
        cols = [key, group[live]]
        by = np.lexsort(cols)
        same = np.ones(len(by) - 1, bool)
        for col in cols:
            same &= col[by][1:] == col[by][:-1]
        hit = np.zeros(len(by), bool)
        hit[by[1:]] |= same
        hit[by[:-1]] |= same
        flat[base[t0[live][hit]] + start[live][hit]] = True
    return [flags[w] for w in which]


def _spans(flags: np.ndarray, base: int, length: int) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [(base + a, base + e - 1 + length) for a, e in zip(edge[::2].tolist(), edge[1::2].tolist())]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]):
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text")) \
        .withColumn("_key", F.unhex(F.md5("_text")))


def repeated_anchors(texts: DataFrame, length: int) -> tuple[DataFrame, bool]:
    """(_key, _anchors): per text the places of anchors that occur more than once
    anywhere, and whether any of them is hot.

    A place packs (first start, last start - first, anchor - first start).
    Repeated rows count, so all anchors of copied texts are among them.
    """
    def run(batches):
        for b in batches:
            at, hs, ps = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                h, p, first, last = anchors(t, length)
                at.append(np.full(len(h), i, np.int64))
                hs.append(h)
                ps.append((first << 24) | ((last - first) << 12) | (p - first))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.concatenate(at))), pa.array(np.concatenate(hs).view(np.int64)),
                 pa.array(np.concatenate(ps))], ["_key", "_h", "_p"])

    found = texts.select("_key", "_text").filter(F.octet_length("_text") >= length).mapInArrow(
        run, "_key binary, _h long, _p long")
    total = staged(found.groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1")
                   .select("_h", (F.col("_n") > HOT).alias("_hot")), "suffix-anchors")
    per = (found.join(total, "_h").groupBy("_key")
           .agg(F.collect_set(F.struct("_h", "_p", "_hot")).alias("_anchors")))
    return per, not total.filter("_hot").isEmpty()


def distinct_texts(texts: DataFrame) -> DataFrame:
    """(_key, _z, _n): every distinct text once, compressed for the shuffle."""
    def run(batches):
        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.compress(t) for t in b.column(1).to_pylist()], pa.binary())], ["_key", "_z"])
    z = texts.select("_key", "_text").mapInArrow(run, "_key binary, _z binary")
    return z.groupBy("_key").agg(F.first("_z").alias("_z"), F.count("*").alias("_n"))


def _contexts(texts: DataFrame, length: int, hot: bool = False) -> DataFrame:
    """Contexts of the repeated anchors that are not hot, or of the hot ones."""
    def run(batches):
        d = zstandard.ZstdDecompressor()
        for b in batches:
            hs, starts, places, parts, at = [], [], [], [], []
            for i, (z, own) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                t = d.decompress(z)
                for x in own:
                    if x["_hot"] == hot:
                        p = x["_p"]
                        a = p >> 24
                        parts.append(t[a:a + (p >> 12 & 0xFFF) + length])
                        starts.append(a)
                        places.append(p & 0xFFF)
                        hs.append(x["_h"])
                        at.append(i)
            key = b.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hs, pa.int64()), pa.array(starts, pa.int64()), key, pa.array(parts, pa.binary()),
                 pa.array(places, pa.int32())], ["_h", "_start", "_key", "_part", "_place"])
    return texts.select("_key", "_z", "_anchors").mapInArrow(
        run, "_h long, _start long, _key binary, _part binary, _place int")


def cut_parts(text: bytes, packed: int, length: int) -> list[tuple[int, int, int, int, int]]:
    """(range, start, end, place of the anchor, place of the core's start) of every
    part of a context; the last two count from the part's start."""
    first, last_off, place = packed >> 24, packed >> 12 & 0xFFF, packed & 0xFFF
    out = []
    for j in range(max(0, place - last_off) // RANGE, place // RANGE + 1):
        high = min(place, j * RANGE + RANGE - 1)        # bytes before the anchor in the first string
        low = max(0, place - last_off, j * RANGE)
        start = first + place - high
        out.append((j, start, first + place - low + length, high, high - j * RANGE))
    return out


def _hot_parts(contexts: DataFrame, length: int) -> DataFrame:
    """(_g, _m, _n, _c, _off, _part, _place): parts of different contexts ``_c`` that
    occur ``_n`` times; ``_g`` hashes anchor, range and core, ``_m`` the part's bytes
    and place, ``_off`` is where the part starts in the context."""
    core = length - RANGE + 1

    def run(batches):
        for b in batches:
            gs, ms, offs, places, parts, at = [], [], [], [], [], []
            for i, (h, t, anchor) in enumerate(zip(*(b.column(k).to_pylist() for k in range(3)))):
                for j, a, e, place, c in cut_parts(t, (len(t) - length) << 12 | anchor, length):
                    part = t[a:e]
                    gs.append(xxhash.xxh64_intdigest(part[c:c + core], (h ^ j) & ((1 << 64) - 1)))
                    ms.append(hashlib.md5(part + bytes([place & 255, place >> 8])).digest())
                    offs.append(a)
                    places.append(place)
                    parts.append(part)
                    at.append(i)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(gs, dtype=np.uint64).view(np.int64)), pa.array(ms, pa.binary()), b.column(3).take(at),
                 b.column(4).take(at), pa.array(offs, pa.int64()), pa.array(parts, pa.binary()),
                 pa.array(places, pa.int32())], ["_g", "_m", "_n", "_c", "_off", "_part", "_place"])
    return contexts.select("_h", "_part", "_place", "_n", "_c").mapInArrow(
        run, "_g long, _m binary, _n long, _c binary, _off long, _part binary, _place int")


def _hot_spans(texts: DataFrame, length: int) -> DataFrame:
    """(_key, _from, _to) of repeated strings around hot anchors."""
    name = F.md5(F.concat("_part", F.encode(F.lpad(F.col("_place").cast("string"), 4, "0"), "utf-8")))
    places = staged(_contexts(texts, length, hot=True).withColumn("_c", F.unhex(name)), "suffix-contexts")
    own = places.groupBy("_c").agg(F.count("*").alias("_n"), F.first("_h").alias("_h"),
                                   F.first("_part").alias("_part"), F.first("_place").alias("_place"))
    rows = staged(_hot_parts(own, length), "suffix-parts")
    kinds = rows.groupBy("_g", "_m").agg(F.sum("_n").alias("_n"), F.first("_part").alias("_part"),
                                         F.first("_place").alias("_place"))
    kinds = staged(kinds, "suffix-kinds")
    per = staged(kinds.groupBy("_g").agg(F.count("*").alias("_d"), F.sum("_n").alias("_all"))
                 .filter("_all > 1").select("_g", "_d"), "suffix-groups")
    live = kinds.join(per, "_g")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def flush(held):
        # a part that occurs again is entered twice
        twice = [x for r in held for x in [r[3:5]] * (2 if r[2] > 1 else 1)]
        flags = repeated_starts(twice, length)
        out, i = [], 0
        for g, m, count, _, _ in held:
            out += [(g, m, a, e) for a, e in _spans(flags[i], 0, length)]
            i += 2 if count > 1 else 1
        return _batch(out, ["_g", "_m", "_a", "_e"], [pa.int64(), pa.binary(), pa.int64(), pa.int64()])

    def sort(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if size > CHUNK and row[0] != held[-1][0]:      # never inside one group
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield flush(held)

    cols = ["_g", "_m", "_n", "_part", "_place"]
    schema = "_g long, _m binary, _a long, _e long"
    spans = (live.filter(F.col("_d") <= HOT).select(*cols).repartition(2 * n, "_g").sortWithinPartitions("_g")
             .mapInArrow(sort, schema))
    if not per.filter(F.col("_d") > HOT).isEmpty():
        spans = spans.unionByName(_wide_spans(live.filter(F.col("_d") > HOT).select(*cols), length, schema))
    # One span a part, then one a context: no join makes more rows than it has parts
    # or places.  Both are stored, so that a join sees them as plain tables, which
    # may be broadcast or, for a very common context, dealt anew.
    spans = staged(spans.groupBy("_g", "_m").agg(F.min("_a").alias("_a"), F.max("_e").alias("_e")), "suffix-part-spans")
    per = staged(rows.select("_g", "_m", "_c", "_off").join(spans, ["_g", "_m"]).groupBy("_c")
                 .agg(F.min(F.col("_off") + F.col("_a")).alias("_a"), F.max(F.col("_off") + F.col("_e")).alias("_e")),
                 "suffix-context-spans")
    return (places.select("_c", "_key", "_start").join(per, "_c")
            .select("_key", (F.col("_start") + F.col("_a")).alias("_from"), (F.col("_start") + F.col("_e")).alias("_to")))


def _wide_spans(kinds: DataFrame, length: int, schema: str) -> DataFrame:
    """Spans of groups with very many different parts: at most RANGE strings a
    part, counted by place and MD5."""
    def run(batches):
        for b in batches:
            rows = []
            for g, m, n, part, place in zip(*(b.column(i).to_pylist() for i in range(5))):
                rows += [(g, m, n, i, hashlib.md5(part[i:i + length] + bytes([(place - i) & 255, (place - i) >> 8])).digest())
                         for i in range(len(part) - length + 1)]
            yield _batch(rows, ["_g", "_m", "_n", "_a", "_s"],
                         [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()])

    strings = staged(kinds.mapInArrow(run, "_g long, _m binary, _n long, _a long, _s binary"), "suffix-strings")
    many = strings.groupBy("_g", "_s").agg(F.sum("_n").alias("_k")).filter("_k > 1").select("_g", "_s")
    hit = strings.join(many, ["_g", "_s"])
    return hit.select("_g", "_m", "_a", (F.col("_a") + length).alias("_e"))


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(_key, _from, _to) of repeated strings, by suffix arrays over whole buckets."""
    def run(batches):
        held, size = [], 0

        def flush(rows):
            out = []
            for (_, start, key, _, _), f in zip(rows, repeated_starts([r[3:] for r in rows], length)):
                out += [(key, a, e) for a, e in _spans(f, start, length)]
            return _batch(out, ["_key", "_from", "_to"], [pa.binary(), pa.int64(), pa.int64()])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if size > CHUNK and row[0] != held[-1][0]:      # never inside one anchor
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield flush(held)

    n = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (contexts.repartition(4 * n, "_h").sortWithinPartitions("_h")
            .mapInArrow(run, "_key binary, _from long, _to long"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the bytes left).

    A very long text is read whole, in one task.  NULL counts as the empty text.
    Texts shorter than ``length`` bytes keep all
    bytes.  Rows of equal text (repeated rows too) are each other's repeats.
    """
    if length % SYMBOL or length < GRAM + SYMBOL or length > 4000:
        raise ValueError("length: a multiple of 8 from 40 to 4000 bytes")
    texts = keyed_texts(docs, id_col, text_col)
    own = distinct_texts(texts)
    per, any_hot = repeated_anchors(texts, length)
    spans = _sorted_spans(_contexts(own.join(per, "_key"), length), length)
    if any_hot:
        some = own.join(per.filter(F.exists("_anchors", lambda a: a["_hot"])), "_key")
        spans = spans.unionByName(_hot_spans(some, length))
    per = staged(spans.groupBy("_key").agg(
        F.collect_list(F.struct("_from", "_to")).alias("_spans")), "suffix-spans")

    def run(batches):
        d = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for key, z, n, found in zip(*(b.column(i).to_pylist() for i in range(4))):
                t = d.decompress(z)
                cover = [(0, len(t))] if n > 1 and len(t) >= length else \
                    sorted((s["_from"], s["_to"]) for s in found or [])
                kept, at, runs = [], 0, 0
                for a, e in cover:
                    if a > at or runs == 0:
                        runs += 1
                        kept.append(t[at:a])
                    at = max(at, e)
                kept.append(t[at:])
                kept = b"".join(kept)
                rows.append((key, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            yield _batch(rows, ["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                         [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()])

    done = (own.join(per, "_key", "left").select("_key", "_z", "_n", "_spans")
            .mapInArrow(run, "_key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    return (texts.select("_id", "_key").join(done, "_key")
            .select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256"))
