"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits, majority over the XXH64 values of word shingles.
Candidates: ``2**(radius+1) - 1`` bit masks, one per nonzero vector v of
GF(2)^(radius+1).  Bit position i carries a vector p(i), and mask v keeps the
bits with <p(i), v> = 1.  Any ``radius`` positions have a nonzero v orthogonal
to all their vectors, so two fingerprints that differ in at most ``radius`` bits
agree under some mask: no pair within the radius is missed.

Linking works on distinct fingerprints.  A bucket (mask, masked value) of up to
``bucket_rows`` fingerprints is compared inside a task, which emits a spanning
forest of its links, never all pairs.  A larger bucket is linked exactly by
meeting points: two fingerprints within 3 bits have a point at most 1 bit from
one and at most 2 bits from the other, so grouping the points around each
fingerprint gives linear many links with the same components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, staged

BITS = 64


def fingerprint_bytes(text: bytes, shingle_words: int = 3) -> int:
    """Signed 64-bit fingerprint of one text (0 when it has no word)."""
    w = text.lower().split()             # bytes: A-Z only, ASCII spaces only
    if not w:
        return 0
    body = b" ".join(w)
    h = xxhash.xxh64_intdigest
    if len(w) <= shingle_words:
        hs = [h(body, 42)]
    else:
        size = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
        end = np.cumsum(size + 1) - 1
        start = end - size
        k = shingle_words - 1
        hs = [h(body[a:b], 42) for a, b in zip(start[:-k or None].tolist(), end[k:].tolist())]
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hs), 1 << 16):     # bounded memory on very long texts
        a = np.array(hs[i:i + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(a.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hs)).astype(np.uint8))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """(id, fp long) of every row; NULL and wordless texts have fp 0."""
    def run(batches):
        for b in batches:
            fps = [fingerprint_bytes(x or b"", shingle_words) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["_id", "_fp"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(run, f"_id {id_type(docs, id_col)}, _fp long")


def covering_masks(radius: int = 3, bits: int = BITS) -> list[int]:
    """Signed 64-bit masks, one per nonzero vector of GF(2)^(radius+1)."""
    n = (1 << (radius + 1)) - 1
    place = [1 + i % n for i in range(bits)]     # every nonzero vector, evenly
    out = []
    for v in range(1, n + 1):
        m = sum(1 << i for i, p in enumerate(place) if bin(p & v).count("1") % 2)
        out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links (Hamming distance <= radius) among fps."""
    n = len(fps)
    root = np.arange(n)
    out = []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    u = fps.view(np.uint64)
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= radius) + i + 1
        for j in near:
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                out.append((int(fps[i]), int(fps[j])))
    return out


def links(fps: DataFrame, radius: int = 3, bucket_rows: int = 4096) -> DataFrame:
    """Links (_a, _b) among distinct fingerprints ``_fp`` whose connected
    components are those of "differ in at most ``radius`` bits"."""
    masks = covering_masks(radius)
    keyed = fps.select("_fp", F.posexplode(F.array(
        *[F.col("_fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("_m", "_key"))
    sizes = keyed.groupBy("_m", "_key").agg(F.count("*").alias("_n")).filter("_n > 1")
    sizes = staged(sizes, "simhash-buckets")
    in_bucket = keyed.join(sizes, ["_m", "_key"])

    def forest(batches):
        for b in batches:
            pairs = [p for x in b.column(0) for p in _forest(
                np.sort(x.values.to_numpy(zero_copy_only=False)), radius)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                ["_a", "_b"])

    small = (in_bucket.filter(F.col("_n") <= bucket_rows)
             .groupBy("_m", "_key").agg(F.collect_list("_fp").alias("_fps"))
             .select("_fps").mapInArrow(forest, "_a long, _b long"))
    out = small
    if not sizes.filter(F.col("_n") > bucket_rows).isEmpty():
        out = small.unionByName(_meeting_links(in_bucket.filter(F.col("_n") > bucket_rows), masks, radius))
    return out.distinct()


def _meeting_links(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links inside oversize buckets, linear in the bucket (radius <= 3)."""
    if radius > 3:
        raise ValueError("oversize buckets are linked by meeting points for radius <= 3")

    def points(batches):
        for b in batches:
            ms, fps = b.column(0).to_pylist(), b.column(2).to_numpy(zero_copy_only=False)
            for m, fp in zip(ms, fps.view(np.uint64)):
                free = [np.uint64(1 << i) for i in range(BITS) if not (masks[m] >> i) & 1]
                one = np.array(free, dtype=np.uint64)
                i, j = np.triu_indices(len(one), 1)
                v = np.concatenate([[np.uint64(0)], one, one[i] ^ one[j]]) ^ fp
                near = np.concatenate([np.ones(1 + len(one), bool), np.zeros(len(i), bool)])
                n = len(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, m, np.int32)), pa.array(v.view(np.int64)),
                     pa.array(np.full(n, fp, np.uint64).view(np.int64)), pa.array(near)],
                    ["_m", "_v", "_fp", "_near"])

    pts = rows.select("_m", "_key", "_fp").mapInArrow(points, "_m int, _v long, _fp long, _near boolean")
    hub = (pts.groupBy("_m", "_v").agg(F.min(F.when(F.col("_near"), F.col("_fp"))).alias("_hub"),
                                       F.count("*").alias("_k"))
           .filter("_hub is not null and _k > 1"))
    return (pts.join(hub, ["_m", "_v"]).filter("_fp <> _hub")
            .select(F.col("_hub").alias("_a"), F.col("_fp").alias("_b")).distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(_node, _root) for every node of ``edges`` (_a, _b): alternating large-star
    and small-star rounds, each staged; stops when a round changes nothing."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        if not large:
            both = both.filter("_b < _a")
        low = both.groupBy("_a").agg(F.least(F.min("_b"), F.first("_a")).alias("_min"))
        out = both.join(low, "_a")
        if large:
            out = out.filter("_b > _a").select(F.col("_b").alias("_a"), F.col("_min").alias("_b"))
        else:
            out = (out.select(F.col("_b").alias("_a"), F.col("_min").alias("_b"))
                   .unionByName(low.select("_a", F.col("_min").alias("_b"))))
        return out.filter("_a <> _b").distinct()

    def mark(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first()

    e = staged(edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b"))
               .filter("_a <> _b"), "components")
    was = mark(e)
    for _ in range(max_rounds):
        e = staged(star(star(e, True), False), "components")
        now = mark(e)
        if tuple(now) == tuple(was):
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))
            .unionByName(e.select(F.col("_b").alias("_node"), F.col("_b").alias("_root")).distinct()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, radius: int = 3,
                    bucket_rows: int = 4096) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the
    smallest id reachable over links of at most ``radius`` bits).

    NULL, empty and wordless texts have fingerprint zero and link like any
    other.  An empty table gives an empty result.  A NULL id keeps its row; it
    never names a component unless the component holds no other id.
    """
    fp = staged(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    first = staged(fp.groupBy("_fp").agg(F.min("_id").alias("_first")), "simhash-distinct")
    comp = components(links(first.select("_fp"), radius, bucket_rows))
    tagged = (first.join(comp.withColumnRenamed("_node", "_fp"), "_fp", "left")
              .select("_fp", "_first", F.coalesce("_root", "_fp").alias("_root")))
    least = tagged.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = tagged.join(least, "_root").select("_fp", "component_id")
    return (fp.join(named, "_fp")
            .select(F.col("_id").alias(id_col),
                    F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id"))
