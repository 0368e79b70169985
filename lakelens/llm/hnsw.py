"""Embedding near-duplicates over one small-world graph per shard.

Rows are dealt to shards by a hash of a row number.  A shard's vectors are cut
into *balls*: a vector joins the nearest leader within half the link angle, else
it leads a ball of its own.  All members of a ball are linked to each other by
the triangle inequality, so copies, however many, cost one graph node and are
counted instead of compared.  The leaders form a hierarchical navigable
small-world graph: every layer holds a sixteenth of the one below, searches walk
from the top, and neighbour lists are chosen for diversity.

Each graph is audited where it is built: members turned away by the link angle
must find every leader that a scan of all leaders finds.  The beam doubles until
the audit passes, up to all leaders, where the search is exact.

Every vector then queries every shard, one shard's graph at a time.  A leader in
reach settles its ball whole where the triangle inequality allows (all members
in, or all out); the others are verified member by member in double precision.
A query returns its number of links and one edge per linked ball, never pairs.
Components are joined from those edges and the balls' own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, staged
from .simhash import components

MIN_SHARDS = 8              # graphs are built side by side, also on small tables
SHARD_ROWS = 131_072        # at most about this many vectors a graph: what one broadcast holds
DEGREE = 16                 # neighbours chosen for a new node; twice as many at most in the lowest layer
BEAM = 32                   # first beam width
AUDIT = 256                 # audit queries a shard
RECALL = 0.995              # of the audit's leaders in reach
BLOCK = 512                 # vectors searched side by side
PAIRS = 512                 # of them and their candidates compared at once
SLACK = 1e-9                # angles nearer than this to a limit are verified


class Graph:
    """Layered small-world graph over unit vectors ``x`` (grows up to len(x) nodes)."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray] | None = None, size: int = 0):
        self.x = x
        self.size = size                            # nodes 0 .. size-1 are in the lowest layer
        self.links = links if links is not None else []
        self.top = 0                                # a node of the highest layer

    def _slots(self, layer: int) -> int:
        return DEGREE * 2 if layer == 0 else DEGREE

    def _ensure(self, layer: int):
        while len(self.links) <= layer:
            self.links.append(np.full((len(self.x), self._slots(len(self.links))), -1, dtype=np.int32))

    def _descend(self, q: np.ndarray, layer: int, at: np.ndarray) -> np.ndarray:
        """Greedy walk in one layer, all queries side by side."""
        best = np.einsum("ij,ij->i", q, self.x[at])
        live = np.arange(len(q))
        while len(live):
            nb = self.links[layer][at[live]]
            step = max(1, PAIRS // nb.shape[1])
            sims = np.concatenate([np.einsum("ij,ikj->ik", q[live[k:k + step]], np.take(self.x, nb[k:k + step], axis=0, mode="wrap"))
                                   for k in range(0, len(live), step)])
            sims[nb < 0] = -2
            k = sims.argmax(1)
            val = sims[np.arange(len(live)), k]
            better = val > best[live]
            live, k, val = live[better], k[better], val[better]
            at[live] = nb[better, k]
            best[live] = val
        return at

    def search(self, q: np.ndarray, beam: int, down_to: int = 0, reach: float | None = None):
        """(ids, sims) of each query's ``beam`` best nodes of a layer, best first
        (-1 padded).  Where the whole beam lies within ``reach``, it is doubled."""
        at = np.full(len(q), self.top, dtype=np.int64)
        for layer in range(len(self.links) - 1, down_to, -1):
            at = self._descend(q, layer, at)
        ids, sims = self._beam(q, at, down_to, min(beam, max(self.size, 1)))
        if reach is not None and beam < self.size:
            full = np.flatnonzero((ids[:, -1] >= 0) & (sims[:, -1] >= reach))
            if len(full):
                more, val = self.search(q[full], beam * 2, down_to, reach)
                pad = more.shape[1] - ids.shape[1]
                if pad > 0:
                    ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
                    sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-2)
                ids[full, :more.shape[1]], sims[full, :more.shape[1]] = more, val
        return ids, sims

    def _beam(self, q, at, layer, beam):
        n, size = len(q), max(self.size, 1)
        ids = np.full((n, beam), -1, dtype=np.int32)
        sims = np.full((n, beam), -2.0, dtype=q.dtype)
        done = np.ones((n, beam), dtype=bool)
        ids[:, 0], sims[:, 0], done[:, 0] = at, np.einsum("ij,ij->i", q, self.x[at]), False
        seen = np.zeros(n * size, dtype=bool)
        seen[np.arange(n) * size + at] = True
        links = self.links[layer]
        width = links.shape[1]
        near, far = np.empty((2, PAIRS, q.shape[1]), dtype=q.dtype)
        live = np.arange(n)
        while True:
            open_ = ~np.take(done, live, axis=0)
            first = open_.argmax(1)             # 0 also where none is open
            some = np.take(open_.ravel(), first + np.arange(len(live)) * beam)
            live, first = live[some], first[some]
            if not len(live):
                return ids, sims
            flat = live * beam + first
            done.ravel()[flat] = True
            nb = np.take(links, np.take(ids.ravel(), flat), axis=0)
            spot = (nb + (live * size)[:, None]).ravel()
            at_ = np.flatnonzero((nb.ravel() >= 0) & ~np.take(seen, spot, mode="clip"))
            if not len(at_):
                continue
            seen[spot[at_]] = True
            r, to = np.take(live, at_ // width), np.take(nb.ravel(), at_)
            val = np.full(nb.shape, -2.0, dtype=q.dtype)
            for k in range(0, len(at_), PAIRS):     # few at a time: both sides stay in the cache
                m = min(PAIRS, len(at_) - k)
                np.take(q, r[k:k + m], axis=0, out=near[:m], mode="clip")
                np.take(self.x, to[k:k + m], axis=0, out=far[:m], mode="clip")
                val.ravel()[at_[k:k + m]] = np.einsum("ij,ij->i", near[:m], far[:m])
            hit = np.flatnonzero(val.max(1) > sims[live, -1])       # rows whose beam changes
            if not len(hit):
                continue
            h, val = live[hit], val[hit]
            fresh = val > -2
            all_s = np.concatenate([np.take(sims, h, axis=0), val], axis=1)
            all_i = np.concatenate([np.take(ids, h, axis=0), np.where(fresh, nb[hit], -1)], axis=1)
            all_d = np.concatenate([np.take(done, h, axis=0), ~fresh], axis=1)
            order = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
            order += (np.arange(len(h)) * (beam + width))[:, None]
            sims[h] = np.take(all_s.ravel(), order)
            ids[h] = np.take(all_i.ravel(), order)
            done[h] = np.take(all_d.ravel(), order)

    def _diverse(self, node: np.ndarray, cand: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
        """Up to k of ``cand`` (best first), each nearer to the node than to any
        one chosen before; free slots go to the nearest left out."""
        if len(cand) <= k:
            return cand
        among = self.x[cand] @ self.x[cand].T
        chosen, worst = [], np.full(len(cand), -2.0)
        for i in range(len(cand)):
            if sims[i] > worst[i]:
                chosen.append(i)
                if len(chosen) == k:
                    break
                np.maximum(worst, among[i], out=worst)
        if len(chosen) < k:
            left = np.setdiff1d(np.arange(len(cand)), chosen, assume_unique=True)
            chosen += left[:k - len(chosen)].tolist()
        return cand[np.array(chosen)]

    def insert(self, nodes: np.ndarray, levels: np.ndarray, beam: int):
        """Nodes (the next ids in order), found in the graph so far and among
        each other, are linked in both directions on every layer they belong to."""
        x = self.x[nodes]
        start = self.size
        high = int(levels.max())
        old_high = len(self.links) - 1
        on = {layer: np.flatnonzero(levels >= layer) for layer in range(high + 1)}
        # all searches come before the first new link
        found = {k: self.search(x[on[k]], beam, k) for k in range(min(high, old_high) + 1)} if start else {}
        self._ensure(high)
        for layer, mine in on.items():
            group = nodes[mine]
            near = x[mine] @ x[mine].T
            np.fill_diagonal(near, -2)
            got_i, got_s = found.get(layer, (None, None))
            k = min(beam, len(group) - 1)
            back: dict[int, list] = {}
            for j, node in enumerate(group):
                cand, val = np.empty(0, np.int64), np.empty(0)
                if k > 0:
                    o = np.argpartition(-near[j], k - 1)[:k]
                    cand, val = group[o], near[j][o]
                if got_i is not None:
                    ok = got_i[j] >= 0
                    cand, val = np.concatenate([cand, got_i[j][ok]]), np.concatenate([val, got_s[j][ok]])
                o = np.argsort(-val, kind="stable")[:beam]
                pick = self._diverse(node, cand[o].astype(np.int64), val[o], DEGREE)
                self.links[layer][node, :len(pick)] = pick
                for p in pick.tolist():
                    back.setdefault(p, []).append(int(node))
            for p, add in back.items():
                have = self.links[layer][p]
                both = np.array(list(dict.fromkeys(have[have >= 0].tolist() + add)), dtype=np.int64)
                slots = self._slots(layer)
                if len(both) > slots:
                    val = self.x[both] @ self.x[p]
                    o = np.argsort(-val, kind="stable")
                    both = self._diverse(p, both[o], val[o], slots - slots // 4)
                self.links[layer][p] = -1
                self.links[layer][p, :len(both)] = both
        if high > old_high:
            self.top = int(nodes[levels == high][0])
        self.size = start + len(nodes)


def _angle(sims):
    return np.arccos(np.clip(sims, -1.0, 1.0))


def _levels(keys: np.ndarray) -> np.ndarray:
    """Layer of each node: a sixteenth of each layer's nodes reach the next."""
    h = (keys.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    out = np.zeros(len(keys), dtype=np.int64)
    for _ in range(12):
        up = (h & np.uint64(15)) == 0
        out[up] += 1
        h = np.where(up, h >> np.uint64(4), np.uint64(1))
    return out


class Shard:
    """Balls of one shard's unit vectors and the graph of their leaders."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, cos: float):
        self.cos, self.link = cos, math.acos(cos)
        self.rows, self.beam, self.recall = rows, BEAM, 1.0
        n, half = len(x), math.cos(self.link / 2) + SLACK
        levels = _levels(rows)
        lead = np.empty((n, x.shape[1]), dtype=x.dtype)
        graph = Graph(lead)
        leader_row, ball, cosine = [], np.empty(n, dtype=np.int64), np.ones(n)
        at = 0
        while at < n:
            size = min(max(at, 16), BLOCK)
            part = np.arange(at, min(at + size, n))
            q = x[part]
            open_ = np.ones(len(part), dtype=bool)
            if graph.size:
                ids, sims = graph.search(q, BEAM)
                joins = sims[:, 0] >= half
                ball[part[joins]], cosine[part[joins]] = ids[joins, 0], sims[joins, 0]
                open_ = ~joins
            near = q @ q.T
            fresh = []                      # positions in the block that lead a ball
            for i in np.flatnonzero(open_):
                if fresh:
                    s = near[i, fresh]
                    j = int(s.argmax())
                    if s[j] >= half:
                        ball[part[i]], cosine[part[i]] = graph.size + j, s[j]
                        continue
                ball[part[i]] = graph.size + len(fresh)
                fresh.append(i)
            if fresh:
                nodes = np.arange(graph.size, graph.size + len(fresh))
                lead[nodes] = q[fresh]
                leader_row.extend(part[fresh].tolist())
                graph.insert(nodes, levels[part[fresh]], BEAM)
            at += len(part)
        self.graph, self.leader = graph, np.array(leader_row, dtype=np.int64)
        graph.x = lead[:graph.size]
        graph.links = [a[:graph.size] for a in graph.links]
        self._balls(x, ball, cosine)

    def _balls(self, x, ball, cosine):
        by = np.lexsort((_angle(cosine), ball))     # members of a ball side by side, nearest first
        self.rows_by, self.x_by = self.rows[by], x[by]
        self.away = _angle(cosine[by])
        self.start = np.searchsorted(ball[by], np.arange(self.graph.size + 1))
        self.radius = self.away[self.start[1:] - 1]
        self.lead_rows = self.rows[self.leader]
        self.reach = math.cos(min(math.pi, self.link + float(self.radius.max()) + SLACK))

    def audit(self, goal: float = RECALL, count: int = AUDIT):
        """Widen the beam until turned members find the leaders in their reach."""
        rng = np.random.default_rng(len(self.rows))
        pick = np.linspace(0, len(self.x_by) - 1, min(count, len(self.x_by))).astype(np.int64)
        v = self.x_by[pick]
        w = rng.standard_normal(v.shape)
        w -= np.einsum("ij,ij->i", w, v)[:, None] * v
        norm = np.linalg.norm(w, axis=1, keepdims=True)
        q = self.cos * v + math.sqrt(1 - self.cos ** 2) * w / np.where(norm > 0, norm, 1)
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        truth = q @ self.graph.x.T >= self.reach
        while True:
            ids, sims = self.graph.search(q, self.beam, reach=self.reach)
            hit = (ids >= 0) & (sims >= self.reach)
            self.recall = hit.sum() / max(1, truth.sum())
            if self.recall >= goal or self.beam >= self.graph.size:
                return
            self.beam *= 2

    def query(self, q: np.ndarray, rows: np.ndarray):
        """(links per query, edge queries, edge rows): one edge per linked ball."""
        n = np.zeros(len(q), dtype=np.int64)
        if not len(q):
            return n, np.empty(0, np.int64), np.empty(0, np.int64)
        ids, sims = self.graph.search(q, self.beam, reach=self.reach)
        i, j = np.nonzero((ids >= 0) & (sims >= self.reach))
        ball = ids[i, j].astype(np.int64)
        angle = _angle(sims[i, j])
        sure = angle + self.radius[ball] <= self.link - SLACK
        n += np.bincount(i[sure], weights=(self.start[ball + 1] - self.start[ball])[sure],
                         minlength=len(q)).astype(np.int64)
        far = angle - self.radius[ball] > self.link + SLACK
        edge = sure.copy()
        for e in np.flatnonzero(~sure & ~far):
            a, b = self.start[ball[e]], self.start[ball[e] + 1]
            # members near enough to the leader are in, those too far are out
            low = a + np.searchsorted(self.away[a:b], self.link - SLACK - angle[e])
            skip = a + np.searchsorted(self.away[a:b], angle[e] - self.link - SLACK)
            low = max(low, a)
            got = low - a + int((self.x_by[max(low, skip):b] @ q[i[e]] >= self.cos).sum())
            n[i[e]] += got
            edge[e] = got > 0
        to = self.lead_rows[ball]
        return n, i[edge], to[edge]


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)         # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _build(cos: float, dim: int):
    """One shard's vectors to rows of its stored form."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        x = unit_rows(np.concatenate(pdf["_x"].to_numpy()), dim)
        s = Shard(x, pdf["_row"].to_numpy(), cos)
        s.audit()
        size, width = s.graph.size, np.diff(s.start)
        ball = np.repeat(np.arange(size), width)
        node = np.full(len(s.rows_by), -1, dtype=np.int64)
        node[s.start[:-1] + _leader_place(s)] = np.arange(size)
        links = [[a[k][a[k] >= 0].tolist() for a in s.graph.links] if k >= 0 else None for k in node]
        return pd.DataFrame({
            "_shard": pdf["_shard"].iloc[0], "_row": s.rows_by, "_x": list(s.x_by), "_ball": ball,
            "_away": s.away, "_node": node, "_links": links, "_lead": s.lead_rows[ball],
            "_beam": s.beam, "_top": s.graph.top, "_recall": float(s.recall)})
    return run


def _leader_place(s: Shard) -> np.ndarray:
    """Where each leader stands among its ball's members."""
    hit = s.rows_by == np.repeat(s.lead_rows, np.diff(s.start))
    return np.flatnonzero(hit) - s.start[:-1]


BUILT = ("_shard int, _row long, _x array<double>, _ball long, _away double, _node long, "
         "_links array<array<int>>, _lead long, _beam long, _top long, _recall double")


def _load(t: pa.Table, cos: float, dim: int) -> Shard:
    """A shard from its stored rows (in any order)."""
    ball, away, node = (t[c].to_numpy() for c in ("_ball", "_away", "_node"))
    by = np.lexsort((node < 0, away, ball))
    s = Shard.__new__(Shard)
    s.cos, s.link = cos, math.acos(cos)
    s.x_by = t["_x"].combine_chunks().flatten().to_numpy().reshape(-1, dim)[by]
    s.rows_by, s.away = t["_row"].to_numpy()[by], away[by]
    size = int(ball.max()) + 1
    s.start = np.searchsorted(ball[by], np.arange(size + 1))
    s.radius = s.away[s.start[1:] - 1]
    s.reach = math.cos(min(math.pi, s.link + float(s.radius.max()) + SLACK))
    s.beam = int(t["_beam"][0].as_py())
    lead = np.flatnonzero(node >= 0)
    lead = lead[np.argsort(node[lead])]
    s.lead_rows = t["_row"].to_numpy()[lead]
    raw = t["_links"].take(pa.array(lead)).to_pylist()
    layers = len(raw[0])
    links = []
    for k in range(layers):
        a = np.full((size, DEGREE * 2 if k == 0 else DEGREE), -1, dtype=np.int32)
        for i, r in enumerate(raw):
            a[i, :len(r[k])] = r[k]
        links.append(a)
    x = t["_x"].combine_chunks().take(pa.array(lead)).flatten().to_numpy().reshape(-1, dim)
    s.graph = Graph(np.ascontiguousarray(x), links, size)
    s.graph.top = int(t["_top"][0].as_py())
    return s


def _ask(share, dim: int):
    """mapInArrow function: every vector against one shard."""
    def run(batches):
        s = share.value
        block = max(16, min(BLOCK, (32 << 20) // s.graph.size))
        for b in batches:
            rows = b.column(0).to_numpy()
            x = unit_rows(b.column(1).flatten().to_numpy(), dim) if len(rows) else np.empty((0, dim))
            for a in range(0, len(rows), block):
                own = rows[a:a + block]
                n, i, to = s.query(x[a:a + block], own)
                has = np.flatnonzero(n)
                cut = np.searchsorted(i, np.append(has, len(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[has]), pa.array(n[has]),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(to))],
                    ["_row", "_n", "_to"])
    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows numbered (``_row``), with ``_x`` NULL where nothing can link."""
    v = F.col(vec_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).alias("_id"), F.when(good, v).alias("_x")).withColumn(
        "_row", F.monotonically_increasing_id())


def _links_of(rows: DataFrame, cos: float, dim: int, count: int, min_shards: int, shard_rows: int):
    """(link counts, edges) among the vectors of one length."""
    spark = rows.sparkSession
    shards = max(min_shards, math.ceil(count / shard_rows))
    named = rows.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int"))
    built = staged(named.repartition(shards, "_shard").groupBy("_shard").applyInPandas(_build(cos, dim), BUILT), "hnsw-shards")
    counts, edges = [], [built.filter("_row <> _lead").select(F.col("_row").alias("_a"), F.col("_lead").alias("_b"))]
    for i in range(shards):
        t = built.filter(F.col("_shard") == i).drop("_shard", "_lead", "_recall").toArrow()
        if not t.num_rows:
            continue
        share = spark.sparkContext.broadcast(_load(t, cos, dim))
        got = staged(rows.select("_row", "_x").mapInArrow(_ask(share, dim), "_row long, _n long, _to array<long>"), "hnsw-found")
        share.destroy()
        counts.append(got.select("_row", "_n"))
        edges.append(got.select(F.col("_row").alias("_a"), F.explode("_to").alias("_b")).filter("_a <> _b"))
    return counts, edges


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cos: float = 0.9,
                    min_shards: int = MIN_SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    A vector that is NULL, empty, zero, or holds a NULL or non-finite component
    links with nothing; vectors link only with vectors of their own length.
    Rows that repeat an id or a vector are rows of their own: copies link, and
    each counts.  A NULL id keeps its row; it names no component unless the
    component holds no other id (then component_id is NULL and the row is kept).
    An empty table gives an empty result.
    """
    ids = id_type(vectors, id_col)
    rows = staged(usable(vectors, id_col, vec_col), "hnsw-rows")
    sizes = rows.filter("_x is not null").groupBy(F.size("_x").alias("d")).count().collect()
    counts, edges = [], []
    for r in sizes:
        own = rows.filter(F.size("_x") == r["d"])
        c, e = _links_of(own, cos, r["d"], r["count"], min_shards, shard_rows)
        counts += c
        edges += e
    if not counts:
        return rows.select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("_id").cast(ids).alias("component_id"), F.lit(True).alias("kept"))
    # every usable vector has met itself once, in its own ball
    n = _union(counts).groupBy("_row").agg((F.sum("_n") - 1).alias("_n"))
    comp = components(_union(edges).distinct())
    tagged = staged(rows.select("_row", "_id").join(n, "_row", "left")
                    .join(comp.withColumnRenamed("_node", "_row"), "_row", "left")
                    .select("_id", F.coalesce("_n", F.lit(0)).cast("long").alias("_n"),
                            "_root"), "hnsw-tagged")
    least = tagged.filter("_root is not null").groupBy("_root").agg(F.min("_id").alias("_least"))
    return (tagged.join(least, "_root", "left")
            .select(F.col("_id").alias(id_col), F.col("_n").alias("n_links"),
                    F.when(F.col("_root").isNull(), F.col("_id")).otherwise(F.col("_least")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
