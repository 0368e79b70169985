"""Ranked lexical search by the Best Position Algorithm.

One pass over the documents keeps, per document, its length and the counts of
the terms some item asks for.  Each Spark partition of those rows is then an
index of its own: per term a list of (document, impact) by descending impact,
and the same list by document for direct access.  Items run over the lists of a
partition and give at most ``top`` documents each; the best ``top`` of all
partitions' survivors are the result, whatever the partitioning is.

Inside a partition an item reads all its lists side by side.  A document met in
one list is looked up in the others, which gives its whole score and its
*position* in each.  A list's best position is the end of the gapless run of
seen positions from its head; no unseen document stands at or before it, so its
score is at most the sum of the impacts right behind the best positions.  That
sum is never above the threshold by last-read positions, because direct accesses
lengthen the runs.  Reading stops once it is strictly below the ``top``-th
score (at equality an unseen document could still win by its smaller id).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_type, staged

# Bytes that are part of a term: digits, A-Z as a-z, a-z, and all of UTF-8 beyond ASCII.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
             for c in range(256))
ITEMS_PER_PASS = 2000       # items whose terms one pass over the documents looks for
STEP = 32                   # positions read from every list between two threshold tests


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased, in order."""
    return text.translate(FOLD).split()


def _counts(vocab: dict):
    """mapInArrow function: (id, n terms, wanted terms, their counts)."""
    def run(batches):
        for b in batches:
            ids, ns, ts, fs = [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                w = terms(text or b"")
                if w:
                    c = Counter(filter(vocab.__contains__, w))
                    ids.append(i)
                    ns.append(len(w))
                    ts.append([vocab[x] for x in c])
                    fs.append(list(c.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(ns, pa.int64()),
                 pa.array(ts, pa.list_(pa.int32())), pa.array(fs, pa.list_(pa.int64()))],
                ["_id", "_n", "_t", "_f"])
    return run


class Lists:
    """The impact lists of one partition."""

    def __init__(self, n, t, f, row, weight, total_rows, total_terms):
        """n: terms per document; t, f, row: term, count and document of each posting."""
        m = 50 + (50 * n * total_rows) // total_terms
        impact = weight[t] * ((1_000_000_000 * f) // (1000 * f + 20 * m[row]))
        by = np.lexsort((row, -impact, t))
        self.row, self.impact = row[by], impact[by]
        key = t[by]
        self.start = np.searchsorted(key, np.arange(len(weight) + 1))
        again = np.lexsort((self.row, key))         # per term by document, for direct access
        self.doc, self.place = self.row[again], (again - self.start[key[again]]).astype(np.int64)

    def list(self, term: int):
        a, b = self.start[term], self.start[term + 1]
        return self.row[a:b], self.impact[a:b], self.doc[a:b], self.place[a:b]


def best_positions(lists: Lists, item: list[int], n_rows: int, top: int, step: int = STEP):
    """(rows, scores, accesses) of one item: its rows with a score above 0 that
    may be among the ``top``, all ties of the last one included; ``accesses``
    counts the positions read in turn."""
    own = [x for x in (lists.list(t) for t in item) if len(x[0]) and x[1][0] > 0]
    seen = np.zeros(n_rows, dtype=bool)
    at = [np.zeros(len(x[0]) + 1, dtype=bool) for x in own]     # seen positions; the last stays unseen
    best = np.zeros(len(own), dtype=np.int64)
    rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    read = 0
    deep = 0
    while own and any(deep < len(x[0]) for x in own):
        new = np.unique(np.concatenate([x[0][deep:deep + step] for x in own]))
        read += sum(len(x[0][deep:deep + step]) for x in own)
        new = new[~seen[new]]
        seen[new] = True
        deep += step
        score = np.zeros(len(new), dtype=np.int64)
        for (_, impact, doc, place), mark in zip(own, at):
            i = np.searchsorted(doc, new)
            i[i == len(doc)] = 0
            hit = doc[i] == new
            p = place[i[hit]]
            mark[p] = True
            score[hit] += impact[p]
        rows, scores = np.concatenate([rows, new]), np.concatenate([scores, score])
        bound = 0
        for j, ((_, impact, _, _), mark) in enumerate(zip(own, at)):
            best[j] += np.argmin(mark[best[j]:])                # first unseen position
            bound += int(impact[best[j]]) if best[j] < len(impact) else 0
        if len(scores) >= top:
            kth = np.partition(scores, len(scores) - top)[len(scores) - top]
            keep = scores >= kth
            rows, scores = rows[keep], scores[keep]
            if bound < kth:
                break
    good = scores > 0
    return rows[good], scores[good], read


def _search(items: list[tuple[int, list[int]]], weight: np.ndarray, total_rows: int, total_terms: int, top: int):
    """mapInArrow function: the partition's candidates, (item number, id, score)."""
    def run(batches):
        ids, ns, ts, fs, sizes = [], [], [], [], []
        for b in batches:
            ids.append(b.column(0))
            ns.append(b.column(1).to_numpy())
            ts.append(b.column(2).flatten().to_numpy())
            fs.append(b.column(3).flatten().to_numpy())
            sizes.append(np.diff(b.column(2).offsets.to_numpy()))
        if not ids:
            return
        n, t, f = np.concatenate(ns), np.concatenate(ts), np.concatenate(fs)
        row = np.repeat(np.arange(len(n)), np.concatenate(sizes))
        lists = Lists(n, t, f, row, weight, total_rows, total_terms)
        ids = pa.chunked_array(ids)
        for number, item in items:
            rows, scores, _ = best_positions(lists, item, len(n), top)
            if len(rows) > top:        # the last score ties: the smallest ids of it stay
                got = ids.take(pa.array(rows)).to_pylist()
                order = sorted(range(len(rows)), key=lambda i: (-scores[i], got[i] is None, got[i] or 0))[:top]
                rows, scores = rows[order], scores[order]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), number, np.int64)), ids.take(pa.array(rows)).combine_chunks(),
                     pa.array(scores)], ["_item", "_id", "_score"])
    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", top: int = 50,
           items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item row.

    NULL, empty and termless texts hold no term: such a document is not counted
    and never ranked, such an item gives no row.  Repeated document rows are
    ranked one by one and take one rank each; repeated item rows give one list
    each.  Equal scores: ascending doc_id, NULL last.  Very long texts are read
    whole, one at a time.  Items are taken ``items_per_pass`` rows at a time
    (all of them, one pass over the documents each), so what is broadcast, one
    pass's terms, does not grow with the number of items.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).alias("_item"), F.col(item_text).cast("binary").alias("_text"))
    rows = staged(rows.withColumn("_no", F.monotonically_increasing_id()), "ranked-items")
    passes = max(1, math.ceil(rows.count() / items_per_pass))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    ids, item_ids = id_type(docs, id_col), id_type(items, item_col)
    found = None
    for i in range(passes):
        some = rows.filter(F.pmod(F.xxhash64("_no"), F.lit(passes)) == i).select("_no", "_text").collect()
        asked = [(r["_no"], sorted(set(terms(bytes(r["_text"] or b""))))) for r in some]
        vocab = {t: k for k, t in enumerate(sorted({t for _, ts in asked for t in ts}))}
        share = spark.sparkContext.broadcast(vocab)

        def count(batches, share=share):
            yield from _counts(share.value)(batches)
        kept = staged(texts.mapInArrow(count, f"_id {ids}, _n long, _t array<int>, _f array<long>"), "ranked-counts")
        total = kept.agg(F.count("*").alias("n"), F.sum("_n").alias("l")).first()
        if not total["n"]:
            df = {}
        else:       # one row per asked term
            df = dict(kept.select(F.explode("_t").alias("_t")).groupBy("_t").count().collect())
        weight = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * df.get(k, 0) + 1)))
                           for k in range(len(vocab))], dtype=np.int64)
        plan = spark.sparkContext.broadcast(([(no, [vocab[t] for t in ts]) for no, ts in asked], weight))

        def look(batches, plan=plan, n=total["n"], terms_=total["l"]):
            yield from _search(*plan.value, n, terms_, top)(batches)
        part = kept.mapInArrow(look, f"_item long, _id {ids}, _score long")
        w = Window.partitionBy("_item").orderBy(F.desc("_score"), F.col("_id").asc_nulls_last())
        part = staged(part.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= top), "ranked-found")
        share.unpersist()
        plan.unpersist()
        found = part if found is None else found.unionByName(part)
    named = rows.select(F.col("_no").alias("_item"), F.col("_item").cast(item_ids).alias("_name"))
    return (found.join(named, "_item")
            .select(F.col("_name").alias(item_col), F.col("_rank").alias("rank"), F.col("_id").alias(id_col),
                    F.col("_score").alias("score")))


def oracle_sql(top: int = 50) -> str:
    """Every document scored for every item in DuckDB."""
    cls = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH words AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all({fold.format('text')}, '{cls}') AS ws FROM documents),
    has AS (SELECT *, len(ws)::BIGINT AS n FROM words WHERE len(ws) > 0),
    tot AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM has),
    asked AS (SELECT DISTINCT no, item_id, t FROM (
        SELECT row_number() OVER () AS no, item_id,
          unnest(regexp_extract_all({fold.format('text')}, '{cls}')) AS t FROM
          (SELECT * FROM benchmark))),
    tf AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS t FROM has)
        WHERE t IN (SELECT t FROM asked) GROUP BY rid, t),
    df AS (SELECT t, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM tf, tot GROUP BY t),
    hit AS (SELECT no, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf
          + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
        FROM asked JOIN tf USING (t) JOIN df USING (t) JOIN has USING (rid), tot GROUP BY no, item_id, rid, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
      doc_id, score FROM hit WHERE score > 0 QUALIFY rank <= {top}"""
