"""Subword ids from a public tokenizer's vocabulary file.

The file is read on the driver (a few MB, set by the vocabulary, not by the
data) and broadcast; every task rebuilds the encoder once and encodes whole
Arrow batches.  Nothing is trained here: merges and ids are the file's.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAD_ID = 0
TEXT_CHARS = 1 << 18    # characters of texts encoded at a time; a longer text is encoded alone
DEFAULT_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    """Where a public tokenizer's file lies: $LAKELENS_TOKENIZERS, else the installed files."""
    base = os.environ.get("LAKELENS_TOKENIZERS")
    if base:
        return os.path.join(base, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def _encoder(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        share = spark.sparkContext.broadcast(f.read())
    made = []

    def get():
        if not made:
            from tokenizers import Tokenizer
            t = Tokenizer.from_str(share.value)
            t.encode_special_tokens = True      # their strings in a text are ordinary text
            made.append(t)
        return made[0]
    return get


def _chunks(col: pa.Array):
    """The texts of an Arrow column in runs of at most TEXT_CHARS characters: an
    encoding takes some hundred bytes a subword, far more than its text."""
    held, size = [], 0
    for x in col:
        t = x.as_py() or ""
        if held and size + len(t) > TEXT_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _kind(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def subword_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", max_len: int = 128,
                   bos: int | None = None, eos: int | None = None, pad: int = PAD_ID) -> DataFrame:
    """One row per input row: id, n_tokens (of the whole text, before the cut),
    input_ids (``bos``, the first subwords, ``eos``; padded to ``max_len``) and
    attention_mask.  NULL and empty texts hold the special ids alone."""
    get = _encoder(docs.sparkSession, path)
    head, tail = [bos] if bos is not None else [], [eos] if eos is not None else []
    room = max_len - len(head) - len(tail)

    def run(batches):
        t = get()
        for b in batches:
            at = 0
            for texts in _chunks(b.column(1)):
                n, ids, mask = [], [], []
                for e in t.encode_batch(texts, add_special_tokens=False):
                    got = e.ids
                    own = head + got[:room] + tail
                    n.append(len(got))
                    ids.append(own + [pad] * (max_len - len(own)))
                    mask.append([1] * len(own) + [0] * (max_len - len(own)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(mask, pa.list_(pa.int32()))], ["_id", "n_tokens", "input_ids", "attention_mask"])
                at += len(texts)

    schema = f"_id {_kind(docs, id_col)}, n_tokens long, input_ids array<int>, attention_mask array<int>"
    return docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema) \
        .withColumnRenamed("_id", id_col)


def subword_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """id, piece, count over all texts, for the subwords that occur.  Counts are
    added up per batch before they are shuffled."""
    get = _encoder(docs.sparkSession, path)

    def run(batches):
        t = get()
        for b in batches:
            total = np.zeros(t.get_vocab_size(), np.int64)
            for texts in _chunks(b.column(0)):
                ids = [np.asarray(e.ids, dtype=np.int64) for e in t.encode_batch(texts, add_special_tokens=False)]
                total += np.bincount(np.concatenate(ids), minlength=len(total))
            u = np.flatnonzero(total)
            n = total[u]
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.astype(np.int32)), pa.array([t.id_to_token(int(i)) for i in u], pa.string()),
                 pa.array(n.astype(np.int64))], ["id", "piece", "n"])

    part = docs.select(F.col(text).alias("_text")).mapInArrow(run, "id int, piece string, n long")
    return part.groupBy("id", "piece").agg(F.sum("n").alias("count"))
