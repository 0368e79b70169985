"""Subword ids against a plain merge loop over the same file, and an exact round trip."""
import json
import unicodedata
from collections import Counter

import pytest
import regex

from lakelens.operators import subwords

TEXTS = [(1, "The quick brown foxes weren't unbelievably tokenizable, 42 times!"), (2, ""), (3, None),
         (4, "été naïve 東京 <|endoftext|> ÀÉ"), (5, "word " * 400), (5, "word " * 400), (None, "no id"), (6, " \n\t ")]


def bytes_to_chars():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return out


def plain_bpe(path):
    model = json.load(open(path, encoding="utf-8"))["model"]
    rank = {tuple(m): i for i, m in enumerate(model["merges"])}
    vocab, chars = model["vocab"], bytes_to_chars()
    cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def encode(text):
        out = []
        for w in cut.findall(regex.sub(r"\s+", " ", unicodedata.normalize("NFC", text)).lower()):
            parts = [chars[b] for b in w.encode()]
            parts[-1] += "</w>"
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 1 << 30), i))
                pair = (parts[best], parts[best + 1])
                if pair not in rank:
                    break
                parts[best:best + 2] = ["".join(pair)]
            out += [vocab[p] for p in parts]
        return out
    return encode


def test_equals_plain_merges(spark):
    path = subwords.tokenizer_path("word_bpe_49k.json")
    encode = plain_bpe(path)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)).cache()
    want, counts = Counter(), Counter()
    for r in docs.collect():
        ids = encode(r["text"] or "")
        counts.update(ids)
        own = [49406] + ids[:126] + [49407]
        want[(r["doc_id"], len(ids), *own, *[0] * (128 - len(own)), sum(map(bool, own)))] += 1
    got = Counter((r["doc_id"], r["n_tokens"], *r["input_ids"], sum(r["attention_mask"])) for r in
                  subwords.subword_encode(docs, path, bos=49406, eos=49407).collect())
    assert got == want
    assert {r["id"]: r["count"] for r in subwords.subword_counts(docs, path).collect()} == dict(counts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_exact_round_trip(spark, name):
    from tokenizers import Tokenizer
    path = subwords.tokenizer_path(name)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    back = Tokenizer.from_file(path)
    longest = 2000
    for r, (_, text) in zip(subwords.subword_encode(docs.coalesce(1), path, max_len=longest).collect(), TEXTS):
        n = sum(r["attention_mask"])
        assert n == r["n_tokens"] <= longest
        assert back.decode(r["input_ids"][:n], skip_special_tokens=False) == (text or "")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert subwords.subword_encode(docs, subwords.tokenizer_path()).count() == 0
    assert subwords.subword_counts(docs, subwords.tokenizer_path()).count() == 0


def test_texts_are_encoded_in_bounded_runs(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(subwords, "TEXT_CHARS", 10)
    texts = ["abcd", "efgh", None, "ijk", "x" * 50, "", "lmno", "pqrstu", "v"]
    runs = list(subwords._chunks(pa.array(texts)))
    assert [t for r in runs for t in r] == [t or "" for t in texts]
    assert all(len(r) == 1 or sum(map(len, r)) <= 10 for r in runs) and len(runs) > 3
    assert list(subwords._chunks(pa.array([], pa.string()))) == []
