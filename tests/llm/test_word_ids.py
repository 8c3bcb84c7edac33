"""Byte-pair ids by distinct words against the library, and decoding back."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from fixtures import documents, frame, prose
from pyspark.sql import functions as F

from conduit.llm import blocks, queries, wordids

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=wordids.ranks_of(RANKS), special_tokens={})


def odd_texts():
    draw = random.Random(5)
    letters = ["a", "B", "7", "é", "Ж", "日", "🙂", "'s", "'", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "\x00", ".", "<|endoftext|>"]
    texts = [t for _, t, *_ in documents()]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(150)]
    return texts + ["x" * 100_000, " " * 5000, "\n\n  \n a", prose(9, 3000)]


@pytest.mark.parametrize("size, words", [(None, None), (1000, 40)])
def test_ids_equal_the_library(spark, monkeypatch, size, words):
    if size:  # many blocks and many ranges of hashes
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
        monkeypatch.setattr(wordids, "RANGE_WORDS", words)
    rows = [(i if i % 9 else None, t, None, None, None) for i, t in enumerate(odd_texts())]
    rows += rows[3:6]
    docs = frame(spark, rows, 4).withColumn("block", F.lit("x")).withColumn("ids", F.lit(1))
    code = library()
    want = Counter()
    for d, t, *_ in rows:
        ids = code.encode_ordinary(t or "")
        back = code.decode_bytes(ids)
        assert back == (t or "").encode()
        want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back).hexdigest()] += 1
    assert Counter(map(tuple, wordids.digests(docs, RANKS, PATTERN).collect())) == want
    ids = wordids.encoded(docs, RANKS, PATTERN)
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids.collect()) == Counter((d, tuple(code.encode_ordinary(t or ""))) for d, t, *_ in rows)
    back = wordids.decoded(ids, RANKS).collect()
    assert Counter((r.doc_id, bytes(r.data)) for r in back) == Counter((d, (t or "").encode()) for d, t, *_ in rows)


def test_no_rows_and_null_rows(spark):
    assert wordids.digests(frame(spark, []), RANKS, PATTERN).count() == 0
    nulls = frame(spark, [(None, None, None, None, None)] * 3, 2)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in wordids.digests(nulls, RANKS, PATTERN).collect()] == [(None, 0, empty, empty)] * 3
    rows = spark.createDataFrame([(1, None), (2, []), (None, [72, 105])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.data) for r in wordids.decoded(rows, RANKS).collect()}
    table = {i: b for b, i in wordids.ranks_of(RANKS).items()}
    assert got == {1: b"", 2: b"", None: table[72] + table[105]}
    bad = spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        wordids.decoded(bad, RANKS).collect()


def test_whole_table(spark, folder):
    code = library()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.ids_sha256 for r in queries.op13_byte_pairs(spark, folder).collect()}
    assert got == {r.doc_id: hashlib.sha256(",".join(map(str, code.encode_ordinary(r.text))).encode()).hexdigest() for r in docs}


def test_packed_numbers():
    for values in ([], [0], [1, 2**32 - 1, 7], list(range(70_000))):
        assert blocks.unpacked(blocks.packed(values)).tolist() == values
