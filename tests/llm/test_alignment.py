"""Cross-tokenizer alignment against the libraries' tokens, compared pair by pair."""

import bisect
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from fixtures import documents, frame, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conduit.llm import alignment, blocks, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(a, b):
    shown = [i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or 174 <= i <= 255]
    letters = {chr(i): i for i in shown}
    for i in range(256):
        if i not in shown:
            letters[chr(256 + len(letters) - len(shown))] = i
    of_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return of_a, of_b


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain_aligned(docs):
    """Rows from the rules as they are stated, from all pairs of tokens of a document."""
    a, b = libraries()
    of_a, of_b = token_bytes(a, b)
    rows, holders = [], Counter()
    for d, text in docs:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        line = (" " + (text or "")).encode()
        parts = [of_a(i) for i in ids_a], [of_b(i) for i in ids_b]
        if not text or b"".join(parts[0]) != line or b"".join(parts[1]) != line:
            ids_a, ids_b, parts = [], [], ([], [])
        where = spans(parts[0]), spans(parts[1])
        links, k = [], 0
        for i, (s, e) in zip(ids_a, where[0]):
            while k and where[1][k][0] > s:
                k -= 1
            while k < len(ids_b) and where[1][k][1] <= s:
                k += 1
            j = k
            while j < len(ids_b) and where[1][j][0] < e:
                links.append((i, ids_b[j]))
                j += 1
        ends = sorted({e for _, e in where[0]} & {e for _, e in where[1]})
        groups = [[[], []] for _ in ends]
        for side, ids in enumerate((ids_a, ids_b)):
            for i, (_, e) in zip(ids, where[side]):
                groups[bisect.bisect_left(ends, e)][side].append(str(i))
        shown = ";".join("|".join(",".join(s) for s in g) for g in groups)
        rows.append((d, len(ids_a), len(ids_b), len(ends), links, hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
        holders.update(set(links))
    highest = Counter()
    for (i, _), n in holders.items():
        highest[i] = max(highest[i], n)
    return Counter(
        (d, na, nb, g, len(links), sum(holders[x] == highest[x[0]] for x in links), sum(holders[x] for x in links), sha)
        for d, na, nb, g, links, sha in rows
    )


def odd_texts():
    draw = random.Random(7)
    letters = ["a", "B", "7", "é", "à", "Ж", "日", "🙂", "'s", "'", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "\x00", ".", "<|endoftext|>", "<s>", "of", "the"]
    texts = [t for _, t, *_ in documents()]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(250)]
    return texts + ["a ▁ b", "▁", "\n\n  \n a", " lead", "tail ", "x" * 40_000, "é   \n b", prose(9, 3000)]


@pytest.mark.parametrize("size", [None, 2000])
def test_alignment_equals_brute_force(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    docs = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts())]
    docs += docs[3:6]
    frame_ = frame(spark, [(d, t, "en", 0.5, 1) for d, t in docs], 4).withColumn("pair", F.lit("x")).withColumn("n_a", F.lit(1))
    got, want = Counter(map(tuple, alignment.aligned(frame_, A, B).collect())), plain_aligned(docs)
    assert got == want
    assert sum(1 for r in want if r[1]) > 200


def test_no_rows_and_null_rows(spark):
    assert alignment.aligned(frame(spark, []), A, B).count() == 0
    nulls = frame(spark, [(None, None, None, None, None), (3, "", None, None, None)], 2)
    assert {tuple(r) for r in alignment.aligned(nulls, A, B).collect()} == {(d, 0, 0, 0, 0, 0, 0, "") for d in (None, 3)}


def test_whole_table(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op11_alignment(spark, folder).collect())) == plain_aligned(docs)


def test_chunks_of_every_character_equal_the_library():
    """No white space of any kind makes a chunk's ids depend on its neighbours."""
    a, _ = libraries()
    coder = alignment.ByteCoder.of(A)
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace() or c < 33 or 0x7F <= c < 0xB0]
    texts = [f" a{s}{t} {t}{s}b{s} {t} " for s in spaces for t in ("", "\n", " ", " ")]
    ids, counts = coder.encode([t.encode() for t in texts])
    want = [x.ids for x in a.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    coder.forget()
