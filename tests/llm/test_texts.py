"""Operators on single texts: encoding, packing, personal data, token counts, trees of hashes."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from fixtures import documents, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conduit.llm import merkle, packing, pii, sentencepieces, tokencounts
from conduit.llm.bpe import Coder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


odd_text = st.text(alphabet=st.sampled_from(list("aAbthe  n'sSé▁日\n\t🙂.,0\x00\x85<|ßİΣ")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(odd_text, max_size=5))
def test_pieces_equal_the_library(texts):
    coder = sentencepieces.PieceCoder.of(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, counts = coder.encode([t.encode() for t in texts])
    want = [model.encode(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w]
    assert coder.decode(ids, counts) == [model.decode(w) for w in want]


def test_piece_round_trips(spark, model):
    rows = sentencepieces.round_trips(frame(spark), PIECES).collect()
    texts = [r[1] or "" for r in documents()]
    assert Counter((r.n_ids, r.ids_crc32) for r in rows) == Counter(
        (len(w), zlib.crc32(struct.pack(f"<{len(w)}I", *w))) for w in map(model.encode, texts)
    )
    assert all(r.same for r in rows)
    assert sentencepieces.round_trips(frame(spark, []), PIECES).count() == 0
    back = sentencepieces.decoded(sentencepieces.encoded(frame(spark), PIECES), PIECES).collect()
    assert Counter(r.text for r in back) == Counter(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(odd_text, max_size=5))
def test_word_ids_equal_the_library(texts):
    want = [Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids for t in texts] if texts else []
    ids, counts = Coder.of(WORDS).encode([t.encode() for t in texts])
    assert ids.tolist() == [i for w in want for i in w]
    assert counts.tolist() == [len(w) for w in want]


def test_packing_holds_every_id_once(spark, tokenizer):
    rows = packing.pack(frame(spark), WORDS).collect()
    want = Counter()
    for doc_id, text, *_ in documents():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            want[doc_id, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_first_fit_takes_the_first_sequence_with_room():
    draw = random.Random(4)
    sizes = sorted((draw.randint(1, 100) for _ in range(300)), reverse=True)
    bins, offsets = packing.first_fit(sizes, 100)
    room: list[int] = []
    for size, found, offset in zip(sizes, bins, offsets):
        want = next((k for k, free in enumerate(room) if free >= size), len(room))
        if want == len(room):
            room.append(100)
        assert (found, offset) == (want, 100 - room[want])
        room[want] -= size


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.one_of(*(st.text(alphabet=st.sampled_from(list(a)), max_size=40) for a in ("ab1@.-+", "0123456789 -", "12.5", "+1 ().-9", "4+1 @.-é"))))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.spans_of(text) if s[0] in pii.BASE] == base_spans(text)


def test_personal_data(spark):
    rows = pii.personal_data(frame(spark)).collect()
    want = Counter()
    for doc_id, text, *_ in documents():
        spans = base_spans(text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[doc_id, sum(s[0] == "phone" for s in spans), hashlib.sha256(told.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_phone, r.base_sha256) for r in rows) == want
    masked = pii.without_personal_data(frame(spark))
    assert masked.schema == frame(spark).schema and masked.count() == len(documents())
    text = masked.where("text like 'Mail%'").first().text
    assert text == "Mail [email], [phone], [ip] and [card]."
    assert pii.personal_data(frame(spark, [])).count() == 0


def test_added_spans():
    text = "pay DE89 3704 0044 0532 0130 00 now, account no. 12345678, ftp://bob:pw@host/x or http://host/a@b"
    added = [(k, text[a:b]) for k, a, b in pii.spans_of(text) if k not in pii.BASE]
    assert added == [
        ("address", "ftp://bob:pw@host/x"),
        ("account", "DE89 3704 0044 0532 0130 00"),
        ("account", "12345678"),
    ]
    assert pii.masked("none here") == "none here"


def test_digit_runs_take_linear_time():
    assert pii.spans_of("1" * 200_000) == [] and pii.spans_of("1." * 100_000)[0][0] == "ip"
    assert pii.spans_of("a@" * 100_000) == []


@settings(max_examples=100, deadline=None)
@given(odd_text, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 70), odd_text), max_size=4))
def test_edited_counts_equal_a_whole_count(text, edits):
    counter = tokencounts.Counter.of(BYTES, public_tokenizers.PATTERN)
    text = text * 40
    tree = tokencounts.CountTree(counter, text)
    for start, end, insert in edits:
        start, end = start * 20, end * 20
        got = tree.edit(start, end, insert)
        start = min(start, len(text))
        text = text[:start] + insert + text[max(start, min(end, len(text))) :]
        assert got == len(counter.encoding.encode_ordinary(text)) and tree.length == len(text)


def test_counted(spark):
    rows = tokencounts.counted(frame(spark), BYTES, public_tokenizers.PATTERN).collect()
    counter = tokencounts.Counter.of(BYTES, public_tokenizers.PATTERN)
    want = Counter()
    for doc_id, text, *_ in documents():
        text = text or ""
        before, edited = len(counter.encoding.encode_ordinary(text)), text
        for start, end, insert in tokencounts.drawn_edits(text):
            edited = edited[:start] + insert + edited[end:]
        want[doc_id, len(text), before, len(edited), len(counter.encoding.encode_ordinary(edited))] += 1
    assert Counter((r.doc_id, r.n_chars, r.n_tokens, r.edited_chars, r.edited_tokens) for r in rows) == want
    long = next(r for r in rows if r.pretokens > 4000)
    assert long.reencoded < 400
    assert tokencounts.counted(frame(spark, []), BYTES, public_tokenizers.PATTERN).count() == 0


def test_given_edits(spark):
    rows = spark.sql(
        "select 1L doc_id, 'one two three' text, array(named_struct('start', 4L, 'end', 7L, 'insert', '2'), null) e"
        " union all select 2L, null, array(named_struct('start', null, 'end', 9L, 'insert', 'new'))"
        " union all select 3L, 'same', null"
    )
    out = {r.doc_id: r for r in tokencounts.counted(rows, BYTES, public_tokenizers.PATTERN, "e").collect()}
    assert (out[1].edited_chars, out[2].edited_chars, out[3].edited_chars) == (11, 3, 4)
    assert out[3].reencoded == 0


def test_document_prints(spark):
    rows = merkle.document_prints(frame(spark)).collect()
    docs = [(d, t or "") for d, t, *_ in documents()]
    assert len(rows) == len(docs)
    named = sorted((d, t) for d, t in docs if d is not None)
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((d, merkle.fingerprint(t)) for d, t in docs)
    follows = {named[k][1]: named[k + 1][1] for k in range(len(named) - 1)}
    for r in rows:
        text = dict(named).get(r.doc_id)
        if text is not None and r.doc_id not in (named[-1][0], documents()[3][0]):
            following = named[max(k for k, (d, _) in enumerate(named) if d == r.doc_id) + 1][1]
            edited = merkle.edited(text, following)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.edited_fingerprint == merkle.fingerprint(edited)
            assert r.near_next == merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(following))
    assert follows and merkle.document_prints(frame(spark, [])).count() == 0


def test_followers_over_many_partitions(spark):
    texts = {i * 3: prose(i, 30) for i in range(200)}
    rows = [(i, t, None, None, None) for i, t in texts.items()]
    out = {r.doc_id: r for r in merkle.document_prints(frame(spark, rows, 7)).collect()}
    ids = sorted(texts)
    for k, i in enumerate(ids):
        edited = merkle.edited(texts[i], texts[ids[(k + 1) % len(ids)]])
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_likeness_and_edits():
    one = "\n\n".join("\n".join(prose(10 * s + p, 12) + ". " + prose(500 + 10 * s + p, 9) + "." for p in range(4)) for s in range(5))
    two = one.replace(prose(21, 12), "something else", 1)
    a, b = merkle.fingerprint(one), merkle.fingerprint(two)
    assert a == merkle.fingerprint(one) and a.split("|")[0] != b.split("|")[0]
    assert merkle.edits(a, b) == [(2, 1)]
    assert 0.9 < merkle.likeness(a, b) < 1 and merkle.likeness(a, merkle.fingerprint(prose(99, 50))) < 0.1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1
    assert merkle.likeness(merkle.fingerprint(""), a) == 0


@pytest.mark.parametrize("piece", ["a://", "account", "account 1234567 ", "+1", "A1", " AA11", "12", "1.", "a@", "://x@", "a://x@"])
def test_hostile_texts_take_linear_time(piece):
    import time

    from conduit.llm import pii

    def seconds(size):
        begin = time.process_time()
        pii.spans_of(piece * (size // len(piece)))
        return time.process_time() - begin

    seconds(1000)
    assert seconds(400_000) < 2
