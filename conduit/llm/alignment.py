"""Alignment of two tokenizers' tokens: as-of joins of token starts, keyed by document.

A batch's texts are encoded by both sides. Tokens of a document cover the same bytes on
both sides, so the token of the other side that covers a token's start is the last one
that starts no later: one ``merge_asof`` gives it for all tokens of one side. Both
directions together are all pairs of tokens that overlap. Where two tokens end at the
same byte, a group of tokens ends.

How often a pair of ids is linked is counted by documents: a block of documents sends
each of its pairs once, with the number of its documents that have it, and gets the
corpus's count back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conduit.llm.blocks import answered, block_bytes, gathered, packed, stored, unpacked
from conduit.llm.bpe import ChunkTable, _byte_letters, gather
from conduit.llm.common import batch, ship, steps, texts_of
from conduit.llm.sentencepieces import PieceCoder
from conduit.session import cut_lineage

_PER_DOCUMENT = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in (*_PER_DOCUMENT, "sizes", "rises", "times")]
    + [("digests", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))]
)
_BLOCKS_SQL = (
    "block long, docs array<long>, n_a binary, n_b binary, n_groups binary, n_links binary, sizes binary, rises binary, times binary, "
    "digests array<string>, pairs array<long>, holders array<long>"
)
_ALIGNED = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())]
)
_ALIGNED_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteCoder(ChunkTable):
    """Ids of whole texts by the byte-level tokenizer at ``path``; one per worker and file.

    A chunk is a run of white space and what follows up to the next one, or up to a mark
    behind a plain letter. It begins with white space only behind a character that is no
    white space of any kind, so no pre-token and no look ahead of the tokenizer's pattern
    reaches over its ends. Texts of special tokens are plain text.
    """

    _made: dict[str, "ByteCoder"] = {}

    @classmethod
    def of(cls, path: str) -> "ByteCoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = {letter: b for b, letter in _byte_letters().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        shown = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            shown[i] = entry.encode() if entry in special else bytes(byte[c] for c in entry)
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_count = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown_begin = np.cumsum(self.shown_count) - self.shown_count
        self.space = np.zeros(256, bool)
        self.space[list(b" \t\n\v\f\r")] = True
        self.letter, self.mark = np.zeros(256, bool), np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.mark[list(b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~\\")] = True  # none begins a contraction
        super().__init__()

    def _chunks(self, texts):
        buffer = b"\xff".join([*texts, b""]) or b"\xff"
        code = np.frombuffer(buffer, np.uint8)
        ahead = np.r_[np.full(3, 255, np.uint8), code]
        one, two, three = ahead[2:-1], ahead[1:-2], ahead[:-3]  # the bytes before each
        wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
        wide |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
        wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
        wide |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
        wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
        stop = code == 255  # no text has the byte 255
        starts = np.r_[True, stop[:-1]] & ~stop
        gap = self.space[code] & (one > 32) & (one != 127) & ~wide
        begin = np.flatnonzero(starts | gap | (self.letter[one] & self.mark[code]))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.cumsum(sizes)
        last = np.flatnonzero(stop)[np.searchsorted(bounds, begin, side="right")] if len(begin) else np.zeros(0, np.int64)
        end = np.minimum(np.r_[begin[1:], len(code)], last) if len(begin) else last
        return buffer, code, begin, end, np.searchsorted(begin, np.r_[0, bounds])

    def _learn(self, chunks: list[bytes], names: list[int]) -> None:
        found = [x.ids for x in self.tokenizer.encode_batch([c.decode() for c in chunks], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self._add(names, np.array([i for ids in found for i in ids], np.int32), counts)


class PieceSide(PieceCoder):
    """The piece model's ids, where the library itself encodes new stretches."""

    _made: dict[str, "PieceSide"] = {}

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__(path)

    def _learn(self, chunks: list[bytes], names: list[int]) -> None:
        bare = [k for k, c in enumerate(chunks) if c == b" "]  # the library gives a lone space no id
        if bare:
            super()._learn([b" "], [names[bare[0]]])
            chunks, names = ([x for k, x in enumerate(xs) if k != bare[0]] for xs in (chunks, names))
        found = self.model.encode([c.decode()[1:] for c in chunks], num_threads=1)  # it adds the first space
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self._add(names, np.array([i for ids in found for i in ids], np.int32), counts)


class Side:
    """One side's tokens of a batch: ids, the document of each, and where it begins and ends."""

    def __init__(self, coder, texts: list[bytes], lines: list[bytes]):
        ids, counts = coder.encode(texts)
        shown = coder if hasattr(coder, "shown") else coder.vocabulary
        self.size = shown.shown_count[ids]
        data = gather(shown.shown, shown.shown_begin[ids], self.size).tobytes()
        ends = np.r_[0, np.cumsum(self.size)][np.r_[0, np.cumsum(counts)]].tolist()
        self.whole = np.array([data[a:b] == line for a, b, line in zip(ends, ends[1:], lines)], bool)
        self.ids, self.counts = ids.astype(np.int64), counts

    def keep(self, whole: np.ndarray) -> None:
        """Drop the tokens of documents that have none by rule, and place the others."""
        stay = np.repeat(whole, self.counts)
        self.ids, self.size = self.ids[stay], self.size[stay]
        self.counts = np.where(whole, self.counts, 0)
        self.doc = np.repeat(np.arange(len(whole)), self.counts)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size


def links_of(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all overlapping pairs: the covering token of each start, both ways."""
    if not len(a.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = pd.DataFrame({"doc": a.doc, "at": a.start, "a": np.arange(len(a.ids))})
    right = pd.DataFrame({"doc": b.doc, "at": b.start, "b": np.arange(len(b.ids))})
    forth = pd.merge_asof(left, right, on="at", by="doc")
    back = pd.merge_asof(right, left, on="at", by="doc")
    of_b = back["a"].to_numpy()
    new = a.start[of_b] != b.start[back["b"].to_numpy()]  # equal starts are found both ways
    return np.r_[forth["a"].to_numpy(), of_b[new]], np.r_[forth["b"].to_numpy(), back["b"].to_numpy()[new]]


def groups_of(a: Side, b: Side, words: tuple) -> tuple[np.ndarray, list[str]]:
    """How many groups each document has, and the digests of their texts."""
    comma, bar, semicolon = words
    last_a, last_b = np.isin(a.end, b.end), np.isin(b.end, a.end)
    of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # the group of each token
    out = np.empty(len(a.ids) + len(b.ids), object)
    out[np.arange(len(a.ids)) + np.searchsorted(of_b, of_a, "left")] = np.where(last_a, bar[a.ids], comma[a.ids])
    out[np.arange(len(b.ids)) + np.searchsorted(of_a, of_b, "right")] = np.where(last_b, semicolon[b.ids], comma[b.ids])
    ends = np.r_[0, np.cumsum(a.counts + b.counts)].tolist()
    texts = ["".join(out[i:j].tolist())[:-1] for i, j in zip(ends, ends[1:])]
    many = np.bincount(a.doc[last_a], minlength=len(a.counts))
    return many, [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]


def _aligned_step(texts: list[bytes], coder_a: ByteCoder, coder_b: PieceSide, base: int, words: tuple):
    """Per document: counts and digest; and its distinct pairs with the number of their links."""
    lines = [b" " + t for t in texts]
    a, b = Side(coder_a, lines, lines), Side(coder_b, texts, lines)
    whole = a.whole & b.whole & np.array([bool(t) for t in texts], bool)
    a.keep(whole)
    b.keep(whole)
    x, y = links_of(a, b)
    doc = a.doc[x]
    groups, digests = groups_of(a, b, words)
    code = a.ids[x] * base + b.ids[y]
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])]) if len(doc) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(doc)])
    n = len(texts)
    per = (a.counts, b.counts, groups, np.bincount(doc, minlength=n))
    return per, digests, np.bincount(doc[first], minlength=n), code[first], times


def _blocks(rows: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    limit = block_bytes()

    def run(batches):
        coder_a, coder_b = ByteCoder.of(byte_level), PieceSide.of(pieces)
        base = coder_b.model.vocab_size()
        ids = range(max(base, len(coder_a.shown_count)))
        words = tuple(np.array([f"{i}{mark}" for i in ids], object) for mark in ",|;")
        for block, docs, texts in gathered(batches, limit):
            parts = [_aligned_step(texts[i:j], coder_a, coder_b, base, words) for i, j in steps([len(t) for t in texts])]
            per = [np.concatenate([p[0][k] for p in parts]) for k in range(4)]
            sizes, codes, times = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
            pairs, numbers, holders = np.unique(codes, return_inverse=True, return_counts=True)
            rises = np.diff(numbers, prepend=0)  # numbers rise within a document
            some = sizes[sizes > 0]
            begins = np.cumsum(some) - some
            rises[begins] = numbers[begins]
            yield batch(
                _BLOCKS,
                block=[block],
                docs=[docs],
                **{name: [packed(values)] for name, values in zip(_PER_DOCUMENT, per)},
                sizes=[packed(sizes)],
                rises=[packed(rises)],
                times=[packed(times)],
                digests=[[d for p in parts for d in p[1]]],
                pairs=[pairs],
                holders=[holders],
            )
        coder_a.forget()
        coder_b.forget()

    return rows.mapInArrow(run, _BLOCKS_SQL)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ran, ends = np.r_[0, np.cumsum(values)], np.cumsum(sizes)
    return ran[ends] - ran[ends - sizes]


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, documents)``: in how many documents of all blocks each pair of ids is linked."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
    return held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.holders").alias("documents"))


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row of ``docs``.

    A is the byte-level tokenizer file ``byte_level`` over a space and the text, B the
    piece model ``pieces`` over the text. Texts that are null or empty, or that either
    side's tokens do not spell byte by byte, have no tokens: zeros and an empty digest.
    A pair of ids counts once for every row that has it linked, so repeated rows and rows
    without a doc_id count like any other. Other columns play no part; an empty table
    gives none.
    """
    ship(docs.sparkSession)
    blocks = stored(_blocks(texts_of(docs), byte_level, pieces), "links")
    base = sentencepiece.SentencePieceProcessor(model_file=pieces).vocab_size()
    counts = cut_lineage(pair_counts(blocks), "pairs")
    side = F.expr(f"pair div {base}")
    highest = counts.groupBy(side.alias("a")).agg(F.max("documents").alias("highest"))
    judged = counts.join(highest, side == F.col("a")).select(
        "pair", "documents", (F.col("documents") == F.col("highest")).cast("long").alias("best")
    )
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(judged, "pair").select("block", F.col("at").cast("long").alias("at"), "documents", "best")

    def run(block, found):
        sizes, rises, times = (unpacked(block[c]) for c in ("sizes", "rises", "times"))
        some = sizes[sizes > 0]
        begins = np.cumsum(some) - some
        ran = np.cumsum(rises)
        numbers = ran - np.repeat(ran[begins] - rises[begins], some)
        documents, best = (found[c].to_numpy() for c in ("documents", "best"))
        return batch(
            _ALIGNED,
            doc_id=block["docs"],
            **{name: unpacked(block[name]) for name in _PER_DOCUMENT},
            n_best=_sums(best[numbers] * times, sizes),
            count_sum=_sums(documents[numbers] * times, sizes),
            groups_sha256=block["digests"],
        )

    return answered(blocks.drop("pairs", "holders"), answers, run, _ALIGNED_SQL)
