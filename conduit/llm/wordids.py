"""Byte-level BPE over a corpus: each distinct word encoded once, its ids joined back by position.

Texts are cut into pre-tokens ("words") by the vocabulary's pattern. A block of documents
keeps the words' places as numbers and sends each of its distinct words once. The words of
all blocks are dealt by their hash; whoever gets a word encodes it once and sends its ids
back to every block that has it, where texts are put together again by position. Words of
a block are sent in slices by ranges of the hash, as many ranges as the number of all
blocks' words asks for, so that a slice's row is not longer than its words.

Decoding deals rows of ids in the same way: a block's distinct ids are joined with the
table of token bytes, and texts are put together from those.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.blocks import answered, block_bytes, gathered, packed, squeezed, stored, unpacked, unsqueezed
from conduit.llm.common import batch, byte_column, ship, sorted_by, texts_of

# Words of all blocks that one range of hashes is meant to hold.
RANGE_WORDS = 100_000
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.binary()), ("numbers", pa.binary()),
     ("order", pa.binary()), ("words", pa.binary()), ("lengths", pa.binary()), ("n_words", pa.int64())]
)
_BLOCKS_SQL = "block long, docs array<long>, sizes binary, numbers binary, order binary, words binary, lengths binary, n_words long"
_SLICES = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary())])
_IDS = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("counts", pa.binary()), ("ids", pa.binary())])


def ranks_of(path: str) -> dict[bytes, int]:
    """The vocabulary file: token bytes and their ranks, which are the ids."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _places(words: list[bytes]) -> np.ndarray:
    """Hashes of words, by which they are dealt: 62 bits."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(2)


def _blocks(docs: DataFrame, pattern: str) -> DataFrame:
    """One row per block: its documents, their words as numbers, and its distinct words by hash."""
    limit = block_bytes()

    def run(batches):
        cut = regex.compile(pattern).findall
        for block, keys, texts in gathered(batches, limit):
            number = defaultdict(count().__next__)
            found, sizes = [], []
            for text in texts:
                parts = cut(text.decode())
                found.append(np.fromiter(map(number.__getitem__, parts), np.uint32, len(parts)))
                sizes.append(len(parts))
            numbers = np.concatenate(found).astype(np.int64)
            words = [w.encode() for w in number]
            # frequent words get small numbers, which compress well
            by_use = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
            renamed = np.empty(len(words), np.int64)
            renamed[by_use] = np.arange(len(words))
            places = _places(words)
            by_place = np.argsort(places, kind="stable")
            order = np.empty(len(words), np.int64)  # of a number, its word's place among the hashes
            order[renamed[by_place]] = np.arange(len(words))
            words = [words[k] for k in by_place.tolist()]
            yield batch(
                _BLOCKS,
                block=[block],
                docs=[keys],
                sizes=[packed(sizes)],
                numbers=[packed(renamed[numbers])],
                order=[packed(order)],
                words=[squeezed(b"".join(words))],
                lengths=[packed(list(map(len, words)))],
                n_words=[len(words)],
            )

    return docs.mapInArrow(run, _BLOCKS_SQL)


def _split(data: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _slices(blocks: DataFrame) -> DataFrame:
    """``(range, block, words, lengths)``: each block's distinct words, by ranges of their hash."""
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = min(max(int(total) // RANGE_WORDS, 1).bit_length(), 40)

    def run(batches):
        for found in batches:
            for block, data, lengths in zip(*(found.column(k).to_pylist() for k in range(3))):
                data, lengths = unsqueezed(data), unpacked(lengths)
                ranges = (_places(_split(data, lengths)) >> np.uint64(62 - bits)).astype(np.int64)
                if not len(ranges):
                    continue
                first = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
                edges = np.r_[first, len(ranges)].tolist()
                ends = np.r_[0, np.cumsum(lengths)][edges].tolist()
                yield batch(
                    _SLICES,
                    range=ranges[first],
                    block=np.full(len(first), block),
                    words=[squeezed(data[a:b]) for a, b in zip(ends, ends[1:])],
                    lengths=[packed(lengths[a:b]) for a, b in zip(edges, edges[1:])],
                )

    return blocks.select("block", "words", "lengths").mapInArrow(run, "range long, block long, words binary, lengths binary")


def _word_ids(slices: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(block, at, counts, ids)`` of every slice: each distinct word of a range is encoded once."""

    def run(batches):
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks_of(ranks), special_tokens={})
        known, owner = {}, None
        for found in batches:
            counts, ids = [], []
            rows = zip(*(found.column(k).to_pylist() for k in (0, 2, 3)))
            for where, data, lengths in rows:
                if where != owner:
                    known, owner = {}, where  # ids by word, four bytes each
                words = _split(unsqueezed(data), unpacked(lengths))
                for word in words:
                    if word not in known:
                        known[word] = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                each = [known[w] for w in words]
                counts.append(packed(np.fromiter(map(len, each), np.int64, len(each)) >> 2))
                ids.append(packed(np.frombuffer(b"".join(each), "<u4")))
            yield batch(_IDS, block=found.column(1), at=found.column(0), counts=counts, ids=ids)

    dealt = sorted_by(slices, ["range"], ["range"])
    return dealt.mapInArrow(run, "block long, at long, counts binary, ids binary")


def _ids_by_position(docs: DataFrame, ranks: str, pattern: str, shown, ddl: str) -> DataFrame:
    """``shown(doc_id, ids)`` of every document, as a record batch a block of them."""
    blocks = stored(_blocks(texts_of(docs), pattern), "words")

    def run(block, answers):
        none = [np.zeros(0, np.int64)]
        counts, ids = (np.concatenate(none + [unpacked(x) for x in answers[c].to_pylist()]) for c in ("counts", "ids"))
        ends = np.cumsum(counts)
        order, numbers, sizes = (unpacked(block[c]) for c in ("order", "numbers", "sizes"))
        count_of, begin_of = counts[order], (ends - counts)[order]
        out, at = [], 0
        for size in sizes.tolist():
            own = numbers[at : at + size]
            at += size
            many = count_of[own]
            total = int(many.sum())
            offset = np.repeat(begin_of[own] - (np.cumsum(many) - many), many)
            out.append(ids[offset + np.arange(total)])
        return shown(block["docs"], out)

    asked = blocks.select("block", "docs", "sizes", "numbers", "order")
    return answered(asked, _word_ids(_slices(blocks), ranks, pattern), run, ddl)


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DECODED = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` of every row: the ids that the library gives the whole text.

    ``ranks`` is the vocabulary file's path. Null texts are empty ones, which have no ids.
    Other columns play no part; repeated rows come out alike; an empty table gives none.
    """
    ship(docs.sparkSession)

    def shown(keys, found):
        return batch(_ENCODED, doc_id=keys, ids=[x.astype(np.int32) for x in found])

    return _ids_by_position(docs, ranks, pattern, shown, "doc_id long, ids array<int>")


class TokenBytes:
    """The table of token bytes as arrays: of the vocabulary's size, one per worker and file."""

    _made: dict[str, "TokenBytes"] = {}

    @classmethod
    def of(cls, path: str) -> "TokenBytes":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        table = sorted((i, b) for b, i in ranks_of(path).items())
        size = np.zeros(table[-1][0] + 1, np.int64)
        size[[i for i, _ in table]] = [len(b) for _, b in table]
        self.size, self.begin = size, np.cumsum(size) - size
        self.flat = np.frombuffer(b"".join(b for _, b in table), np.uint8)
        self.decimal = np.array([str(i) for i in range(len(size))], object)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens one after the other."""
        many = self.size[ids]
        offset = np.repeat(self.begin[ids] - (np.cumsum(many) - many), many)
        return self.flat[offset + np.arange(len(offset))].tobytes()


def token_table(spark, ranks: str) -> DataFrame:
    """``(id, bytes)`` of every token of the vocabulary: as many rows as that has."""
    ship(spark)
    table = sorted((i, b) for b, i in ranks_of(ranks).items())
    ids, data = zip(*table)
    return spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "bytes": pa.array(data, pa.binary())}))


_ID_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.binary()), ("numbers", pa.binary()), ("distinct", pa.list_(pa.int64()))]
)


def _id_blocks(rows: DataFrame) -> DataFrame:
    """One row per block of ``rows(doc_id, ids)``: the places of its distinct ids as numbers."""
    limit = block_bytes()

    def made(block, keys, rows):
        distinct, numbers = np.unique(np.concatenate([np.asarray(r, np.int64) for r in rows]), return_inverse=True)
        sizes = packed(list(map(len, rows)))
        return batch(_ID_BLOCKS, block=[block], docs=[keys], sizes=[sizes], numbers=[packed(numbers)], distinct=[distinct])

    def run(batches):
        block = TaskContext.get().partitionId() << 24
        keys, held, total = [], [], 0
        for found in batches:
            for key, ids in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
                keys.append(key)
                held.append(ids or [])
                total += 4 * len(held[-1])
                if total > limit:
                    yield made(block, keys, held)
                    block, keys, held, total = block + 1, [], [], 0
        if keys:
            yield made(block, keys, held)

    return rows.mapInArrow(run, "block long, docs array<long>, sizes binary, numbers binary, distinct array<long>")


def decoded(rows: DataFrame, ranks: str) -> DataFrame:
    """``(doc_id, data)``: the bytes that every row of ``(doc_id, ids)`` stands for.

    A block's distinct ids are joined with :func:`token_table`. Null ids are none, which
    give no bytes; a null or an id that the vocabulary has not fails the job. Repeated
    rows come out alike.
    """
    spark = ship(rows.sparkSession)
    given = rows.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<long>) ids")
    blocks = stored(_id_blocks(given), "ids")
    asked = blocks.select("block", F.posexplode("distinct").alias("at", "id"))
    # the left join keeps ids that are no tokens, for run to refuse
    answers = asked.join(token_table(spark, ranks), "id", "left").select("block", F.col("at").cast("long").alias("at"), "bytes")

    def run(block, found):
        parts = found["bytes"].to_pylist()
        if None in parts:
            raise ValueError("ids that are not in the vocabulary")
        numbers, ends = unpacked(block["numbers"]).tolist(), np.r_[0, np.cumsum(unpacked(block["sizes"]))].tolist()
        data = [b"".join([parts[k] for k in numbers[a:b]]) for a, b in zip(ends, ends[1:])]
        return batch(_DECODED, doc_id=block["docs"], data=data)

    return answered(blocks.drop("distinct"), answers, run, "doc_id long, data binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs``.

    The digests are of the decimal ids joined by commas and of the bytes the ids decode
    to; there the table of token bytes, of the vocabulary's size, is at every worker, and
    the ids are joined with it where they are put together. Rows are handled as by
    :func:`encoded`.
    """
    ship(docs.sparkSession)

    def shown(keys, found):
        table = TokenBytes.of(ranks)
        return batch(
            _DIGESTS,
            doc_id=keys,
            n_tokens=[len(x) for x in found],
            ids_sha256=[hashlib.sha256(",".join(table.decimal[x].tolist()).encode()).hexdigest() for x in found],
            decoded_sha256=[hashlib.sha256(table.joined(x)).hexdigest() for x in found],
        )

    return _ids_by_position(docs, ranks, pattern, shown, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
