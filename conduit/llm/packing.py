"""Sequences of a fixed length from whole documents, first fit decreasing.

A document's ids are cut every 2048 into pieces. Pieces are dealt at random (a hash) to
partitions and taken in bounded groups there; each group is packed by itself: largest
piece first, into the first open sequence with room, which a tournament tree over the
sequences' free room finds in logarithmic time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.bpe import Coder
from conduit.llm.common import batch, byte_column, ship, steps, texts_of

LENGTH = 2048  # ids of a sequence
END = 1  # the id behind every document
GROUP = 8192  # pieces packed together


def first_fit(sizes: list[int], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; ``sizes`` must be in falling order."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [length] * (2 * leaves)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < leaves:  # the winner of each match has the most room; go left if it does
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(length - room[node])
        room[node] -= size
        node //= 2
        while node:
            most = room[2 * node] if room[2 * node] > room[2 * node + 1] else room[2 * node + 1]
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins, offsets


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)
_PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Every document's pieces of at most LENGTH ids, with the ids' checksum."""
    ship(docs.sparkSession)

    def cut(batches):
        coder = Coder.of(tokenizer)
        for found in batches:
            texts, ids = byte_column(found.column(1)), found.column(0).to_pylist()
            out: list[tuple] = []
            for i, j in steps([len(x) for x in texts]):
                flat, counts = coder.encode(texts[i:j])
                at = 0
                for doc, n in zip(ids[i:j], counts.tolist()):
                    own = np.append(flat[at : at + n], END).astype("<u4").tobytes()
                    at += n
                    for begin in range(0, n + 1, LENGTH):
                        part = own[4 * begin : 4 * (begin + LENGTH)]
                        out.append((doc, begin, len(part) // 4, zlib.crc32(part), n + 1))
            yield batch(_PIECES, **dict(zip(_PIECES.names, zip(*out)))) if out else batch(_PIECES, **{n: [] for n in _PIECES.names})
        coder.forget()

    return texts_of(docs).mapInArrow(cut, _PIECES_SQL)


_PACKED = pa.schema([*_PIECES, pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())])


def _pack_batches(batches):
    """Packs GROUP pieces at a time; ids of sequences begin with the partition's number."""
    base = TaskContext.get().partitionId() << 40
    held: list[pa.RecordBatch] = []

    def packed(found: pa.Table):
        nonlocal base
        length = found["length"].to_numpy()
        order = np.argsort(-length, kind="stable")
        bins, offsets = first_fit(length[order].tolist())
        found = found.take(pa.array(order))
        out = found.append_column("sequence_id", pa.array(np.array(bins, np.int64) + base))
        out = out.append_column("offset", pa.array(offsets, pa.int64()))
        base += max(bins) + 1
        return out.combine_chunks().to_batches()

    rows = 0
    for found in batches:
        held.append(found.select(_PIECES.names))
        rows += found.num_rows
        while rows >= 2 * GROUP:  # the last group of a partition has one to two times GROUP
            whole = pa.Table.from_batches(held)
            yield from packed(whole.slice(0, GROUP))
            held = whole.slice(GROUP).to_batches()
            rows -= GROUP
    if rows:
        yield from packed(pa.Table.from_batches(held))


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece.

    Every row of ``docs`` is a document of its own, also a repeated one and one without a
    doc_id; a null or empty text is the one id that ends it. Other columns play no part;
    an empty table gives an empty result.
    """
    dealt = pieces(docs, tokenizer).withColumn("draw", F.xxhash64("ids_crc32", "doc_id", "start", F.lit(2048)))
    dealt = dealt.repartition("draw").sortWithinPartitions("draw", "doc_id", "start", "ids_crc32")
    return dealt.mapInArrow(_pack_batches, _PIECES_SQL + ", sequence_id long, offset long")
