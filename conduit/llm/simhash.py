"""Near copies by fingerprints: segment bit counts on a grid, then the exact distance.

A fingerprint of 64 bits is two halves of 16 two-bit segments. The number of ones in a
segment (0, 1 or 2) is a coordinate, and the Manhattan distance of two such vectors is
never more than the Hamming distance of the bits. Two fingerprints within three bits
are within one bit on one of their halves, so on that half their vectors are equal or
one step apart on one coordinate. Every fingerprint stands in its own cell of the grid
and looks into that cell and the 16 cells one step up; whoever is one step down looks
up from there. The candidates of a cell pass the Manhattan bound over both halves, then
the exact count of differing bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.llm.common import batch, byte_column, ship, sorted_by, texts_of
from conduit.llm.components import components
from conduit.session import cut_lineage

WORDS = 3  # of a shingle
SEED = 42
DISTANCE = 3  # bits
# Fingerprints that stand in one cell before its looks are dealt over blocks of it.
CELL_BLOCK = 2048
_PAIRS_AT_ONCE = 1 << 21
_PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])
_NAMED = pa.schema([("id", pa.int64()), ("sha", pa.string()), ("whole", pa.int64()), ("print", pa.int64())])
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Hashes of all shingles of a text, in order; a shorter text is one shingle, no words none."""
    parts = text.lower().split()  # ASCII case and white space only, as these are bytes
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    n = len(parts) - words + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    begins = np.concatenate(([0], ends[: n - 1])).tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(begins, ends)], np.uint64)


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The majority bit of the hashes of all shingles of a text (repeats count)."""
    hashes = shingle_hashes(text, words, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _print_batches(batches):
    for found in batches:
        texts = byte_column(found.column(1))
        prints = np.array([fingerprint(x) for x in texts], np.uint64)
        yield batch(_PRINTS, doc_id=found.column(0), print=prints.view(np.int64))


def _named_prints(batches):
    for found in batches:
        prints = np.array([fingerprint(x) for x in byte_column(found.column(3))], np.uint64)
        yield batch(_NAMED, id=found.column(0), sha=found.column(1), whole=found.column(2), print=prints.view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, print)`` of every row; a text without words has the print zero."""
    ship(docs.sparkSession)
    return texts_of(docs).mapInArrow(_print_batches, "doc_id long, print long")


def _segments(prints: np.ndarray) -> np.ndarray:
    """Number of ones in each two-bit segment, kept in the two bits."""
    odd = np.uint64(0x5555555555555555)
    return (prints & odd) + ((prints >> np.uint64(1)) & odd)


_CELLS = pa.schema([("cell", pa.int64()), ("look", pa.bool_()), ("print", pa.int64())])


def _cell_batches(batches):
    low = np.uint64(0xFFFFFFFF)
    for found in batches:
        prints = found.column(0).to_numpy().view(np.uint64)
        counts = _segments(prints)
        cells, looks = [], []
        for half in (0, 1):
            own = ((counts >> np.uint64(32 * half)) & low) | np.uint64(half << 32)
            cells += [own, own]
            looks += [(False, prints), (True, prints)]
            for segment in range(16):
                shift = np.uint64(2 * segment)
                room = ((own >> shift) & np.uint64(3)) < 2
                cells.append(own[room] + (np.uint64(1) << shift))
                looks.append((True, prints[room]))
        yield batch(
            _CELLS,
            cell=np.concatenate(cells).view(np.int64),
            look=np.concatenate([np.full(len(p), kind) for kind, p in looks]),
            print=np.concatenate([p for _, p in looks]).view(np.int64),
        )


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the given ones, at most one per node."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs differ in at most DISTANCE bits: the Manhattan bound, then the bits."""
    def spread(prints):  # ones of each byte: segments of eight bits
        two = _segments(prints)
        four = (two & np.uint64(0x3333333333333333)) + ((two >> np.uint64(2)) & np.uint64(0x3333333333333333))
        return ((four + (four >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)).view(np.int8).reshape(-1, 8)

    apart = np.abs(spread(x) - spread(y)).sum(1, dtype=np.int16)
    maybe = np.flatnonzero(apart <= DISTANCE)
    return maybe[np.bitwise_count(x[maybe] ^ y[maybe]) <= DISTANCE]


def _link_batches(batches):
    """Verified links of each (cell, block): its standing prints come first, then the looks."""
    held_key, held = None, np.zeros(0, np.uint64)
    for found in batches:
        key = np.stack([found.column(0).to_numpy(), found.column(1).to_numpy()], axis=1)
        look = found.column(2).to_numpy(zero_copy_only=False)
        prints = found.column(3).to_numpy().view(np.uint64)
        if held_key is not None and len(held):  # the open group goes on: its standing prints go first
            if len(key) and (key[0] == held_key).all():
                key = np.concatenate([np.repeat(held_key[None], len(held), 0), key])
                look = np.concatenate([np.zeros(len(held), bool), look])
                prints = np.concatenate([held, prints])
        if not len(key):
            continue
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        last = np.r_[first[1:], len(key)]
        standing = np.add.reduceat(~look, first)
        group = np.repeat(np.arange(len(first)), last - first)
        lookers = np.flatnonzero(look)
        each = standing[group[lookers]]
        lookers, each = lookers[each > 0], each[each > 0]
        made_u, made_v = [], []
        ends = np.cumsum(each)
        at = 0
        while at < len(lookers):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS_AT_ONCE)))
            n = each[at:stop]
            x = np.repeat(lookers[at:stop], n)
            y = first[group[x]] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near = _near(prints[x], prints[y])
            x, y = prints[x[near]], prints[y[near]]
            other = x != y
            if other.any():
                a, b = spanning(x[other].view(np.int64), y[other].view(np.int64))
                made_u.append(a)
                made_v.append(b)
            at = stop
        if made_u:
            a, b = spanning(np.concatenate(made_u), np.concatenate(made_v))
            yield batch(_LINKS, u=a, v=b)
        held_key = key[-1].copy()
        held = prints[first[-1] :][~look[first[-1] :]]


def links(classes: DataFrame) -> DataFrame:
    """Links ``(u, v)`` that join all distinct prints within DISTANCE bits of each other.

    They span the same components as all such pairs, with at most one link per print
    and batch, so a large group of near copies never makes its square of pairs. A cell
    with many standing prints is dealt over blocks, and each look goes to all of them.
    """
    cells = classes.select("print").mapInArrow(_cell_batches, "cell long, look boolean, print long")
    crowded = (
        cells.where("not look")
        .groupBy("cell")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > CELL_BLOCK)
        .select(F.col("cell").alias("crowd"), F.ceil(F.col("n") / CELL_BLOCK).cast("int").alias("blocks"))
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    dealt = cells.join(crowded, cells["cell"] == crowded["crowd"], "left").select(
        "cell",
        F.explode(F.when(F.col("look"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))).alias("block"),
        "look",
        "print",
    )
    dealt = sorted_by(dealt, ["cell", "block"], ["cell", "block", "look"])
    return dealt.mapInArrow(_link_batches, "u long, v long")


def _rooted(prints: DataFrame, first: Column) -> DataFrame:
    """``(print, first, root)`` of all distinct prints: root is the smallest print that links reach."""
    classes = cut_lineage(prints.groupBy("print").agg(first.alias("first")), "classes")
    found = components(links(classes))
    return classes.join(found, classes["print"] == found["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs``.

    Equal fingerprints are one class; classes within three bits are linked, and
    component_id is the smallest doc_id that links reach. Null and empty texts have the
    fingerprint zero and are linked like any other. A row without a doc_id gets its
    class's component; where no member has an id, that is null. Repeated rows come out
    as often as they came in; columns other than doc_id and text play no part; an empty
    table gives an empty result.
    """
    prints = cut_lineage(fingerprints(docs), "prints")
    roots = _rooted(prints, F.min("doc_id"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    owner = roots.join(least, "root").select("print", "component_id")
    return prints.join(owner, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, whatever the ids.

    Components are those of :func:`near_copies`; null and empty texts are copies of each
    other. The row with the smallest doc_id stays, nulls last; of several that with the
    smallest SHA-256 of its text, then the smallest hash of all its columns that can be
    hashed. Rows that agree in all of these are repeats, and one of them stays. Columns
    are kept as they are, whatever their names; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not _has_map(f.dataType)]
    who = {"id": F.col("doc_id").cast("long"), "sha": F.sha2(text, 256), "whole": F.xxhash64(*hashed)}
    rows = docs.select(*[c.alias(n) for n, c in who.items()], text.alias("text"))
    prints = cut_lineage(rows.mapInArrow(_named_prints, "id long, sha string, whole long, print long"), "prints")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "sha", "whole")
    least = _rooted(prints, F.min(rank)).groupBy("root").agg(F.min("first").alias("best"))
    # one name for join and repeats, so that the rows move once
    name = F.sha2(F.concat_ws(" ", F.coalesce(F.col("id").cast("string"), F.lit("-")), "sha", F.col("whole").cast("string")), 256)
    kept = least.select("best.*").select(name.alias("kept"))
    named = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in who.items()]).select("row", name.alias("name"))
    return named.join(kept, F.col("name") == F.col("kept"), "left_semi").dropDuplicates(["name"]).select("row.*")


def _has_map(kind) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))
