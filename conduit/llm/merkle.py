"""Fingerprints of documents as hash trees over sections, paragraphs and sentences.

A text is cut at blank lines into sections, at line breaks into paragraphs and behind
sentence ends into leaves; a long stretch without sentence ends is cut at words picked
by their own hash, so an edit moves no cut outside it. A paragraph is a hash of its content, a section and the
root are hashes of their children. The written fingerprint holds the root and the whole
tree: ``root|section;section``, a section being ``name:paragraph,paragraph`` and a
paragraph the 24-bit names of its leaves, joined.

Equal texts have equal roots. Where roots differ, sections of the same name are the same
and only the others are opened, down to the leaves that differ.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.common import batch, partitions_for, ship, texts_of

LEAF = 6  # hexadecimal digits of a leaf's name
LONGEST = 100  # code points of a sentence that stays one leaf
_SECTION = regex.compile(r"(\n[ \t\r]*\n\s*)")
_SENTENCE = regex.compile(r"(?<=[.!?;:,。！？]) +")


def _node(below: bytes) -> bytes:
    return hashlib.blake2b(below, digest_size=16).digest()


def _leaves(paragraph: str) -> list[str]:
    out = []
    for sentence in _SENTENCE.split(paragraph):
        if len(sentence) <= LONGEST:
            out.append(sentence)
            continue
        held: list[str] = []
        for word in sentence.split(" "):
            if len(word) > LONGEST:  # cut from its beginning, so a change at its end moves nothing
                out += [word[k : k + LONGEST] for k in range(0, len(word), LONGEST)]
                continue
            held.append(word)
            if xxhash.xxh32_intdigest(word) % 4 == 0:
                out.append(" ".join(held))
                held = []
        if held:
            out.append(" ".join(held))
    return out


def fingerprint(text: str) -> str:
    """The tree of a text, written out; its root covers every character of the text."""
    name = xxhash.xxh32_hexdigest
    sections, nodes = [], []
    parts = _SECTION.split(text) if text else []
    for k in range(0, len(parts), 2):  # every other part is the white space between sections
        own = parts[k].split("\n")
        below = b"".join([_node(p.encode()) for p in own])
        node = _node(below + "".join(parts[k + 1 : k + 2]).encode())
        nodes.append(node)
        sections.append(f"{node[:6].hex()}:" + ",".join(["".join([name(x)[:LEAF] for x in _leaves(p)]) for p in own]))
    return f"{_node(b''.join(nodes)).hex()}|" + ";".join(sections)


def _cut(paragraphs: str) -> list[str]:
    return [p[i : i + LEAF] for p in paragraphs.split(",") for i in range(0, len(p), LEAF)]


def _sections(print_: str) -> list[tuple[str, str]]:
    tree = print_.partition("|")[2]
    return [(s[:12], s[13:]) for s in tree.split(";")] if tree else []


def likeness(one: str, two: str) -> float:
    """Share of leaves that two fingerprints have in common, 0 to 1 (1: equal texts).

    Sections of one name are common as they stand; only the others' leaves are compared.
    """
    if one.partition("|")[0] == two.partition("|")[0]:
        return 1.0
    a, b = _sections(one), _sections(two)
    shared = Counter(n for n, _ in a) & Counter(n for n, _ in b)
    common = total = 0
    rest: list[Counter] = []
    for side in (a, b):
        left, loose = Counter(shared), Counter()
        for name, paragraphs in side:
            leaves = sum(len(p) // LEAF for p in paragraphs.split(","))
            total += leaves
            if left[name]:
                left[name] -= 1
                common += leaves
            else:
                loose.update(_cut(paragraphs))
        rest.append(loose)
    common += 2 * sum((rest[0] & rest[1]).values())
    return common / total if total else 0.0


def edits(one: str, two: str) -> list[tuple[int, int]]:
    """``(section, paragraph)`` of the first text that the second does not have."""
    there = Counter(n for n, _ in _sections(two))
    paragraphs = Counter(p for _, ps in _sections(two) for p in ps.split(","))
    out = []
    for k, (name, own) in enumerate(_sections(one)):
        if there[name]:
            there[name] -= 1
            continue
        out += [(k, j) for j, p in enumerate(own.split(",")) if not paragraphs[p]]
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame) -> DataFrame:
    """Rows in partitions ordered by document, each last row's follower added to its partition.

    Columns: ``place`` (the bucket of ids), ``extra`` (the added rows), ``doc_id``,
    ``text``. Ids alone decide the buckets, from quantiles of theirs; the first row of a
    bucket also goes to the one before it, so no partition needs another's rows.
    """
    spark = docs.sparkSession
    rows = texts_of(docs)
    # one bucket more for rows without an id, before all others
    ids = rows.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"))
    count = 4 * partitions_for(spark)
    marks = ids.agg(F.percentile_approx("id", [k / count for k in range(1, count)], 10000)).first()[0]
    marks = np.unique(np.array(marks or [], np.int64))

    def placed(batches):
        kind = pa.schema([("place", pa.int32()), ("id", pa.int64())])
        for found in batches:
            at = np.searchsorted(marks, found.column(0).to_numpy(), side="right")
            least: dict[int, int] = {}
            for p, i in zip(at.tolist(), found.column(0).to_pylist()):
                if i < least.get(p, i + 1):
                    least[p] = i
            yield batch(kind, place=np.array(list(least), np.int32), id=list(least.values()))

    # the first id of each bucket that has any: a row per bucket
    firsts = ids.mapInArrow(placed, "place int, id long").groupBy("place").agg(F.min("id").alias("id"))
    firsts = sorted((r["place"], r["id"]) for r in firsts.collect())
    before = {firsts[k][1]: firsts[k - 1][0] for k in range(len(firsts))}  # the last goes on with the first
    kind = pa.schema([("place", pa.int32()), ("extra", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])

    def dealt(batches):
        for found in batches:
            ids = found.column(0).fill_null(-(2**63)).to_numpy()
            at = np.searchsorted(marks, ids, side="right").astype(np.int32)
            texts = found.column(1).cast(pa.string())
            yield batch(kind, place=at, extra=np.zeros(len(at), bool), doc_id=found.column(0), text=texts)
            again = [k for k, i in enumerate(ids.tolist()) if i in before]
            if again:
                pick = pa.array(again)
                to = np.array([before[i] for i in ids[again].tolist()], np.int32)
                yield batch(
                    kind,
                    place=to,
                    extra=np.ones(len(again), bool),
                    doc_id=found.column(0).take(pick),
                    text=texts.take(pick),
                )

    spread = rows.mapInArrow(dealt, "place int, extra boolean, doc_id long, text string")
    spread = spread.withColumn("tie", F.xxhash64("text"))
    return spread.repartition(count, "place").sortWithinPartitions("place", "extra", "doc_id", "tie")


_PRINTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _print_batches(batches):
    held = None  # the last row: bucket, extra, id, text, fingerprint

    def row(one, two):
        _, _, doc, text, print_ = one
        other = edited(text, two[3])
        again = print_ if other == text else fingerprint(other)
        return (
            doc,
            len(text),
            hashlib.sha256(other.encode()).hexdigest(),
            print_,
            again,
            likeness(print_, again),
            likeness(print_, two[4]),
        )

    for found in batches:
        out = []
        for now in zip(*(found.column(k).to_pylist() for k in range(4))):
            if held and held[1] and now[1] and held[0] == now[0]:
                continue  # a bucket's first of several added rows is the follower
            now = (*now, fingerprint(now[3]))
            if held and held[0] == now[0] and not held[1]:
                out.append(row(held, now))
            held = now
        if out:
            yield batch(_PRINTS, **dict(zip(_PRINTS.names, zip(*out))))


def document_prints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    Documents follow each other by doc_id; rows without one come first, and repeated ids
    follow each other by a hash of their texts. The last row is followed by the first; a
    single row by itself. Null texts are empty ones; an empty text's fingerprint is like
    that of another empty text only. Other columns play no part; an empty table gives an
    empty result.
    """
    ship(docs.sparkSession)
    ordered = with_following(docs).select("place", "extra", "doc_id", "text")
    return ordered.mapInArrow(
        _print_batches,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
