"""Importance resampling to a target's distribution, by lines that are looked at once.

A text is its lines. Distinct lines of a corpus are gathered with their occurrences, and
the features of each (hashed runs of one to three words) are worked out once: times the
occurrences they are the corpus's counts, with the gains of all buckets they are the
line's weight. Runs that reach over line ends belong to no line; every document has them
beside its lines' numbers and adds them by itself. A line is named by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.blocks import answered, block_bytes, gathered, packed, stored, unpacked
from conduit.llm.common import batch, byte_column, ship, sorted_by, texts_of
from conduit.plans.segments import number_rows
from conduit.session import cut_lineage

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 5  # of those documents that are drawn
_KNOWN = 200_000  # lines whose occurrences a task counts at once; it bounds a worker's memory
_words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
_LINES = pa.schema([("key", pa.binary()), ("line", pa.binary()), ("n", pa.int64())])
_FEATURES = pa.schema([("keys", pa.list_(pa.binary())), ("n", pa.list_(pa.int64())), ("sizes", pa.binary()), ("steps", pa.binary())])
_COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
_WEIGHTS = pa.schema([("key", pa.binary()), ("weight", pa.int64())])
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("n_words", pa.binary()), ("sizes", pa.binary()), ("numbers", pa.binary()),
     ("cross_sizes", pa.binary()), ("cross", pa.binary()), ("keys", pa.list_(pa.binary()))]
)
_BLOCKS_SQL = "block long, docs array<long>, n_words binary, sizes binary, numbers binary, cross_sizes binary, cross binary, keys array<binary>"
_SCORES = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "n_features", "weight", "score")])


def words_of(line: bytes) -> list[bytes]:
    return _words(line.lower())  # A-Z only, as these are bytes


def buckets_of(words: list[bytes]) -> np.ndarray:
    """Buckets of all runs of one to three of the words, sorted."""
    text, crc = b" ".join(words), zlib.crc32
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1].tolist() if words else []
    ends = ends.tolist()
    found = [crc(w) for w in words]
    found += [crc(text[a:b]) for a, b in zip(begins, ends[1:])]
    found += [crc(text[a:b]) for a, b in zip(begins, ends[2:])]
    return np.sort(np.array(found, np.int64) % BUCKETS)


def crossing(tail: list[bytes], head: list[bytes]) -> list[int]:
    """Buckets of the runs that begin in ``tail``, the last two words so far, and end in ``head``."""
    runs = []
    if tail and head:
        runs.append(tail[-1:] + head[:1])
        if len(tail) > 1:
            runs.append(tail[-2:] + head[:1])
        if len(head) > 1:
            runs.append(tail[-1:] + head[:2])
    return [zlib.crc32(b" ".join(r)) % BUCKETS for r in runs]


def _name(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def _line_batches(batches):
    """Every line a task meets with its text once, and its further occurrences as a number."""
    seen: dict[bytes, int] = {}

    def repeats():
        more = [(k, n) for k, n in seen.items() if n]
        seen.clear()
        return batch(_LINES, key=[k for k, _ in more], line=[None] * len(more), n=[n for _, n in more])

    for found in batches:
        keys, lines = [], []
        for text in byte_column(found.column(0)):
            for line in text.split(b"\n"):
                if not line:
                    continue
                key = _name(line)
                if key in seen:
                    seen[key] += 1
                else:
                    seen[key] = 0
                    keys.append(key)
                    lines.append(line)
        yield batch(_LINES, key=keys, line=lines, n=[1] * len(keys))
        if len(seen) > _KNOWN:
            yield repeats()
    yield repeats()


def _feature_batches(batches):
    """The features of every distinct line, once, from rows sorted by key with a text first."""
    held, n, buckets = None, 0, None

    def made(rows):
        sizes = np.array([len(b) for _, _, b in rows], np.int64)
        flat = np.concatenate([b for _, _, b in rows])
        steps = np.diff(flat, prepend=0)
        begins = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[begins] = flat[begins]  # a line's first bucket is a step from zero
        return batch(_FEATURES, keys=[[k for k, _, _ in rows]], n=[[n for _, n, _ in rows]], sizes=[packed(sizes)], steps=[packed(steps)])

    for found in batches:
        rows = []
        columns = (found.column(0).to_pylist(), found.column(1).to_pylist(), found.column(2).to_pylist())
        for key, line, many in zip(*columns):
            if key == held:
                n += many
                continue
            if held is not None:
                rows.append((held, n, buckets))
            held, n, buckets = key, many, buckets_of(words_of(line))
        if rows:
            yield made(rows)
    if held is not None:
        yield made([(held, n, buckets)])


def line_features(texts: DataFrame) -> DataFrame:
    """Distinct lines of ``texts(text)`` in runs: names, occurrences, buckets as steps up; written."""
    lines = texts.select("text").mapInArrow(_line_batches, "key binary, line binary, n long")
    dealt = sorted_by(lines.withColumn("bare", F.col("line").isNull()), ["key"], ["key", "bare"]).drop("bare")
    kind = "keys array<binary>, n array<long>, sizes binary, steps binary"
    return cut_lineage(dealt.mapInArrow(_feature_batches, kind), "lines")


def _buckets(sizes: bytes, steps: bytes) -> tuple[np.ndarray, np.ndarray]:
    """How many features each line has, and their buckets one line after the other."""
    sizes, steps = unpacked(sizes), unpacked(steps)
    ran = np.cumsum(steps)
    some = sizes[sizes > 0]
    begins = np.cumsum(some) - some
    return sizes, ran - np.repeat(ran[begins] - steps[begins], some)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of values, one run after the other."""
    ran = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return ran[ends] - ran[ends - sizes]


def _line_counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for found in batches:
        for n, sizes, steps in zip(*(found.column(k).to_pylist() for k in range(3))):
            sizes, buckets = _buckets(sizes, steps)
            np.add.at(total, buckets, np.repeat(np.array(n, np.int64), sizes))
    yield batch(_COUNTS, bucket=np.arange(BUCKETS), n=total)


def _cross_counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for found in batches:
        for cross in found.column(0).to_pylist():
            total += np.bincount(unpacked(cross), minlength=BUCKETS)
    yield batch(_COUNTS, bucket=np.arange(BUCKETS), n=total)


def blocks_of(rows: DataFrame) -> DataFrame:
    """One row per block of ``rows(doc_id, text)``: its distinct lines, and what every document has of them; written."""
    limit = block_bytes()

    def run(batches):
        for block, docs, texts in gathered(batches, limit):
            number: dict[bytes, int] = {}
            edges: list[tuple] = []  # of each distinct line: how many words, the first two and the last two
            numbers, sizes, cross, cross_sizes, n_words = [], [], [], [], []
            for text in texts:
                tail, at, before, many = [], len(numbers), len(cross), 0
                for line in text.split(b"\n"):
                    if not line:
                        continue
                    k = number.setdefault(line, len(number))
                    if k == len(edges):
                        words = words_of(line)
                        edges.append((len(words), words[:2], words[-2:]))
                    n, head, last = edges[k]
                    numbers.append(k)
                    many += n
                    if n:
                        cross += crossing(tail, head)
                        tail = (tail + last)[-2:]
                n_words.append(many)
                sizes.append(len(numbers) - at)
                cross_sizes.append(len(cross) - before)
            yield batch(
                _BLOCKS,
                block=[block],
                docs=[docs],
                n_words=[packed(n_words)],
                sizes=[packed(sizes)],
                numbers=[packed(numbers)],
                cross_sizes=[packed(cross_sizes)],
                cross=[packed(cross)],
                keys=[[_name(line) for line in number]],
            )

    return stored(rows.mapInArrow(run, _BLOCKS_SQL), "documents")


def bucket_counts(lines: DataFrame, blocks: DataFrame) -> np.ndarray:
    """Features of a corpus in every bucket: a table of fixed size."""
    parts = lines.select("n", "sizes", "steps").mapInArrow(_line_counts, "bucket long, n long")
    parts = parts.union(blocks.select("cross").mapInArrow(_cross_counts, "bucket long, n long"))
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight."""
    of_source, of_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(source.astype(float).tolist(), target.astype(float).tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * of_source / ((s + 1) * of_target))) for s, t in pairs], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """The random part of a document's score, from its id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row of ``docs``."""
    ship(docs.sparkSession)
    rows = texts_of(docs)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines, blocks = line_features(rows), blocks_of(rows)
    gains = gains_of(bucket_counts(lines, blocks), bucket_counts(line_features(wanted), blocks_of(wanted)))

    def weigh(batches):
        for found in batches:
            for keys, sizes, steps in zip(*(found.column(k).to_pylist() for k in range(3))):
                sizes, buckets = _buckets(sizes, steps)
                yield batch(_WEIGHTS, key=keys, weight=_sums(gains[buckets], sizes))

    def run(block, answers):
        weight = answers["weight"].to_numpy()
        numbers, sizes, n_words = (unpacked(block[c]) for c in ("numbers", "sizes", "n_words"))
        total = _sums(weight[numbers], sizes) + _sums(gains[unpacked(block["cross"])], unpacked(block["cross_sizes"]))
        features = sum(np.maximum(n_words - k, 0) for k in range(3))
        drawn = total + np.array([noise(d, seed) for d in block["docs"]], np.int64)
        return batch(_SCORES, doc_id=block["docs"], n_words=n_words, n_features=features, weight=total, score=drawn)

    weights = lines.select("keys", "sizes", "steps").mapInArrow(weigh, "key binary, weight long")
    asked = blocks.select("block", F.posexplode("keys").alias("at", "key"))
    answers = asked.join(weights, "key").select("block", F.col("at").cast("long").alias("at"), "weight")
    ddl = "doc_id long, n_words long, n_features long, weight long, score long"
    return answered(blocks.drop("keys"), answers, run, ddl)


def resampled(docs: DataFrame, target: DataFrame, seed: int = SEED, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row of ``docs``.

    Of the rows with at least ``least`` words, ``percent`` in a hundred are drawn: those of
    the highest score, which is the weight towards ``target(text)`` and a random part from
    the doc_id. Drawn rows are ranked from 1; ties go to the smaller doc_id, nulls last,
    then by a hash of the row; other ranks are null. Null texts are empty ones, without
    words, of weight 0. Repeated rows are ranked one after the other. Other columns play
    no part; an empty table gives none; an empty target gives all documents gains alike.
    """
    found = cut_lineage(scores(docs, target, seed), "scores")
    free = found.where(F.col("n_words") >= least)
    many = free.count() * percent // 100
    placed = free.select(F.negative("score").alias("down"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "n_features", "weight", "score")
    numbered = number_rows(placed, ["down", "no_id", "doc_id"], "rank")
    shown = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered.select(*shown, F.when(F.col("rank") <= many, F.col("rank")).alias("rank"))
    rest = found.where(F.col("n_words") < least).select(*shown, F.lit(None).cast("long").alias("rank"))
    return ranked.union(rest)
