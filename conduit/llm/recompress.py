"""Passages that repeat across documents, found by recompression.

Rounds name neighbouring symbols: in each round every symbol falls into one of two
classes by its name, and a first-class symbol followed by a second-class one becomes one
symbol, named from the two names. A symbol is never both, so a run of equal symbols
stays a block of single ones. Names are hashes of what they stand for, hence the same on
every machine and in every document; equal windows of 13 words get the same symbol
borders at the words 3 to 11, at most four words apart, whatever stands around them.

Borders are then named by the six words around them, and each window takes the border
with the smallest name among its words 3 to 10 as its high-level symbol. Spark gathers
these symbols over all documents (round one): only windows whose symbol occurs in two
different texts can repeat. Their 13 words are named with 96 bits and gathered again
(round two), where the smallest doc_id of each name decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.common import (
    batch,
    bitmap_filter,
    byte_column,
    maybe_in,
    mix,
    ship,
    slot_of,
    sorted_by,
    steps,
    texts_of,
    word_hashes,
)
from conduit.session import cut_lineage

WINDOW = 13  # words
ROUNDS = 2  # of pairing
_FIRST, _LAST = 3, 10  # words of a window where its border symbols are looked for
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Words:
    """The words of several documents as one array of hashes, with where each begins."""

    def __init__(self, texts: list[bytes]):
        parts = [text.split() for text in texts]  # bytes split at ASCII white space only
        self.parts = parts
        self.counts = np.fromiter(map(len, parts), np.int64, len(parts))
        self.begins = np.cumsum(self.counts) - self.counts
        self.hashes = word_hashes([word for part in parts for word in part])
        self.doc = np.repeat(np.arange(len(parts)), self.counts)
        self.tags = np.array([xxhash.xxh32_intdigest(b" ".join(p)) for p in parts], np.uint32).view(np.int32)


def borders(words: Words, rounds: int = ROUNDS) -> np.ndarray:
    """Word positions where a symbol begins after the rounds of pairing."""
    name, at, doc = words.hashes, np.arange(len(words.hashes)), words.doc
    for round_ in range(rounds):
        with np.errstate(over="ignore"):
            second = ((name + np.uint64(round_)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63) == 1
        pair = np.zeros(len(name), bool)
        pair[:-1] = ~second[:-1] & second[1:] & (doc[1:] == doc[:-1])
        joined = name.copy()
        joined[:-1][pair[:-1]] = mix(name[:-1], name[1:])[pair[:-1]]
        keep = np.ones(len(name), bool)
        keep[1:] = ~pair[:-1]
        name, at, doc = joined[keep], at[keep], doc[keep]
    return at


def _starts(words: Words) -> np.ndarray:
    """Positions at which a whole window of one document begins."""
    n = len(words.hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1 :])


def symbols(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each window's begin and the name of its high-level symbol."""
    start, h = _starts(words), words.hashes
    if not len(start):
        return start, np.zeros(0, np.uint64)
    at = borders(words)
    at = at[(at >= 3) & (at + 3 <= len(h))]
    name = np.full(len(at), 0x51ED270B, np.uint64)
    for offset in range(-3, 3):
        name = mix(name, h[at + offset])
    least = np.full(len(h), _NONE)
    least[at] = name
    reach = 1
    while reach < _LAST - _FIRST + 1:  # of the next 1, 2, 4, 8 words
        moved = np.full(len(h), _NONE)
        moved[:-reach] = least[reach:]
        least = np.minimum(least, moved)
        reach *= 2
    return start, least[start + _FIRST]


def window_names(words: Words, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits that stand for the 13 words of each window."""
    a = np.full(len(start), 0x2545F491, np.uint64)
    b = np.full(len(start), 0x6C078965, np.uint64)
    for offset in range(WINDOW):
        word = words.hashes[start + offset]
        a = mix(a, word)
        b = mix(b ^ np.uint64(0xD1B54A32D192ED03), word)
    return a.view(np.int64), (b >> np.uint64(32)).astype(np.uint32).view(np.int32)


# Rows of a gathering round: name, name2, the first document of a batch that has it, that
# one's tag and value, and the others of that batch as packed (doc, tag, value).
_GATHER = pa.schema(
    [("name", pa.int64()), ("name2", pa.int32()), ("doc", pa.int64()), ("tag", pa.int32()), ("value", pa.int32()), ("more", pa.binary())]
)
_GATHER_SQL = "name long, name2 int, doc long, tag int, value int, more binary"
_PACK = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("value", "<i4")])


def _gathered(name, name2, doc, tag, value) -> pa.RecordBatch:
    """One row per name: a very common name gives one row per batch, not per document."""
    order = np.lexsort((value, doc, name2, name))
    name, name2, doc, tag, value = (x[order] for x in (name, name2, doc, tag, value))
    first = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (name2[1:] != name2[:-1])][: len(name)])
    last = np.r_[first[1:], len(name)]
    packed = np.empty(len(name), _PACK)
    packed["doc"], packed["tag"], packed["value"] = doc, tag, value
    more = np.full(len(first), None, object)
    for i in np.flatnonzero(last - first > 1):
        more[i] = packed[first[i] + 1 : last[i]].tobytes()
    return batch(
        _GATHER,
        name=name[first],
        name2=name2[first],
        doc=doc[first],
        tag=tag[first],
        value=value[first],
        more=pa.array(more, pa.binary()),
    )


def _symbol_batches(batches):
    for found in batches:
        texts, ids = byte_column(found.column(1)), found.column(0).to_numpy()
        for i, j in steps([len(x) for x in texts]):
            words = Words(texts[i:j])
            start, symbol = symbols(words)
            if not len(start):
                continue
            doc = words.doc[start]
            new = np.r_[True, (symbol[1:] != symbol[:-1]) | (doc[1:] != doc[:-1])]
            symbol, doc = symbol[new], doc[new]
            zero = np.zeros(len(doc), np.int32)
            yield _gathered(symbol.view(np.int64), zero, ids[i:j][doc], words.tags[doc], zero)


def _window_batches(batches):
    for found in batches:
        texts, ids = byte_column(found.column(1)), found.column(0).to_numpy()
        shared = found.column(2).to_pylist()
        for i, j in steps([len(x) for x in texts]):
            words = Words(texts[i:j])
            start, symbol = symbols(words)
            keep = np.zeros(len(start), bool)
            edges = np.searchsorted(start, np.r_[words.begins, len(words.hashes)])
            for k in range(j - i):
                own = slice(edges[k], edges[k + 1])
                keep[own] = np.isin(symbol[own], np.array(shared[i + k], np.int64).view(np.uint64))
            start = start[keep]
            if not len(start):
                continue
            doc = words.doc[start]
            a, b = window_names(words, start)
            yield _gathered(a, b, ids[i:j][doc], words.tags[doc], (start - words.begins[doc]).astype(np.int32))


_FOUND = pa.schema([("doc", pa.int64()), ("tag", pa.int32()), ("name", pa.int64()), ("value", pa.int32())])
_FOUND_SQL = "doc long, tag int, name long, value int"


def _runs(batches, later_only: bool):
    """Members of each name that two texts have, from rows sorted by (name, name2, doc).

    Only a name's first member is remembered, so a name of any size streams through.
    ``later_only``: just the members with a larger doc than the first's; else all whose
    text is not the first's, and that first one.
    """
    open_name = open_first = None
    told = False
    for found in batches:
        if not found.num_rows:
            continue
        name, name2, doc, tag, value = (found.column(k).to_numpy() for k in range(5))
        more = found.column(5)
        if more.null_count < len(more):
            rest = {i: np.frombuffer(x, _PACK) for i, x in enumerate(more.to_pylist()) if x is not None}
            size = np.ones(len(name), np.int64)
            for i, x in rest.items():
                size[i] += len(x)
            at = np.cumsum(size) - size
            name, name2, doc, tag, value = (np.repeat(x, size) for x in (name, name2, doc, tag, value))
            for i, x in rest.items():
                own = slice(at[i] + 1, at[i] + size[i])
                doc[own], tag[own], value[own] = x["doc"], x["tag"], x["value"]
        begin = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (name2[1:] != name2[:-1])])
        run = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(name)]))
        first_doc, first_tag = doc[begin], tag[begin]
        goes_on = open_name == (name[0], name2[0])
        if goes_on:
            first_doc[0], first_tag[0] = open_first[0], open_first[1]
        if later_only:
            out = np.flatnonzero(doc > first_doc[run])
            yield batch(_FOUND, doc=doc[out], tag=tag[out], name=name[out], value=value[out])
        else:
            other = tag != first_tag[run]
            shared = np.zeros(len(begin), bool)
            shared[run[other]] = True
            firsts = begin[shared]
            if goes_on and shared[0]:
                firsts = firsts[1:]
                if not told:  # the first stands in an earlier batch
                    yield batch(_FOUND, doc=[open_first[0]], tag=[open_first[1]], name=[int(name[0])], value=[0])
            out = np.r_[np.flatnonzero(other), firsts]
            yield batch(_FOUND, doc=doc[out], tag=tag[out], name=name[out], value=value[out])
            told = bool(shared[-1]) or (goes_on and len(begin) == 1 and told)
        open_name = (name[-1], name2[-1])
        open_first = (first_doc[-1], first_tag[-1])


def _all_runs(batches):
    yield from _runs(batches, False)


def _later_runs(batches):
    yield from _runs(batches, True)


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("tag", pa.int32()), ("digest", pa.binary()), ("kept_sha256", pa.string())])


def _digest_batches(batches):
    for found in batches:
        lines = [b" ".join(x.split()) for x in byte_column(found.column(1))]
        yield batch(
            _DIGEST,
            doc_id=found.column(0),
            n_words=[x.count(b" ") + 1 if x else 0 for x in lines],
            tag=np.array([xxhash.xxh32_intdigest(x) for x in lines], np.uint32).view(np.int32),
            digest=[xxhash.xxh3_128_digest(x) for x in lines],
            kept_sha256=[hashlib.sha256(x).hexdigest() for x in lines],
        )


def covered(starts: list[int], n_words: int) -> np.ndarray:
    """Which words stand in a window that begins at one of ``starts``."""
    step = np.zeros(n_words + 1, np.int64)
    at = np.asarray(starts, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return np.cumsum(step)[:n_words] > 0


def without_words(text: str, gone: np.ndarray) -> str:
    """``text`` without those of its words; of removed stretches one line break or space stays."""
    out, at, word, cut = [], 0, 0, False
    data = text.encode()
    ends = []
    for part in data.split():
        begin = data.index(part, at)
        ends.append((begin, begin + len(part)))
        at = begin + len(part)
    at = 0
    for (begin, end), drop in zip(ends, gone.tolist()):
        if drop:
            cut = True
        else:
            gap = data[at:begin]
            if cut:
                gap = b"" if not out else b"\n" if b"\n" in gap else b" "
            out.append(gap + data[begin:end])
            cut = False
        at, word = end, word + 1
    if not cut:
        out.append(data[at:])
    return b"".join(out).decode()


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Digests of all documents, and the begins of the windows that a smaller doc_id has too.

    The first frame is ``(doc_id, n_words, tag, digest, kept_sha256, copy)``; copy marks
    the later copies of a whole text, whose windows (all of them) the second leaves out.
    The second is ``(doc, tag, starts)``.
    """
    spark = ship(docs.sparkSession)
    texts = texts_of(docs)
    digests = cut_lineage(
        texts.mapInArrow(_digest_batches, "doc_id long, n_words long, tag int, digest binary, kept_sha256 string"),
        "digests",
    )
    named = texts.where("doc_id is not null")
    firsts = digests.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = cut_lineage(
        digests.join(firsts.where("last > first"), "digest")
        .where("doc_id > first")
        .select(F.col("doc_id").alias("doc"), "tag")
        .distinct(),
        "copies",
    )
    rows = named.mapInArrow(_symbol_batches, _GATHER_SQL)
    shared = sorted_by(rows, ["name"], ["name", "name2", "doc", "tag"]).mapInArrow(_all_runs, _FOUND_SQL)
    shared = (
        shared.join(copies, ["doc", "tag"], "left_anti")
        .groupBy("doc", "tag")
        .agg(F.collect_set("name").alias("shared"))
    )
    shared = cut_lineage(shared, "symbols")
    # Only texts that may have a shared symbol travel to their symbols.
    tagged = _some_tagged(named, shared)
    rows = (
        tagged.join(shared, (tagged["doc_id"] == shared["doc"]) & (tagged["tag"] == shared["tag"]))
        .select("doc_id", "text", "shared")
        .mapInArrow(_window_batches, _GATHER_SQL)
    )
    later = sorted_by(rows, ["name", "name2"], ["name", "name2", "doc", "tag"]).mapInArrow(_later_runs, _FOUND_SQL)
    starts = later.groupBy("doc", "tag").agg(F.collect_set("value").alias("starts"))
    digests = digests.join(copies.withColumnRenamed("doc", "doc_id").withColumn("copy", F.lit(True)), ["doc_id", "tag"], "left")
    return digests, cut_lineage(starts, "windows")


_TAGGED = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("tag", pa.int32())])


def _tag(text: bytes) -> int:
    return int(np.uint32(xxhash.xxh32_intdigest(b" ".join(text.split()))).view(np.int32))


def _some_tagged(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``(doc_id, text, tag)`` of the texts whose doc_id may be in ``ids``.

    Thinned out and tagged in one pass, so a task keeps one Python worker busy, not two.
    """
    held = texts.sparkSession.sparkContext.broadcast(bitmap_filter(ids, "doc"))

    def run(batches):
        for found in batches:
            found = found.filter(pa.array(maybe_in(held.value, found.column(2))))
            if found.num_rows:
                tags = [_tag(x) for x in byte_column(found.column(1))]
                yield batch(_TAGGED, doc_id=found.column(0), text=found.column(1).cast(pa.string()), tag=tags)

    slotted = texts.where("doc_id is not null").withColumn("slot", slot_of("doc_id"))
    return slotted.mapInArrow(run, "doc_id long, text string, tag int")


_KEPT = pa.schema([("doc", pa.int64()), ("tag", pa.int32()), ("n_removed", pa.int64()), ("sha", pa.string()), ("clean", pa.string())])


def _removed_batches(batches):
    for found in batches:
        ids, texts, tags, starts = (found.column(k).to_pylist() for k in range(4))
        removed, shas, cleans = [], [], []
        for text, at in zip(texts, starts):
            parts = text.encode().split()
            gone = covered(at, len(parts))
            kept = b" ".join([word for word, drop in zip(parts, gone.tolist()) if not drop])
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(kept).hexdigest())
            cleans.append(without_words(text, gone))
        yield batch(_KEPT, doc=ids, tag=tags, n_removed=removed, sha=shas, clean=cleans)


def _changed(docs: DataFrame, starts: DataFrame) -> DataFrame:
    """``(doc, tag, n_removed, sha, clean)`` of the documents that lose some words."""
    tagged = _some_tagged(texts_of(docs), starts)
    return (
        tagged.join(starts, (tagged["doc_id"] == starts["doc"]) & (tagged["tag"] == starts["tag"]))
        .select("doc_id", "text", tagged["tag"], "starts")
        .mapInArrow(_removed_batches, "doc long, tag int, n_removed long, sha string, clean string")
    )


_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``docs``.

    A word goes if a window of 13 words of its text covers it whose words also start in
    a document with a smaller doc_id. Null and empty texts and texts of fewer than 13
    words keep all they have. Rows without a doc_id keep everything and lend nothing.
    Rows with the same doc_id don't count against each other, also with different
    texts. Other columns play no part; an empty table gives an empty result.
    """
    digests, starts = repeated_windows(docs)
    changed = _changed(docs, starts).drop("clean").distinct()
    rows = digests.join(changed, (digests["doc_id"] == changed["doc"]) & (digests["tag"] == changed["tag"]), "left")
    whole = F.coalesce("copy", F.lit(False)) & (F.col("n_words") >= WINDOW)
    return rows.select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("sha", "kept_sha256")).alias("kept_sha256"),
    )


def without_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with those words cut out of their texts; a row that loses its last word goes.

    Every other row stays as it is, also one that had no words to begin with.
    """
    ship(docs.sparkSession)
    digests, starts = repeated_windows(docs)
    some = _changed(docs, starts).select("doc", "tag", "clean")
    whole = digests.where("copy").where(F.col("n_words") >= WINDOW)
    clean = some.union(whole.select("doc_id", "tag", F.lit("")))
    clean = clean.groupBy("doc", "tag").agg(F.min("clean").alias("clean"))
    clean = cut_lineage(clean, "clean")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_filter(clean, "doc"))
    marked = "__tag"
    while marked in docs.columns:
        marked += "_"
    place = docs.columns.index("text")

    def tagged(batches):  # the tag of the texts that may change, null for all others
        for found in batches:
            maybe = maybe_in(bitmap.value, found.column(found.num_columns - 1))
            texts = byte_column(found.column(place))
            tags = [_tag(x or b"") if y else None for x, y in zip(texts, maybe.tolist())]
            rest = [found.column(k) for k in range(found.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(tags, pa.int32())], names=[*found.schema.names[:-1], marked]
            )

    schema = docs.withColumn(marked, F.lit(None).cast("int")).schema
    rows = docs.withColumn(marked, slot_of("doc_id")).mapInArrow(tagged, schema)
    kept = rows.where(F.col(marked).isNull() | F.col("doc_id").isNull()).drop(marked)
    rows = rows.where(F.col(marked).isNotNull() & F.col("doc_id").isNotNull())
    found = clean.select(*(F.col(c).alias(f"{marked}_{c}") for c in clean.columns))
    rows = rows.join(
        found,
        (F.col("doc_id").cast("long") == F.col(f"{marked}_doc")) & (F.col(marked) == F.col(f"{marked}_tag")),
        "left",
    )
    cut = F.col(f"{marked}_clean")
    rows = rows.where(cut.isNull() | (F.trim(cut) != "")).withColumn("text", F.coalesce(cut, "text"))
    return kept.unionByName(rows.select(*docs.columns))
