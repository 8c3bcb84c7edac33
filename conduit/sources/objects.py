"""Object listing, content digests and bulk copy.

Work is cut into byte ranges, not objects, so one object with a third of all
bytes spreads over the cluster; a range is streamed in small buffers.
"""

from __future__ import annotations

import bz2
import hashlib
import os
import re
import stat
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conduit.functions.network import full_match
from conduit.plans.segments import segment_count
from conduit.session import cut_lineage, hadoop_path, in_shared_folder, local_table, scratch_path
from conduit.sources import bzip
from conduit.sources.bzip import Part, unpacked

BUFFER = 2 * 1024 * 1024
RANGE_BYTES = 128 * 1024 * 1024
_WHOLE = 2**62  # a range no object exceeds


class TransferError(OSError):
    """A transfer that cannot be done or came out short."""


# -- listing --------------------------------------------------------------------


class NameFilter:
    """Any number of patterns; a name passes when one matches all of it."""

    def __init__(self, *patterns: str):
        self.patterns: list[str] = []
        for pattern in patterns:
            self.add(pattern)

    def add(self, pattern: str) -> bool:
        """Add a pattern; an empty one is ignored, an invalid one refused."""
        try:
            re.compile(pattern)
        except re.error:
            return False
        if pattern:
            self.patterns.append(pattern)
        return True

    def matches(self, name: Column) -> Column:
        if not self.patterns:
            return F.lit(True)
        return reduce(or_, [full_match(name, p) for p in self.patterns])


_ENTRY = "path string, name string, size bigint, flag string, protocol string, us bigint"

# Entry kinds by the test on a file mode that tells them.
_FLAGS = (
    ("LINK", stat.S_ISLNK),
    ("DIR", stat.S_ISDIR),
    ("FILE", stat.S_ISREG),
    ("CHAR", stat.S_ISCHR),
    ("BLOCK", stat.S_ISBLK),
    ("FIFO", stat.S_ISFIFO),
    ("SOCKET", stat.S_ISSOCK),
)


def _mounted_entries(path: str) -> Iterator[tuple]:
    with os.scandir(_local(path)) as found:
        for entry in found:
            seen = entry.stat(follow_symlinks=False)
            flag = next((f for f, test in _FLAGS if test(seen.st_mode)), "UNKNOWN")
            yield entry.name, seen.st_size, flag, seen.st_mtime_ns // 1000


def _stored_entries(path: str) -> Iterator[tuple]:
    from pyarrow import fs

    store, inner = _store_of(path)
    for info in store.get_file_info(fs.FileSelector(inner)):
        flag = "DIR" if info.type == fs.FileType.Directory else "FILE"
        when = int(info.mtime.timestamp() * 1_000_000) if info.mtime else None
        yield info.base_name, info.size or 0, flag, when


def _list_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of each directory; directories have no size."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            scheme = _scheme_of(row.path)
            entries = _mounted_entries if scheme == "file" else _stored_entries
            base, prefix = row.path.rstrip("/"), f"{row.name}/" if row.name else ""
            for names in _grouped(entries(row.path), 4096):
                yield pd.DataFrame(
                    {
                        "path": [f"{base}/{n}" for n, *_ in names],
                        "name": [f"{prefix}{n}" for n, *_ in names],
                        "size": [0 if f == "DIR" else s for _, s, f, _ in names],
                        "flag": [f for _, _, f, _ in names],
                        "protocol": scheme.upper(),
                        "us": pd.array([m for *_, m in names], dtype="Int64"),
                    }
                )


def _grouped(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    group: list[tuple] = []
    for row in rows:
        group.append(row)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def list_objects(
    spark: SparkSession, root: str, names: NameFilter | None = None, recursive: bool = True
) -> DataFrame:
    """``(path, name, size, flag, protocol, modified)`` of the entries below a root.

    One level of directories is listed per step, each directory by one task, so
    no machine holds the whole tree; empty and hidden objects are included.
    ``name`` is relative to the root. A recursive listing has no directories, a
    flat one shows them.
    """
    fs, handle = hadoop_path(spark, root)
    start = handle.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    level = local_table(
        spark, {"path": [start], "name": [""]}, {"path": "string", "name": "string"}
    )
    levels = []
    while True:
        found = cut_lineage(level.mapInPandas(_list_directories, _ENTRY), "listing")
        levels.append(found)
        inner = found.filter(F.col("flag") == "DIR").select("path", "name")
        if not recursive or inner.isEmpty():
            break
        level = inner.repartition(segment_count(inner), "path")
    listing = reduce(DataFrame.unionByName, levels)
    listing = listing.withColumn("modified", F.timestamp_micros("us")).drop("us")
    if recursive:
        listing = listing.filter(F.col("flag") != "DIR")
    return listing.filter(names.matches(F.col("name"))) if names else listing


def listing_totals(listing: DataFrame) -> DataFrame:
    """``(objects, bytes)`` of a listing."""
    return listing.agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


# -- reading ----------------------------------------------------------------------


def byte_ranges(listing: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The listing cut into ``(offset, length)`` ranges, spread evenly over tasks."""
    starts = F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes)
    )
    cut = listing.withColumn("offset", F.explode(starts)).withColumn(
        "length", F.least(F.lit(range_bytes), F.col("size") - F.col("offset"))
    )
    return cut.repartition(segment_count(listing), "path", "offset")


# Object stores by the name their client here knows.
_STORES = {"s3a": "s3", "s3n": "s3"}


def _local(path: str) -> str:
    """A mounted path without its scheme; listing paths are not percent-encoded."""
    if _scheme_of(path) != "file":
        raise TransferError(f"not a mounted path: {path}")
    return re.sub(r"\Afile:/*", "/", path)


def _scheme_of(path: str) -> str:
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return scheme[1].lower() if scheme else "file"


def _store_of(path: str):
    """Client and inner path of an object that is not on a mount."""
    from pyarrow import fs

    scheme, _, rest = path.partition("://")
    authority, _, key = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{_STORES.get(scheme, scheme)}://{authority}")
    return store, f"{base.rstrip('/')}/{key}"


def _open_input(path: str):
    if _scheme_of(path) == "file":
        return open(_local(path), "rb", buffering=0)
    store, inner = _store_of(path)
    return store.open_input_file(inner)


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """``(path, content)`` of objects small enough to be one value each."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select("path", "content")


def _pieces(handle, length: int) -> Iterator[bytes]:
    left = length
    while left > 0:
        piece = handle.read(min(BUFFER, left))
        if not piece:
            raise TransferError(f"object ended {left} bytes early")
        left -= len(piece)
        yield bytes(piece)


class _RangeDigests:
    """MD5s of the fixed ranges of one object, from pieces that come in order."""

    def __init__(self, range_bytes: int, offset: int = 0):
        self.range_bytes, self.offset, self.left = range_bytes, offset, range_bytes
        self.digest, self.done = hashlib.md5(), []

    def update(self, piece: bytes) -> None:
        view = memoryview(piece)
        while view:
            if not self.left:
                self._close()
            part = view[: self.left]
            self.digest.update(part)
            self.left -= len(part)
            view = view[len(part) :]

    def _close(self) -> None:
        size = self.range_bytes - self.left
        self.done.append((self.offset, size, self.digest.hexdigest()))
        self.offset += size
        self.digest, self.left = hashlib.md5(), self.range_bytes

    def rows(self, path: str, name: str) -> list[tuple]:
        self._close()  # an empty object has one range, of no bytes
        return [(path, name, *range_) for range_ in self.done]


_DIGEST_COLUMNS = ["path", "name", "offset", "length", "md5"]


def _range_digester(range_bytes: int):
    def digest_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                digests = _RangeDigests(range_bytes, row.offset)
                with _open_input(row.path) as handle:
                    handle.seek(row.offset)
                    for piece in _pieces(handle, row.length):
                        digests.update(piece)
                rows += digests.rows(row.path, row.name)
            yield pd.DataFrame(rows, columns=_DIGEST_COLUMNS)

    return digest_ranges


_RANGE_DIGEST = "path string, name string, offset bigint, length bigint, md5 string"


def _whole_digest(ranges: DataFrame, *more: Column) -> DataFrame:
    """Per object: bytes and the MD5 of its ranges' MD5s with their number.

    The form is the same for objects of one range and of many, and for every scheme.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "md5")))
    joined = F.array_join(F.transform(ordered, lambda r: r["md5"]), "")
    tree = F.concat(F.md5(F.unhex(joined)), F.lit("-"), F.count(F.lit(1)).cast("string"))
    return ranges.groupBy("path", "name").agg(
        F.sum("length").alias("bytes"), tree.alias("ranges_md5"), *more
    )


def digest_objects(listing: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, name, bytes, ranges_md5)`` from reading every byte once.

    Two digests compare when they were taken with the same ``range_bytes``.
    """
    ranges = byte_ranges(listing, range_bytes).select("path", "name", "offset", "length")
    return _whole_digest(ranges.mapInPandas(_range_digester(range_bytes), _RANGE_DIGEST))


def _plain_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums = []
        for row in batch.itertuples(index=False):
            digest = hashlib.md5()
            with _open_input(row.path) as handle:
                for piece in _pieces(handle, row.size):
                    digest.update(piece)
            sums.append(digest.hexdigest())
        yield batch[["path", "name", "size"]].assign(md5=sums).rename(columns={"size": "bytes"})


def plain_digests(listing: DataFrame) -> DataFrame:
    """``(path, name, bytes, md5)``: the MD5 of each object as one stream, one task each."""
    dealt = listing.select("path", "name", "size").repartition(segment_count(listing), "path")
    return dealt.mapInPandas(_plain_digests, "path string, name string, bytes bigint, md5 string")


# -- copying ----------------------------------------------------------------------


def _open_output(path: str):
    if _scheme_of(path) == "file":
        os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
        return open(_local(path), "wb")
    store, inner = _store_of(path)
    return store.open_output_stream(inner, compression=None)  # not by its extension


@contextmanager
def _placed_writer(path: str, at: int):
    """A function that writes on from an offset; other ranges stay as they are.

    Object stores take no writes at an offset, so there a range is an object.
    """
    if _scheme_of(path) != "file":
        with _open_output(path) as out:
            yield out.write
        return
    os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
    out = os.open(_local(path), os.O_WRONLY | os.O_CREAT, 0o644)

    def write(piece: bytes) -> None:
        nonlocal at
        view = memoryview(piece)
        while view:
            written = os.pwrite(out, view, at)
            at += written
            view = view[written:]

    try:
        yield write
    finally:
        os.close(out)


def _size_of(path: str) -> int | None:
    """Size of an object, None when there is none."""
    if _scheme_of(path) == "file":
        return os.path.getsize(_local(path)) if os.path.exists(_local(path)) else None
    store, inner = _store_of(path)
    return store.get_file_info(inner).size


def _rename(path: str, target: str) -> None:
    if _scheme_of(path) == "file":
        os.makedirs(os.path.dirname(_local(target)), exist_ok=True)
        os.replace(_local(path), _local(target))
    else:
        store, inner = _store_of(path)
        store.move(inner, _store_of(target)[1])


def _range_writer(range_bytes: int):
    """Copies ranges to their place in the target; repeating one changes nothing."""

    def write_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                digests = _RangeDigests(range_bytes, row.target_offset)
                with _open_input(row.path) as handle:
                    handle.seek(row.offset)
                    with _placed_writer(row.target, row.target_offset) as write:
                        for piece in _pieces(handle, row.length):
                            digests.update(piece)
                            write(piece)
                rows += digests.rows(row.path, row.name)
            yield pd.DataFrame(rows, columns=_DIGEST_COLUMNS)

    return write_ranges


def _compress_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each range as a bzip2 stream of its own; streams laid end to end are one file."""
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            packer, digest = bz2.BZ2Compressor(), hashlib.md5()
            with _open_input(row.path) as handle, _open_output(row.part) as out:
                handle.seek(row.offset)
                for piece in _pieces(handle, row.length):
                    digest.update(piece)
                    out.write(packer.compress(piece))
                out.write(packer.flush())
                size = out.tell()
            rows.append((row.part, row.name, row.target, row.offset, size, digest.hexdigest()))
        yield pd.DataFrame(rows, columns=["path", "name", "target", "at", "length", "plain_md5"])


def _unpack_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The plain bytes of the bzip2 blocks that begin in each range, as a part of their own."""
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            told = None
            with _open_input(row.path) as handle:

                def read(offset: int, count: int) -> bytes:
                    handle.seek(offset)
                    return b"".join(_pieces(handle, min(count, row.size - offset)))

                with _open_output(row.part) as out:
                    try:
                        for piece in unpacked(read, row.size, row.offset, row.length):
                            if isinstance(piece, Part):
                                told = piece
                            else:
                                out.write(piece)
                    except OSError as broken:
                        raise TransferError(f"{row.name}: {broken}") from broken
            shown = tuple(told) if told else (None, None, 0)
            rows.append((row.path, row.name, row.target, row.part, row.offset, *shown))
        frame = pd.DataFrame(rows, columns=["path", "name", "target", "part", "at", "first", "following", "length"])
        yield frame.astype({"first": "Int64", "following": "Int64"})


def _put_together(range_bytes: int, written: int):
    """Ranges of the plain bytes from slices of parts, given as lines of offset, length and path."""

    def write_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                begin = row.k * written
                digests = _RangeDigests(range_bytes, begin)
                with _placed_writer(row.target, begin) as write:
                    for line in row.slices.split("\n") if row.slices else ():
                        offset, length, part = line.split(" ", 2)
                        with _open_input(part) as handle:
                            handle.seek(int(offset))
                            for piece in _pieces(handle, int(length)):
                                digests.update(piece)
                                write(piece)
                rows += digests.rows(row.path, row.name)
            yield pd.DataFrame(rows, columns=_DIGEST_COLUMNS)

    return write_ranges


def _decompressed(placed: DataFrame, range_bytes: int, mounted: bool) -> DataFrame:
    """Decompress in as many tasks as the packed objects have ranges, then put the plain ranges together.

    A store has no writes at an offset, so there a target is put together by one task.
    """
    ranges = byte_ranges(placed, range_bytes)
    part = F.concat("target", F.lit(".part-"), F.col("offset").cast("string"))
    parts = cut_lineage(
        ranges.withColumn("part", part)
        .select("path", "name", "size", "offset", "length", "part", "target")
        .mapInPandas(
            _unpack_ranges,
            "path string, name string, target string, part string, at bigint, first bigint, following bigint, length bigint",
        ),
        "unpacked",
    )
    # every part says where the next one must begin, and the last one that there is none
    order = Window.partitionBy("path", "name").orderBy("at")
    agreed = F.coalesce(F.lead("first").over(order), F.lit(-1)) == F.col("following")
    broken = parts.where("first is not null").withColumn("agreed", agreed).where(~F.col("agreed")).first()
    if broken is not None:
        raise TransferError(f"{broken['name']}: damaged behind bit {broken['following']}")
    begin = F.sum("length").over(order) - F.col("length")
    written = range_bytes if mounted else _WHOLE
    found = parts.withColumn("begin", begin).where("length > 0")
    ranges_of = F.sequence(F.expr(f"begin div {written}"), F.expr(f"(begin + length - 1) div {written}"))
    pieces = found.withColumn("k", F.explode(ranges_of))
    low = F.greatest(F.col("begin"), F.col("k") * F.lit(written))
    high = F.least(F.expr("begin + length"), F.col("k") * F.lit(written) + F.lit(written))
    line = F.concat_ws(" ", (low - F.col("begin")).cast("string"), (high - low).cast("string"), "part")
    empty = parts.groupBy("path", "name", "target").agg(F.sum("length").alias("all")).where("`all` = 0")
    whole = pieces.withColumn("low", low).withColumn("line", line).groupBy("path", "name", "target", "k").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("low", "line"))), lambda p: p["line"]), "\n").alias("slices")
    )
    none = empty.select("path", "name", "target", F.lit(0).cast("bigint").alias("k"), F.lit("").alias("slices"))
    return whole.unionByName(none).mapInPandas(_put_together(range_bytes, written), _RANGE_DIGEST)


def _publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Move finished objects to their final names, if they are whole."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            size = _size_of(row.staged)
            if size is not None:
                if size != row.bytes:
                    raise TransferError(f"{row.name}: {size} bytes written, {row.bytes} expected")
                _rename(row.staged, row.dest)
            elif _size_of(row.dest) != row.bytes:  # else an earlier try renamed it
                raise TransferError(f"{row.name}: nothing was written")
        yield batch[["path", "name", "dest", "bytes", "ranges_md5"]]


def _qualified(spark: SparkSession, path: str, shared: bool) -> str:
    """A destination with its scheme; a mount of a cluster must be declared shared.

    The checkpoint folder is: every executor reaches it.
    """
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        fs, handle = hadoop_path(spark, path)
        path = handle.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    one_machine = spark.sparkContext.master.startswith("local")
    if _scheme_of(path) == "file" and not (shared or one_machine or in_shared_folder(spark, path)):
        raise TransferError(f"{path} may be another folder on every executor; say shared=True if not")
    return path


def copy_objects(
    listing: DataFrame,
    dest: str,
    codec: str | None = None,
    range_bytes: int = RANGE_BYTES,
    shared: bool = False,
) -> DataFrame:
    """Copy every object of a listing below ``dest``, byte for byte.

    ``codec`` is None, ``compress`` or ``decompress`` (bzip2). Objects are
    written under staging names and get their final ones only when whole. A
    destination without a scheme is one of the default file system; on a cluster a
    mount must be one that all executors share: ``shared`` says so, and of what lies in
    the checkpoint folder it is known. Returns
    ``(path, name, dest, bytes, ranges_md5)``; the digest is that of the plain bytes,
    also where the copy is compressed, so all three forms compare.
    """
    if codec not in (None, "compress", "decompress"):
        raise ValueError(f"unknown codec: {codec}")
    spark = listing.sparkSession
    dest = _qualified(spark, dest, shared)
    mounted = _scheme_of(dest) == "file"
    root = (_local(dest) if mounted else dest).rstrip("/")
    staging = f"{root}/.staging-{os.path.basename(scratch_path(spark, 'copy'))}"
    final = {
        None: F.col("name"),
        "compress": F.concat("name", F.lit(".bz2")),
        "decompress": F.regexp_replace("name", r"\.bz2\z", ""),
    }[codec]
    place = lambda base: F.concat(F.lit(base + "/"), final)
    same = F.regexp_replace("path", r"\Afile:/*", "/") == place(root)
    clash = listing.filter(same).first()
    if clash is not None:
        raise TransferError(f"cannot copy {clash['path']} onto itself")
    placed = listing.select(
        "path", "name", "size", place(staging).alias("target"), place(root).alias("dest")
    )
    if codec == "decompress":
        done = _decompressed(placed, range_bytes, mounted)
    else:
        # stores take no writes at an offset; what is packed is cut alike everywhere
        ranges = byte_ranges(placed, range_bytes if mounted or codec else _WHOLE)
        plain = None
        if codec == "compress":
            ranges, plain = _compressed(ranges, mounted)
        else:
            ranges = ranges.withColumn("target_offset", F.col("offset"))
        done = ranges.select(
            "path", "name", "offset", "length", "target", "target_offset"
        ).mapInPandas(_range_writer(range_bytes) if mounted or plain is None else _laid_end_to_end, _RANGE_DIGEST)
    # written once, then published: a retry of the second step repeats no copy
    done = done.withColumn("staged", place(staging))
    if codec == "compress":
        done = done.withColumn("path", F.col("staged"))  # parts belong to their target
    written = cut_lineage(done, "copied")
    whole = _whole_digest(written, F.max("staged").alias("staged")).withColumn(
        "dest", place(root)
    )
    if codec == "compress":  # of what was packed, not of the packing
        plain = _whole_digest(plain).select(F.col("path").alias("staged"), "ranges_md5")
        whole = whole.drop("ranges_md5").join(plain, "staged")
    published = cut_lineage(
        whole.select("path", "name", "staged", "dest", "bytes", "ranges_md5").mapInPandas(
            _publish, "path string, name string, dest string, bytes bigint, ranges_md5 string"
        ),
        "published",
    )
    fs, leftover = hadoop_path(spark, f"file:{staging}" if mounted else staging)
    fs.delete(leftover, True)
    return published


def _laid_end_to_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One store object from all its parts, given in order as ``path``, one text per line."""
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            digests = _RangeDigests(_WHOLE)
            with _open_output(row.target) as out:
                for part in row.path.split("\n"):
                    with _open_input(part) as handle:
                        while piece := handle.read(BUFFER):
                            out.write(piece)
                            digests.update(bytes(piece))
            rows += digests.rows(row.target, row.name)
        yield pd.DataFrame(rows, columns=_DIGEST_COLUMNS)


def _compressed(ranges: DataFrame, mounted: bool) -> tuple[DataFrame, DataFrame]:
    """Compress ranges to parts, then say where each part goes in its target.

    Also the digests of what was packed. A store has no writes at an offset, so there a
    target gets all of its parts at once, in order.
    """
    part = F.concat("target", F.lit(".part-"), F.col("offset").cast("string"))
    parts = cut_lineage(
        ranges.withColumn("part", part)
        .select("path", "name", "offset", "length", "part", "target")
        .mapInPandas(
            _compress_ranges,
            "path string, name string, target string, at bigint, length bigint, plain_md5 string",
        ),
        "packed",
    )
    plain = parts.select(
        F.col("target").alias("path"), "name", F.col("at").alias("offset"), "length",
        F.col("plain_md5").alias("md5"),
    )
    zero = F.lit(0).cast("bigint")
    if not mounted:
        ordered = F.array_sort(F.collect_list(F.struct("at", "path")))
        joined = F.array_join(F.transform(ordered, lambda p: p["path"]), "\n")
        whole = parts.groupBy("name", "target").agg(joined.alias("path"), F.sum("length").alias("length"))
        return whole.select("path", "name", zero.alias("offset"), "length", "target", zero.alias("target_offset")), plain
    earlier = (
        Window.partitionBy("name").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = parts.select(
        "path",
        "name",
        zero.alias("offset"),
        "length",
        "target",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("target_offset"),
    )
    return placed, plain


# -- sinks ------------------------------------------------------------------------


def discard(df: DataFrame) -> int:
    """Run a frame and keep nothing; returns 0, the rows stored."""
    df.write.format("noop").mode("overwrite").save()
    return 0


def write_objects(df: DataFrame, dest: str, shared: bool = False) -> DataFrame:
    """Store each row's ``content`` as an object ``name`` below ``dest``; returns a listing.

    ``(path, name, size)`` per object. A repeated row writes the same object again.
    """
    root = _qualified(df.sparkSession, dest, shared).rstrip("/")

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with _open_output(row.path) as out:
                    out.write(bytes(row.content))
            yield batch[["path", "name"]].assign(size=[len(c) for c in batch["content"]])

    rows = df.select(
        F.concat(F.lit(root + "/"), "name").alias("path"), "name", F.col("content").cast("binary").alias("content")
    )
    return cut_lineage(rows.mapInPandas(store, "path string, name string, size bigint"), "stored")


def publish_dataset(df: DataFrame, dest: str, file_format: str = "parquet", **options) -> None:
    """Write beside the target, then give it its name, so no reader sees a part.

    Every call has a staging name of its own; what is there already is told first.
    """
    spark = df.sparkSession
    fs, target = hadoop_path(spark, dest)
    if fs.exists(target):
        raise TransferError(f"already there: {dest}")
    staged = f"{dest.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    df.write.format(file_format).options(**options).mode("overwrite").save(staged)
    _, source = hadoop_path(spark, staged)
    if fs.exists(target):
        fs.delete(source, True)
        raise TransferError(f"already there: {dest}")
    if not fs.rename(source, target):
        raise TransferError(f"cannot publish {dest}")


# Executors need no copy of this package: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(bzip)
