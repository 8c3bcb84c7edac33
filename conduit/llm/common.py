"""What the operators of this subpackage share: shipping code, word arrays, Arrow maps."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one vectorised step holds as word lists and arrays. It bounds a
# Python worker's memory; no result depends on it.
STEP_BYTES = 1 << 20
# Rows of one Arrow batch: with rows of a few kilobytes, a few megabytes.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> SparkSession:
    """Let executors import this package, and keep Arrow batches of texts small.

    The package goes out as one zip through Spark's own file distribution, so
    executors need no installation and module-level caches live as long as a worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    if getattr(context, "_conduit_shipped", False):
        return spark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("conduit", os.path.relpath(path, root)))
    path = os.path.join(tempfile.mkdtemp(prefix="conduit-code-"), "conduit_code.zip")
    with open(path, "wb") as file:
        file.write(held.getvalue())
    context.addPyFile(path)
    context._conduit_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with null texts as empty ones; other columns play no part."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_column(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def steps(sizes: list[int], limit: int = STEP_BYTES):
    """Index ranges whose sizes sum to about ``limit``; one huge row is a step of its own."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(a: np.ndarray, b) -> np.ndarray:
    """A 64-bit name for the pair (a, b); the order counts."""
    with np.errstate(over="ignore"):
        h = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h + b) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in schema
        ],
        schema=schema,
    )


def sorted_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows dealt by ``keys`` and sorted in their partition, for a streaming pass."""
    return df.repartition(*keys).sortWithinPartitions(*order)


def bitmap_filter(ids: DataFrame, column: str, log2_bits: int = 23) -> bytes:
    """A bitmap of hashed ids, of fixed size (1 MiB), to thin out rows before a join.

    It may let rows pass that are not in ``ids``, never the reverse; the join decides.
    """
    slots = ids.select(slot_of(column, log2_bits).alias("slot"))
    words = (
        slots.select(
            F.shiftright("slot", 6).alias("word"),
            F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    out = np.zeros(1 << (log2_bits - 6), np.int64)
    found = words.toArrow()  # one row per word of the bitmap at most
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def maybe_in(bitmap: bytes, slots: pa.Array) -> np.ndarray:
    """Which rows, by the slots of their ids, may be in the bitmap."""
    bits, at = np.frombuffer(bitmap, np.int64), slots.to_numpy()
    return ((bits[at >> 6] >> (at & 63)) & 1).astype(bool)


def slot_of(column: str, log2_bits: int = 23) -> F.Column:
    """A row's place in the bitmap of :func:`bitmap_filter`."""
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << log2_bits))
