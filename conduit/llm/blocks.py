"""Blocks of documents: what they share is asked for once a block, the answers put back by position.

A block is a run of rows of one task with some megabytes of text. Its rows become numbers
of distinct units (words, lines, pairs); the units travel, each once a block, and the
answers meet the numbers again. A unit that is in every document is so one row a block,
whatever its share of all rows. Blocks are written before anything else reads them, so
that a lost executor finds the same blocks again.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from conduit.llm.common import byte_column, partitions_for
from conduit.session import scratch_path

# Bytes of text of one block; one longer text is a block of its own. No result depends on it.
BLOCK_BYTES = 16 << 20


def block_bytes() -> int:
    """The limit of a block, to be taken on the driver and sent with the code."""
    return BLOCK_BYTES


def gathered(batches, limit: int):
    """``(block, first column, texts)`` of the rows of ``batches(key, text)``; the text as bytes.

    Block numbers are unique over all tasks of a stage.
    """
    block = TaskContext.get().partitionId() << 24
    keys, texts, total = [], [], 0
    for found in batches:
        for key, text in zip(found.column(0).to_pylist(), byte_column(found.column(1))):
            if total and total + len(text) > limit:
                yield block, keys, texts
                block, keys, texts, total = block + 1, [], [], 0
            keys.append(key)
            texts.append(text)
            total += len(text)
    if keys:
        yield block, keys, texts


def squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def packed(values) -> bytes:
    """Numbers from 0 to 2**32 - 1, byte by byte in planes, compressed."""
    planes = np.ascontiguousarray(np.asarray(values).astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return squeezed(planes.tobytes())


def unsqueezed(data: bytes) -> bytes:
    return zstandard.decompress(data)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueezed(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def stored(blocks: DataFrame, label: str) -> DataFrame:
    """``blocks(block, ...)`` written in buckets of ``block``, so that answers move to them and not they to the answers.

    The bucketed table's name is dropped at once; its files stay in the shared folder.
    """
    spark = blocks.sparkSession
    name = f"conduit_{label}_{uuid.uuid4().hex}"
    writer = blocks.write.bucketBy(partitions_for(spark), "block").option("path", scratch_path(spark, label))
    writer.saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held


def answered(blocks: DataFrame, answers: DataFrame, run, ddl: str) -> DataFrame:
    """``run(block, answers)`` of every row of ``blocks``, a record batch each.

    ``blocks`` is of :func:`stored`. ``run`` gets a dictionary of the block's columns, and
    one of each column's values of its rows of ``answers(block, at, ...)``, ordered by ``at``.
    """

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["at"].to_numpy(), kind="stable")
        found = {c: right[c].take(pa.array(order)) for c in right.column_names}
        rows = left.to_pylist()
        if len(rows) != 1:
            raise ValueError("answers of a block that is not there")
        return pa.Table.from_batches([run(rows[0], found)])

    asked = answers.withColumnRenamed("block", "of_block")  # its own column, also where it comes from blocks
    return blocks.groupBy("block").cogroup(asked.groupBy("of_block")).applyInArrow(meet, ddl)
