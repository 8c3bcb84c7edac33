"""Running values over a total order without one task per key.

A key may hold a third of all rows, so nothing here windows over a whole key.
Rows are range-partitioned into *segments* of bounded size along the order;
values run inside a segment, and the totals of earlier segments (at most one
row per key and segment) are carried in.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conduit.session import cut_lineage

SEG = "_seg"
ORD = "_ord"
_SHIFT = 33  # monotonically_increasing_id keeps the row position in 33 bits


# Bytes that a segment is meant to hold; a frame's size is Spark's own estimate.
SEGMENT_BYTES = 256 * 1024 * 1024


def segment_count(df: DataFrame) -> int:
    """As many segments as the frame's bytes ask for, and enough to keep all cores busy."""
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a plan of unknown size is estimated as huge: then the session's number holds
    asked = -(-size // SEGMENT_BYTES) if size < 2**60 else 0
    return max(shuffle, spark.sparkContext.defaultParallelism, asked)


def ordered_segments(
    df: DataFrame, order: Sequence[str], total: bool = False, segments: int | None = None
) -> DataFrame:
    """Rows in order with ``_seg`` (segment) and ``_ord`` (global order).

    The result is written once, so segment numbers stay the same for every
    later pass. Unless the order is ``total`` (tells every row apart), a hash of
    the row breaks ties; that lets a run of equal order values be split, but the
    pass that samples the order then reads every column.
    """
    columns = [F.col(c) for c in order]
    if not total:
        columns.append(_row_hash(df))
    placed = df.withColumns({f"_order{at}": c for at, c in enumerate(columns)})
    keys = [f"_order{at}" for at in range(len(columns))]
    ranged = placed.repartitionByRange(
        segments or segment_count(df), *keys
    ).sortWithinPartitions(*keys)
    position = F.monotonically_increasing_id()
    tagged = ranged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.shiftright(position, _SHIFT).cast("int").alias(SEG),
        position.alias(ORD),
    )
    return cut_lineage(tagged, "segments")


def _row_hash(df: DataFrame) -> Column:
    hashable = [
        f.name
        for f in df.schema.fields
        if not re.search("map<|variant", f.dataType.simpleString())
    ]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable])


def running(
    segments: DataFrame,
    keys: Sequence[str],
    measures: dict[str, tuple[Callable[[Column], Column], Column]],
    inclusive: bool = True,
) -> DataFrame:
    """Add running values per key; ``measures`` maps a name to (aggregate, value).

    The aggregate must combine its own results (sum, max, min). Carried totals
    travel as one extra row at the head of their segment, so there is no join.
    """
    prepared = segments.select(
        "*", *[value.alias(name) for name, (_, value) in measures.items()]
    )
    totals = prepared.groupBy(*keys, SEG).agg(
        *[agg(F.col(name)).alias(name) for name, (agg, _) in measures.items()]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *keys,
        SEG,
        F.lit(-1).cast("bigint").alias(ORD),
        *[agg(F.col(name)).over(earlier).alias(name) for name, (agg, _) in measures.items()],
    ).filter(reduce(or_, [F.col(name).isNotNull() for name in measures]))
    here = (
        Window.partitionBy(*keys, SEG)
        .orderBy(ORD)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    both = prepared.unionByName(carried, allowMissingColumns=True)
    return both.withColumns(
        {name: agg(F.col(name)).over(here) for name, (agg, _) in measures.items()}
    ).filter(F.col(ORD) >= 0)


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "row_no", total: bool = False
) -> DataFrame:
    """Global 1-based row numbers along ``order``; see :func:`ordered_segments`."""
    segments = ordered_segments(df, order, total)
    counts = segments.groupBy(SEG).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per segment: this window never sees more rows than the job has partitions.
    offsets = counts.select(
        F.col(SEG).alias("_at"),
        (F.sum("_rows").over(Window.orderBy(SEG)) - F.col("_rows")).alias("_before"),
    )
    within = F.col(ORD) - F.shiftleft(F.col(SEG).cast("bigint"), _SHIFT)
    return segments.join(
        F.broadcast(offsets), F.col(SEG) == F.col("_at"), "inner"
    ).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + within + 1).alias(name)
    )
