"""Pages of an ordered table that open only the files they lie in.

The rows are written once in order, each segment a folder, with a directory beside them:
how many rows lie before each segment. A page reads the segments it overlaps, so what it
opens does not grow with its number, as it would by numbering or skipping rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.plans.segments import _SHIFT, ORD, SEG, ordered_segments
from conduit.session import hadoop_path


def write_pages(df: DataFrame, order: Sequence[str], path: str, total: bool = False, segments: int | None = None) -> Pages:
    """Write a table's rows in order, with their directory; ties as in ``paginate``."""
    placed = ordered_segments(df, order, total, segments)
    placed.write.partitionBy(SEG).parquet(f"{path}/rows")
    counts = placed.groupBy(F.col(SEG).alias("segment")).agg(F.count(F.lit(1)).alias("rows"))
    counts.write.parquet(f"{path}/directory")
    return Pages(df.sparkSession, path, df.schema)


class Pages:
    """What :func:`write_pages` wrote."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        # one row per segment, which is as many as the writing job had tasks
        found = spark.read.parquet(f"{self.path}/directory").orderBy("segment").collect()
        self.segments = [r["segment"] for r in found]
        self.before = [0, *accumulate(r["rows"] for r in found)]

    @property
    def rows(self) -> int:
        return self.before[-1]

    def page(self, number: int, size: int = 256) -> DataFrame:
        """The rows of a page, counted from 0, in order; none behind the last page."""
        if size < 1 or number < 0:
            raise ValueError("a page has a size from 1 and a number from 0")
        return self.between(number * size, (number + 1) * size)

    def between(self, first: int, last: int) -> DataFrame:
        """The rows from one place to before another, with ``row_no`` from 1, in order."""
        last = min(last, self.rows)
        numbered = T.StructType([*self.schema.fields, T.StructField("row_no", T.LongType())])
        if first >= last:
            return self.spark.createDataFrame([], numbered)
        low = bisect_right(self.before, first) - 1
        high = bisect_right(self.before, last - 1) - 1
        opened = self.segments[low : high + 1]
        starts = F.create_map(*[F.lit(x) for s, b in zip(opened, self.before[low:]) for x in (s, b)])
        stored = T.StructType([*self.schema.fields, T.StructField(ORD, T.LongType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(
            *[f"{self.path}/rows/{SEG}={s}" for s in opened]
        )
        within = F.col(ORD) - F.shiftleft(F.col(SEG).cast("bigint"), _SHIFT)
        row_no = (F.element_at(starts, F.col(SEG).cast("int")) + within + 1).cast("bigint")
        shown = rows.select(*[F.col(f"`{c}`") for c in self.schema.names], row_no.alias("row_no"))
        return shown.where((F.col("row_no") > first) & (F.col("row_no") <= last)).orderBy("row_no")

    def files(self, number: int, size: int = 256) -> int:
        """How many files a page opens."""
        return len(self.page(number, size).inputFiles())


def release(pages: Pages) -> None:
    """Delete the written rows and their directory."""
    fs, root = hadoop_path(pages.spark, pages.path)
    fs.delete(root, True)
