"""A log of micro-batches as spans: appended one by one, merged as they pile up.

Each micro-batch is a folder named by its number; ``fan`` spans of one length become a
span of their batches together, so what a reader opens grows with the logarithm of the
number of batches. Rows may lie in buckets, of which a reader opens those it needs.

Nothing is changed in place. A span counts when it is finished, and one that lies within
a longer finished one does not count any more; it is deleted at the next merge, so that
who reads it now can end. The newest batch is never merged, since a restarted stream
may repeat it; then it replaces its own part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.session import hadoop_path

BATCH, BUCKET = "batch", "bucket"
Span = tuple[int, int]


class SpanLog:
    """Frames of one schema below a folder; ``batch`` says in which micro-batch a row came.

    ``bucketed_by`` names columns whose hash deals rows to ``buckets`` folders of a span.
    ``merge`` reduces the rows of several spans to what is still needed of them.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        bucketed_by: Sequence[str] = (),
        buckets: int = 32,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        fan: int = 8,
    ):
        self.path, self.merge, self.fan = path.rstrip("/"), merge, fan
        self.schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        self.bucketed_by, self.buckets = list(bucketed_by), buckets

    def bucket_of(self) -> Column:
        """The bucket of a row."""
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.bucketed_by]), F.lit(self.buckets)).cast("int")

    def append(self, frame: DataFrame, batch_id: int) -> None:
        """Store a micro-batch; one that is there already is replaced."""
        spark = frame.sparkSession
        if any(first <= batch_id <= last and first < last for first, last in self._finished(spark)):
            raise ValueError(f"batch {batch_id} is merged already: {self.path} belongs to another checkpoint")
        self._write(frame.withColumn(BATCH, F.lit(batch_id).cast("bigint")), (batch_id, batch_id))

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of some buckets, or of batches before one."""
        rows = self.read_spans(spark, self.spans(spark), buckets)
        return rows if before is None else rows.where(F.col(BATCH) < before)

    def touched(self, frame: DataFrame) -> list[int]:
        """The buckets of a frame's rows: never more than there are buckets."""
        return sorted(row[0] for row in frame.select(self.bucket_of().alias(BUCKET)).distinct().collect())

    def newest(self, spark: SparkSession) -> int | None:
        """The number of the last micro-batch."""
        return max((last for _, last in self._finished(spark)), default=None)

    def spans(self, spark: SparkSession) -> list[Span]:
        """The spans that count, in order."""
        kept: list[Span] = []
        for span in sorted(self._finished(spark), key=lambda s: (s[0], -s[1])):
            if not kept or span[1] > kept[-1][1]:
                kept.append(span)
        return kept

    def settle(self, spark: SparkSession, newest: int) -> None:
        """Merge spans of batches before ``newest`` wherever ``fan`` of a length lie side by side."""
        counted = self.spans(spark)
        stale = set(self._finished(spark)) - set(counted)
        merged = False
        while run := self._due([s for s in counted if s[1] < newest]):
            whole = (run[0][0], run[-1][1])
            rows = self.read_spans(spark, run)
            self._write(self.merge(rows) if self.merge else rows, whole)
            counted = sorted({*counted, whole} - set(run))
            merged = True
        if merged:
            self.delete(spark, stale)

    def delete_within(self, spark: SparkSession, span: Span) -> None:
        """Delete a span; before it those it was made of, which would count again."""
        inner = [s for s in self._finished(spark) if span[0] <= s[0] and s[1] <= span[1]]
        self.delete(spark, sorted(inner, key=lambda s: s[1] - s[0]))

    def delete(self, spark: SparkSession, spans) -> None:
        for span in spans:
            fs, folder = hadoop_path(spark, self._folder(span))
            fs.delete(folder, True)

    def _due(self, counted: list[Span]) -> list[Span]:
        """The last ``fan`` spans, if they are of one order of length."""
        tail = counted[-self.fan :]
        orders = {self._order(last - first + 1) for first, last in tail}
        return tail if len(tail) == self.fan and len(orders) == 1 else []

    def _order(self, length: int) -> int:
        order = 0
        while length >= self.fan:
            length, order = length // self.fan, order + 1
        return order

    def _folder(self, span: Span) -> str:
        return f"{self.path}/span={span[0]}-{span[1]}"

    def _finished(self, spark: SparkSession) -> list[Span]:
        fs, root = hadoop_path(spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            _, done = hadoop_path(spark, f"{self.path}/{name}/_SUCCESS")
            if name.startswith("span=") and fs.exists(done):
                first, _, last = name.removeprefix("span=").partition("-")
                found.append((int(first), int(last)))
        return found

    def _write(self, rows: DataFrame, span: Span) -> None:
        rows = rows.select(*self.schema.names)
        if not self.bucketed_by:
            rows.write.mode("overwrite").parquet(self._folder(span))
            return
        # rows of a bucket come together, and adaptive execution splits a bucket that is large
        dealt = rows.withColumn(BUCKET, self.bucket_of()).hint("rebalance", BUCKET)
        dealt = dealt.sortWithinPartitions(BUCKET, *self.bucketed_by)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self._folder(span))

    def read_spans(self, spark: SparkSession, spans: Sequence[Span], buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of some spans, or of some of their buckets."""
        folders = [self._folder(s) for s in spans]
        if buckets is not None:
            wanted = {f"{BUCKET}={b}" for b in buckets}
            found = []
            for folder in folders:
                fs, handle = hadoop_path(spark, folder)
                names = [s.getPath().getName() for s in fs.listStatus(handle)]
                found += [f"{folder}/{name}" for name in names if name in wanted]
            folders = found
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return rows.select(*self.schema.names)
