"""Running a stream to the end of its input and reading what it produced."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from conduit.session import hadoop_path, scratch_path


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Process what is there now in micro-batches; restarts at the checkpoint.

    With ``every``, an interval such as ``250 milliseconds``, the query goes on and looks
    for new records that often until it is stopped.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "checkpoint")
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own folder; repeating one replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_batches(spark, path: str, schema: T.StructType) -> DataFrame:
    """Everything written by :func:`batch_writer`, with its ``batch`` number."""
    return read_parts(spark, path, T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))


def read_parts(spark, path: str, schema: T.StructType) -> DataFrame:
    """Parquet below a folder, folder names as columns; no rows where nothing was written."""
    fs, handle = hadoop_path(spark, path)
    if not fs.exists(handle):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


class Delivered:
    """How many rows a stream's batches had, beside its checkpoint, so that a restart goes on counting.

    A batch's number and rows are the name of an empty file; every ``SUM_EVERY`` batches
    one file with their sum replaces them. A batch that is repeated counts once.
    """

    SUM_EVERY = 100

    def __init__(self, spark, checkpoint: str):
        self._spark, self._path = spark, f"{checkpoint.rstrip('/')}/delivered"
        self._fs, self._root = hadoop_path(spark, self._path)

    def _held(self) -> tuple[int, int, dict[int, list[int]]]:
        """The last batch of the newest sum, that sum, and the rows of the batches behind it."""
        if not self._fs.exists(self._root):
            return -1, 0, {}
        names = [status.getPath().getName() for status in self._fs.listStatus(self._root)]
        sums = [tuple(map(int, n.split("-")[1:])) for n in names if n.startswith("sum-")]
        last, total = max(sums, default=(-1, 0))
        rows: dict[int, list[int]] = {}
        for batch, count in (map(int, n.split("-")) for n in names if n[0].isdigit()):
            if batch > last:
                rows.setdefault(batch, []).append(count)
        return last, total, rows

    def _create(self, name: str) -> None:
        self._fs.create(hadoop_path(self._spark, f"{self._path}/{name}")[1], True).close()

    def add(self, batch_id: int, count: int) -> None:
        last, total, rows = self._held()
        if batch_id <= last or batch_id in rows:
            return
        self._create(f"{batch_id}-{count}")
        if (batch_id + 1) % self.SUM_EVERY:
            return
        total += count + sum(c[0] for c in rows.values())
        self._create(f"sum-{batch_id}-{total}")
        for status in self._fs.listStatus(self._root):
            name = status.getPath().getName()
            if int(name.removeprefix("sum-").split("-")[0]) < batch_id or name == f"{batch_id}-{count}":
                self._fs.delete(status.getPath(), False)

    def total(self) -> int:
        _, total, rows = self._held()
        return total + sum(c[0] for c in rows.values())


class Subscription:
    """A stream that runs until it is stopped; guards its own order of calls."""

    def __init__(self, every: str = "250 milliseconds"):
        self.every = every
        self._stream: DataFrame | None = None
        self._handle: Callable[[DataFrame, int], None] | None = None
        self._query: StreamingQuery | None = None
        self._counts: Delivered | None = None

    def subscribe(self, stream: DataFrame, handle: Callable[[DataFrame, int], None]) -> None:
        if self._query is not None:
            raise RuntimeError("already started")
        self._stream, self._handle = stream, handle

    def start(self, checkpoint: str | None = None) -> StreamingQuery:
        """Begin to deliver; a second start, or one without a subscription, raises."""
        if self._stream is None:
            raise RuntimeError("nothing is subscribed")
        if self._query is not None:
            raise RuntimeError("already started")
        checkpoint = checkpoint or scratch_path(self._stream.sparkSession, "checkpoint")
        self._counts = Delivered(self._stream.sparkSession, checkpoint)
        self._query = start(self._stream, self._counted, checkpoint, every=self.every)
        return self._query

    def _counted(self, batch: DataFrame, batch_id: int) -> None:
        """Handle a batch and count it; it is kept meanwhile, so it is read once."""
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._handle(batch, batch_id)
            self._counts.add(batch_id, batch.count())
        finally:
            batch.unpersist()

    def delivered(self) -> int:
        """Rows handled since the checkpoint began, over all starts; exact, however many batches."""
        return self._counts.total() if self._counts else 0

    def stop(self) -> None:
        """Stop after the batch at hand; stopping what does not run does nothing."""
        if self._query is not None:
            self._query.stop()
            self._query = None


def materialise(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream into the shared folder and return its output as a frame."""
    path = scratch_path(stream.sparkSession, label)
    start(stream, batch_writer(path), mode=mode).awaitTermination()
    return read_batches(stream.sparkSession, path, stream.schema)


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of update-mode output."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    newest = updates.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), "batch").alias("_newest")
    )
    return newest.select(*keys, "_newest.*")
