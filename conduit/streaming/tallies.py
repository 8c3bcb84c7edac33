"""Live counters and de-duplication that no row is too late for.

There is no watermark to close an hour or to forget a key. Counters are kept as partials
by key and micro-batch, which merge in any order, so a late row updates its counter like
any other. Records are kept once: their keys are looked up in the buckets of what was
kept before. Both are logs of spans, so that a repeated batch replaces its own part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conduit.streaming.spans import BATCH, SpanLog

# How partials of each kind of measure come from rows, and from each other.
_FROM_ROWS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_FROM_PARTS = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


class Tally:
    """Aggregates per key below a folder: ``measures`` maps a name to (kind, column).

    A kind is count, sum, min or max. ``store`` is a ``foreachBatch`` function. A null key
    is a key like any other.
    """

    def __init__(self, path: str, stream: DataFrame, keys: dict[str, Column], measures: dict[str, tuple[str, Column]]):
        self.keys, self.measures = keys, measures
        self.log = SpanLog(path, self._partials(stream).schema, merge=self._merged)

    def _partials(self, rows: DataFrame) -> DataFrame:
        totals = [_FROM_ROWS[kind](column).alias(name) for name, (kind, column) in self.measures.items()]
        return rows.groupBy(*[c.alias(name) for name, c in self.keys.items()]).agg(*totals)

    def _merged(self, parts: DataFrame) -> DataFrame:
        totals = [_FROM_PARTS[kind](name).alias(name) for name, (kind, _) in self.measures.items()]
        return parts.groupBy(*self.keys).agg(*totals, F.max(BATCH).alias(BATCH))

    def store(self, batch: DataFrame, batch_id: int) -> None:
        self.log.append(self._partials(batch), batch_id)
        self.log.settle(batch.sparkSession, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """``(*keys, *measures)`` over all that came so far."""
        return self._merged(self.log.read(spark)).drop(BATCH)


class Kept:
    """Each record of a stream once, however often and however late it is delivered.

    Deliveries agree in ``keys``, which no other record has. With ``delay`` (an interval,
    such as ``1 hour``) the times ``ts`` of a record's deliveries lie no further apart than
    that, and of what was kept only the rows around a batch's times are opened. Which of
    several deliveries in one batch stays is not said. ``store`` is a ``foreachBatch``
    function; null keys are equal to each other.
    """

    def __init__(
        self,
        path: str,
        stream: DataFrame,
        keys: Sequence[str],
        ts: str | None = None,
        delay: str | None = None,
        buckets: int = 32,
    ):
        self.keys, self.ts, self.delay = list(keys), ts, delay
        self.log = SpanLog(path, stream.schema, keys, buckets)

    def store(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = self._near(batch, self.log.read(spark, self.log.touched(batch), batch_id))
            old = seen.select(*[F.col(c).alias(f"_{at}") for at, c in enumerate(self.keys)])
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{at}")) for at, c in enumerate(self.keys)])
            self.log.append(batch.dropDuplicates(self.keys).join(old, same, "left_anti"), batch_id)
        finally:
            batch.unpersist()
        self.log.settle(spark, batch_id)

    def _near(self, batch: DataFrame, seen: DataFrame) -> DataFrame:
        """What was kept within the delay around a batch's times, by bounds that a scan can use."""
        if not self.delay:
            return seen
        reach = F.expr(f"INTERVAL {self.delay}")
        first, last = batch.agg(F.min(self.ts) - reach, F.max(self.ts) + reach).first()
        near = F.col(self.ts).isNull()
        return seen.where(near if first is None else near | F.col(self.ts).between(F.lit(first), F.lit(last)))

    def read(self, spark: SparkSession) -> DataFrame:
        """The records kept so far."""
        return self.log.read(spark).drop(BATCH)
