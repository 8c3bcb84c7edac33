"""Change feeds, dispatch to handlers, de-duplication and live counters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conduit.functions.patterns import CHANGE_FLAGS
from conduit.operators.counters import statistics_columns
from conduit.operators.lookups import Topic, route_exact, topic_table
from conduit.streaming.tallies import Kept, Tally

Handler = Callable[[DataFrame, int], None]


def is_bulk(op: Column) -> Column:
    """A change of all rows, which carries no row id."""
    return op.bitwiseAND(F.lit(CHANGE_FLAGS["allrows"])) > 0


def change_events(stream: DataFrame, op: str = "row_op", rowid: str = "rowid") -> DataFrame:
    """The feed with the row id of bulk changes emptied."""
    return stream.withColumn(
        rowid, F.when(is_bulk(F.col(op)), F.lit("")).otherwise(F.col(rowid))
    )


def dispatcher(
    topics: Sequence[Topic],
    handlers: dict[str, Handler],
    source: str,
    global_handler: Handler | None = None,
) -> Handler:
    """A ``foreachBatch`` function: one call per topic present, or one for all.

    The batch is kept while its topics are handled, so it is read once.
    """

    def dispatch(batch: DataFrame, batch_id: int) -> None:
        if global_handler:
            global_handler(batch, batch_id)
            return
        matched = route_exact(batch, source, topic_table(batch.sparkSession, topics))
        matched = matched.filter(F.col("topic_index").isNotNull())
        matched.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            present = matched.select("topic_index").distinct().collect()  # <= len(topics)
            for at in sorted(row[0] for row in present):
                handler = handlers.get(topics[at].name)
                if handler:
                    rows = matched.filter(F.col("topic_index") == at).drop("topic_index")
                    handler(rows, batch_id)
        finally:
            matched.unpersist()

    return dispatch


def once(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, path: str) -> Kept:
    """Each record once below ``path``, however often it was delivered within ``delay``."""
    return Kept(path, stream, keys, ts, delay)


def hourly_counters(stream: DataFrame, ts: str, amount: str, path: str) -> Tally:
    """Count and amount per hour below ``path``; a row counts however late it comes."""
    measures = {"count": ("count", F.lit(1)), "amount": ("sum", F.col(amount))}
    return Tally(path, stream, {"hour": F.date_trunc("hour", ts)}, measures)


def alive_hours(counters: DataFrame, as_of: Column, ttl: str = "1 day") -> DataFrame:
    """Hours whose counters live at a moment: they expire ``ttl`` after the hour began."""
    return counters.where(F.col("hour") + F.expr(f"INTERVAL {ttl}") > as_of)


def live_statistics(stream: DataFrame, identity: str, kind: Column, amount: Column) -> DataFrame:
    """Identity statistics kept up to date as events arrive."""
    return stream.groupBy(identity).agg(*statistics_columns(kind, amount))


def ticks(stream: DataFrame, ts: str, path: str, span: str = "1 second") -> Tally:
    """Rows per tick of a stream below ``path``; a row counts however late it comes."""
    return Tally(path, stream, {"tick": F.window(ts, span)["start"]}, {"rows": ("count", F.lit(1))})
