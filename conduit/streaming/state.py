"""Live hashes: the op-log fold kept up to date by a stream.

The state below a folder is the log itself: each micro-batch adds its operations under
its own number, so files may arrive in any order and in any number of batches, and a
repeated batch replaces its own part. What a key holds is always the distributed fold of
its operations in the order of their times, however late one came, so a hot key is
spread out and nothing is dropped. The log lies in spans and buckets of keys
(:mod:`conduit.streaming.spans`), so a batch opens only the buckets it touched, and of
those as many files as the logarithm of the number of batches.

:func:`compact` folds the past into a base that says up to which moment and batch it
goes; only what comes behind that moment in a later batch can no longer be placed, and
goes to a frame of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.operators.counters import alive
from conduit.operators.oplog import fold_log
from conduit.session import hadoop_path
from conduit.streaming.spans import SpanLog

_TEXT, _NUMBER = T.StringType(), T.LongType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_OPS = _struct(
    key=_TEXT, ts=T.TimestampType(), seq=_NUMBER, op=_TEXT, field=_TEXT, amount=_NUMBER
)
_HELD = _struct(key=_TEXT, field=_TEXT, value=_NUMBER, expire_at=T.TimestampNTZType())


def _log(path: str) -> SpanLog:
    return SpanLog(f"{path}/ops", _OPS, ["key"])


def _late_log(path: str) -> SpanLog:
    return SpanLog(f"{path}/late", _OPS)


def _newest(updates: DataFrame) -> DataFrame:
    """Of every key the rows of its newest batch."""
    newest = updates.groupBy("key").agg(F.max("batch").alias("_batch"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("batch") == F.col("_batch"))
    return updates.join(newest.withColumnRenamed("key", "_key"), same, "left_semi")


def _updates(path: str) -> SpanLog:
    return SpanLog(f"{path}/updates", _HELD, merge=_newest)


def store_operations(path: str, ts: str = "ts", seq: str = "seq"):
    """``foreachBatch`` function that adds each batch's operations to the log below ``path``.

    Operations at or before the moment of a base go to ``late`` beside it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ops = batch.select(
            F.col("key").cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"),
            F.col(seq).cast("bigint").alias("seq"), "op", "field",
            F.col("amount").cast("bigint").alias("amount"),
        )
        base = _base(spark, path)
        if base is not None and batch_id > base.upto:
            behind = F.unix_micros("ts") <= base.clock
            _late_log(path).append(ops.where(behind), batch_id)
            ops = ops.where(~behind)
        _log(path).append(ops, batch_id)
        _log(path).settle(spark, batch_id)

    return store


def live_hashes(path: str, ts: str = "ts", seq: str = "seq"):
    """``foreachBatch`` function that also tells what the keys a batch touched now hold.

    The log of updates gets ``(key, field, value, expire_at)`` of those keys, and one row
    without a field for a key that holds nothing any more. Only they are folded again.
    """
    store = store_operations(path, ts, seq)

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store(batch, batch_id)
        log = _log(path)
        added = log.read(spark, before=batch_id + 1).where(F.col("batch") == batch_id).select("key")
        touched = added.distinct()
        mine = operations(spark, path, log.touched(added)).join(touched, "key", "left_semi").drop("batch")
        newest = mine.agg(F.max("ts")).first()[0]
        if newest is None:
            return
        held = fold_log(mine, ["key"], newest)
        _updates(path).append(touched.join(held, "key", "left").select(*_HELD.names), batch_id)
        _updates(path).settle(spark, batch_id)

    return fold


def operations(spark, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """All operations of the log, with the batch each came in; a base comes in none.

    Of some buckets, if those are given.
    """
    log = _log(path).read(spark, buckets)
    base = _base(spark, path)
    if base is None:
        return log
    held = base.log(path).read(spark, buckets).drop("batch")
    kept = log.where(F.unix_micros("ts") > base.clock)
    return kept.unionByName(_as_operations(held, base.clock).withColumn("batch", F.lit(None).cast("bigint")))


def late_operations(spark, path: str) -> DataFrame:
    """Operations that came behind a base's moment, by batch.

    Those that a batch stored while the base was made are among them.
    """
    late = _late_log(path).read(spark)
    base = _base(spark, path)
    return late if base is None else late.unionByName(_behind(spark, path, base))


def folded_values(spark, path: str, as_of) -> DataFrame:
    """``(key, field, value, expire_at)`` alive at a moment after a base's."""
    return fold_log(operations(spark, path).drop("batch"), ["key"], as_of).select(*_HELD.names)


def live_values(spark, path: str, as_of) -> DataFrame:
    """The same from the newest update of each key, at a moment after the last operation."""
    held = _newest(_updates(path).read(spark)).where(F.col("field").isNotNull())
    return alive(held, F.lit(as_of).cast("timestamp_ntz")).select(*_HELD.names)


def _behind(spark, path: str, base: Base) -> DataFrame:
    """Operations that a base could not take in, and those the bases before it could not."""
    log = _log(path).read(spark).where((F.unix_micros("ts") <= base.clock) & (F.col("batch") > base.upto))
    before = base.behind(path).read(spark).drop("batch").withColumnRenamed("came", "batch")
    return log.unionByName(before)


class Base(NamedTuple):
    """A fold of all operations up to a moment (in microseconds) and a batch."""

    clock: int
    upto: int

    def log(self, path: str) -> SpanLog:
        """The base's rows, as a log of one span, in the buckets of the operations."""
        return SpanLog(f"{path}/base/clock={self.clock}-upto={self.upto}/values", _HELD, ["key"])

    def behind(self, path: str) -> SpanLog:
        """Operations that came behind the bases before, with the batch they came in."""
        kinds = T.StructType([*_OPS.fields, T.StructField("came", _NUMBER)])
        return SpanLog(f"{path}/base/clock={self.clock}-upto={self.upto}/behind", kinds)


def compact(spark, path: str, until) -> None:
    """Fold all up to a moment into a base; a moment not after the present base's is refused.

    The base counts from the moment it is finished, all buckets at once; until then, and
    if this ends before, the one before counts. A stream may write meanwhile: what it adds
    counts, or is among :func:`late_operations`. What the base before had made superfluous
    is deleted here, not what this one does, so that who reads now can end.
    """
    clock = spark.range(1).select(F.unix_micros(F.lit(until).cast("timestamp"))).first()[0]
    present = _base(spark, path)
    if present is not None and clock <= present.clock:
        raise ValueError(f"the base goes further already: {clock} is not after {present.clock}")
    log = _log(path)
    known = [n for n in (log.newest(spark), present and present.upto) if n is not None]
    if not known:
        return
    upto = max(known)
    held = fold_log(operations(spark, path).where(F.coalesce("batch", F.lit(-1)) <= upto).drop("batch"), ["key"], until)
    base = Base(clock, upto)
    if present is not None:
        base.behind(path).append(_behind(spark, path, present).withColumnRenamed("batch", "came"), 0)
    base.log(path).append(held.select(*_HELD.names), 0)  # last, as it makes the base count
    if present is not None:
        _delete_covered(spark, path, present)


def _delete_covered(spark, path: str, base: Base) -> None:
    """Spans whose operations are all in a base, and what was made before it."""
    log = _log(path)
    for span in log.spans(spark):
        if span[1] <= base.upto:
            last = log.read_spans(spark, [span]).agg(F.max(F.unix_micros("ts"))).first()[0]
            if last is None or last <= base.clock:
                log.delete_within(spark, span)
    fs, root = hadoop_path(spark, f"{path}/base")
    for status in fs.listStatus(root):
        found = _named(status.getPath().getName())
        if found.clock < base.clock:
            fs.delete(status.getPath(), True)


def _named(name: str) -> Base:
    clock, _, upto = name.removeprefix("clock=").partition("-upto=")
    return Base(int(clock), int(upto))


def _base(spark, path: str) -> Base | None:
    """The newest finished base."""
    fs, root = hadoop_path(spark, f"{path}/base")
    if not fs.exists(root):
        return None
    found = [_named(status.getPath().getName()) for status in fs.listStatus(root)]
    return max((b for b in found if b.log(path).spans(spark)), default=None)


def _as_operations(state: DataFrame, clock: int) -> DataFrame:
    """Operations that rebuild a state: its values, then its deadlines."""
    moment = F.timestamp_micros(F.lit(clock))
    values = state.select(
        "key", moment.alias("ts"), F.lit(-2).cast("bigint").alias("seq"),
        F.lit("hset").alias("op"), "field", F.col("value").alias("amount"),
    )
    ends = F.unix_micros(F.max("expire_at").cast("timestamp"))
    deadlines = state.filter(F.col("expire_at").isNotNull()).groupBy("key").agg(ends.alias("amount"))
    return values.unionByName(
        deadlines.select(
            "key", moment.alias("ts"), F.lit(-1).cast("bigint").alias("seq"),
            F.lit("expireat").alias("op"), F.lit(None).cast("string").alias("field"), "amount",
        )
    )
