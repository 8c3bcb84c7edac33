"""Queries: streaming forms, run over a replay of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.functions.network import change_names
from conduit.operators.lookups import Topic, change_fate
from conduit.plans.catalogue_keys import (
    CHANGES_SQL,
    EXPIRING_FOLD_SQL,
    LOG_AS_OF,
    STATISTICS_SQL,
    amount,
    change_log,
    kind,
    operation_log,
    row_id,
)
from conduit.plans.registry import query, table
from conduit.session import scratch_path
from conduit.sources.topics import replay, shard_envelope
from conduit.streaming import feeds, runs, state


# Files that one micro-batch of a replay takes; by default all that are there.
FILES_PER_TRIGGER = None


def _events(spark, folder, files_per_trigger=None):
    """The events table as a stream, with a zoned timestamp."""
    path = f"{folder.rstrip('/')}/events.parquet"
    schema = table(spark, folder, "events").schema
    stream = replay(spark, path, schema, files_per_trigger or FILES_PER_TRIGGER)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _plain(column):
    return F.col(column).cast("timestamp_ntz").alias(column)


@query("SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def stm01_topic_replay(spark, folder):
    records = runs.materialise(_events(spark, folder).select("event_type"), "topic")
    return records.groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))


@query("""
    SELECT CASE WHEN event_type <> 'error' THEN hex(encode(props)) END AS data,
           CAST(event_id AS VARCHAR) AS sequence_number, CAST(user_id AS VARCHAR) AS partition_key,
           epoch_us(ts) // 1000 AS "timestamp"
    FROM events
""")
def stm02_shard_envelope(spark, folder):
    payload = F.when(F.col("event_type") != "error", F.col("props")).otherwise(F.lit(""))
    envelope = shard_envelope(payload, F.col("event_id"), F.col("user_id"), F.col("ts"))
    rows = runs.materialise(_events(spark, folder).select(*envelope), "envelope")
    return rows.select(
        F.hex("data").alias("data"), "sequence_number", "partition_key", "timestamp"
    )


@query(f"""
    SELECT CASE WHEN coalesce(rowid, '') = '' THEN 'bulk' WHEN rowid LIKE 'bad%' THEN 'malformed'
                ELSE 'row' END AS fate,
           CASE row_op WHEN 1 THEN 'allrows' WHEN 2 THEN 'insert' WHEN 4 THEN 'update'
                WHEN 8 THEN 'remove' END AS change, count(*) AS changes
    FROM {CHANGES_SQL} GROUP BY 1, 2
""")
def stm03_change_feed(spark, folder):
    stream = _events(spark, folder)
    user = F.col("user_id")
    code = F.expr(
        "CASE event_type WHEN 'signup' THEN 2 WHEN 'purchase' THEN 8 WHEN 'error' THEN 1 ELSE 4 END"
    )
    rowid = F.when(user % 16 == 5, F.concat(F.lit("bad "), user.cast("string"))).otherwise(
        row_id(user * 20)
    )
    changes = feeds.change_events(
        stream.select("event_id", rowid.alias("rowid"), code.alias("row_op"))
    )
    kept = runs.materialise(changes, "changes")
    tagged = kept.select(
        change_fate(F.col("rowid")).alias("fate"),
        F.array_join(change_names(F.col("row_op")), ",").alias("change"),
    )
    return tagged.groupBy("fate", "change").agg(F.count(F.lit(1)).alias("changes"))


@query("""
    SELECT CASE event_type WHEN 'signup' THEN 'accounts' WHEN 'view' THEN 'view'
                ELSE 'sales' END AS topic, event_id
    FROM events WHERE event_type IN ('signup', 'view', 'purchase')
""")
def stm04_dispatch(spark, folder):
    topics = (Topic("accounts", "signup"), Topic("view", "signup"), Topic("sales", "purchase"))
    path = scratch_path(spark, "dispatched")

    def store(topic):
        def handle(rows, batch_id):
            rows.select("event_id").write.mode("overwrite").parquet(
                f"{path}/topic={topic}/batch={batch_id}"
            )

        return handle

    handlers = {t.name: store(t.name) for t in topics}
    dispatch = feeds.dispatcher(topics, handlers, "event_type")
    runs.start(_events(spark, folder), dispatch).awaitTermination()
    kind = T.StructType.fromDDL("event_id bigint, topic string, batch bigint")
    return runs.read_parts(spark, path, kind).select("topic", "event_id")


@query("SELECT event_type, count(*) AS records FROM events GROUP BY event_type")
def stm05_once(spark, folder):
    # every record is delivered twice
    twice = _events(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    twice = twice.select("event_id", "event_type", "ts")
    kept = feeds.once(twice, ["event_id"], "ts", "1 hour", scratch_path(spark, "once"))
    runs.start(twice, kept.store).awaitTermination()
    return kept.read(spark).groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))


@query("SELECT count(*) AS records, CAST(sum(event_id) AS BIGINT) AS checksum FROM events")
def stm06_rate_limit(spark, folder):
    # a topic of several files, so that the limit makes several batches
    path = scratch_path(spark, "topic")
    events = table(spark, folder, "events").select("event_id")
    events.repartition(6, "event_id").write.parquet(path)
    stream = replay(spark, path, events.schema, files_per_trigger=2)
    rows = runs.materialise(stream, "limited")
    return rows.agg(
        F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("checksum")
    )


@query("SELECT count(*) AS records, CAST(sum(event_id) AS BIGINT) AS checksum FROM events")
def stm07_restart(spark, folder):
    path, checkpoint = scratch_path(spark, "restarted"), scratch_path(spark, "checkpoint")
    stream = _events(spark, folder).select("event_id")
    for _ in range(2):  # the second start finds nothing new
        runs.start(stream, runs.batch_writer(path), checkpoint).awaitTermination()
    return runs.read_batches(spark, path, stream.schema).agg(
        F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("checksum")
    )


@query("""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS count,
           round(sum(value), 2) AS amount
    FROM events GROUP BY 1
""")
def stm08_hourly_counters(spark, folder):
    stream = _events(spark, folder).select("ts", "value")
    hourly = feeds.hourly_counters(stream, "ts", "value", scratch_path(spark, "hourly"))
    runs.start(stream, hourly.store).awaitTermination()
    return hourly.read(spark).select(
        _plain("hour"), "count", F.round("amount", 2).alias("amount")
    )


@query(STATISTICS_SQL)
def stm09_live_statistics(spark, folder):
    live = feeds.live_statistics(_events(spark, folder), "user_id", kind(), amount())
    return runs.latest(runs.materialise(live, "statistics", "update"), ["user_id"])


def _operations(spark, folder, files_per_trigger=None):
    events = _events(spark, folder, files_per_trigger)
    ops = operation_log(spark, folder, expiring=True, events=events)
    ops = ops.filter(F.col("ts") <= F.lit(LOG_AS_OF).cast("timestamp"))
    return ops.withColumn("key", F.col("key").cast("string"))


_HASHES_SQL = f"SELECT CAST(key AS VARCHAR) AS key, field, value, expire_at FROM ({EXPIRING_FOLD_SQL})"


@query(_HASHES_SQL)
def stm10_batch_folds(spark, folder):
    path = scratch_path(spark, "folded")
    ops = _operations(spark, folder, files_per_trigger=5)
    runs.start(ops, state.store_operations(path)).awaitTermination()
    return state.folded_values(spark, path, LOG_AS_OF)


@query(_HASHES_SQL)
def stm10_live_hashes(spark, folder):
    path = scratch_path(spark, "hashes")
    ops = _operations(spark, folder, files_per_trigger=4)
    runs.start(ops, state.live_hashes(path)).awaitTermination()
    return state.live_values(spark, path, LOG_AS_OF)


@query("""
    SELECT date_trunc('second', ts) AS tick, count(*) AS "rows" FROM events GROUP BY 1
""")
def stm11_throughput(spark, folder):
    stream = _events(spark, folder).select("ts")
    ticks = feeds.ticks(stream, "ts", scratch_path(spark, "ticks"))
    runs.start(stream, ticks.store).awaitTermination()
    return ticks.read(spark).select(_plain("tick"), "rows")
