"""Streaming: replay, dispatch, de-duplication, restart and live counters."""

import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from conduit.operators.lookups import Topic
from conduit.plans import catalogue, catalogue_streams
from conduit.sources.topics import TopicSpec, decode_json, present_topics, replay, shard_envelope
from conduit.streaming import feeds, runs, spans, state

START = datetime.datetime(2024, 1, 1)


@pytest.fixture
def topic(spark, tmp_path):
    """Four files of ten records each, in order."""
    path = str(tmp_path / "topic")
    for part in range(4):
        rows = [
            (part * 10 + i, START + datetime.timedelta(minutes=part * 30 + i), "abcd"[i % 4] * 3, i)
            for i in range(10)
        ]
        df = spark.createDataFrame(rows, "id bigint, ts timestamp, kind string, v bigint")
        df.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, limit=1):
    return replay(spark, path, spark.read.parquet(path).schema, limit)


def test_rate_limit_makes_small_batches(spark, topic):
    rows = runs.materialise(stream(spark, topic), "limited")
    sizes = [r["count"] for r in rows.groupBy("batch").count().collect()]
    assert sizes == [10, 10, 10, 10]


def test_restart_resumes(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for expected in (40, 50):
        runs.start(stream(spark, topic), runs.batch_writer(out), checkpoint).awaitTermination()
        assert runs.read_batches(spark, out, stream(spark, topic).schema).count() == expected
        more = spark.range(100, 110).select(
            "id", F.lit(START).alias("ts"), F.lit("aaa").alias("kind"), F.col("id").alias("v")
        )
        more.coalesce(1).write.mode("append").parquet(topic)


def test_failed_batch_is_repeated(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write, calls = runs.batch_writer(out), []

    def flaky(batch, batch_id):
        write(batch, batch_id)
        calls.append(batch_id)
        if calls.count(1) == 1 and batch_id == 1:
            raise RuntimeError("after the write, before the commit")

    with pytest.raises(Exception):
        runs.start(stream(spark, topic), flaky, checkpoint).awaitTermination()
    runs.start(stream(spark, topic), flaky, checkpoint).awaitTermination()
    assert calls.count(1) == 2
    assert runs.read_batches(spark, out, stream(spark, topic).schema).count() == 40


def test_dispatch(spark, topic):
    seen = {}

    def note(name):
        def handle(rows, batch_id):
            seen[name] = seen.get(name, 0) + rows.count()

        return handle

    topics = [Topic("first", "aaa"), Topic("aaa", "bbb"), Topic("silent", "ccc")]
    handlers = {"first": note("first"), "aaa": note("aaa")}
    runs.start(stream(spark, topic), feeds.dispatcher(topics, handlers, "kind")).awaitTermination()
    assert seen == {"first": 12, "aaa": 12}
    seen.clear()
    all_rows = feeds.dispatcher(topics, handlers, "kind", global_handler=note("all"))
    runs.start(stream(spark, topic), all_rows).awaitTermination()
    assert seen == {"all": 40}


def test_once_across_batches(spark, topic, tmp_path):
    twice = stream(spark, topic).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    again = feeds.once(twice, ["id"], "ts", "1 hour", str(tmp_path / "once"))
    runs.start(twice, again.store).awaitTermination()
    assert sorted(r.id for r in again.read(spark).collect()) == list(range(40))


def test_live_results_equal_batch(spark, topic, tmp_path):
    batch = spark.read.parquet(topic)
    tally = feeds.hourly_counters(stream(spark, topic), "ts", "v", str(tmp_path / "hours"))
    runs.start(stream(spark, topic), tally.store).awaitTermination()
    hourly = tally.read(spark)
    expected = batch.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("v").alias("amount")
    )
    assert sorted(map(tuple, hourly.collect())) == sorted(map(tuple, expected.collect()))
    kind = F.create_map(F.lit("aaa"), F.lit("p2p"), F.lit("bbb"), F.lit("bill"))[F.col("kind")]
    live = runs.materialise(feeds.live_statistics(stream(spark, topic), "v", kind, F.col("id")), "s", "update")
    row = runs.latest(live, ["v"]).filter("v = 0").first()
    assert (row.p2p, row.p2p_sum, row.bill) == (4, 60, 0)


def test_late_rows_count(spark, tmp_path):
    """A row counts in its hour however late it comes; hours are alive for their time to live."""
    tally = feeds.hourly_counters(spark.createDataFrame([], "ts timestamp, v int"), "ts", "v", str(tmp_path / "hours"))
    at = lambda h: START + datetime.timedelta(hours=h)
    for n, hours in enumerate(((0, 0), (48,), (1, 0), (), (None,))):
        rows = [(None if h is None else at(h), 1) for h in hours]
        tally.store(spark.createDataFrame(rows, "ts timestamp, v int"), n)
    held = {r["hour"]: (r["count"], r["amount"]) for r in tally.read(spark).collect()}
    assert held == {at(0): (3, 3), at(1): (1, 1), at(48): (1, 1), None: (1, 1)}
    alive = feeds.alive_hours(tally.read(spark), F.lit(at(24.5)).cast("timestamp"), "1 day")
    assert {r.hour for r in alive.collect()} == {at(1), at(48)}


def test_repeated_batches_replace_their_own_part(spark, tmp_path):
    kept = feeds.once(spark.createDataFrame([], "id long, ts timestamp"), ["id"], "ts", "1 hour", str(tmp_path / "kept"))
    ticks = feeds.ticks(spark.createDataFrame([], "id long, ts timestamp"), "ts", str(tmp_path / "ticks"))
    late = START - datetime.timedelta(days=9)
    batches = [[(1, START), (1, START), (None, START)], [(2, late), (1, START)], [(2, late), (None, START), (3, None)], [(3, None)]]
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "id long, ts timestamp")
        for _ in range(2):  # a restart repeats the newest batch
            kept.store(frame, n)
            ticks.store(frame, n)
    assert sorted((r.id or 0) for r in kept.read(spark).collect()) == [0, 1, 2, 3]
    assert {r.tick: r.rows for r in ticks.read(spark).collect()} == {START: 5, late: 2}


def test_spans_grow_with_the_logarithm(spark, tmp_path):
    """What a batch opens does not grow with the log, and merging loses nothing."""
    log = spans.SpanLog(str(tmp_path / "log"), spark.range(1).schema, ["id"], buckets=4, fan=3)
    opened = []
    for n in range(20):
        log.append(spark.range(n * 10, n * 10 + 10, 1, 1), n)
        log.settle(spark, n)
        opened.append(len(log.read(spark, [1]).inputFiles()))
        assert [b[0] - a[1] for a, b in zip(log.spans(spark), log.spans(spark)[1:])] == [1] * (len(log.spans(spark)) - 1)
    assert max(opened[10:]) <= max(opened[:10]) + 2 and max(opened) <= 8
    assert sorted(r.id for r in log.read(spark).collect()) == list(range(200))
    assert sorted(r.id for r in log.read(spark, before=2).collect()) == list(range(20))
    some = log.touched(spark.range(5, 6))
    assert 5 in {r.id for r in log.read(spark, some).collect()}
    with pytest.raises(ValueError):
        log.append(spark.range(1), 3)  # another checkpoint begins anew in this log


def test_unfinished_spans_do_not_count(spark, tmp_path):
    log = spans.SpanLog(str(tmp_path / "log"), spark.range(1).schema, fan=2)
    for n in range(3):
        log.append(spark.range(n, n + 1), n)
    shutil.copytree(tmp_path / "log" / "span=0-0", tmp_path / "log" / "span=0-1")
    (tmp_path / "log" / "span=0-1" / "_SUCCESS").unlink()  # a merge that ended before it was done
    assert log.spans(spark) == [(0, 0), (1, 1), (2, 2)]
    log.settle(spark, 2)
    assert log.spans(spark) == [(0, 1), (2, 2)]
    assert sorted(r.id for r in log.read(spark).collect()) == [0, 1, 2]


def test_change_events_collapse_bulk(spark):
    df = spark.createDataFrame([("A" * 18, 1), ("B" * 18, 2), ("C" * 18, 5)], "rowid string, row_op int")
    assert [r.rowid for r in feeds.change_events(df).collect()] == ["", "B" * 18, ""]


def test_envelope(spark):
    df = spark.createDataFrame([("x", 5, "k", START), ("", 6, "k", START)], "d string, s int, k string, t timestamp")
    rows = df.select(*shard_envelope(F.col("d"), F.col("s"), F.col("k"), F.col("t"))).collect()
    assert [(r.data and bytes(r.data), r.sequence_number) for r in rows] == [(b"x", "5"), (None, "6")]
    assert rows[0].timestamp == 1704067200000


def test_undecodable_records_are_skipped(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([('{"a":1}',), ("garbage",), (None,)], "value string")
    schema = T.StructType.fromDDL("a bigint")
    got = decode_json(df, schema).collect()
    assert [r.a for r in got if r.a is not None] == [1]
    assert len(got) == 1


def test_broker_options():
    spec = TopicSpec("host:9092", ("one", "two"), max_records=128)
    assert spec.reader_options() == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "one,two",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "128",
    }


@pytest.fixture(scope="module")
def scattered(spark, folder, tmp_path_factory):
    """The events table as 12 files in no order of time."""
    root = tmp_path_factory.mktemp("scattered")
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(12, F.xxhash64("event_id")).write.parquet(str(root / "events.parquet"))
    return str(root)


@pytest.mark.parametrize("name", ["stm10_live_hashes", "stm10_batch_folds"])
def test_hashes_for_any_file_layout(spark, folder, scattered, name):
    want = {(str(r.key), r.field, r.value, r.expire_at) for r in catalogue.QUERIES["agg09_expiring_log_fold"](spark, folder).collect()}
    got = [tuple(r) for r in catalogue.QUERIES[name](spark, scattered).select("key", "field", "value", "expire_at").collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("name", ["stm05_once", "stm08_hourly_counters", "stm09_live_statistics", "stm11_throughput", "stm06_rate_limit"])
@pytest.mark.parametrize("files", [1, None])
def test_streams_for_any_file_layout(spark, folder, scattered, monkeypatch, name, files):
    """Twelve files in no order of time, one a micro-batch or all at once."""
    monkeypatch.setattr(catalogue_streams, "FILES_PER_TRIGGER", files)
    rows = [sorted(map(str, catalogue.QUERIES[name](spark, where).collect())) for where in (folder, scattered)]
    assert rows[0] == rows[1]


def test_emptied_keys_and_late_operations(spark, tmp_path):
    path = str(tmp_path / "state")
    fold = state.live_hashes(path)
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    schema = "key string, ts timestamp, seq long, op string, field string, amount long"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    fold(frame([("a", at(1), 1, "hset", "x", 1), ("b", at(2), 2, "hset", "x", 7)]), 0)
    fold(frame([("a", at(5), 3, "del", None, None)]), 1)
    fold(frame([("b", at(1), 0, "hincrby", "y", 4)]), 2)  # older than all of its key
    fold(frame([]), 3)
    rows = lambda df: sorted((r.key, r.field, r.value) for r in df.collect())
    assert rows(state.live_values(spark, path, at(9))) == [("b", "x", 7), ("b", "y", 4)]
    state.compact(spark, path, at(5))
    fold(frame([("b", at(3), 5, "hset", "x", 1), ("b", at(7), 6, "hincrby", "x", 1)]), 4)
    assert rows(state.folded_values(spark, path, at(9))) == [("b", "x", 8), ("b", "y", 4)]
    assert [(r.key, r.amount) for r in state.late_operations(spark, path).collect()] == [("b", 1)]


OPS = "key string, ts timestamp, seq long, op string, field string, amount long"


def at(second):
    return datetime.datetime(2024, 1, 1, 0, 0, second)


def filled(spark, path):
    fold = state.store_operations(path)
    for n in range(6):
        fold(spark.createDataFrame([(f"k{n % 3}", at(n * 5 + 1), n, "hincrby", f"f{n}", n + 1)], OPS), n)
    return fold


def held(spark, path):
    return sorted((r.key, r.field, r.value) for r in state.folded_values(spark, path, at(59)).collect())


@pytest.mark.parametrize("moments", [(20, 5), (3, 12, 8, 40), (40, 40, 50)])
def test_compacting_in_any_order_loses_nothing(spark, tmp_path, moments):
    path = str(tmp_path / "state")
    filled(spark, path)
    want, furthest = held(spark, path), -1
    assert len(want) == 6
    for moment in moments:
        if moment > furthest:
            state.compact(spark, path, at(moment))
            furthest = moment
        else:
            with pytest.raises(ValueError):
                state.compact(spark, path, at(moment))
        assert held(spark, path) == want
    assert state.late_operations(spark, path).count() == 0


def test_compaction_may_end_anywhere_and_run_beside_a_writer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    fold = filled(spark, path)
    want = held(spark, path)
    append = spans.SpanLog.append

    def dies(self, frame, batch_id):
        append(self, frame, batch_id)
        if "/base/" in self.path:
            for done in (tmp_path / "state" / "base").rglob("_SUCCESS"):
                done.unlink()
            raise OSError("lost before the base was finished")

    monkeypatch.setattr(spans.SpanLog, "append", dies)
    with pytest.raises(OSError):
        state.compact(spark, path, at(20))
    monkeypatch.undo()
    assert held(spark, path) == want

    def beside(self, frame, batch_id):  # a batch comes in while the base is being made
        if self.path.endswith("/values"):
            fold(spark.createDataFrame([("k9", at(2), 90, "hset", "early", 1), ("k9", at(50), 91, "hset", "new", 2)], OPS), 6)
        append(self, frame, batch_id)

    monkeypatch.setattr(spans.SpanLog, "append", beside)
    state.compact(spark, path, at(21))
    monkeypatch.undo()
    assert held(spark, path) == sorted([*want, ("k9", "new", 2)])
    assert [r.field for r in state.late_operations(spark, path).collect()] == ["early"]
    state.compact(spark, path, at(55))  # deletes what the base before had covered
    assert held(spark, path) == sorted([*want, ("k9", "new", 2)])
    assert [r.field for r in state.late_operations(spark, path).collect()] == ["early"]


def test_empty_streams(spark, folder, tmp_path):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stm01_topic_replay", "stm04_dispatch", "stm05_once", "stm10_batch_folds", "stm10_live_hashes"):
        assert catalogue.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_subscription_guards(spark, topic):
    seen = []
    run = runs.Subscription("100 milliseconds")
    with pytest.raises(RuntimeError):
        run.start()
    run.subscribe(stream(spark, topic), lambda rows, batch_id: seen.append(rows.count()))
    query = run.start()
    with pytest.raises(RuntimeError):
        run.start()
    query.processAllAvailable()
    assert run.delivered() == 40 == sum(seen)
    run.stop()
    run.stop()
    assert run.delivered() == 40


def test_delivered_rows_are_exact_after_many_batches_and_a_restart(spark, topic, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    for wanted in (40, 80):
        run = runs.Subscription("100 milliseconds")
        run.subscribe(stream(spark, topic), lambda rows, batch_id: (rows.count(), rows.count()))
        run.start(checkpoint).processAllAvailable()
        run.stop()
        assert run.delivered() == wanted
        for n in range(4):  # as many files again
            spark.read.parquet(topic).limit(10).coalesce(1).write.mode("append").parquet(topic)
    counts = runs.Delivered(spark, str(tmp_path / "many"))
    for n in range(350):
        counts.add(n, n)
        counts.add(n, n)  # a repeated batch counts once
    assert counts.total() == sum(range(350)) == runs.Delivered(spark, str(tmp_path / "many")).total()
    assert len(list((tmp_path / "many" / "delivered").glob("[!.]*"))) <= 51


def test_topics_that_exist():
    assert present_topics(("a", "b"), ["b", "c"]) == ("b",)
    with pytest.raises(LookupError):
        present_topics(("a",), [])


def test_segments_follow_the_size(spark, folder, monkeypatch):
    from conduit.plans import segments

    events = spark.read.parquet(f"{folder}/events.parquet")
    few = segments.segment_count(events)
    monkeypatch.setattr(segments, "SEGMENT_BYTES", 100)
    assert segments.segment_count(events) > 4 * few
