"""The distributed op-log fold against a one-operation-at-a-time model."""

import datetime
import random

import pytest

from conduit.operators import oplog
from conduit.plans import segments
from conduit.streaming import runs, state

START = datetime.datetime(2024, 1, 1)


def model(log, as_of):
    """Replay operations in order, the plain way."""
    held = {}
    for key, ts, _, op, field, amount in sorted(log, key=lambda o: (o[1], o[2])):
        if ts > as_of:
            continue
        fields, deadline = held.get(key, ({}, None))
        if deadline is not None and deadline <= ts:
            fields, deadline = {}, None
        if op == "hset":
            fields = fields | {field: amount}
        elif op == "hincrby":
            fields = fields | {field: fields.get(field, 0) + amount}
        elif op == "del" or (op == "expire" and amount <= 0):
            fields, deadline = {}, None
        elif fields:
            deadline = ts + datetime.timedelta(seconds=amount)
        held[key] = (fields, deadline)
    return sorted(
        (key, field, value, deadline)
        for key, (fields, deadline) in held.items()
        if deadline is None or deadline > as_of
        for field, value in fields.items()
    )


def random_log(rng, size, keys, expiries=0.3):
    log, at = [], START
    for seq in range(size):
        at += datetime.timedelta(seconds=rng.choice([0, 1, 5, 20, 60]))
        key = keys[0] if rng.random() < 0.5 else rng.choice(keys)  # one hot key
        pick = rng.random()
        if pick < expiries:
            log.append((key, at, seq, "expire", None, rng.choice([-1, 0, 5, 30, 100, 400])))
        elif pick < expiries + 0.08:
            log.append((key, at, seq, "del", None, None))
        else:
            op = "hset" if pick > 0.85 else "hincrby"
            log.append((key, at, seq, op, rng.choice("fgh"), rng.randint(-9, 9)))
    rng.shuffle(log)
    return log


SCHEMA = "key string, ts timestamp_ntz, seq bigint, op string, field string, amount bigint"


@pytest.mark.parametrize("seed", range(6))
def test_fold_equals_model(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(segments, "segment_count", lambda df: 7)  # cut the hot key up
    log = random_log(rng, 400, ["hot", "b", "c", "d"], expiries=0.1 + 0.08 * seed)
    as_of = START + datetime.timedelta(seconds=rng.randint(3000, 8000))
    df = spark.createDataFrame(log, SCHEMA)
    got = oplog.fold_log(df, ["key"], as_of).select("key", "field", "value", "expire_at")
    assert sorted(tuple(r) for r in got.collect()) == model(log, as_of)


def test_boundaries(spark):
    at = lambda s: START + datetime.timedelta(seconds=s)
    log = [
        ("gone", at(0), 0, "hset", "f", 1), ("gone", at(1), 1, "expire", None, 10),
        ("reborn", at(0), 2, "hset", "f", 1), ("reborn", at(1), 3, "expire", None, 10),
        ("reborn", at(11), 4, "hincrby", "f", 5),
        ("kept", at(0), 5, "hset", "f", 1), ("kept", at(1), 6, "expire", None, 500),
        ("kept", at(2), 7, "hincrby", "f", 2),
        ("early", at(0), 8, "expire", None, 5), ("early", at(2), 9, "hset", "f", 3),
        ("cut", at(0), 10, "hset", "f", 1), ("cut", at(1), 11, "expire", None, 0),
        ("later", at(300), 12, "hset", "f", 1),
    ]
    df = spark.createDataFrame(log, SCHEMA)
    got = oplog.fold_log(df, ["key"], at(100)).select("key", "field", "value", "expire_at")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("early", "f", 3, None), ("kept", "f", 3, at(501)), ("reborn", "f", 5, None),
    ]


def test_stream_over_many_batches_equals_model(spark, tmp_path):
    rng = random.Random(99)
    log = random_log(rng, 300, ["hot", "b", "c"])
    rng.shuffle(log)  # files come in no order of time
    for part in range(6):
        chunk = spark.createDataFrame(log[part * 50 : part * 50 + 50], SCHEMA).coalesce(1)
        chunk.write.mode("append").parquet(str(tmp_path / "ops"))
    files = spark.read.parquet(str(tmp_path / "ops"))
    stream = (
        spark.readStream.schema(files.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "ops"))
    )
    ops = stream.withColumn("ts", stream["ts"].cast("timestamp"))
    path, as_of = str(tmp_path / "folded"), max(o[1] for o in log)
    runs.start(ops, state.live_hashes(path)).awaitTermination()
    want = model(sorted(log, key=lambda o: (o[1], o[2])), as_of)
    assert state.operations(spark, path).select("batch").distinct().count() > 1
    assert sorted(tuple(r) for r in state.folded_values(spark, path, as_of).collect()) == want
    assert sorted(tuple(r) for r in state.live_values(spark, path, as_of).collect()) == want
