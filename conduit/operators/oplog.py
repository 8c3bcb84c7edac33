"""Folding an ordered log of hash operations into the final state.

``hset``, ``hincrby``, ``expire`` and ``del`` act in order on (key, field).
Whether an ``expire`` counts depends on whether the key was alive then, which
depends on earlier expiries, so the fold looks sequential. It is not: all that a
run of a key's operations needs to know of the past is its deadline until the
run's first control (``expire``, ``del``), and one bit there, alive or dead. So a
run has a summary of fixed size: the last write before that control, and how the
run ends for either bit. Summaries of adjoining runs compose, so a hot key is
spread over segments, one summary each, and one pass over a key's summaries gives
its last death and its deadline. Writes are then folded by field and segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.plans.segments import ORD, SEG, ordered_segments

# ``expireat`` is an ``expire`` with its deadline in microseconds since 1970.
OPERATIONS = ("hset", "hincrby", "expire", "expireat", "del")


def fold_log(
    log: DataFrame, keys: Sequence[str], as_of, ts: str = "ts", seq: str = "seq"
) -> DataFrame:
    """State ``(*keys, field, value, expire_at)`` at ``as_of``.

    The log has the keys (never NULL), ``ts`` and ``seq`` (a total order per
    key), ``op``, ``field`` and ``amount``: the value set, the increment, or the
    seconds to live. A key expires when its deadline is reached; an expiry of a
    missing key does nothing; one that is not positive deletes.
    """
    keys = list(keys)
    # microseconds as plain numbers; the log may hold zoned or plain timestamps
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    now = micros(F.lit(as_of))
    slim = log.select(
        *keys, micros(F.col(ts)).alias("us"), F.col(seq).alias("seq"), "op", "field", "amount"
    ).filter(F.col("us") <= now)
    segments = ordered_segments(slim, [*keys, "us", "seq"], total=True)
    fates = _key_fates(segments, keys, now)
    return _fold_writes(segments, keys, fates)


def _key_fates(segments: DataFrame, keys: list[str], now) -> DataFrame:
    """Per key and segment with writes of a key that died or ends: what its last death cuts away, and its deadline."""
    ends_at = F.when(F.col("op") == "expireat", F.col("amount")).when(
        F.col("op") == "expire", F.col("us") + F.col("amount") * F.lit(1000000)
    )
    kills = (F.col("op") == "del") | F.coalesce(ends_at <= F.col("us"), F.lit(False))
    steps = segments.select(
        *keys, SEG, ORD, "us", F.col("op").isin("hset", "hincrby").alias("writes"),
        kills.alias("kills"), ends_at.alias("ends"),
    )
    kinds = [T.StructField(c, segments.schema[c].dataType) for c in keys]
    runs = steps.mapInArrow(_summaries(len(keys)), T.StructType([*kinds, *_RUN.fields]))
    run = F.struct(*_RUN.names)
    held = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(run)).alias("runs"))
    fates = held.select(*keys, F.array_distinct(f"runs.{SEG}").alias("segs"), _composed(F.col("runs")).alias("end"))
    over = F.col("end.alive") & (F.col("end.ends") <= now)
    fates = fates.select(
        *keys,
        "segs",
        F.col("end.cut_ord").alias("cut_ord"),
        F.greatest("end.cut_us", F.when(over, F.col("end.ends"))).alias("cut_us"),
        F.when(F.col("end.alive") & (F.col("end.ends") > now), F.col("end.ends")).alias("deadline"),
    )
    told = F.coalesce("cut_ord", "cut_us", "deadline").isNotNull()
    return fates.filter(told).select(*keys, F.explode("segs").alias(SEG), "cut_ord", "cut_us", "deadline")


_END = T.StructType(
    [T.StructField("alive", T.BooleanType()), *[T.StructField(n, T.LongType()) for n in ("ends", "cut_ord", "cut_us")]]
)
# first says where a run begins; written and control are moments: of the last write before
# the first control (or of all), and of that control.
_RUN = T.StructType(
    [
        T.StructField("first", T.LongType()),
        T.StructField(SEG, T.IntegerType()),
        T.StructField("written", T.LongType()),
        T.StructField("control", T.LongType()),
        T.StructField("if_dead", _END),
        T.StructField("if_alive", _END),
    ]
)


def _summaries(n_keys: int):
    """A summary of every run of a key's rows; it travels by value, so executors need no copy of this module."""

    def summarise(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def wrote(end, moment):
            """After writes up to a moment: a deadline that they passed was a death."""
            alive, ends, cut_ord, cut_us = end
            if alive and ends is not None and ends <= moment:
                return True, None, cut_ord, ends  # deaths come in order of time
            return True, ends if alive else None, cut_ord, cut_us

        def controlled(end, moment, kills, deadline, place):
            alive, ends, cut_ord, cut_us = end
            if alive and ends is not None and ends <= moment:
                alive, ends, cut_us = False, None, ends
            if kills:
                return False, None, place, cut_us
            return (True, deadline, cut_ord, cut_us) if alive else (False, None, cut_ord, cut_us)

        names = ("alive", "ends", "cut_ord", "cut_us")
        schema, owner, run = None, None, None  # run: first, segment, written, control, if_dead, if_alive

        for found in batches:
            n = found.num_rows
            if not n:
                continue
            heads = [found.column(k) for k in range(n_keys + 1)]  # the keys and the segment
            place, us, writes, kills, ends = (found.column(n_keys + 1 + k) for k in range(5))
            changes = np.zeros(n, bool)
            for column in heads:
                changes[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
            first_head = tuple(c[0].as_py() for c in heads)
            changes[0] = first_head != owner
            begins = np.flatnonzero(changes).tolist()
            bounds = [*([0] if not changes[0] else []), *begins, n]
            place, moments = place.to_pylist(), us.to_pylist()
            writes = writes.to_numpy(zero_copy_only=False)
            last_write = np.maximum.accumulate(np.where(writes, np.arange(n), -1)).tolist()
            controls = np.flatnonzero(~writes).tolist()
            kills, ends = kills.to_pylist(), ends.to_pylist()
            done, at = [], 0
            for begin, stop in zip(bounds, bounds[1:]):
                if changes[begin]:
                    if run is not None:
                        done.append((owner, run))
                    owner = tuple(c[begin].as_py() for c in heads)
                    run = [place[begin], owner[-1], None, None, None, None]
                since = begin
                while True:
                    control = controls[at] if at < len(controls) and controls[at] < stop else None
                    write = last_write[(stop if control is None else control) - 1] if (stop if control is None else control) else -1
                    if write >= since:
                        if run[3] is None:
                            run[2] = moments[write]
                        else:
                            run[4], run[5] = wrote(run[4], moments[write]), wrote(run[5], moments[write])
                    if control is None:
                        break
                    if run[3] is None:
                        run[3] = moments[control]
                        run[4], run[5] = (False, None, None, None), (True, None, None, None)
                    what = (moments[control], kills[control], ends[control], place[control])
                    run[4], run[5] = controlled(run[4], *what), controlled(run[5], *what)
                    since, at = control + 1, at + 1
            schema = found.schema
            if done:
                yield shown(done, schema, names, pa)
        if run is not None:
            yield shown([(owner, run)], schema, names, pa)

    def shown(done, schema, names, pa):
        end = pa.struct([("alive", pa.bool_()), ("ends", pa.int64()), ("cut_ord", pa.int64()), ("cut_us", pa.int64())])
        told = [[r[k] if k < 4 or r[k] is None else dict(zip(names, r[k])) for _, r in done] for k in range(6)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), end, end]
        columns = [pa.array([o[k] for o, _ in done], schema.field(k).type) for k in range(n_keys)]
        columns += [pa.array(values, kind) for values, kind in zip(told, kinds)]
        titles = [schema.field(k).name for k in range(n_keys)] + ["first", schema.field(n_keys).name, "written", "control", "if_dead", "if_alive"]
        return pa.RecordBatch.from_arrays(columns, titles)

    return summarise


def _composed(runs: Column) -> Column:
    """How a key ends after all its runs, from nothing: one pass over their summaries."""

    def passed(state: Column, moment: Column) -> Column:
        return F.coalesce(state["alive"] & (state["ends"] <= moment), F.lit(False))

    def end(alive: Column, ends: Column, cut_ord: Column, cut_us: Column) -> Column:
        return F.struct(
            alive.cast("boolean").alias("alive"), ends.cast("bigint").alias("ends"),
            cut_ord.cast("bigint").alias("cut_ord"), cut_us.cast("bigint").alias("cut_us"),
        )

    def settled(state: Column, moment: Column, written: bool) -> Column:
        """After what happened up to a moment: a passed deadline was a death, then a write revives."""
        died = passed(state, moment)
        alive = (state["alive"] & ~died) | F.lit(written)
        return end(alive, F.when(state["alive"] & ~died, state["ends"]), state["cut_ord"], F.greatest(state["cut_us"], F.when(died, state["ends"])))

    def step(state: Column, run: Column) -> Column:
        wrote = F.when(run["written"].isNotNull(), settled(state, run["written"], True)).otherwise(state)
        return _let(wrote, lambda at: F.when(run["control"].isNull(), at).otherwise(_let(settled(at, run["control"], False), lambda c: _let(
            F.when(c["alive"], run["if_alive"]).otherwise(run["if_dead"]),
            lambda e: end(e["alive"], e["ends"], F.greatest(c["cut_ord"], e["cut_ord"]), F.greatest(c["cut_us"], e["cut_us"])),
        ))))

    none = F.lit(None)
    return F.aggregate(runs, end(F.lit(False), none, none, none), step)


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _fold_writes(segments: DataFrame, keys: list[str], fates: DataFrame) -> DataFrame:
    """Apply the writes that outlived every cut: last set, then later increments."""
    writes = segments.filter(F.col("op").isin("hset", "hincrby"))
    # fates reach the writes per (key, segment), so no join key is hot
    live = writes.join(fates, [*keys, SEG], "left").filter(
        (F.col("cut_ord").isNull() | (F.col(ORD) > F.col("cut_ord")))
        & (F.col("cut_us").isNull() | (F.col("us") >= F.col("cut_us")))
    )
    is_set = F.col("op") == "hset"
    local = Window.partitionBy(*keys, "field", SEG)
    based = live.withColumn("base", F.max(F.when(is_set, F.col(ORD))).over(local))
    counts = (is_set & (F.col(ORD) == F.col("base"))) | (
        ~is_set & (F.col("base").isNull() | (F.col(ORD) > F.col("base")))
    )
    parts = based.groupBy(*keys, "field", SEG).agg(
        F.coalesce(F.sum(F.when(counts, F.col("amount"))), F.lit(0)).alias("part"),
        F.max("base").isNotNull().alias("is_set"),
        F.max("deadline").alias("deadline"),
    )
    # one row per field and segment from here on
    whole = Window.partitionBy(*keys, "field")
    last_set = F.max(F.when(F.col("is_set"), F.col(SEG))).over(whole)
    return (
        parts.withColumn("last_set", last_set)
        .filter(F.col("last_set").isNull() | (F.col(SEG) >= F.col("last_set")))
        .groupBy(*keys, "field")
        .agg(F.sum("part").alias("value"), F.max("deadline").alias("_deadline"))
        .withColumn("expire_at", F.timestamp_micros("_deadline").cast("timestamp_ntz"))
        .drop("_deadline")
    )
