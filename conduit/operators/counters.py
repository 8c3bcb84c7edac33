"""Per-key statistics, counters, hashes and expiry.

Every aggregate here combines map-side, so a key with a third of all rows
reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.functions.numbers import parse_identity
from conduit.plans.segments import ordered_segments, running
from conduit.session import cut_lineage

# The five kinds an identity's statistics tell apart.
KINDS = ("p2p", "bill", "co", "ci", "pay")


class DuplicateKey(ValueError):
    """An identity that was inserted twice."""


def identity_statistics(df: DataFrame, identity: str, kind: Column, amount: Column) -> DataFrame:
    """Sum and count per identity for each of the five kinds."""
    return df.groupBy(identity).agg(*statistics_columns(kind, amount))


def statistics_columns(kind: Column, amount: Column) -> list[Column]:
    """The ten aggregates, for batch and streaming groupings alike."""
    sums = [
        F.coalesce(F.sum(F.when(kind == k, amount)), F.lit(0)).cast("bigint").alias(f"{k}_sum")
        for k in KINDS
    ]
    counts = [F.count(F.when(kind == k, 1)).alias(k) for k in KINDS]
    return sums + counts


def identities(df: DataFrame, text: Column) -> DataFrame:
    """Add ``identity``; texts that are not 18 digits have NULL there."""
    return df.withColumn("identity", parse_identity(text))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys inserted more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, or :class:`DuplicateKey` when a key occurs twice."""
    example = duplicate_keys(df, keys).first()
    if example is not None:
        raise DuplicateKey(f"duplicate key: {example.asDict()}")
    return df


def add_to_fields(
    df: DataFrame, key: Column, fields: dict[str, Column], name: str = "key"
) -> DataFrame:
    """Totals ``(key, field, value, whole)`` of increments, one field per named amount.

    Fields of whole amounts are summed exactly, and ``whole`` holds that sum: a bigint, or
    decimal(38,0) if any total of the frame is beyond one (a stream, whose totals are not
    known beforehand, fails there). The others are summed as double. ``value`` is the
    double of either. A field whose amounts are all NULL was never touched and has no row.
    """
    kinds = df.select(*[a.alias(f"_{at}") for at, a in enumerate(fields.values())]).schema.fields
    exact = [isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for f in kinds]
    # sums of narrower amounts need 2**32 rows of a key to pass a bigint
    wide = [isinstance(f.dataType, T.LongType) and not df.isStreaming for f in kinds]
    totals = df.groupBy(key.alias(name)).agg(
        *[
            F.sum(amount.cast("decimal(20,0)" if wide[at] else "bigint" if exact[at] else "double")).alias(f"_{at}")
            for at, amount in enumerate(fields.values())
        ]
    )
    whole = "bigint"
    if any(wide):
        totals = cut_lineage(totals, "totals")  # looked at twice, and one row per key
        beyond = reduce(or_, [~F.col(f"_{at}").between(-(2**63), 2**63 - 1) for at, w in enumerate(wide) if w])
        if not totals.filter(beyond).isEmpty():
            whole = "decimal(38,0)"
    # one row per key so far; only now is it spread to one per field
    pairs = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.col(f"_{at}").cast("double").alias("value"),
                (F.col(f"_{at}") if exact[at] else F.lit(None)).cast(whole).alias("whole"),
            )
            for at, field in enumerate(fields)
        ]
    )
    return totals.select(name, F.inline(pairs)).filter(F.col("value").isNotNull())


def increment(df: DataFrame, keys: Sequence[str], **by) -> DataFrame:
    """Counters per key: each named one is the sum of its increments."""
    sums = [F.sum(amount if isinstance(amount, Column) else F.lit(amount)).alias(name)
            for name, amount in by.items()]
    return df.groupBy(*keys).agg(*sums)


def running_increment(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    by: Column,
    name: str = "value",
    total: bool = False,
) -> DataFrame:
    """Every increment with the counter value after it, in order per key.

    ``total`` says that keys and order tell every row apart.
    """
    segments = ordered_segments(df.withColumn("_by", by), [*keys, *order], total)
    return running(segments, keys, {name: (F.sum, F.col("_by"))}).select(
        *[F.col(f"`{c}`") for c in df.columns], name
    )


def whole_hash(values: DataFrame, key: str, wanted) -> DataFrame:
    """``(field, value)`` rows of one key; a missing key has none."""
    return values.filter(F.col(key) == F.lit(wanted)).select("field", "value")


def hash_maps(values: DataFrame, key: str) -> DataFrame:
    """One map per key with every field it has.

    A map is one value, so a key's fields must fit into one; ``values`` itself is the
    form for hashes with more.
    """
    held = values.filter(F.col("value").isNotNull()).groupBy(key, "field").agg(F.max("value").alias("value"))
    return held.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("fields")
    )


def last_write(df: DataFrame, keys: Sequence[str], value: str, order: Column) -> DataFrame:
    """The value written last per key."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def with_expiry(df: DataFrame, keys: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """Per key the moment it expires: the last write plus ``seconds``."""
    return df.groupBy(*keys).agg(
        (F.max(ts) + F.expr(f"INTERVAL {int(seconds)} SECONDS")).alias("expire_at")
    )


def alive(df: DataFrame, as_of: Column) -> DataFrame:
    """Rows not expired at a moment; a NULL expiry never expires."""
    return df.filter(F.col("expire_at").isNull() | (F.col("expire_at") > as_of))


def time_to_live(df: DataFrame, as_of: Column) -> DataFrame:
    """Add ``ttl``: whole seconds left, -1 without expiry, -2 when gone."""
    left = F.unix_timestamp("expire_at") - F.unix_timestamp(as_of)
    return df.withColumn(
        "ttl",
        F.when(F.col("expire_at").isNull(), F.lit(-1))
        .when(F.col("expire_at") <= as_of, F.lit(-2))
        .otherwise(left)
        .cast("bigint"),
    )


def delivery_rate(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows and rows per second of every tumbling interval."""
    span = F.window(ts, f"{int(seconds)} seconds")
    return (
        df.groupBy(span.alias("_w"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("_w.start").alias("tick"),
            "rows",
            (F.col("rows") / F.lit(float(seconds))).alias("per_second"),
        )
    )
