"""Line framing, response blocks, log lines and fixed-layout messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conduit.functions.dates import iso8601
from conduit.functions.numbers import from_little_endian, to_little_endian
from conduit.functions.patterns import (
    ALREADY_CODES,
    LOG_LEVELS,
    RESPONSE_ACTION,
    RESPONSE_CELL,
    RESPONSE_END,
    RESPONSE_ERROR,
    RESPONSE_IMEI,
    RESPONSE_IMSI,
    RESPONSE_RETURN_CODE,
    RESPONSE_VLR,
)

# -- lines --------------------------------------------------------------------


def split_lines(text: Column) -> Column:
    """Lines ended by CR or LF each, so CRLF leaves an empty line between."""
    return F.split(text, "[\r\n]")


def frame_lines(df: DataFrame, column: str, longer_than: int = 0) -> DataFrame:
    """One row per line longer than a bound, with its ``line_no`` from 0."""
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != column],
        F.posexplode(split_lines(F.col(f"`{column}`"))).alias("line_no", "line"),
    ).filter(F.length("line") > longer_than)


# -- network-element responses --------------------------------------------------

PENDING, FAILED, TIMED_OUT = -1, -2, -3


@dataclass(frozen=True)
class Conditions:
    """Patterns of the lines that decide on a response, each matched whole.

    ``success`` captures the return code, ``error`` is a failure, and the response ends
    with it or with ``breaks``.
    """

    success: str = RESPONSE_RETURN_CODE
    error: str = RESPONSE_ERROR
    breaks: str = RESPONSE_END


def _last(lines: Column, pattern: str) -> Column:
    """The capture of the last line that matches, or ""; lines end in a newline."""
    return F.regexp_extract(lines, rf"(?s)\A(?:.*\n)?{pattern}\n", 1)


def _bound(value: Column, body) -> Column:
    """One-element array of ``body(value)``, the value computed once."""
    return F.transform(F.array(value), body)


def response_lines(text: Column, conditions: Conditions = Conditions()) -> Column:
    """One-element array: the lines longer than one character, up to the end mark or error."""

    def cut(lines: Column) -> Column:
        closing = rf"\A(?:{conditions.breaks}|{conditions.error})\z"
        closes = F.transform(lines, lambda line: line.rlike(closing))
        stop = _bound(
            F.array_position(closes, True).cast("int"),
            lambda at: F.slice(lines, F.lit(1), F.when(at > 0, at).otherwise(F.size(lines))),
        )
        return stop[0]

    return _bound(F.filter(split_lines(text), lambda line: F.length(line) > 1), cut)


def parse_responses(
    df: DataFrame, column: str, timeout: bool = True, conditions: Conditions = Conditions()
) -> DataFrame:
    """Subscriber columns and ``retcode`` of one response text per row.

    ``retcode`` is the last return code, -2 after ``ERROR``; a response that
    never closes is -3 when calls had a ``timeout``, else what was read so far.
    """
    # a generator, so the optimiser cannot repeat the split in every column
    staged = df.withColumn("_lines", F.explode(response_lines(F.col(f"`{column}`"), conditions)))
    staged = staged.withColumn("_lines", F.concat(F.array_join("_lines", "\n"), F.lit("\n")))
    lines = F.col("_lines")
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    found = {
        "code": conditions.success, "imsi": RESPONSE_IMSI, "imei": RESPONSE_IMEI, "vlr": RESPONSE_VLR, "cell": RESPONSE_CELL,
        "action": RESPONSE_ACTION,
    }
    raw = staged.select(
        *kept,
        *[_last(lines, pattern).alias(f"_{name}") for name, pattern in found.items()],
        lines.rlike(rf"(?:\A|\n)(?:{conditions.error})\n\z").alias("_failed"),
        lines.rlike(rf"(?:\A|\n)(?:{conditions.breaks})\n\z").alias("_closed"),
    )
    given = {name: F.nullif(F.col(f"_{name}"), F.lit("")) for name in found}
    code = F.coalesce(given["code"].try_cast("int"), F.lit(PENDING))
    return raw.select(
        *kept,
        F.when(F.col("_failed"), F.lit(FAILED))
        .when(F.col("_closed"), code)
        .otherwise(F.lit(TIMED_OUT) if timeout else code)
        .alias("retcode"),
        *[given[name].alias(name) for name in ("imsi", "imei", "vlr")],
        # a moment that does not exist is none
        F.regexp_replace(given["action"], r"[ \t\x0B\f]", " ").try_cast("timestamp_ntz").alias("lastactive"),
        F.conv(F.substring(given["cell"], 1, 4), 16, 10).cast("int").alias("lac"),
        F.conv(F.substring(given["cell"], 5, 4), 16, 10).cast("int").alias("cell"),
    )


def provisioning_result(retcode: Column) -> Column:
    """0 done, 1 already there or gone, -1 failed."""
    return F.when(retcode == 0, 0).when(retcode.isin(*ALREADY_CODES), 1).otherwise(-1)


# -- log lines ------------------------------------------------------------------

_LOG_LINE = (
    r"(?s)\A\[([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}) +"
    r"([0-9]+) +([A-Z]+)\] (.*)\z"
)


def log_line(ts: Column, pid: Column, level: Column, text: Column) -> Column:
    """``[time pid(8) LEVEL(9)] text``; an unknown level is ``NULL``."""
    known = F.when(level.isin(*LOG_LEVELS), level).otherwise(F.lit("NULL"))
    return F.format_string("[%s %8d %9s] %s", iso8601(ts), pid, known, text)


def level_rank(level: Column) -> Column:
    """0 for the most severe level, NULL for an unknown one."""
    return F.nullif(
        F.array_position(F.array(*[F.lit(x) for x in LOG_LEVELS]), level), F.lit(0)
    ) - F.lit(1)


def parse_log(df: DataFrame, column: str) -> DataFrame:
    """``(ts, pid, level, text)`` of the lines in log form; the others drop.

    So does a line whose moment does not exist or whose number is out of range.
    """
    line = F.col(f"`{column}`")
    part = lambda group: F.regexp_extract(line, _LOG_LINE, group)
    moment, number = part(1).try_cast("timestamp_ntz"), part(2).try_cast("bigint")
    good = line.rlike(_LOG_LINE) & moment.isNotNull() & number.isNotNull()
    return df.filter(good).select(
        *[F.col(f"`{c}`") for c in df.columns if c != column],
        moment.alias("ts"),
        number.alias("pid"),
        part(3).alias("level"),
        part(4).alias("text"),
    )


def at_least(df: DataFrame, level: str) -> DataFrame:
    """Log rows as severe as ``level`` or more."""
    if level not in LOG_LEVELS:
        raise ValueError(f"unknown level: {level}")
    return df.filter(F.col("level").isin(*LOG_LEVELS[: LOG_LEVELS.index(level) + 1]))


# -- fixed-layout binary messages -------------------------------------------------


@dataclass(frozen=True)
class Slot:
    """One member of a fixed layout: an 8-byte ``integer`` or ``text`` of a size."""

    name: str
    kind: str
    size: int = 8


# Two counters, a path and a batch name.
BATCH_MESSAGE = (
    Slot("index", "integer"),
    Slot("total", "integer"),
    Slot("filename", "text", 4096),
    Slot("batchid", "text", 64),
)


def encode_message(layout: Sequence[Slot], values: dict[str, Column]) -> Column:
    """Message bytes; texts are cut to leave a NUL and filled with NULs."""
    pieces = []
    for slot in layout:
        value = values[slot.name]
        if slot.kind == "integer":
            pieces.append(to_little_endian(value, slot.size))
        else:
            kept = F.substring(value.cast("binary"), 1, slot.size - 1)
            zeros = F.lit(bytes(slot.size))
            pieces.append(F.substring(F.concat(kept, zeros), 1, slot.size))
    return F.concat(*pieces)


def decode_message(layout: Sequence[Slot], message: Column) -> list[Column]:
    """Columns of a message; texts end at their first NUL."""
    columns, at = [], 1
    for slot in layout:
        piece = F.substring(message, at, slot.size)
        if slot.kind == "integer":
            columns.append(from_little_endian(piece).alias(slot.name))
        else:
            text = F.substring_index(piece.cast("string"), "\x00", 1)
            columns.append(text.alias(slot.name))
        at += slot.size
    return columns


# -- events -----------------------------------------------------------------------


def event_line(
    event_date: Column, fingerprint: Column, msisdn: Column, event_type: Column,
    session: Column, screen: Column,
) -> Column:
    """``[date] {device = number} => type <> session - screen``."""
    return F.format_string(
        "[%s] {%s = %s} => %s <> %s - %s",
        event_date, fingerprint, msisdn, event_type, session, screen,
    )
