"""Number parsing, byte views and random values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_integer(text: Column, bits: int = 64, signed: bool = True) -> Column:
    """``struct(value, error)`` of a whole-string integer.

    ``error`` is NULL, ``invalid`` (no leading number), ``overflow`` or
    ``trailing``. Values of unsigned 64-bit parses are decimal(20,0).
    """
    if bits not in (8, 16, 32, 64):
        raise ValueError("bits must be 8, 16, 32 or 64")
    low = -(2 ** (bits - 1)) if signed else 0
    high = 2 ** (bits - (1 if signed else 0)) - 1
    kind = "bigint" if signed or bits < 64 else "decimal(20,0)"
    number = F.regexp_extract(text, r"\A-?[0-9]+" if signed else r"\A[0-9]+", 0)
    wide = F.when(number != "", number).try_cast("decimal(38,0)")
    fits = wide.between(
        F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)")
    )
    error = (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(number == "", F.lit("invalid"))
        .when(~F.coalesce(fits, F.lit(False)), F.lit("overflow"))
        .when(number != text, F.lit("trailing"))
    )
    value = F.when(error.isNull(), wide).try_cast(kind)
    return F.struct(value.alias("value"), error.alias("error"))


def integer_or_fail(text: Column, bits: int = 64, signed: bool = True) -> Column:
    """Parsed integer; a bad text fails the query with its kind of error."""
    parsed = parse_integer(text, bits, signed)
    message = F.concat(parsed["error"], F.lit(" integer: "), text)
    return F.when(parsed["error"].isNotNull(), F.raise_error(message)).otherwise(
        parsed["value"]
    )


def parse_identity(text: Column) -> Column:
    """Exactly 18 digits as a bigint, anything else NULL."""
    return F.when(text.rlike(r"\A[0-9]{18}\z"), text.try_cast("bigint"))


def bytes_to_u64(value: Column) -> Column:
    """Up to 8 big-endian bytes, left-aligned, as decimal(20,0)."""
    digits = F.rpad(F.hex(value), 16, "0")
    return F.when(
        F.octet_length(value) <= 8, F.conv(digits, 16, 10).cast("decimal(20,0)")
    )


def bytes_to_bits(value: Column) -> Column:
    """Eight binary digits per byte, most significant first."""
    pairs = F.regexp_extract_all(F.hex(value), F.lit("(..)"), F.lit(1))
    return F.array_join(F.transform(pairs, lambda p: F.lpad(F.conv(p, 16, 2), 8, "0")), "")


def uniform(lower: float, upper: float, seed: int | None = None) -> Column:
    """Random double in ``[lower, upper)``."""
    source = F.rand() if seed is None else F.rand(seed)
    return source * F.lit(float(upper - lower)) + F.lit(float(lower))


def uuid() -> Column:
    """Random version-4 identifier in 8-4-4-4-12 form."""
    return F.uuid()


def to_little_endian(value: Column, size: int = 8) -> Column:
    """Unsigned integer as little-endian bytes."""
    return F.unhex(_reversed_pairs(F.lpad(F.hex(value.cast("bigint")), size * 2, "0"), size))


def from_little_endian(value: Column) -> Column:
    """At most eight little-endian bytes as a bigint; from 2^63 on, its two's complement."""
    return F.conv(_reversed_pairs(F.hex(value), 8), 16, -10).cast("bigint")


def _reversed_pairs(digits: Column, size: int) -> Column:
    """Up to ``size`` pairs of digits in reverse order."""
    return F.concat(*[F.substring(digits, 2 * at + 1, 2) for at in reversed(range(size))])
