"""Normalising any frame to boolean, bigint, double, string and binary."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.functions.dates import database_date, stored_date

SIX_TYPES = ("void", "boolean", "bigint", "double", "string", "binary")

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def six_type_name(data_type: T.DataType) -> str:
    """The normalised type a Spark type becomes."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, _WHOLE):
        return "bigint"
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    if isinstance(data_type, T.BinaryType):
        return "binary"
    return "string"


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def _as_six(field: T.StructField) -> Column:
    column = _named(field.name)
    if isinstance(field.dataType, _TEMPORAL):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(field.dataType, _NESTED):
        return F.lit(None).cast("string")
    return column.cast(six_type_name(field.dataType))


def to_six_types(df: DataFrame) -> DataFrame:
    """The rule all sources share; nested values become NULL strings."""
    return df.select(*[_as_six(f).alias(f.name) for f in df.schema.fields])


def from_avro_frame(df: DataFrame) -> DataFrame:
    """Normalise a frame decoded from Avro: the shared rule as it stands."""
    return to_six_types(df)


def from_oracle_frame(df: DataFrame, large_objects: tuple[str, ...] = ()) -> DataFrame:
    """Normalise a JDBC frame of an Oracle query.

    NUMBER with a scale is double, without one bigint; dates are text, NULL ones
    NULL; CHAR is right-trimmed; LOBs are bytes, and always NULL.
    """
    columns = []
    for f in df.schema.fields:
        column = _named(f.name)
        if f.name in large_objects:
            column = F.lit(None).cast("binary")
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double" if f.dataType.scale > 0 else "bigint")
        elif isinstance(f.dataType, T.StringType):
            column = F.rtrim(column)
        else:
            column = _as_six(f)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def oracle_date(ts: Column) -> Column:
    """Date text of a timestamp; NULL stays NULL."""
    return database_date(ts)


def oracle_stored_date(raw: Column) -> Column:
    """Date text of the seven bytes a date is stored in; all zeros without a century."""
    return stored_date(raw)


def sqlite_type(declared: Column) -> Column:
    """Normalised type of a declared SQLite type; case-sensitive substrings."""
    return (
        F.when(declared.contains("INT"), "bigint")
        .when(declared.rlike("REAL|FLOA|DOUB"), "double")
        .when(declared.contains("BLOB"), "binary")
        .when(declared.contains("BOOL"), "boolean")
        .otherwise("string")
    )


# Cassandra types by the normalised type they become.
CASSANDRA_TYPES = {
    "bigint": ("tinyint", "smallint", "int", "bigint", "counter"),
    "double": ("float", "double", "decimal"),
    "boolean": ("boolean",),
    "binary": ("blob",),
}


def cassandra_type(declared: Column) -> Column:
    """Normalised type of a Cassandra column type."""
    mapped = F.lit("string")
    for target, names in CASSANDRA_TYPES.items():
        mapped = F.when(F.lower(declared).isin(*names), target).otherwise(mapped)
    return mapped


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to normalised types; values that do not fit become NULL."""
    return df.select(
        *[
            (_named(c).try_cast(types[c]) if c in types else _named(c)).alias(c)
            for c in df.columns
        ]
    )


_BINDABLE = (bool, int, float, str, bytes, bytearray, uuid.UUID, type(None))


def check_binds(args):
    """Bind values fit for :func:`conduit.operators.dml.sql`; containers are refused."""
    named = isinstance(args, dict)
    values = args.values() if named else args
    for value in values:
        if not isinstance(value, _BINDABLE):
            raise TypeError(f"cannot bind a {type(value).__name__}")
        if isinstance(value, int) and not -(2**63) <= value < 2**64:
            raise OverflowError(f"integer out of range: {value}")
    def clean(value):
        if isinstance(value, uuid.UUID):
            return str(value)
        if isinstance(value, int) and value >= 2**63:  # beyond bigint, but exact as a decimal
            return Decimal(value)
        return value

    return {k: clean(v) for k, v in args.items()} if named else [clean(v) for v in args]
