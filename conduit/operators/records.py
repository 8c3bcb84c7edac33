"""Row building, projection, JSON and text forms of a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.functions.encoding import base64_decode, base64_encode
from conduit.operators.typing import SIX_TYPES, six_type_name
from conduit.plans.segments import number_rows


class RecordError(ValueError):
    """A column that is missing, out of range or of another type."""


def build_rows(values: Column, schema: T.StructType) -> list[Column]:
    """Columns of a declared schema from an array of texts.

    Short arrays are padded with NULL, extra values are ignored.
    """
    return [
        F.get(values, F.lit(at)).cast(field.dataType).alias(field.name)
        for at, field in enumerate(schema.fields)
    ]


def column_index(df: DataFrame, name: str) -> int:
    """Position of the first column with exactly this name."""
    if name not in df.columns:
        raise RecordError(f"column not found: {name}")
    return df.columns.index(name)


def column_name(df: DataFrame, selector: str | int) -> str:
    """Exact column name from a name or a 0-based position."""
    if isinstance(selector, str):
        selector = column_index(df, selector)
    if not 0 <= selector < len(df.columns):
        raise RecordError(f"column index out of bounds: {selector}")
    return df.columns[selector]


def project(df: DataFrame, *selectors: str | int) -> DataFrame:
    """Select by exact name or position."""
    return df.select(*[F.col(f"`{column_name(df, s)}`") for s in selectors])


def project_typed(df: DataFrame, wanted: dict[str | int, str]) -> DataFrame:
    """Select columns whose type must be the one asked for; never casts.

    Types are named ``boolean``, ``bigint``, ``double``, ``string``, ``binary``.
    """
    for selector, expected in wanted.items():
        if expected not in SIX_TYPES:
            raise RecordError(f"unknown type: {expected}")
        actual = df.schema[column_name(df, selector)].dataType.simpleString()
        if actual != expected:
            raise RecordError(f"type mismatch on {selector}: expected {expected}, got {actual}")
    return project(df, *wanted)


def leading_columns(df: DataFrame, count: int) -> DataFrame:
    """The first ``count`` columns, left to right."""
    if count > len(df.columns):
        raise RecordError(f"only {len(df.columns)} columns, {count} asked for")
    return project(df, *range(count))


def value_or_default(column: Column, default) -> Column:
    """``struct(value, present)``: NULL leaves the default and reports absence."""
    return F.struct(
        F.coalesce(column, F.lit(default)).alias("value"),
        column.isNotNull().alias("present"),
    )


def binary_prefix(df: DataFrame, name: str, size: int) -> Column:
    """``struct(bytes, copied)`` of at most ``size`` bytes; NULL copies none."""
    field = df.schema[column_name(df, name)]
    if not isinstance(field.dataType, T.BinaryType):
        raise RecordError(f"{name} is not binary")
    column = F.col(f"`{name}`")
    return F.struct(
        F.substring(column, 1, size).alias("bytes"),
        F.when(column.isNull(), 0)
        .otherwise(F.least(F.lit(size), F.octet_length(column)))
        .alias("copied"),
    )


def to_json_row(df: DataFrame) -> Column:
    """JSON object in schema order; NULLs are written, bytes become base64."""
    members = [
        base64_encode(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.BinaryType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


# JSON kinds a declared type accepts.
_JSON_KINDS = {
    "boolean": r"BOOLEAN",
    "bigint": r"BIGINT",
    "double": r"DOUBLE|DECIMAL\(.*",
    "string": r"STRING",
    "binary": r"STRING",
}


def parse_json_rows(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Declared columns from a JSON text, plus ``json_error``.

    A missing or null member is NULL. A member of another JSON kind, or a text
    that is no JSON object, sets ``json_error`` and leaves the columns NULL.
    """
    tree = F.try_parse_json(F.col(f"`{column}`"))
    staged = df.withColumn("_tree", tree)
    kind_of = {
        f.name: F.schema_of_variant(F.try_variant_get("_tree", _member(f.name), "variant"))
        for f in schema.fields
    }
    staged = staged.withColumns({f"_kind_{n}": k for n, k in kind_of.items()})
    errors = [
        F.when(
            ~F.col(f"_kind_{f.name}").rlike(
                rf"\A(?:VOID|{_JSON_KINDS[f.dataType.simpleString()]})\z"
            ),
            F.lit(f"type mismatch: {f.name}"),
        )
        for f in schema.fields
    ]
    not_object = ~F.coalesce(F.schema_of_variant("_tree").startswith("OBJECT"), F.lit(False))
    staged = staged.withColumn(
        "json_error",
        F.when(not_object & F.col(f"`{column}`").isNotNull(), F.lit("not a JSON object"))
        .otherwise(F.coalesce(*errors)),
    )
    values = []
    for f in schema.fields:
        plain = "string" if isinstance(f.dataType, T.BinaryType) else f.dataType.simpleString()
        value = F.try_variant_get("_tree", _member(f.name), plain)
        if isinstance(f.dataType, T.BinaryType):
            value = base64_decode(value)
        values.append(F.when(F.col("json_error").isNull(), value).alias(f.name))
    return staged.select(*[F.col(f"`{c}`") for c in df.columns], *values, "json_error")


def _member(name: str) -> str:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{quoted}']"


def to_text_row(df: DataFrame) -> Column:
    """``a=1 | b=NULL | c=[6 bytes]``."""
    parts = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            shown = F.concat(F.lit("["), F.octet_length(column).cast("string"), F.lit(" bytes]"))
        else:
            shown = column.cast("string")
        parts.append(F.concat(F.lit(f"{f.name}="), F.coalesce(shown, F.lit("NULL"))))
    return F.concat_ws(" | ", *parts)


def describe(df: DataFrame) -> DataFrame:
    """``(position, name, type)`` from the schema alone, in the six normalised types."""
    rows = [(at, f.name, six_type_name(f.dataType)) for at, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def fill_counts(df: DataFrame) -> DataFrame:
    """``(name, rows, filled)``: how far each column is filled, from one pass."""
    fields = df.schema.fields
    counts = [F.count(F.col(f"`{f.name}`")).alias(f"c{at}") for at, f in enumerate(fields)]
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    lines = [
        F.struct(F.lit(f.name).alias("name"), F.col("rows"), F.col(f"c{at}").alias("filled"))
        for at, f in enumerate(fields)
    ]
    return totals.select(F.inline(F.array(*lines)))


def with_source(df: DataFrame, source: str) -> DataFrame:
    """Tag rows with the topic or table they came from."""
    return df.withColumn("source", F.lit(source))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All frames as one, each row tagged; columns missing in one are NULL."""
    tagged = [with_source(df, name) for name, df in frames.items()]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df, allowMissingColumns=True)
    return merged


def paginate(
    df: DataFrame, order: Sequence[str], size: int = 256, total: bool = False
) -> DataFrame:
    """Add ``row_no`` and ``batch_id`` along ``order``.

    ``total`` says that the order tells every row apart, which saves a pass over
    the other columns.
    """
    if size < 1:
        raise RecordError("page size must be positive")
    numbered = number_rows(df, order, total=total)
    return numbered.withColumn(
        "batch_id", F.floor((F.col("row_no") - 1) / F.lit(size)).cast("bigint")
    )
