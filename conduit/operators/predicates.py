"""A compact predicate language, turned into one Catalyst column.

``field op literal`` comparisons combined with ``not``, ``and``, ``or`` (in that
order of strength) and parentheses. Comparisons are bound to the schema here;
the boolean structure is left to Spark's own expression syntax, which ranks the
three keywords the same way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOLERANCE = 1e-12

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

_TOKEN = re.compile(
    r"""\s*(?:
        (?P<paren>[()])
      | (?P<op>==|!=|<=|>=|<|>)
      | (?P<number>-?[0-9][0-9.]*)
      | '(?P<single>[^']*)(?:'|\Z)
      | "(?P<double>[^"]*)(?:"|\Z)
      | (?P<word>[A-Za-z_][A-Za-z0-9_]*)
    )""",
    re.VERBOSE,
)


class PredicateError(ValueError):
    """A predicate that does not parse or does not fit the schema."""


def _tokens(text: str) -> list[tuple[str, str]]:
    found, at, end = [], 0, len(text.rstrip())
    while at < end:
        match = _TOKEN.match(text, at)
        if not match:
            raise PredicateError(f"unexpected character at {at}: {text[at:at + 10]!r}")
        kind = match.lastgroup
        found.append(("string" if kind in ("single", "double") else kind, match[kind]))
        at = match.end()
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(literal: str) -> float:
    try:
        return float(literal)
    except ValueError:
        raise PredicateError(f"not a number: {literal}") from None


def _string_test(field: str, op: str, literal: str) -> str:
    return f"({field} {op} {_quoted(literal)})"


def _integer_test(field: str, op: str, literal: str) -> str:
    value = _number(literal)
    if value.is_integer() and abs(value) < 2**53:
        return f"({field} {op} {int(value)}L)"
    return _fraction_test(f"CAST({field} AS DOUBLE)", op, literal)


def _fraction_test(field: str, op: str, literal: str) -> str:
    value = _number(literal)
    near = f"abs({field} - {value!r}D) < {TOLERANCE!r}D"
    if op == "==":
        # the range lets the scan skip row groups; the distance decides
        low, high = value - 2 * TOLERANCE, value + 2 * TOLERANCE
        return f"({field} >= {low!r}D AND {field} <= {high!r}D AND {near})"
    if op == "!=":
        return f"(NOT ({near}) AND NOT isnan({field}))"
    if op in (">", ">="):
        # Spark sorts NaN above every number; a comparison with it is false
        return f"({field} {op} {value!r}D AND NOT isnan({field}))"
    return f"({field} {op} {value!r}D)"


def _comparison(schema: T.StructType, field: str, op: str, kind: str, literal: str) -> str:
    if field not in schema.names:
        raise PredicateError(f"unknown field: {field}")
    data_type = schema[field].dataType
    name = f"`{field}`"
    textual = isinstance(data_type, T.StringType)
    if textual != (kind == "string"):
        held, given = ("string", "number") if textual else ("numeric", "string")
        raise PredicateError(f"{field} is {held}, the literal is a {given}")
    if textual:
        return _string_test(name, op, literal)
    if isinstance(data_type, _INTEGRAL):
        return _integer_test(name, op, literal)
    if isinstance(data_type, T.BooleanType):
        return _integer_test(f"CAST({name} AS INT)", op, literal)
    if isinstance(data_type, _FRACTIONAL):
        cast = name if isinstance(data_type, T.DoubleType) else f"CAST({name} AS DOUBLE)"
        return _fraction_test(cast, op, literal)
    raise PredicateError(f"{field} has no comparable type: {data_type.simpleString()}")


def predicate_sql(text: str, schema: T.StructType) -> str:
    """The predicate as a Spark SQL boolean expression."""
    tokens = _tokens(text)
    parts: list[str] = []
    depth, at, operand_next = 0, 0, True
    while at < len(tokens):
        kind, value = tokens[at]
        at += 1
        if operand_next:
            if (kind, value) == ("word", "not"):
                parts.append("NOT")
            elif (kind, value) == ("paren", "("):
                depth += 1
                parts.append("(")
            elif kind == "word" and value not in ("and", "or"):
                kinds = [k for k, _ in tokens[at : at + 2]]
                if kinds[:1] != ["op"]:
                    raise PredicateError(f"expected a comparison after {value}")
                if kinds[1:] not in (["number"], ["string"]):
                    raise PredicateError(f"expected a number or string after {value}")
                (_, op), (literal_kind, literal) = tokens[at : at + 2]
                parts.append(_comparison(schema, value, op, literal_kind, literal))
                at += 2
                operand_next = False
            else:
                raise PredicateError(f"expected a field name, got {value!r}")
        elif kind == "word" and value in ("and", "or"):
            parts.append(value.upper())
            operand_next = True
        elif (kind, value) == ("paren", ")") and depth:
            depth -= 1
            parts.append(")")
        else:
            raise PredicateError(f"unexpected {value!r}")
    if operand_next:
        raise PredicateError("expected a field name at the end")
    if depth:
        raise PredicateError("expected a closing parenthesis")
    return " ".join(parts)


def compile_predicate(text: str, schema: T.StructType) -> Column:
    """Boolean column of a predicate; raises before anything runs."""
    return F.expr(predicate_sql(text, schema))


def where(df: DataFrame, text: str) -> DataFrame:
    """Rows for which the predicate is true; unknown (NULL) rows drop."""
    return df.filter(compile_predicate(text, df.schema))


def match_rules(df: DataFrame, rules: dict[str, str], name: str = "rule") -> DataFrame:
    """One row per input row and matching rule, in a single pass."""
    hits = [
        F.when(compile_predicate(text, df.schema), F.lit(rule))
        for rule, text in rules.items()
    ]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*hits))))
