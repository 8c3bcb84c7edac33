"""Validation, URI and code-table functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from conduit.functions import patterns as P
from conduit.functions.strings import trim


def full_match(text: Column, pattern: str) -> Column:
    """True when the whole text matches."""
    return text.rlike(rf"\A(?:{pattern})\z")


def is_hostname(text: Column) -> Column:
    """Labels of letters, digits and inner hyphens, one other byte between them.

    Any single byte separates, not only a dot, so an address in dotted-quad
    form is one case of this rule. It is tested by what must not occur, which
    stays linear on hostile input.
    """
    edges = text.rlike(r"\A[A-Za-z0-9]") & text.rlike(r"[A-Za-z0-9]\z")
    broken = text.rlike(r"[^A-Za-z0-9-][^A-Za-z0-9]|-[^A-Za-z0-9-]|[^\x00-\x7F]")
    return edges & ~broken


def is_username(text: Column) -> Column:
    """Runs of letters and digits with one of ``._-`` between them.

    Also tested by what must not occur: a repeated group of the pattern would go
    one level deeper into the matcher per run.
    """
    edges = text.rlike(r"\A[A-Za-z0-9]") & text.rlike(r"[A-Za-z0-9]\z")
    return edges & ~text.rlike(r"[._-][._-]|[^A-Za-z0-9._-]")


def is_strict_hostname(text: Column) -> Column:
    """The same with a dot as the only separator."""
    return is_hostname(text) & ~text.rlike(r"[^A-Za-z0-9.-]")


VALIDATORS = {
    "hostname": is_hostname,
    "username": is_username,
    "tns": lambda c: full_match(c, P.TNS_NAME),
    "consumer": lambda c: full_match(c, P.CONSUMER_NAME),
    "rowid": lambda c: full_match(c, P.ROW_ID),
    "region": lambda c: full_match(c, P.REGION),
}


def validate(kind: str, text: Column) -> Column:
    """Boolean check of a text by kind."""
    if kind not in VALIDATORS:
        raise ValueError(f"unknown kind: {kind}")
    return VALIDATORS[kind](text)


def resource_kind(arn: Column) -> Column:
    """``struct(kind, stream)`` with kind CONSUMER, STREAM or UNKNOWN."""
    kind = (
        F.when(full_match(arn, P.CONSUMER_ARN), "CONSUMER")
        .when(full_match(arn, P.STREAM_ARN), "STREAM")
        .otherwise("UNKNOWN")
    )
    stream = F.when(kind != "UNKNOWN", F.regexp_extract(arn, rf"\A{P.STREAM_ARN}", 1))
    return F.struct(kind.alias("kind"), stream.alias("stream"))


_SCHEME = r"(?s)\A([^:]*)://(?=.)"


def split_uri(uri: Column) -> Column:
    """``struct(protocol, host, port, path, filename, query)``.

    Missing parts are empty; the query keeps its ``?``; user info is not known. The
    protocol is all before the first ``://``, also beyond a ``?``, but the query
    begins at the first ``?`` of the whole text.
    """
    rest = F.regexp_replace(uri, _SCHEME, "")
    authority = F.regexp_extract(rest, r"\A[^/?]*", 0)
    path = trim(F.regexp_extract(rest, r"(?s)\A[^/?]*(/[^?]*)", 1))
    return F.struct(
        F.lower(F.regexp_extract(uri, _SCHEME, 1)).alias("protocol"),
        trim(F.substring_index(authority, ":", 1)).alias("host"),
        trim(F.regexp_extract(authority, r"(?s):(.*)\z", 1)).alias("port"),
        path.alias("path"),
        trim(F.regexp_extract(path, r"([^/\\]*)\z", 1)).alias("filename"),
        F.regexp_extract(uri, r"(?s)\?.*\z", 0).alias("query"),
    )


def _code_of(name: Column, table: dict[str, int], group: str) -> Column:
    short = F.regexp_replace(name, rf"\A[A-Z]+::{group}::", "")
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.when(name.isNotNull(), F.coalesce(F.try_element_at(lookup, short), F.lit(-1)))


def _name_of(code: Column, table: dict[str, int], group: str) -> Column:
    lookup = F.create_map(*[F.lit(x) for k, v in table.items() for x in (v, k)])
    name = F.coalesce(F.try_element_at(lookup, code.cast("int")), F.lit("UNKNOWN"))
    return F.concat(F.lit(f"{group.lower()}::"), name)


def protocol_code(name: Column) -> Column:
    """Code of a protocol name, short or qualified, upper case only; else -1."""
    return _code_of(name, P.PROTOCOLS, "PROTOCOL")


def protocol_name(code: Column) -> Column:
    """Qualified name of a protocol code."""
    return _name_of(code, P.PROTOCOLS, "PROTOCOL")


def auth_code(name: Column) -> Column:
    """Code of an authentication name, short or qualified; else -1."""
    return _code_of(name, P.AUTH_TYPES, "AUTHTYPE")


def auth_name(code: Column) -> Column:
    """Qualified name of an authentication code."""
    return _name_of(code, P.AUTH_TYPES, "AUTHTYPE")


def change_names(mask: Column) -> Column:
    """Names of the flags set in a change mask, in bit order."""
    names = [
        F.when(mask.bitwiseAND(F.lit(bit)) > 0, F.lit(name))
        for name, bit in P.CHANGE_FLAGS.items()
    ]
    return F.array_compact(F.array(*names))
