"""Splitting, joining, trimming and path functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from conduit.functions.patterns import C_SPACE


def split_tokens(text: Column, delimiter: str) -> Column:
    """Tokens between single-character delimiters; empty tokens are dropped."""
    if len(delimiter) != 1:
        raise ValueError("delimiter must be one character")
    return F.filter(F.split(text, re.escape(delimiter)), lambda token: token != "")


def merge_tokens(tokens: Column, delimiter: str) -> Column:
    """Join tokens with a delimiter; an empty list gives an empty string."""
    return F.array_join(tokens, delimiter)


def ltrim(text: Column) -> Column:
    """Strip leading C white space."""
    return F.regexp_replace(text, rf"\A{C_SPACE}+", "")


def rtrim(text: Column) -> Column:
    """Strip trailing C white space."""
    return F.regexp_replace(text, rf"(?<!{C_SPACE}){C_SPACE}+\z", "")


def trim(text: Column) -> Column:
    """Strip C white space from both ends."""
    return ltrim(rtrim(text))


def trim_buffer(text: Column) -> Column:
    """Buffer form: leading blanks only, then trailing white space.

    The first character left after the blanks always stays.
    """
    body = F.regexp_replace(text, r"\A +", "")
    head = F.substring(body, 1, 1)
    return F.concat(head, rtrim(F.substr(body, F.lit(2))))


def split_path(path: Column) -> Column:
    """``struct(parent, filename)`` of a slash-separated path."""
    parent = F.regexp_extract(path, r"(?s)\A(.*?)/*[^/]*\z", 1)
    root = path.rlike(r"\A/+[^/]*\z")
    return F.struct(
        F.when(root, F.lit("/")).otherwise(parent).alias("parent"),
        F.regexp_extract(path, r"([^/]*)\z", 1).alias("filename"),
    )


def split_bucket(path: Column) -> Column:
    """``struct(bucket, key)``; fewer than two segments leave the path as key."""
    parts = split_tokens(path, "/")
    split = F.size(parts) >= 2
    return F.struct(
        F.when(split, F.get(parts, F.lit(0))).otherwise(F.lit("")).alias("bucket"),
        F.when(split, F.array_join(F.slice(parts, 2, F.size(parts)), "/"))
        .otherwise(path)
        .alias("key"),
    )


def share_path(path: Column, share: str, strict: bool = False) -> Column:
    """Path inside a share, with backslashes.

    A path of another share gives NULL, or an error when ``strict``.
    """
    parts = split_tokens(path, "/")
    inside = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), "\\")
    wrong = (
        F.raise_error(F.concat(F.lit(f"path is not on share {share}: "), path))
        if strict
        else F.lit(None).cast("string")
    )
    return F.when(F.get(parts, F.lit(0)) == share, inside).otherwise(wrong)
