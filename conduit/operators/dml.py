"""Parameterised SQL and row changes as new frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conduit.operators.typing import check_binds

# Fixed value: quoted text with doubled quotes inside, or a placeholder that no
# word character precedes. Possessive repetition loops instead of going deeper, so
# no length of text exhausts the stack of the matcher; a quote that nothing closes
# falls back to the first pair, and the pairs behind it match one by one.
_QUOTED = r"'[^']*+(?:''[^']*+)*+'|'[^']*+'"
_SCAN = rf"{_QUOTED}|\B(:[a-zA-Z0-9_]+)"
# the same, and all that is neither: the matches cover the text
_PARTS = rf"(?:{_QUOTED})|\B:[a-zA-Z0-9_]+|[^':]++|[':]"


def sql(spark: SparkSession, text: str, args=None, **tables: DataFrame) -> DataFrame:
    """Run SQL with bound values over frames named in the text as ``{name}``."""
    bound = check_binds(args) if args is not None else None
    return spark.sql(text, args=bound, **tables)


def count_placeholders(text: Column) -> Column:
    """Number of ``:name`` placeholders outside quoted text."""
    names = F.regexp_extract_all(text, F.lit(_SCAN), F.lit(1))
    return F.size(F.filter(names, lambda name: name != ""))


def positional_placeholders(text: Column) -> Column:
    """Every ``:name`` outside quoted text replaced by ``?``."""
    parts = F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0))
    named = lambda part: part.rlike(r"\A:.")  # noqa: E731  (a lone colon is one character)
    return F.array_join(F.transform(parts, lambda p: F.when(named(p), "?").otherwise(p)), "")


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The frame with rows added; columns the rows lack are NULL."""
    return df.unionByName(rows, allowMissingColumns=True)


def update_rows(df: DataFrame, changes: dict[str, Column], where: Column) -> DataFrame:
    """The frame with new values where the condition is true."""
    return df.withColumns(
        {
            name: F.when(where, value).otherwise(F.col(name)).cast(df.schema[name].dataType)
            for name, value in changes.items()
        }
    )


def delete_rows(df: DataFrame, where: Column) -> DataFrame:
    """The frame without the rows the condition is true for; unknown ones stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def create_table(df: DataFrame, name: str, path: str) -> None:
    """Create a parquet table at a path."""
    df.write.format("parquet").mode("errorifexists").option("path", path).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
