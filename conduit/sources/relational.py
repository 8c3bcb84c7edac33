"""Relational sources and sinks through Spark's JDBC format.

Needs the database's driver jar on the class path. The readers split on a
numeric column so that no single connection carries a table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from conduit.operators.typing import to_six_types

FETCH_ROWS = 256


@dataclass(frozen=True)
class Endpoint:
    """Where a database is and who asks."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        named = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }
        return {k: v for k, v in named.items() if v is not None}


@dataclass(frozen=True)
class Split:
    """How to cut a table into ranges of a numeric or date column."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def read_options(
    endpoint: Endpoint,
    source: str,
    split: Split | None = None,
    fetch_rows: int = FETCH_ROWS,
    is_query: bool | None = None,
) -> dict[str, str]:
    """Options of one read; ``source`` is a table name or, by ``is_query``, a query.

    Without ``is_query``, a text whose first word is SELECT or WITH is a query.
    """
    options = endpoint.options() | {"fetchsize": str(fetch_rows)}
    if is_query is None:
        is_query = re.match(r"\s*(?:select|with)\b", source, re.IGNORECASE) is not None
    if split is None:
        return options | {"query" if is_query else "dbtable": source}
    # Spark takes a split only with a table, so a query becomes a derived one
    return options | {
        "dbtable": f"({source}) q" if is_query else source,
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def reader(
    spark: SparkSession, endpoint: Endpoint, source: str, split: Split | None = None
) -> DataFrameReader:
    return spark.read.format("jdbc").options(**read_options(endpoint, source, split))


def read_relational(
    spark: SparkSession, endpoint: Endpoint, source: str, split: Split | None = None
) -> DataFrame:
    """Rows of a table or query in the six normalised types."""
    return to_six_types(reader(spark, endpoint, source, split).load())


def write_options(endpoint: Endpoint, table: str, batch_rows: int) -> dict[str, str]:
    return endpoint.options() | {"dbtable": table, "batchsize": str(batch_rows)}


def append_relational(
    df: DataFrame, endpoint: Endpoint, table: str, batch_rows: int = 1000
) -> None:
    """Insert rows; each partition is one transaction of the database."""
    df.write.format("jdbc").options(**write_options(endpoint, table, batch_rows)).mode(
        "append"
    ).save()


def append_batches(endpoint: Endpoint, table: str, batch_rows: int = 1000):
    """``foreachBatch`` function that inserts each micro-batch with its number.

    The number lets the database drop a batch that is delivered again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        append_relational(numbered, endpoint, table, batch_rows)

    return write
