"""Pipeline stages: each applies one operator to all documents it gets and keeps their columns.

Rows whose text a stage changes get the new text's length in ``n_chars``, if there is
such a column. A stage never adds a column, whatever the names of those it gets.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conduit.llm import packing, pii, recompress, simhash, toxicity
from conduit.llm.common import table


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as its texts now have them."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kind))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the smallest doc_id, nulls last."""
    return simhash.without_near_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a window of a smaller doc_id repeats are cut out; documents left without any go."""
    return _counted(recompress.without_repeated_passages(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; all documents stay."""
    return _counted(pii.without_personal_data(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048, one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
