"""A corpus pipeline: toxic texts go, near copies go, repeats are cut, personal data masked, the rest packed.

Every stage is one operator of ``conduit.llm`` applied to all that its predecessor kept.
``run`` applies the stages to ``documents``; each result is written to the shared folder
as Parquet and read again as the next stage's input. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conduit.llm import stages
from conduit.llm.common import table
from conduit.session import cut_lineage

STAGES = [
    ("toxicity", stages.without_toxic),
    ("near copies", stages.without_near_copies),
    ("repeated passages", stages.without_repeated_passages),
    ("personal data", stages.without_personal_data),
    ("packing", stages.packed),
]

# Hashes with a seed, trained scores and a tokenizer are beyond SQL; a brute-force version tests it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
