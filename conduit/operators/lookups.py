"""Change lookup, routing and key lookups.

Sides are never hinted as broadcast: Spark broadcasts the ones whose size it
knows to be below its threshold, and adaptive execution splits skewed keys in
the sort-merge joins that remain.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conduit.functions.network import validate
from conduit.session import local_table


@dataclass(frozen=True)
class Topic:
    """A registered topic: what it is called and what it stands for."""

    name: str
    target: str

    def __post_init__(self):
        if len(self.name) <= 2 or len(self.target) <= 2:
            raise ValueError("topic name and target must be longer than 2 characters")


def topic_table(spark, topics: Sequence[Topic]) -> DataFrame:
    """Registered topics in order as a frame ``(topic_index, name, target)``."""
    columns = {
        "topic_index": list(range(len(topics))),
        "name": [t.name for t in topics],
        "target": [t.target for t in topics],
    }
    return local_table(
        spark, columns, {"topic_index": "bigint", "name": "string", "target": "string"}
    )


# -- change feed ------------------------------------------------------------


def change_fate(rowid: Column) -> Column:
    """``bulk`` (no row id), ``row`` (well-formed id) or ``malformed``."""
    key = F.coalesce(rowid, F.lit(""))
    return F.when(key == "", "bulk").when(validate("rowid", key), "row").otherwise("malformed")


def split_changes(changes: DataFrame, rowid: str = "rowid") -> dict[str, DataFrame]:
    """The changes by fate; for all of them in one pass, group by :func:`change_fate`."""
    fate = change_fate(F.col(rowid))
    return {name: changes.filter(fate == name) for name in ("bulk", "row", "malformed")}


def fetch_changed_rows(
    changes: DataFrame, table: DataFrame, rowid: str = "rowid"
) -> DataFrame:
    """Current table row of every well-formed change; vanished rows do not appear."""
    return split_changes(changes, rowid)["row"].join(table, rowid, "inner")


def missing_rows(changes: DataFrame, table: DataFrame, rowid: str = "rowid") -> DataFrame:
    """Well-formed changes whose row no longer exists."""
    return split_changes(changes, rowid)["row"].join(table.select(rowid), rowid, "left_anti")


def delivery_counts(
    changes: DataFrame, table: DataFrame, rowid: str = "rowid"
) -> DataFrame:
    """``(delivered, counted, missing, malformed, bulk)`` of a change batch.

    A vanished row is neither delivered nor counted; a malformed id is dropped
    but counted; a bulk change is both.
    """
    key = F.coalesce(F.col(rowid), F.lit(""))
    # pre-aggregated: a hot row id crosses the shuffle once per task
    per_key = changes.groupBy(key.alias(rowid)).agg(F.count(F.lit(1)).alias("n"))
    kept = per_key.join(
        table.select(rowid, F.lit(True).alias("_found")), rowid, "left"
    ).select(
        "n",
        F.when(F.col(rowid) == "", "bulk")
        .when(~validate("rowid", F.col(rowid)), "malformed")
        .when(F.col("_found"), "found")
        .otherwise("missing")
        .alias("fate"),
    )
    total = lambda *fates: F.coalesce(
        F.sum(F.when(F.col("fate").isin(*fates), F.col("n"))), F.lit(0)
    )
    return kept.agg(
        total("found", "bulk").alias("delivered"),
        total("found", "bulk", "malformed").alias("counted"),
        total("missing").alias("missing"),
        total("malformed").alias("malformed"),
        total("bulk").alias("bulk"),
    )


# -- routing ----------------------------------------------------------------


def route_exact(df: DataFrame, source: str, topics: DataFrame) -> DataFrame:
    """Add ``topic_index``: the first topic whose name or target is the source.

    Unrouted rows keep a NULL index; see :func:`routed` and :func:`unrouted`.
    """
    routes = (
        topics.select("topic_index", F.explode(F.array("name", "target")).alias("_route"))
        .groupBy("_route")
        .agg(F.min("topic_index").alias("topic_index"))
    )
    return df.join(routes, df[source] == routes["_route"], "left").drop("_route")


def routed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("topic_index").isNotNull())


def unrouted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("topic_index").isNull())


def route_all(df: DataFrame) -> DataFrame:
    """A global handler takes every row."""
    return df.withColumn("topic_index", F.lit(-1).cast("bigint"))


def contains_route(table_name: Column, topics: Sequence[Topic]) -> Column:
    """Index of the first topic whose statement holds the table name, or whose
    name the table name holds; 0 when none does.

    Topics are registered in code, so the choice is an expression, not a join.
    """
    choice = F.coalesce(
        *[
            F.when(
                F.contains(F.lit(t.target), table_name) | table_name.contains(t.name),
                F.lit(at),
            )
            for at, t in enumerate(topics)
        ],
        F.lit(0),
    )
    return choice.cast("bigint")


# Characters of the grams by which texts that may hold one another are brought together.
GRAM = 3


def _grams(text: Column) -> Column:
    """The different grams of a text; a shorter text is its own."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(at, lambda k: F.substr(text, k, F.lit(GRAM))))


def _holds(holders: DataFrame, needles: DataFrame) -> DataFrame:
    """Distinct pairs ``(holder, needle)`` of texts of which the first holds the second.

    Every needle is looked up by the one of its grams that the fewest holders have; a
    needle with a gram that none has is in none. Needles shorter than a gram are looked
    up among the shorter pieces of holders.
    """
    short = F.length("needle") < GRAM
    pieces = holders.select("holder", F.explode(_grams(F.col("holder"))).alias("gram"))
    held = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    asked = needles.where(~short).select("needle", F.explode(_grams(F.col("needle"))).alias("gram"))
    rarest = (
        asked.join(held, "gram", "left")
        .groupBy("needle")
        .agg(F.min(F.struct("n", "gram")).alias("best"), F.bool_and(F.col("n").isNotNull()).alias("all_held"))
        .where("all_held")
        .select("needle", F.col("best.gram").alias("gram"))
    )
    found = pieces.join(rarest, "gram").where(F.contains("holder", "needle")).select("holder", "needle")
    letters = F.split("holder", "")
    runs = F.concat(
        F.array(F.lit("")),
        F.filter(letters, lambda c: c != ""),
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length("holder") - 1, F.lit(1))),
            lambda k: F.substr(F.col("holder"), k, F.lit(2)),
        ),
    )
    small = holders.select("holder", F.explode(F.array_distinct(runs)).alias("needle"))
    return found.union(small.join(needles.where(short), "needle").select("holder", "needle")).distinct()


def route_contains(df: DataFrame, source: str, topics: DataFrame) -> DataFrame:
    """Add ``topic_index`` like :func:`contains_route`, for any number of topics.

    Texts meet by grams, not each with each; every different source text is looked up once.
    """
    texts = df.select(F.col(source).alias("_text")).where(F.col(source).isNotNull()).distinct()
    names, targets = topics.select("name").distinct(), topics.select("target").distinct()
    named = _holds(texts.select(F.col("_text").alias("holder")), names.select(F.col("name").alias("needle")))
    told = _holds(targets.select(F.col("target").alias("holder")), texts.select(F.col("_text").alias("needle")))
    by_name = named.join(topics, F.col("needle") == F.col("name")).select(F.col("holder").alias("_text"), "topic_index")
    by_target = told.join(topics, F.col("holder") == F.col("target")).select(F.col("needle").alias("_text"), "topic_index")
    first = by_name.union(by_target).groupBy("_text").agg(F.min("topic_index").alias("topic_index"))
    joined = df.join(first, df[source] == first["_text"], "left").drop("_text")
    return joined.withColumn("topic_index", F.coalesce("topic_index", F.lit(0)).cast("bigint"))


def route_exchange(
    messages: DataFrame, bindings: DataFrame, keys: Sequence[str] = ("exchange", "routing_key")
) -> DataFrame:
    """One row per message and queue bound with an equal key; unbound rows vanish."""
    return messages.join(bindings.dropDuplicates([*keys, "queue"]), list(keys), "inner")


def binding_table(spark, bindings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Registered bindings as a frame ``(exchange, routing_key, queue)``."""
    names = ("exchange", "routing_key", "queue")
    columns = {n: [b[at] for b in bindings] for at, n in enumerate(names)}
    return local_table(spark, columns, dict.fromkeys(names, "string"))


# -- keys -------------------------------------------------------------------


def find(df: DataFrame, entities: DataFrame, key: str, entity_key: str) -> DataFrame:
    """Each row with its entity, or NULLs."""
    return df.join(entities, df[key] == entities[entity_key], "left")


def store_entities(entities: DataFrame, key: str, path: str, buckets: int | None = None) -> DataFrame:
    """Entities written once in buckets sorted by their key, for lookups that come again and again.

    The frame that comes back lies as :func:`find`, :func:`existing` and :func:`without`
    need it, so only their other side moves. There are as many buckets as the session has
    shuffle partitions, unless told otherwise. The files stay below ``path``; the name they
    were written under does not. All entities of one key lie
    in one bucket.
    """
    spark = entities.sparkSession
    many = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"conduit_entities_{uuid.uuid4().hex}"
    # one file a bucket, so that its order survives the reading
    dealt = entities.repartition(many, F.col(key))
    dealt.write.bucketBy(many, key).sortBy(key).option("path", path).saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held


def existing_entities(df: DataFrame, key: str, entities: DataFrame, entity_key: str) -> DataFrame:
    """The stored entities that a frame's keys name, each once, without moving the entities."""
    wanted = df.select(F.col(key).alias("_key")).distinct()
    return entities.join(wanted, entities[entity_key] == wanted["_key"], "left_semi")


def _key_set(other: DataFrame, key: str) -> DataFrame:
    # distinct combines map-side, so a hot key does not reach the join
    return other.select(F.col(key).alias("_key")).distinct()


def existing(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key exists in the other frame."""
    keys = _key_set(other, other_key)
    return df.join(keys, df[key] == keys["_key"], "left_semi")


def without(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows left after deleting the other frame's keys."""
    keys = _key_set(other, other_key)
    return df.join(keys, df[key] == keys["_key"], "left_anti")
