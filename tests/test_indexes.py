"""Pages by a directory, and routing by containment for many topics."""

import random

import pytest
from pyspark.sql import functions as F

from conduit.operators import lookups
from conduit.operators.lookups import Topic
from conduit.plans import pages


def test_pages_open_only_their_files(spark, tmp_path):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 3).alias("tie"))
    held = pages.write_pages(rows, ["tie", "v"], str(tmp_path / "pages"), total=True, segments=12)
    want = sorted((r.tie, r.v, r.id) for r in rows.collect())
    assert held.rows == 5000
    opened = []
    for number in (0, 1, 7, 30, 49):
        page = held.page(number, 100)
        assert page.columns == ["id", "v", "tie", "row_no"]
        got = [(r.tie, r.v, r.id, r.row_no) for r in page.collect()]
        assert got == [(*w, number * 100 + k + 1) for k, w in enumerate(want[number * 100 : number * 100 + 100])]
        opened.append(held.files(number, 100))
    assert max(opened) <= 2  # however far the page
    assert held.page(50, 100).count() == 0 and held.page(0, 10**6).count() == 5000
    assert [r.row_no for r in held.between(4990, 9999).collect()] == list(range(4991, 5001))
    again = pages.Pages(spark, str(tmp_path / "pages"), rows.schema)
    assert again.page(3, 50).collect() == held.page(3, 50).collect()
    with pytest.raises(ValueError):
        held.page(-1)
    empty = pages.write_pages(rows.where("false"), ["v"], str(tmp_path / "none"))
    assert empty.rows == 0 and empty.page(0).count() == 0
    pages.release(held)
    assert not (tmp_path / "pages").exists()


def plain_route(text, topics):
    if text is not None:
        for at, t in enumerate(topics):
            if text in t.target or t.name in text:
                return at
    return 0


def test_routing_by_containment_equals_the_expression(spark):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abc ") for _ in range(n))
    topics = [Topic(word(draw.randint(3, 6)), "SELECT " + word(draw.randint(3, 30))) for _ in range(40)]
    texts = [word(draw.randint(0, 12)) for _ in range(400)] + [None, "", "é", "SELECT", "EC", "SELECT abc", topics[9].name, topics[31].target]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts[:50])], "id long, text string")
    out = lookups.route_contains(rows, "text", lookups.topic_table(spark, topics))
    assert out.columns == ["id", "text", "topic_index"]
    got = {r.id: r.topic_index for r in out.collect()}
    assert got == {k: plain_route(t, topics) for k, t in enumerate(texts + texts[:50])}
    same = rows.select("id", lookups.contains_route(F.col("text"), topics).alias("topic_index"))
    assert {r.id: r.topic_index for r in same.collect()} == got
    assert lookups.route_contains(rows.where("false"), "text", lookups.topic_table(spark, topics)).count() == 0


def test_many_topics_make_no_cross_join(spark):
    topics = spark.range(10_000).select(
        F.col("id").alias("topic_index"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("name"),
        F.concat(F.lit("SELECT * FROM table_"), F.col("id").cast("string"), F.lit(" x")).alias("target"),
    )
    rows = spark.range(3000).select("id", F.concat(F.lit("zz t"), (F.col("id") * 3).cast("string"), F.lit(". zz")).alias("text"))
    out = lookups.route_contains(rows, "text", topics)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert all(r.topic_index == 3 * r.id for r in out.collect())


def test_stored_entities_do_not_move(spark, tmp_path):
    entities = spark.range(2000).select(F.col("id").alias("e"), F.concat(F.lit("n"), "id").alias("name"))
    stored = lookups.store_entities(entities, "e", str(tmp_path / "entities"), 4)
    rows = spark.range(500).select((F.col("id") * 7).alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (lookups.find(rows, stored, "k", "e"), lookups.existing_entities(rows, "k", stored, "e")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan
            assert plan.count("Exchange hashpartitioning") == 1, plan  # of the rows, none of the entities
        found = {r.k: r.name for r in lookups.find(rows, stored, "k", "e").collect()}
        assert found == {k * 7: f"n{k * 7}" if k * 7 < 2000 else None for k in range(500)}
        assert lookups.existing_entities(rows, "k", stored, "e").count() == len([k for k in range(500) if k * 7 < 2000])
        assert lookups.without(rows, "k", stored, "e").count() == len([k for k in range(500) if k * 7 >= 2000])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
