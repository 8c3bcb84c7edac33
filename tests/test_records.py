"""Record building, typing, paging, keys and row changes."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.operators import counters, dml, lookups, records, typing
from conduit.operators.lookups import Topic
from conduit.plans import segments


@pytest.fixture(scope="module")
def people(spark):
    """The small table of typed rows with NULLs."""
    rows = [
        (1, "Alice", 95.5, 1, bytes.fromhex("DEADBEEFCAFE"), None),
        (2, "Bob", 72.0, 0, None, None),
        (3, "Carol", 88.8, 1, None, "note"),
        (4, "Dave", 61.1, 0, None, None),
        (5, "Eve", None, 1, None, None),
        (6, "Frank", 44.0, 0, None, None),
    ]
    schema = "ID bigint, NAME string, SCORE double, FLAGS bigint, PAYLOAD binary, NOTES string"
    return spark.createDataFrame(rows, schema)


def test_projection_is_exact(people):
    assert records.project(people, 1, "ID").columns == ["NAME", "ID"]
    for bad in ("name", "ABSENT", 6, -1):
        with pytest.raises(records.RecordError):
            records.project(people, bad)
    assert records.leading_columns(people, 2).columns == ["ID", "NAME"]
    with pytest.raises(records.RecordError):
        records.leading_columns(people, 7)


def test_types_are_strict(people):
    assert records.project_typed(people, {"ID": "bigint", 4: "binary"}).columns == ["ID", "PAYLOAD"]
    for wanted in ({"ID": "double"}, {"NAME": "bigint"}, {"SCORE": "string"}, {"ID": "int"}):
        with pytest.raises(records.RecordError):
            records.project_typed(people, wanted)
    with pytest.raises(records.RecordError):
        records.binary_prefix(people, "NAME", 4)


def test_null_leaves_the_default(people):
    got = people.select("ID", records.value_or_default(F.col("SCORE"), -1.0).alias("v"))
    assert got.filter("ID = 5").first().v.asDict() == {"value": -1.0, "present": False}
    copied = people.select("ID", records.binary_prefix(people, "PAYLOAD", 4).alias("p"))
    first, second = copied.orderBy("ID").take(2)
    assert (bytes(first.p.bytes).hex(), first.p.copied) == ("deadbeef", 4)
    assert (second.p.bytes, second.p.copied) == (None, 0)


def test_json_and_text_forms(people):
    rows = people.select("ID", records.to_json_row(people).alias("j"), records.to_text_row(people).alias("t"))
    first = rows.filter("ID = 1").first()
    assert first.j == (
        '{"ID":1,"NAME":"Alice","SCORE":95.5,"FLAGS":1,"PAYLOAD":"3q2+78r+","NOTES":null}'
    )
    assert first.t == "ID=1 | NAME=Alice | SCORE=95.5 | FLAGS=1 | PAYLOAD=[6 bytes] | NOTES=NULL"


def test_json_round_trip(people):
    lines = people.select(records.to_json_row(people).alias("line"))
    back = records.parse_json_rows(lines, "line", people.schema)
    assert back.filter("json_error IS NOT NULL").count() == 0
    assert sorted(map(str, back.drop("line", "json_error").collect())) == sorted(
        map(str, people.collect())
    )


def test_json_strictness(spark):
    schema = T.StructType.fromDDL("n bigint, x double, b boolean, s string, y binary")
    cases = {
        '{"n":1,"x":1.5,"b":true,"s":"t","y":"QUJD","more":[1]}': None,
        '{"n":null}': None,
        "{}": None,
        '{"x":2.0}': None,
        '{"n":1.5}': "type mismatch: n",
        '{"n":"1"}': "type mismatch: n",
        '{"x":1}': "type mismatch: x",
        '{"b":"true"}': "type mismatch: b",
        '{"s":5}': "type mismatch: s",
        '{"y":5}': "type mismatch: y",
        '{"N":1}': None,
        "[1]": "not a JSON object",
        "5": "not a JSON object",
        "{broken": "not a JSON object",
        "null": "not a JSON object",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, line string")
    got = records.parse_json_rows(df, "line", schema).orderBy("i").collect()
    assert [r.json_error for r in got] == list(cases.values())
    assert (got[0].n, got[0].x, got[0].b, got[0].s, bytes(got[0].y)) == (1, 1.5, True, "t", b"ABC")
    assert got[4].n is None and got[10].n is None


def test_build_rows_pads_and_trims(spark):
    schema = T.StructType.fromDDL("a bigint, b string, c double")
    df = spark.createDataFrame([(["1", "x", "2.5", "extra"],), (["7"],), ([],)], "v array<string>")
    got = [tuple(r) for r in df.select(*records.build_rows(F.col("v"), schema)).collect()]
    assert sorted(got, key=str) == [(1, "x", 2.5), (7, None, None), (None, None, None)]


def test_pages(spark, monkeypatch):
    monkeypatch.setattr(segments, "segment_count", lambda df: 5)
    df = spark.range(100).select((F.col("id") * 7 % 101).alias("k"), F.lit(1).alias("same"))
    pages = records.paginate(df, ["same", "k"], 8).orderBy("row_no").collect()
    keys = sorted(i * 7 % 101 for i in range(100))
    assert [(r.k, r.row_no, r.batch_id) for r in pages] == [
        (k, i + 1, i // 8) for i, k in enumerate(keys)
    ]
    with pytest.raises(records.RecordError):
        records.paginate(df, ["k"], 0)


def test_running_values_on_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(segments, "segment_count", lambda df: 6)
    df = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("g"),
        "id",
        (F.col("id") % 11 - 3).alias("v"),
    )
    got = counters.running_increment(df, ["g"], ["id"], F.col("v"), "total")
    totals, expected = {}, {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        totals[r.g] = totals.get(r.g, 0) + r.v
        expected[r.id] = totals[r.g]
    assert {r.id: r.total for r in got.collect()} == expected


def test_running_values_keep_null_keys(spark, monkeypatch):
    monkeypatch.setattr(segments, "segment_count", lambda df: 3)
    df = spark.createDataFrame([(None, i, 1) for i in range(20)], "g string, id bigint, v bigint")
    got = counters.running_increment(df, ["g"], ["id"], F.col("v"), "total").collect()
    assert sorted(r.total for r in got) == list(range(1, 21))


def test_union_and_source(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([(2,)], "k int")
    got = records.union_sources({"a": a, "b": b}).collect()
    assert sorted((r.k, r.only_a, r.source) for r in got) == [(1, "x", "a"), (2, None, "b")]


def test_six_types(spark):
    df = spark.sql(
        "SELECT 1Y a, 2S b, 3 c, 1.5F d, CAST(2.5 AS DECIMAL(5,1)) e, true f, 'x' g, X'01' h, "
        "date'2024-01-02' i, timestamp'2024-01-02 03:04:05' j, array(1) k, map(1,2) l, "
        "named_struct('z',1) m, NULL n"
    )
    got = typing.to_six_types(df)
    assert [f.dataType.simpleString() for f in got.schema] == (
        ["bigint"] * 3 + ["double"] * 2 + ["boolean", "string", "binary"] + ["string"] * 6
    )
    row = got.first()
    assert (row.e, row.i, row.j) == (2.5, "2024-01-02 00:00:00", "2024-01-02 03:04:05")
    assert [row.k, row.l, row.m, row.n] == [None] * 4


def test_binds(spark):
    assert typing.check_binds([1, 2.5, "x", b"y", True, None]) == [1, 2.5, "x", b"y", True, None]
    ident = uuid.uuid4()
    assert typing.check_binds({"u": ident}) == {"u": str(ident)}
    for bad in ([1], {"a": 1}, (1,), datetime.date.today()):
        with pytest.raises(TypeError):
            typing.check_binds([bad])
    with pytest.raises(OverflowError):
        typing.check_binds([2**64])


def test_bound_sql(people, spark):
    got = dml.sql(spark, "SELECT ID FROM {p} WHERE ID < :top AND NAME <> :who",
                  {"top": 4, "who": "it's"}, p=people)
    assert got.count() == 3


def test_row_changes(people):
    gone = dml.delete_rows(people, F.col("NAME") == "Frank")
    assert gone.count() == 5
    assert dml.delete_rows(people, F.col("SCORE") > 0).count() == 1  # unknown stays
    raised = dml.update_rows(people, {"SCORE": F.lit(99.9), "NOTES": F.lit("Updated")}, F.col("ID") == 1)
    assert raised.filter("SCORE = 99.9 AND NOTES = 'Updated'").count() == 1
    assert raised.schema["SCORE"].dataType == T.DoubleType()


def test_unique_keys(people):
    assert counters.require_unique(people, ["ID"]) is people
    with pytest.raises(counters.DuplicateKey):
        counters.require_unique(people, ["FLAGS"])


def test_expiry_rules(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-01 00:00:10'), ('b', NULL), "
        "('c', timestamp_ntz'2024-01-01 00:00:05') t(k, expire_at)"
    )
    now = F.lit("2024-01-01 00:00:05").cast("timestamp_ntz")
    assert sorted(r.k for r in counters.alive(df, now).collect()) == ["a", "b"]
    assert {r.k: r.ttl for r in counters.time_to_live(df, now).collect()} == {"a": 5, "b": -1, "c": -2}


def test_topics_are_checked():
    for name, target in (("ab", "target"), ("name", "xy")):
        with pytest.raises(ValueError):
            Topic(name, target)


def test_first_registered_topic_wins(spark):
    topics = lookups.topic_table(spark, [Topic("one", "shared"), Topic("shared", "two"), Topic("two", "one")])
    df = spark.createDataFrame([("one",), ("shared",), ("two",), ("none",)], "s string")
    got = {r.s: r.topic_index for r in lookups.route_exact(df, "s", topics).collect()}
    assert got == {"one": 0, "shared": 0, "two": 1, "none": None}
    assert lookups.unrouted(lookups.route_exact(df, "s", topics)).count() == 1
    assert lookups.route_all(df).filter("topic_index = -1").count() == 4


def test_routes_are_broadcast(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    topics = lookups.topic_table(spark, [Topic("view", "view")])
    plan = lookups.route_exact(events, "event_type", topics)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hash_views(spark):
    values = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "key string, field string, value int")
    assert sorted(tuple(r) for r in counters.whole_hash(values, "key", "a").collect()) == [("x", 1), ("y", 2)]
    assert counters.whole_hash(values, "key", "absent").count() == 0
    assert {r.key: r.fields for r in counters.hash_maps(values, "key").collect()} == {
        "a": {"x": 1, "y": 2}, "b": {"x": 3},
    }
