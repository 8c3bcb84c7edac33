"""Values that once killed an executor, failed a job or came out changed."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.functions import dates, encoding, network
from conduit.operators import counters, dml, listings, records, textual, typing

LONG = [
    "a.a" * 16_000, "a" * 50_000, "''" * 25_000, "'" + "''" * 25_000, "'" + "''" * 25_000 + "'", ":a" * 25_000,
    "'a" * 25_000, " a" * 25_000, "-rw " + "a " * 25_000 + "jan 1 2001 x", "d jan " * 8_000, "1-" * 25_000, ";" * 50_000,
    "http://" * 7_000, "." * 50_000, "a-" * 25_000, "+s1," * 12_000 + "\tx", "0" * 50_000, "\x01\x02" * 25_000,
]


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("kind", list(network.VALIDATORS))
def test_validators_survive_long_texts(spark, kind):
    got = column(spark, LONG, lambda c: network.validate(kind, c))
    assert all(v in (True, False) for v in got)


def test_user_names(spark):
    cases = {"a.a": True, "a" * 12_000: True, ".".join("a" * 12_000): True, "a..b": False, "-a": False, "a_": False, "": False, "aé": False}
    assert column(spark, list(cases), network.is_username) == list(cases.values())


def test_parsers_survive_long_texts(spark):
    df = spark.createDataFrame([(v,) for v in LONG], "v string")
    as_of = F.lit("2024-06-01").cast("timestamp")
    assert listings.parse_listing(df, "v", as_of).count() >= 0
    assert textual.parse_responses(df, "v").count() == len(LONG)
    assert textual.parse_log(df, "v").count() == 0
    assert df.select(network.split_uri(F.col("v")), network.resource_kind(F.col("v"))).count() == len(LONG)
    df.select(network.split_uri(F.col("v"))).write.format("noop").mode("overwrite").save()


def test_placeholders(spark):
    cases = {
        "a\x01b = :x": (1, "a\x01b = ?"), "'\x01:keep'": (0, "'\x01:keep'"), "'a'' :x": (1, "'a'' ?"),
        "'" + "''" * 20_000 + "' :x": (1, "'" + "''" * 20_000 + "' ?"), "'a''b''c :x": (1, "'a''b''c ?"),
        "k::int, a:b :c": (2, "k:?, a:b ?"), ":": (0, ":"), "": (0, ""),
    }
    assert column(spark, list(cases), dml.count_placeholders) == [n for n, _ in cases.values()]
    assert column(spark, list(cases), dml.positional_placeholders) == [t for _, t in cases.values()]
    for text in LONG:
        assert column(spark, [text], dml.positional_placeholders)[0].replace("?", "") is not None


def test_bad_lines_drop(spark):
    df = spark.createDataFrame(
        [("[2024-13-45T07:08:09.000        1      INFO] x",), ("[2024-01-02T07:08:09.000 12345678901234567890      INFO] x",),
         ("[2024-01-02T07:08:09.000        1      INFO] ok",)], "v string")
    assert [r.text for r in textual.parse_log(df, "v").collect()] == ["ok"]
    text = "RETCODE = 0  ok\n  action = 2024-13-45 07:08:09\n---  END\n"
    row = textual.parse_responses(spark.createDataFrame([(text,)], "v string"), "v").first()
    assert (row.retcode, row.lastactive) == (0, None)


def test_listing_lines(spark):
    cases = {
        "-rw-r--r-- 1 u g 9223372036854775807 jan 5 2001 big": ("big", 2**63 - 1),
        "-rw-r--r-- 1 u g 99999999999999999999 jan 5 2001 huge": ("huge", None),
        "-rw-r--r-- 1 u g 7 jan 5 99999999999 year": None,
        "-rw-r--r-- 1 u g 7 jan 123456789012345678 2001 day": None,
        "+s7,\x01,\ta\x01b\x02c": ("a\x01b\x02c", 7),
        "-rw-r--r-- 1 " + "t " * 20_000 + "3 feb 5 2001 many": ("many", 3),
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: (r["name"], r["size"]) for r in listings.parse_listing(df, "v", F.lit("2024-06-01").cast("timestamp")).collect()}
    assert got == {k: v for k, v in cases.items() if v}


def test_stored_dates(spark):
    raw = [bytes([120, 124, 2, 29, 14, 6, 10]), bytes(7), None, b"x"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, v binary")
    got = [r.r for r in df.select("i", dates.stored_date(F.col("v")).alias("r")).orderBy("i").collect()]
    assert got == ["2024-02-29 13:05:09", "0000-00-00 00:00:00", None, None]


def test_exact_counters(spark):
    df = spark.createDataFrame([("a", 2**53, 0.5), ("a", 1, None), ("b", None, None)], "k string, n long, x double")
    got = {(r.key, r.field): (r.value, r.whole) for r in counters.add_to_fields(df, F.col("k"), {"n": F.col("n"), "x": F.col("x")}).collect()}
    assert got == {("a", "n"): (float(2**53 + 1), 2**53 + 1), ("a", "x"): (0.5, None)}


def test_counters_beyond_a_bigint(spark):
    most, fields = 2**63 - 1, {"n": F.col("n"), "m": F.col("m"), "x": F.col("x")}
    rows = [("a", most, 1, 0.5), ("a", most, 2, None), ("b", -most, None, None), ("b", -1, None, None), (None, -most, 1, 1.0), (None, -2, 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, n long, m int, x double")
    found = counters.add_to_fields(df, F.col("k"), fields)
    assert {(r.key, r.field): (r.value, r.whole) for r in found.collect()} == {
        ("a", "n"): (float(2 * most), 2 * most), ("a", "m"): (3.0, 3), ("a", "x"): (0.5, None),
        ("b", "n"): (-(2.0**63), -(2**63)), (None, "n"): (-(2.0**63), -(2**63) - 1), (None, "m"): (2.0, 2), (None, "x"): (2.0, None),
    }
    # as long as all totals fit, the type is that of the SQL
    fits = counters.add_to_fields(df.where("k = 'b'"), F.col("k"), fields)
    assert fits.schema["whole"].dataType == T.LongType() and fits.first().whole == -(2**63)


def test_repeated_members(spark):
    df = spark.createDataFrame([('{"k":1,"k":2}',)], "v string")
    row = records.parse_json_rows(df, "v", T.StructType.fromDDL("k bigint")).first()
    assert (row.k, row.json_error) == (2, None)


def test_uri_white_space(spark):
    got = column(spark, ["h\t/a", "http://h :80\n/x", "a?b://c"], network.split_uri)
    assert [r.host for r in got[:2]] == ["h", "h"] and got[1].port == "80"
    assert got[2].protocol == "a?b"


def test_large_binds(spark):
    assert typing.check_binds([2**64 - 1]) == [Decimal(2**64 - 1)]
    assert dml.sql(spark, "SELECT ? AS v", [2**63]).first().v == Decimal(2**63)
    with pytest.raises(OverflowError):
        typing.check_binds([2**64])


def test_large_objects_are_bytes(spark):
    df = spark.createDataFrame([("x",)], "body string")
    assert typing.from_oracle_frame(df, ("body",)).schema["body"].dataType == T.BinaryType()


@pytest.mark.parametrize("key", [None, b"1" * 24, b"1" * 15])
def test_other_keys_are_refused(spark, key):
    df = spark.createDataFrame([(b"text", key, bytes(16))], "v binary, k binary, iv binary")
    with pytest.raises(Exception, match="16 bytes"):
        df.select(encoding.aes_cbc_encrypt(F.col("v"), F.col("k"), F.col("iv"))).collect()


def test_dates_keep_null(spark):
    assert spark.range(1).select(dates.database_date(F.lit(None).cast("timestamp"))).first()[0] is None
