"""Listing lines, responses, log lines, messages and line framing."""

import datetime

import pytest
from pyspark.sql import functions as F

from conduit.operators import listings, textual

UTC = datetime.timezone.utc


def epoch(*parts):
    return int(datetime.datetime(*parts, tzinfo=UTC).timestamp())


def entries(spark, lines, as_of="2000-06-15 12:00:00"):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    rows = listings.parse_listing(df, "line", F.lit(as_of).cast("timestamp")).collect()
    return {r.i: r for r in rows}


LISTED = [
    # line, (name, size, mtime, kind, is_dir, is_file, id)
    ("+i8388621.29609,m824255902,/,\tdev",
     ("dev", None, 824255902, "local", True, False, "8388621.29609")),
    ("+i8388621.44468,m839956783,r,s10376,\tRFCEPLF",
     ("RFCEPLF", 10376, 839956783, "local", False, True, "8388621.44468")),
    ("+s12\tx y", ("x y", None, None, None, False, False, None)),
    ("-rw-r--r--   1 root     other        531 Jan 29 03:26 README",
     ("README", 531, epoch(2000, 1, 29, 3, 26), "minute", False, True, None)),
    ("dr-xr-xr-x   2 root     other        512 Apr  8  1994 etc",
     ("etc", 512, epoch(1994, 4, 8), "day", True, False, None)),
    ("dr-xr-xr-x   2 root     512 Apr  8  1994 etc",
     ("etc", 512, epoch(1994, 4, 8), "day", True, False, None)),
    ("lrwxrwxrwx   1 root     other          7 Jan 25 00:17 bin -> usr/bin",
     ("bin", 7, epoch(2000, 1, 25, 0, 17), "minute", True, True, None)),
    ("----------   1 owner    group         1803128 Jul 10 10:18 ls-lR.Z",
     ("ls-lR.Z", 1803128, epoch(1999, 7, 10, 10, 18), "minute", False, True, None)),
    ("d [R----F--] supervisor            512       Jan 16 18:53    login",
     ("login", 512, epoch(2000, 1, 16, 18, 53), "minute", True, False, None)),
    ("- [R----F--] rhesus             214059       Oct 20 15:27    cx.exe",
     ("cx.exe", 214059, epoch(1999, 10, 20, 15, 27), "minute", False, True, None)),
    ("-------r--         326  1391972  1392298 Nov 22  1995 MegaPhone.sit",
     ("MegaPhone.sit", 1392298, epoch(1995, 11, 22), "day", False, True, None)),
    ("drwxrwxr-x               folder        2 May 10  1996 network",
     ("network", 2, epoch(1996, 5, 10), "day", True, False, None)),
    ("-rw-r--r-- 1 o g 10 Feb 30 1999 a -> b c",
     ("a -> b c", 10, epoch(1999, 3, 2), "day", False, True, None)),
    ("-rw-r--r-- 1 o g 10 MAY  3 1:05 two  blanks ",
     ("two  blanks ", 10, epoch(2000, 5, 3, 1, 5), "minute", False, True, None)),
    ("00README.TXT;1      2 30-DEC-1996 17:44 [SYSTEM] (RWED,RWED,RE,RE)",
     ("00README.TXT", None, epoch(1996, 12, 30, 17, 44), "minute", False, True, None)),
    ("CORE.DIR;1          1  8-SEP-1996 16:09 [SYSTEM] (RWE,RWE,RE,RE)",
     ("CORE", None, epoch(1996, 9, 8, 16, 9), "minute", True, False, None)),
    ("CII-MANUAL.TEX;1  213/216  29-JAN-1996 03:33:12  [ANONYMOU,ANONYMOUS]   (RWED,RWED,,)",
     ("CII-MANUAL.TEX", None, epoch(1996, 1, 29, 3, 33), "minute", False, True, None)),
    ("04-27-00  09:09PM       <DIR>          licensed",
     ("licensed", None, epoch(2000, 4, 27, 21, 9), "minute", True, False, None)),
    ("07-18-00  10:16AM       <DIR>          pub",
     ("pub", None, epoch(2000, 7, 18, 10, 16), "minute", True, False, None)),
    ("04-14-00  03:47PM                  589 readme.htm",
     ("readme.htm", 589, epoch(2000, 4, 14, 15, 47), "minute", False, True, None)),
    ("01-02-99  12:05AM  7 midnight", ("midnight", 7, epoch(1999, 1, 2, 0, 5), "minute", False, True, None)),
    ("01-02-49  12:05PM  7 noon", ("noon", 7, epoch(2049, 1, 2, 12, 5), "minute", False, True, None)),
]

IGNORED = [
    "", "x", "total 14786", "Total of 11 Files, 10966 Blocks.", "DISK$ANONFTP:[ANONYMOUS]",
    "Directory DISK$PCSA:[ANONYM]", "+no tab here", "-rw-r--r-- 1 o g 10 Xxx 3 1999 a",
    "drwx 1 2", "NAME;1 2 30-XXX-1996 17:44 x", "04-14-00  03:47PM  589", "12-13 no",
    "-rw-r--r-- 1 o g 10 Jan 3 199 a May 3 1999 b",
]


def test_listing_lines(spark):
    got = entries(spark, [line for line, _ in LISTED])
    for i, (line, expected) in enumerate(LISTED):
        row = got[i]
        assert (
            row["name"], row["size"], row["mtime"], row["mtime_kind"],
            row["is_dir"], row["is_file"], row["id"],
        ) == expected, line


def test_other_lines_drop(spark):
    assert entries(spark, IGNORED) == {}


@pytest.mark.parametrize(
    "as_of, shown, year",
    [
        ("2000-06-15 12:00:00", "Jun 15", 2000),
        ("2000-06-15 12:00:00", "Jun 16", 2000),
        ("2000-06-15 12:00:00", "Jul 20", 1999),
        ("2000-12-31 12:00:00", "Jan  1", 2001),
        ("2000-12-31 12:00:00", "Feb  1", 2000),
        ("2000-01-01 12:00:00", "Dec 31", 1999),
    ],
)
def test_year_guess(spark, as_of, shown, year):
    got = entries(spark, [f"-rw-r--r-- 1 o g 10 {shown} 10:00 a"], as_of)
    assert datetime.datetime.fromtimestamp(got[0].mtime, UTC).year == year


def responses(spark, texts, **kwargs):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return textual.parse_responses(df, "t", **kwargs).orderBy("i").collect()


def test_responses(spark):
    done = (
        "+++ x\r\nRETCODE = 0 ok\r\n  IMSI  =  1\r\n  IMSI  =  2\r\n  IMEI = 9\r\nIMEI = 8\r\n"
        "  Cell Identity = 412201a2B00ff\r\n  Last action = 2024-05-06 07:08:09.\r\n---   END\r\n"
        "  IMSI = 3\r\nRETCODE = 7 late\r\n"
    )
    rows = responses(spark, [done, "RETCODE = 5952 was\nERROR\n", "RETCODE = 1 ok\n", "", "--- END"])
    first = rows[0]
    assert (first.retcode, first.imsi, first.imei, first.vlr) == (0, "2", "9", None)
    assert (first.lac, first.cell) == (0x1A2B, 0x00FF)
    assert first.lastactive == datetime.datetime(2024, 5, 6, 7, 8, 9)
    assert [r.retcode for r in rows[1:]] == [-2, -3, -3, -1]
    assert [r.retcode for r in responses(spark, ["RETCODE = 1 ok\n"], timeout=False)] == [1]


def test_provisioning_codes(spark):
    df = spark.createDataFrame([(0,), (5952,), (245952,), (3,), (-2,)], "c int")
    got = [r.r for r in df.select(textual.provisioning_result(F.col("c")).alias("r")).collect()]
    assert got == [0, 1, 1, -1, -1]


def test_log_lines(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'ERROR', 'a] b'), (2, 'DEBUG', ''), (3, 'WHAT', 'x') t(i, l, m)"
    )
    lines = df.select(
        "i", textual.log_line(F.timestamp_seconds(F.lit(0)), F.lit(42), F.col("l"), F.col("m")).alias("line")
    )
    shown = [r.line for r in lines.orderBy("i").collect()]
    assert shown[0] == "[1970-01-01T00:00:00.000       42     ERROR] a] b"
    assert shown[2] == "[1970-01-01T00:00:00.000       42      NULL] x"
    back = textual.parse_log(lines, "line").orderBy("i").collect()
    assert [(r.pid, r.level, r.text) for r in back] == [
        (42, "ERROR", "a] b"), (42, "DEBUG", ""), (42, "NULL", "x"),
    ]
    assert [r.i for r in textual.at_least(textual.parse_log(lines, "line"), "ERROR").collect()] == [1]
    with pytest.raises(ValueError):
        textual.at_least(lines, "LOUD")


def test_messages(spark):
    layout = (textual.Slot("n", "integer"), textual.Slot("t", "text", 6))
    df = spark.createDataFrame([(1, "abc"), (2**40, "abcdefgh"), (0, "")], "n bigint, t string")
    sent = df.select(textual.encode_message(layout, {"n": F.col("n"), "t": F.col("t")}).alias("m"))
    assert bytes(sent.first().m) == b"\x01" + bytes(7) + b"abc\0\0\0"
    got = [tuple(r) for r in sent.select(*textual.decode_message(layout, F.col("m"))).collect()]
    assert got == [(1, "abc"), (2**40, "abcde"), (0, "")]


def test_lines(spark):
    df = spark.createDataFrame([(1, "a\r\nbb\rccc\n")], "i int, t string")
    assert [(r.line_no, r.line) for r in textual.frame_lines(df, "t").collect()] == [
        (0, "a"), (2, "bb"), (3, "ccc"),
    ]
    assert [r.line for r in textual.frame_lines(df, "t", 1).collect()] == ["bb", "ccc"]
