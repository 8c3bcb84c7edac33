"""Queries: scalar functions and text parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from conduit.functions import dates, encoding, network, numbers, patterns, strings
from conduit.operators import listings, textual
from conduit.plans.registry import query, table

# -- strings ---------------------------------------------------------------------


@query("""
    SELECT page_id, token_no, token FROM (
      SELECT page_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS token_no
      FROM (SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS tokens
            FROM pages))
""")
def str01_split(spark, folder):
    tokens = strings.split_tokens(F.col("url"), "/")
    return (
        table(spark, folder, "pages")
        .select("page_id", F.posexplode(tokens).alias("token_no", "token"))
        .withColumn("token_no", F.col("token_no").cast("bigint"))
    )


@query("""
    SELECT page_id,
           array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), '|') AS merged
    FROM pages
""")
def str02_merge(spark, folder):
    merged = strings.merge_tokens(strings.split_tokens(F.col("url"), "/"), "|")
    return table(spark, folder, "pages").select("page_id", merged.alias("merged"))


@query(r"""
    SELECT c_custkey,
           c_name || E'\n\x0b ' AS left_side, E' \t ' || c_name AS right_side, c_name AS both_sides,
           E'\t ' || c_name AS buffer
    FROM customer
""")
def str03_trim(spark, folder):
    padded = F.concat(F.lit(" \t "), "c_name", F.lit("\n\x0b "))
    return table(spark, folder, "customer").select(
        "c_custkey",
        strings.ltrim(padded).alias("left_side"),
        strings.rtrim(padded).alias("right_side"),
        strings.trim(padded).alias("both_sides"),
        strings.trim_buffer(padded).alias("buffer"),
    )


_PATH_SQL = r"""
    (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/top' WHEN 1 THEN 'bare' WHEN 2 THEN 'dir/'
                     ELSE regexp_replace(url, '^[a-z]+:/', '') END AS p FROM pages)
"""


def _paths(spark, folder):
    variant = F.col("page_id") % 5
    path = (
        F.when(variant == 0, "/top")
        .when(variant == 1, "bare")
        .when(variant == 2, "dir/")
        .otherwise(F.regexp_replace("url", "^[a-z]+:/", ""))
    )
    return table(spark, folder, "pages").select("page_id", path.alias("p"))


@query(f"""
    SELECT page_id, CASE WHEN p = '/top' THEN '/' ELSE
             rtrim(substr(p, 1, length(p) - length(list_extract(string_split(p, '/'), -1))), '/')
           END AS parent,
           list_extract(string_split(p, '/'), -1) AS filename
    FROM {_PATH_SQL}
""")
def str04_splitpath(spark, folder):
    paths = _paths(spark, folder)
    return paths.select("page_id", strings.split_path(F.col("p")).alias("s")).select(
        "page_id", "s.*"
    )


@query(f"""
    SELECT page_id, CASE WHEN len(parts) >= 2 THEN parts[1] ELSE '' END AS bucket,
           CASE WHEN len(parts) >= 2 THEN array_to_string(parts[2:], '/') ELSE p END AS key
    FROM (SELECT page_id, p, list_filter(string_split(p, '/'), lambda x: x <> '') AS parts
          FROM {_PATH_SQL})
""")
def str05_splitbucket(spark, folder):
    paths = _paths(spark, folder)
    return paths.select("page_id", strings.split_bucket(F.col("p")).alias("s")).select(
        "page_id", "s.*"
    )


@query(r"""
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN
             array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), chr(92)) END
           AS inner_path
    FROM pages
""")
def str06_share_path(spark, folder):
    share = F.when(F.col("page_id") % 2 == 0, "/media/").otherwise("/other/")
    path = F.concat(share, "url")
    return table(spark, folder, "pages").select(
        "page_id", strings.share_path(path, "media").alias("inner_path")
    )


# -- encoding ----------------------------------------------------------------------


@query("SELECT doc_id, to_base64(encode(text)) AS encoded FROM documents")
def enc01_base64_encode(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", encoding.base64_encode(F.col("text")).alias("encoded")
    )


@query("""
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN substr(c_name, 1, 15)
           WHEN 2 THEN substr(c_name, 1, 16) ELSE c_name || 'x' END AS decoded
    FROM customer
""")
def enc02_base64_decode(spark, folder):
    full = encoding.base64_encode(F.col("c_name"))
    variant = F.col("c_custkey") % 4
    dirty = (
        F.when(variant == 0, F.concat(full, F.lit("*QUJD")))
        .when(variant == 1, F.substring(full, 1, 21))
        .when(variant == 2, F.concat(F.substring(full, 1, 22), F.lit("==QUJD")))
        .otherwise(encoding.base64_encode(F.concat("c_name", F.lit("x"))))
    )
    return table(spark, folder, "customer").select(
        "c_custkey", encoding.base64_decode(dirty).cast("string").alias("decoded")
    )


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def enc03_md5(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", encoding.md5_hex(F.col("text")).alias("digest")
    )


@query(r"""
    SELECT doc_id, rtrim(regexp_replace(md5(text), '(..)', '\1:', 'g'), ':') AS md5,
           rtrim(regexp_replace(sha1(text), '(..)', '\1:', 'g'), ':') AS sha1
    FROM documents
""")
def enc04_fingerprint(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        encoding.fingerprint(F.col("text")).alias("md5"),
        encoding.fingerprint(F.col("text"), "sha1").alias("sha1"),
    )


_KEY = bytes(range(16))


@query("SELECT doc_id, md5(text) AS opened, 16 AS sealed_bytes, true AS changed FROM documents")
def enc05_aes_block(spark, folder):
    block = F.unhex(F.md5("text"))
    sealed = encoding.aes_block_encrypt(block, F.lit(_KEY))
    opened = encoding.aes_block_decrypt(F.col("sealed"), F.lit(_KEY))
    return (
        table(spark, folder, "documents")
        .select("doc_id", block.alias("block"), sealed.alias("sealed"))
        .select(
            "doc_id",
            F.lower(F.hex(opened)).alias("opened"),
            F.octet_length("sealed").alias("sealed_bytes"),
            (F.col("sealed") != F.col("block")).alias("changed"),
        )
    )


@query("""
    SELECT doc_id, md5(text) AS opened, (octet_length(encode(text)) + 15) // 16 * 16 AS sealed_bytes
    FROM documents
""")
def enc06_aes_chain(spark, folder):
    body = F.col("text").cast("binary")
    iv = F.unhex(F.md5(F.col("doc_id").cast("string")))
    sealed = encoding.aes_cbc_encrypt(body, F.lit(_KEY), iv)
    return (
        table(spark, folder, "documents")
        .select(
            "doc_id", F.octet_length(body).alias("size"), iv.alias("iv"), sealed.alias("sealed")
        )
        .select(
            "doc_id",
            F.md5(
                encoding.aes_cbc_decrypt(F.col("sealed"), F.lit(_KEY), F.col("iv"), F.col("size"))
            ).alias("opened"),
            F.octet_length("sealed").cast("bigint").alias("sealed_bytes"),
        )
    )


# -- numbers -----------------------------------------------------------------------


@query("""
    SELECT o_orderkey,
           CASE o_orderkey % 8 WHEN 0 THEN o_orderkey WHEN 1 THEN -o_orderkey END AS value,
           CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'invalid'
                WHEN 3 THEN 'invalid' WHEN 4 THEN 'trailing' WHEN 5 THEN 'trailing'
                WHEN 6 THEN 'overflow' ELSE 'invalid' END AS error
    FROM orders
""")
def num01_parse_integer(spark, folder):
    digits = F.col("o_orderkey").cast("string")
    variant = F.col("o_orderkey") % 8
    text = (
        F.when(variant == 0, digits)
        .when(variant == 1, F.concat(F.lit("-"), digits))
        .when(variant == 2, F.concat(F.lit("+"), digits))
        .when(variant == 3, F.concat(F.lit(" "), digits))
        .when(variant == 4, F.concat(digits, F.lit(" ")))
        .when(variant == 5, F.concat(digits, F.lit(".5")))
        .when(variant == 6, F.concat(F.lit("99999999999999999999"), digits, F.lit("x")))
        .otherwise(F.lit(""))
    )
    parsed = numbers.parse_integer(text)
    return table(spark, folder, "orders").select("o_orderkey", parsed.alias("p")).select(
        "o_orderkey", "p.value", "p.error"
    )


@query("""
    SELECT p_partkey, CAST(CAST(p_partkey % 65536 AS HUGEINT) * 281474976710656 AS VARCHAR) AS value
    FROM part
""")
def num02_bytes_to_u64(spark, folder):
    two_bytes = F.unhex(F.lpad(F.hex(F.col("p_partkey") % 65536), 4, "0"))
    return table(spark, folder, "part").select(
        "p_partkey", numbers.bytes_to_u64(two_bytes).cast("string").alias("value")
    )


@query("SELECT c_custkey, bin(c_mktsegment) AS bits FROM customer")
def num03_bytes_to_bits(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", numbers.bytes_to_bits(F.col("c_mktsegment").cast("binary")).alias("bits")
    )


@query('SELECT count(*) AS "rows", count(*) AS inside, true AS spread FROM orders')
def num04_uniform(spark, folder):
    drawn = table(spark, folder, "orders").select(numbers.uniform(-5.0, 20.0, seed=7).alias("x"))
    inside = (F.col("x") >= -5.0) & (F.col("x") < 20.0)
    return drawn.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(inside, 1)).alias("inside"),
        (F.max("x") - F.min("x") > 20).alias("spread"),
    )


@query('SELECT count(*) AS "rows", count(*) AS well_formed, CAST(0 AS BIGINT) AS repeated FROM orders')
def num05_uuid(spark, folder):
    shape = "[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"
    drawn = table(spark, folder, "orders").select(numbers.uuid().alias("u"), numbers.uuid().alias("v"))
    return drawn.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(network.full_match(F.col("u"), shape), 1)).alias("well_formed"),
        F.count(F.when(F.col("u") == F.col("v"), 1)).alias("repeated"),
    )


# -- dates ---------------------------------------------------------------------------


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS iso FROM events")
def dat01_iso8601(spark, folder):
    return table(spark, folder, "events").select("event_id", dates.iso8601(F.col("ts")).alias("iso"))


@query("""
    SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
           CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS age
    FROM events
""")
def dat02_epoch_and_age(spark, folder):
    seconds = dates.epoch_seconds(F.col("ts"))
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id", seconds.alias("seconds"), dates.age_seconds(seconds, as_of).alias("age")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %I:%M:%S %p') AS shown FROM events")
def dat03_twelve_hour(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", dates.full_date(dates.epoch_seconds(F.col("ts"))).alias("shown")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS shown FROM events")
def dat04_epoch_millis(spark, folder):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        "event_id", dates.full_date_ms(millis).alias("shown")
    )


# -- validation and addresses ----------------------------------------------------------


@query(rf"""
    SELECT page_id, name, regexp_full_match(name, '{patterns.ADDRESS}')
           OR regexp_full_match(name, '{patterns.HOST_NAME}') AS valid
    FROM (SELECT page_id, CASE page_id % 6 WHEN 0 THEN host WHEN 1 THEN '-' || host
            WHEN 2 THEN host || '..x' WHEN 3 THEN '10.' || page_id % 300 || '.0.1'
            WHEN 4 THEN replace(host, '.', '_') ELSE replace(host, '.', '-.') END AS name
          FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?]*)', 1) AS host FROM pages))
""")
def net01_hostname(spark, folder):
    pages = table(spark, folder, "pages")
    host, variant = network.split_uri(F.col("url"))["host"], F.col("page_id") % 6
    name = (
        F.when(variant == 0, host)
        .when(variant == 1, F.concat(F.lit("-"), host))
        .when(variant == 2, F.concat(host, F.lit("..x")))
        .when(
            variant == 3,
            F.concat(F.lit("10."), (F.col("page_id") % 300).cast("string"), F.lit(".0.1")),
        )
        .when(variant == 4, F.replace(host, F.lit("."), F.lit("_")))
        .otherwise(F.replace(host, F.lit("."), F.lit("-.")))
    )
    return pages.select("page_id", name.alias("name")).select(
        "page_id", "name", network.validate("hostname", F.col("name")).alias("valid")
    )


_KINDS = ("username", "tns", "consumer", "rowid", "region")

_VALIDATED_SQL = """
    SELECT c_custkey,
           CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', '.')
             WHEN 2 THEN 'us-east-' || c_custkey WHEN 3 THEN replace(c_name, '#', '/')
             WHEN 4 THEN replace(c_name, '#', '-_') ELSE lower(c_mktsegment) END AS name
    FROM customer
"""


@query(
    f"SELECT c_custkey, name, "
    + ", ".join(
        f"regexp_full_match(name, '{pattern}') AS is_{kind}"
        for kind, pattern in zip(
            _KINDS,
            (
                patterns.USERNAME,
                patterns.TNS_NAME,
                patterns.CONSUMER_NAME,
                patterns.ROW_ID,
                patterns.REGION,
            ),
        )
    )
    + f" FROM ({_VALIDATED_SQL})"
)
def net02_validators(spark, folder):
    variant = F.col("c_custkey") % 6
    swap = lambda by: F.replace(F.col("c_name"), F.lit("#"), F.lit(by))
    name = (
        F.when(variant == 0, F.col("c_name"))
        .when(variant == 1, swap("."))
        .when(variant == 2, F.concat(F.lit("us-east-"), F.col("c_custkey").cast("string")))
        .when(variant == 3, swap("/"))
        .when(variant == 4, swap("-_"))
        .otherwise(F.lower("c_mktsegment"))
    )
    named = table(spark, folder, "customer").select("c_custkey", name.alias("name"))
    return named.select(
        "c_custkey",
        "name",
        *[network.validate(k, F.col("name")).alias(f"is_{k}") for k in _KINDS],
    )


@query("""
    SELECT c_custkey,
           CASE c_custkey % 4 WHEN 0 THEN 'STREAM' WHEN 1 THEN 'CONSUMER' ELSE 'UNKNOWN' END AS kind,
           CASE WHEN c_custkey % 4 < 2 THEN 'stream-' || c_custkey END AS stream
    FROM customer
""")
def net03_resource_kind(spark, folder):
    variant = F.col("c_custkey") % 4
    stream = F.format_string(
        "arn:aws:kinesis:eu-west-1:123456789012:stream/stream-%d", "c_custkey"
    )
    arn = (
        F.when(variant == 0, stream)
        .when(variant == 1, F.concat(stream, F.lit("/consumer/app.one:1234567890")))
        .when(variant == 2, F.concat(stream, F.lit("/consumer/app.one:12")))
        .otherwise(F.col("c_name"))
    )
    return (
        table(spark, folder, "customer")
        .select("c_custkey", network.resource_kind(arn).alias("r"))
        .select("c_custkey", "r.*")
    )


@query(r"""
    SELECT page_id, lower(coalesce(scheme, '')) AS protocol, string_split(authority, ':')[1] AS host,
           CASE WHEN contains(authority, ':') THEN string_split(authority, ':')[2] ELSE '' END AS port,
           path, list_extract(string_split(path, '/'), -1) AS filename, query
    FROM (SELECT page_id, CASE WHEN contains(u, '://') THEN string_split(u, '://')[1] END AS scheme,
                 regexp_extract(rest, '^[^/?]*', 0) AS authority,
                 regexp_extract(string_split(rest, '?')[1], '/.*', 0) AS path,
                 CASE WHEN contains(rest, '?') THEN substr(rest, strpos(rest, '?')) ELSE '' END AS query
          FROM (SELECT page_id, u, list_extract(string_split(u, '://'), -1) AS rest
                FROM (SELECT page_id, CASE page_id % 4
                               WHEN 0 THEN url
                               WHEN 1 THEN upper(substr(url, 1, 4)) || substr(url, 5)
                               WHEN 2 THEN regexp_extract(url, '://([^/?]*)', 1) || ':8080'
                               ELSE regexp_extract(url, '://([^/?]*)', 1) || ':80/a/b.html?&q=1:2'
                             END AS u FROM pages)))
""")
def net04_split_uri(spark, folder):
    variant = F.col("page_id") % 4
    host = F.regexp_extract("url", "://([^/?]*)", 1)
    uri = (
        F.when(variant == 0, F.col("url"))
        .when(variant == 1, F.concat(F.upper(F.substring("url", 1, 4)), F.substr("url", F.lit(5))))
        .when(variant == 2, F.concat(host, F.lit(":8080")))
        .otherwise(F.concat(host, F.lit(":80/a/b.html?&q=1:2")))
    )
    pages = table(spark, folder, "pages").select("page_id", uri.alias("u"))
    return pages.select("page_id", network.split_uri(F.col("u")).alias("s")).select("page_id", "s.*")


_PROTOCOL_NAMES = tuple(patterns.PROTOCOLS)
_AUTH_NAMES = tuple(patterns.AUTH_TYPES)


@query(f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN -1 ELSE CAST(o_orderkey % 14 AS INTEGER) - 1 END
             AS protocol,
           CAST(o_orderkey % 5 AS INTEGER) - 1 AS auth,
           'protocol::' || list_extract({list(_PROTOCOL_NAMES)}, CAST(o_orderkey % 14 AS INTEGER) + 1) AS protocol_name,
           'authtype::' || list_extract({list(_AUTH_NAMES)}, CAST(o_orderkey % 5 AS INTEGER) + 1) AS auth_name
    FROM orders
""")  # noqa: E501
def net05_codes(spark, folder):
    key = F.col("o_orderkey")
    protocol = F.get(F.array(*[F.lit(n) for n in _PROTOCOL_NAMES]), (key % 14).cast("int"))
    auth = F.get(F.array(*[F.lit(n) for n in _AUTH_NAMES]), (key % 5).cast("int"))
    # short, lower-case (not a name) and qualified forms
    written = (
        F.when(key % 3 == 0, protocol)
        .when(key % 3 == 1, F.lower(protocol))
        .otherwise(F.concat(F.lit("CONDUIT::PROTOCOL::"), protocol))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        network.protocol_code(written).alias("protocol"),
        network.auth_code(auth).alias("auth"),
        network.protocol_name(key % 14 - 1).alias("protocol_name"),
        network.auth_name(key % 5 - 1).alias("auth_name"),
    )


@query(
    "SELECT event_id, concat_ws(',', "
    + ", ".join(
        f"CASE WHEN (event_id % 128) & {bit} > 0 THEN '{name}' END"
        for name, bit in patterns.CHANGE_FLAGS.items()
    )
    + ") AS changes FROM events"
)
def net06_change_flags(spark, folder):
    names = network.change_names(F.col("event_id") % 128)
    return table(spark, folder, "events").select(
        "event_id", F.array_join(names, ",").alias("changes")
    )


# -- text ingestion ----------------------------------------------------------------------

_AS_OF = "2002-03-01 12:00:00"


@query(f"""
    SELECT o_orderkey,
           CASE o_orderkey % 7 WHEN 4 THEN 'DIR' || o_orderkey ELSE 'order ' || o_orderkey || '.dat'
           END AS name,
           CASE WHEN o_orderkey % 7 NOT IN (3, 4, 6) THEN CAST(floor(o_totalprice) AS BIGINT) END AS size,
           CASE o_orderkey % 7
             WHEN 1 THEN CAST(epoch(TIMESTAMP '2002-03-01' - to_days(CAST(o_orderkey % 340 AS INTEGER))) AS BIGINT)
                         + 13 * 3600 + 5 * 60
             WHEN 0 THEN CAST(epoch(o_orderdate) AS BIGINT)
             WHEN 2 THEN CAST(epoch(o_orderdate) AS BIGINT)
             ELSE CAST(epoch(o_orderdate) AS BIGINT) + 15 * 3600 + 47 * 60 END AS mtime,
           o_orderkey % 7 IN (4, 6) AS is_dir, o_orderkey % 7 NOT IN (4, 6) AS is_file,
           CASE WHEN o_orderkey % 7 = 2 THEN 'id' || o_orderkey END AS id
    FROM orders WHERE o_orderkey % 7 <> 5 OR o_orderkey % 2 = 0
""")  # noqa: E501
def txt01_listing_lines(spark, folder):
    orders = table(spark, folder, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    size = F.floor("o_totalprice").cast("string")
    shown = lambda fmt, ts=day: F.date_format(ts, fmt)
    recent = F.lit(_AS_OF[:10]).cast("date") - (key % 340).cast("int")
    name = F.concat(F.lit("order "), key.cast("string"), F.lit(".dat"))
    dos = F.concat(shown("MM-dd-yy"), F.lit("  03:47PM"))
    variant = key % 7
    line = (
        F.when(
            variant == 0,
            F.concat(F.lit("-rw-r--r--   1 root  other  "), size, F.lit(" "),
                     shown("MMM d  yyyy"), F.lit(" "), name),
        )
        .when(
            variant == 1,
            F.concat(F.lit("-rw-r--r--  1 owner "), size, F.lit(" "),
                     shown("MMM d", recent), F.lit(" 13:05 "), name),
        )
        .when(
            variant == 2,
            F.concat(F.lit("+iid"), key.cast("string"), F.lit(",m"),
                     F.unix_timestamp(day).cast("string"), F.lit(",r,s"), size, F.lit(",\t"), name),
        )
        .when(
            variant == 3,
            F.concat(name, F.lit(";1  2 "), F.upper(shown("d-MMM-yyyy")),
                     F.lit(" 15:47 [SYSTEM] (RWED,RWED,RE,RE)")),
        )
        .when(
            variant == 4,
            F.concat(F.lit("DIR"), key.cast("string"), F.lit(".DIR;1   1 "),
                     F.upper(shown("d-MMM-yyyy")), F.lit(" 15:47:12  [A,B]  (RWE)")),
        )
        .when((variant == 5) & (key % 2 == 1), F.concat(F.lit("total "), size))
        .when(variant == 5, F.concat(dos, F.lit("       "), size, F.lit(" "), name))
        .otherwise(F.concat(dos, F.lit("       <DIR>          "), name))
    )
    as_of = F.lit(_AS_OF).cast("timestamp")
    rows = listings.parse_listing(orders.select("o_orderkey", line.alias("line")), "line", as_of)
    return rows.drop("line", "mtime_kind")


@query("""
    SELECT c_custkey,
           CASE WHEN c_custkey % 7 = 0 THEN -2 WHEN c_custkey % 11 = 0 THEN -3
                ELSE CAST(c_custkey % 3 AS INTEGER) END AS retcode,
           '47001' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS imsi,
           CASE WHEN c_custkey % 7 > 0 THEN '35' || lpad(CAST(c_custkey AS VARCHAR), 13, '0') END AS imei,
           '88017' || c_nationkey AS vlr,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(c_custkey AS BIGINT)) AS lastactive,
           CAST(c_nationkey + 4096 AS INTEGER) AS lac,
           CAST(c_custkey % 65536 AS INTEGER) AS cell,
           CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 3 > 0 THEN -1 ELSE 0 END AS result
    FROM customer
""")  # noqa: E501
def txt02_element_responses(spark, folder):
    key = F.col("c_custkey")
    seconds = F.timestamp_seconds(F.lit(1704067200) + key)
    code = (key % 3).cast("string")
    text = F.concat(
        F.lit("+++ response\r\nRETCODE = 9  pending\r\nRETCODE = "), code, F.lit("  done\r\n\r\n"),
        F.lit("  IMSI  =  0\r\n"),
        F.lit("  IMSI  =  47001"), F.lpad(key.cast("string"), 10, "0"), F.lit("\r\n"),
        F.lit("  VLRNUM  =  88017"), F.col("c_nationkey").cast("string"), F.lit("\r\n"),
        F.lit("  Cell Identity  =  41220"),
        F.lpad(F.hex(F.col("c_nationkey") + 4096), 4, "0"),
        F.lower(F.lpad(F.hex(key % 65536), 4, "0")), F.lit("\n"),
        F.lit("Last action  =  "), F.date_format(seconds, "yyyy-MM-dd HH:mm:ss"), F.lit(" (ok)\n"),
        F.when(key % 7 == 0, "ERROR\r\n").otherwise(F.lit("")),
        F.lit("  IMEI  =  35"), F.lpad(key.cast("string"), 13, "0"), F.lit("\n"),
        F.when(key % 11 == 0, "").otherwise(F.lit("---    END\r\n  VLRNUM  =  1\r\n")),
    )
    blocks = table(spark, folder, "customer").select("c_custkey", text.alias("response"))
    rows = textual.parse_responses(blocks, "response")
    return rows.withColumn("result", textual.provisioning_result(F.col("retcode")))


_LEVEL_OF = {
    "signup": "NOTICE", "view": "DEBUG", "click": "INFO", "purchase": "WARNING", "error": "ERROR",
}


@query("""
    SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id AS pid,
           CASE event_type WHEN 'purchase' THEN 'WARNING' ELSE 'ERROR' END AS level,
           CAST(CASE event_type WHEN 'purchase' THEN 4 ELSE 3 END AS BIGINT) AS rank,
           event_type || ' [' || props || ']' AS text
    FROM events WHERE event_type IN ('purchase', 'error')
""")
def txt03_log_lines(spark, folder):
    level = F.create_map(*[F.lit(x) for pair in _LEVEL_OF.items() for x in pair])[
        F.col("event_type")
    ]
    text = F.concat("event_type", F.lit(" ["), "props", F.lit("]"))
    lines = table(spark, folder, "events").select(
        "event_id", textual.log_line(F.col("ts"), F.col("user_id"), level, text).alias("line")
    )
    severe = textual.at_least(textual.parse_log(lines, "line"), "WARNING")
    return severe.withColumn("rank", textual.level_rank(F.col("level")))


@query("""
    SELECT o_orderkey, o_orderkey AS index, o_custkey AS total,
           '/data/' || o_orderpriority || '/' || o_orderkey || '.csv' AS filename,
           o_orderstatus AS batchid, 4176 AS bytes
    FROM orders
""")
def txt04_fixed_layout(spark, folder):
    path = F.concat(
        F.lit("/data/"), "o_orderpriority", F.lit("/"), F.col("o_orderkey").cast("string"),
        F.lit(".csv"),
    )
    message = textual.encode_message(
        textual.BATCH_MESSAGE,
        {
            "index": F.col("o_orderkey"),
            "total": F.col("o_custkey"),
            "filename": path,
            "batchid": F.col("o_orderstatus"),
        },
    )
    sent = table(spark, folder, "orders").select("o_orderkey", message.alias("message"))
    return sent.select(
        "o_orderkey",
        *textual.decode_message(textual.BATCH_MESSAGE, F.col("message")),
        F.octet_length("message").alias("bytes"),
    )


@query("""
    SELECT event_id, '[' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '] {' || md5(props) || ' = ' ||
           user_id || '} => ' || event_type || ' <> s' || event_id // 10 || ' - ' || props AS line
    FROM events
""")
def txt05_event_line(spark, folder):
    line = textual.event_line(
        dates.iso8601(F.col("ts")),
        encoding.md5_hex(F.col("props")),
        F.col("user_id").cast("string"),
        F.col("event_type"),
        F.concat(F.lit("s"), F.floor(F.col("event_id") / 10).cast("string")),
        F.col("props"),
    )
    return table(spark, folder, "events").select("event_id", line.alias("line"))
