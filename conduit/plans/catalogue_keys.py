"""Queries: change lookup, routing, keyed counters and the operation log."""

from __future__ import annotations

from pyspark.sql import functions as F

from conduit.functions.patterns import CHANGE_FLAGS
from conduit.operators import counters, lookups, oplog, predicates, records
from conduit.operators.lookups import Topic
from conduit.plans.registry import query, table
from conduit.session import scratch_path

# -- shared shapes -----------------------------------------------------------------

# event types stand for the five kinds of statistics and for change operations
KIND_OF = {"signup": "p2p", "view": "bill", "click": "co", "purchase": "ci", "error": "pay"}
CHANGE_OF = {"signup": "insert", "view": "update", "click": "update", "purchase": "remove"}

AMOUNT_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def amount():
    """The whole number held in an event's properties."""
    return F.get_json_object("props", "$.k").cast("bigint")


def kind():
    return F.create_map(*[F.lit(x) for pair in KIND_OF.items() for x in pair])[F.col("event_type")]


def change_log(spark, folder):
    """Events as changes ``(event_id, table, rowid, row_op)`` of customer rows.

    Errors are bulk changes; every 16th user writes a malformed row id.
    """
    user = F.col("user_id")
    code = F.create_map(
        *[F.lit(x) for t, name in CHANGE_OF.items() for x in (t, CHANGE_FLAGS[name])]
    )
    operation = F.coalesce(
        F.try_element_at(code, F.col("event_type")), F.lit(CHANGE_FLAGS["allrows"])
    )
    rowid = F.when(user % 16 == 5, F.concat(F.lit("bad "), user.cast("string"))).otherwise(
        row_id(user * 20)
    )
    return table(spark, folder, "events").select(
        "event_id",
        F.lit("customer").alias("table"),
        F.when(F.col("event_type") != "error", rowid).alias("rowid"),
        operation.alias("row_op"),
    )


CHANGES_SQL = """
    (SELECT event_id, CASE WHEN event_type <> 'error' THEN
              CASE WHEN user_id % 16 = 5 THEN 'bad ' || user_id
                   ELSE lpad(CAST(user_id * 20 AS VARCHAR), 18, 'A') END END AS rowid,
            CASE event_type WHEN 'signup' THEN 2 WHEN 'purchase' THEN 8 WHEN 'error' THEN 1
                 ELSE 4 END AS row_op
     FROM events)
"""


def row_id(key):
    return F.lpad(key.cast("string"), 18, "A")


def keyed_customers(spark, folder):
    return table(spark, folder, "customer").select(
        row_id(F.col("c_custkey")).alias("rowid"), "c_custkey", "c_name"
    )


KEYED_SQL = """
    (SELECT lpad(CAST(c_custkey AS VARCHAR), 18, 'A') AS rowid, c_custkey, c_name FROM customer)
"""


# -- flagship ------------------------------------------------------------------------


@query("""
    SELECT CAST(json_object('hour', strftime(hour, '%Y%m%d%H'), 'event_type', event_type,
                            'count', n, 'cents', cents) AS VARCHAR) AS row_json
    FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n,
                 CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
          FROM events WHERE value > 100 AND NOT event_type = 'error' GROUP BY 1, 2)
""")
def hourly_counters_by_predicate(spark, folder):
    events = table(spark, folder, "events")
    kept = predicates.where(events, "value > 100 and not event_type == 'error'")
    hourly = kept.groupBy(
        F.date_format(F.date_trunc("hour", "ts"), "yyyyMMddHH").alias("hour"), "event_type"
    ).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
    )
    return hourly.select(records.to_json_row(hourly).alias("row_json"))


# -- change lookup and routing ---------------------------------------------------------


@query(f"""
    SELECT event_id, row_op, c_custkey, c_name FROM {CHANGES_SQL} JOIN {KEYED_SQL} USING (rowid)
    WHERE regexp_full_match(rowid, '[A-Za-z0-9+/]{{18}}')
""")
def jon01_changed_rows(spark, folder):
    rows = lookups.fetch_changed_rows(change_log(spark, folder), keyed_customers(spark, folder))
    return rows.select("event_id", "row_op", "c_custkey", "c_name")


@query(f"""
    SELECT event_id, rowid FROM {CHANGES_SQL}
    WHERE regexp_full_match(rowid, '[A-Za-z0-9+/]{{18}}')
      AND rowid NOT IN (SELECT rowid FROM {KEYED_SQL})
""")
def jon01_missing_rows(spark, folder):
    rows = lookups.missing_rows(change_log(spark, folder), keyed_customers(spark, folder))
    return rows.select("event_id", "rowid")


@query(f"""
    SELECT count(*) FILTER (fate IN ('bulk', 'found')) AS delivered,
           count(*) FILTER (fate <> 'missing') AS counted,
           count(*) FILTER (fate = 'missing') AS missing,
           count(*) FILTER (fate = 'malformed') AS malformed, count(*) FILTER (fate = 'bulk') AS bulk
    FROM (SELECT CASE WHEN ch.rowid IS NULL THEN 'bulk' WHEN ch.rowid LIKE 'bad%' THEN 'malformed'
                      WHEN cu.rowid IS NULL THEN 'missing' ELSE 'found' END AS fate
          FROM {CHANGES_SQL} ch LEFT JOIN {KEYED_SQL} cu ON ch.rowid = cu.rowid)
""")
def jon01_delivery_counts(spark, folder):
    return lookups.delivery_counts(change_log(spark, folder), keyed_customers(spark, folder))


TOPICS = (
    Topic("accounts", "signup"),
    Topic("view", "page.views"),
    Topic("traffic", "click"),
    Topic("signup", "second.choice"),
    Topic("sales", "purchase"),
)

ROUTE_SQL = (
    "CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 "
    "WHEN 'purchase' THEN 4 END"
)


@query(f"""
    SELECT event_id, CAST({ROUTE_SQL} AS BIGINT) AS topic_index FROM events
    WHERE event_type <> 'error'
""")
def jon02_route_exact(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    matched = lookups.route_exact(events, "event_type", lookups.topic_table(spark, TOPICS))
    return lookups.routed(matched).select("event_id", "topic_index")


@query("SELECT event_id, event_type FROM events WHERE event_type = 'error'")
def jon02_unrouted(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    matched = lookups.route_exact(events, "event_type", lookups.topic_table(spark, TOPICS))
    return lookups.unrouted(matched).select("event_id", "event_type")


KEYWORDS = (
    Topic("gizmo", "SELECT * FROM other"),
    Topic("nothing", "SELECT small ring, red widget FROM parts"),
    Topic("rod", "SELECT 1"),
    Topic("blue", "SELECT hot ring FROM parts"),
)


@query("""
    SELECT p_partkey, CASE WHEN contains(p_name, 'gizmo') THEN 0
        WHEN contains('SELECT small ring, red widget FROM parts', p_name) THEN 1
        WHEN contains(p_name, 'rod') THEN 2
        WHEN contains(p_name, 'blue') OR contains('SELECT hot ring FROM parts', p_name) THEN 3
        ELSE 0 END::BIGINT AS topic_index
    FROM part
""")
def jon03_route_contains(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", lookups.contains_route(F.col("p_name"), KEYWORDS).alias("topic_index")
    )


_TOPICS_SQL = """(
    SELECT s_suppkey AS topic_index, right(s_name, 3) AS name, 'SELECT ' || s_name || ' FROM calls' AS target FROM supplier
)"""


@query(f"""
    SELECT c_custkey, coalesce(min(topic_index), 0) AS topic_index
    FROM (SELECT c_custkey, right(c_name, (1 + c_custkey % 5)::INT) AS text FROM customer)
    LEFT JOIN {_TOPICS_SQL} ON contains(target, text) OR contains(text, name) GROUP BY c_custkey
""")
def jon03_route_contains_join(spark, folder):
    topics = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("topic_index"),
        F.right("s_name", F.lit(3)).alias("name"),
        F.concat(F.lit("SELECT "), F.col("s_name"), F.lit(" FROM calls")).alias("target"),
    )
    texts = table(spark, folder, "customer").select(
        "c_custkey", F.right("c_name", (1 + F.col("c_custkey") % 5).cast("int")).alias("text")
    )
    return lookups.route_contains(texts, "text", topics).select("c_custkey", "topic_index")


@query("""
    SELECT o_orderkey, c_custkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def jon04_keyed_lookup(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return lookups.find(orders, customer, "o_custkey", "c_custkey").drop("o_custkey")


@query("""
    SELECT o_orderkey, c_custkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def jon04_stored_entities(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    stored = lookups.store_entities(customer, "c_custkey", scratch_path(spark, "entities"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lookups.find(orders, stored, "o_custkey", "c_custkey").drop("o_custkey")


@query("""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def jon05_exists(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    large = table(spark, folder, "orders").filter("o_totalprice > 450000")
    return lookups.existing(customer, "c_custkey", large, "o_custkey")


@query("""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def jon05_delete(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    large = table(spark, folder, "orders").filter("o_totalprice > 450000")
    return lookups.without(customer, "c_custkey", large, "o_custkey")


BINDINGS = (
    ("live", "click", "traffic"),
    ("live", "view", "traffic"),
    ("live", "purchase", "sales"),
    ("live", "purchase", "audit"),
    ("batch", "error", "audit"),
    ("live", "purchase", "audit"),
)

_BINDINGS_SQL = ", ".join(str(b) for b in sorted(set(BINDINGS)))


@query(f"""
    SELECT event_id, queue FROM events JOIN (VALUES {_BINDINGS_SQL}) b(exchange, routing_key, queue)
      ON routing_key = event_type AND exchange = CASE WHEN value > 20 THEN 'live' ELSE 'batch' END
""")
def jon06_route_exchange(spark, folder):
    messages = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("value") > 20, "live").otherwise("batch").alias("exchange"),
        F.col("event_type").alias("routing_key"),
    )
    bindings = lookups.binding_table(spark, BINDINGS)
    return lookups.route_exchange(messages, bindings).select("event_id", "queue")


# -- statistics and counters -------------------------------------------------------------

STATISTICS_SQL = (
    "SELECT user_id, "
    + ", ".join(
        f"CAST(coalesce(sum({AMOUNT_SQL}) FILTER (event_type = '{t}'), 0) AS BIGINT) AS {k}_sum, "
        f"count(*) FILTER (event_type = '{t}') AS {k}"
        for t, k in KIND_OF.items()
    )
    + " FROM events GROUP BY user_id"
)


@query(STATISTICS_SQL)
def agg01_identity_statistics(spark, folder):
    return counters.identity_statistics(table(spark, folder, "events"), "user_id", kind(), amount())


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def agg02_duplicate_keys(spark, folder):
    return counters.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS identity FROM orders
""")
def agg03_parse_identity(spark, folder):
    digits = F.lpad(F.col("o_orderkey").cast("string"), 18, "0")
    text = (
        F.when(F.col("o_orderstatus") == "F", digits)
        .when(F.col("o_orderstatus") == "O", F.concat(digits, F.lit("0")))
        .otherwise(F.concat(F.substring(digits, 1, 17), F.lit("x")))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    return counters.identities(orders, F.col("text")).drop("text")


@query("""
    SELECT key, field, coalesce(round(value, 2), CAST(whole AS DOUBLE)) AS value, whole FROM (
      SELECT 'stats:' || strftime(ts, '%Y%m%d%H') AS key, 'count' AS field,
             CAST(NULL AS DOUBLE) AS value, count(*) AS whole FROM events GROUP BY 1
      UNION ALL SELECT 'stats:' || strftime(ts, '%Y%m%d%H'), 'amount', sum(value), NULL
      FROM events GROUP BY 1
      UNION ALL SELECT 'stats:' || strftime(ts, '%Y%m%d%H'), 'large', NULL,
             CAST(sum(event_id + 9007199254740993) AS BIGINT) FROM events GROUP BY 1)
""")
def agg04_hash_counters(spark, folder):
    key = F.concat(F.lit("stats:"), F.date_format("ts", "yyyyMMddHH"))
    totals = counters.add_to_fields(
        table(spark, folder, "events"),
        key,
        # the last is beyond what a double holds exactly
        {"count": F.lit(1), "amount": F.col("value"), "large": F.col("event_id") + 2**53 + 1},
    )
    value = F.when(F.col("whole").isNull(), F.round("value", 2)).otherwise(F.col("value"))
    return totals.withColumn("value", value)


@query(f"""
    SELECT event_id, CAST(sum({AMOUNT_SQL}) OVER (PARTITION BY event_type ORDER BY ts, event_id)
                          AS BIGINT) AS value
    FROM events
""")
def agg04_running_counter(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "props")
    after = counters.running_increment(events, ["event_type"], ["ts", "event_id"], amount(), total=True)
    return after.select("event_id", "value")


@query(f"""
    SELECT user_id, CAST(sum({AMOUNT_SQL}) AS BIGINT) AS total, count(*) AS events
    FROM events GROUP BY user_id
""")
def agg05_scalar_counter(spark, folder):
    events = table(spark, folder, "events").select("user_id", amount().alias("k"))
    return counters.increment(events, ["user_id"], total=F.col("k"), events=1)


@query("SELECT user_id, event_type AS field, count(*) AS value FROM events GROUP BY 1, 2")
def agg06_whole_hash(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "field")
    values = counters.increment(events, ["user_id", "field"], value=1)
    maps = counters.hash_maps(values, "user_id")
    return maps.select("user_id", F.explode("fields").alias("field", "value"))


@query("""
    SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events
    GROUP BY user_id, event_type
""")
def agg07_last_write(spark, folder):
    events = table(spark, folder, "events")
    return counters.last_write(events, ["user_id", "event_type"], "value", F.col("event_id"))


_EXPIRY_AS_OF = "2024-01-30 12:00:00"


@query(f"""
    SELECT user_id, expire_at, CAST(floor(epoch(expire_at)) AS BIGINT) -
           CAST(epoch(TIMESTAMP '{_EXPIRY_AS_OF}') AS BIGINT) AS ttl
    FROM (SELECT user_id, max(ts) + INTERVAL 43200 SECONDS AS expire_at FROM events GROUP BY user_id)
    WHERE expire_at > TIMESTAMP '{_EXPIRY_AS_OF}'
""")
def agg08_expiry(spark, folder):
    moment = F.lit(_EXPIRY_AS_OF).cast("timestamp_ntz")
    expiring = counters.with_expiry(table(spark, folder, "events"), ["user_id"], "ts", 43200)
    return counters.time_to_live(counters.alive(expiring, moment), moment)


# -- the operation log -----------------------------------------------------------------------

LOG_AS_OF = "2024-01-30 00:00:00"


def operation_log(spark, folder, expiring: bool, events=None):
    """Events as hash operations of one key per user.

    Views and clicks add to a field each, purchases set one, errors delete the
    key when their amount is low, and sign-ups limit its life when ``expiring``.
    """
    k, kind_ = amount(), F.col("event_type")
    operation = (
        F.when(kind_.isin("view", "click"), "hincrby")
        .when(kind_ == "purchase", "hset")
        .when((kind_ == "error") & (k < 15), "del")
        .when((kind_ == "signup") & F.lit(expiring), "expire")
    )
    field = F.when(kind_.isin("view", "click"), kind_).when(kind_ == "purchase", F.lit("view"))
    by = F.when(kind_ == "signup", (k - 1) * 1200).otherwise(k)
    events = table(spark, folder, "events") if events is None else events
    return (
        events.select(
            F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"),
            operation.alias("op"), field.alias("field"), by.alias("amount"),
        )
        .filter(F.col("op").isNotNull())
    )


def _log_sql(expiring: bool) -> str:
    last = "WHEN 'signup' THEN 'expire'" if expiring else ""
    return f"""
        SELECT * FROM (
          SELECT user_id AS key, ts, event_id AS seq, epoch_us(ts) AS us,
                 CASE event_type WHEN 'view' THEN 'hincrby' WHEN 'click' THEN 'hincrby'
                   WHEN 'purchase' THEN 'hset'
                   WHEN 'error' THEN CASE WHEN {AMOUNT_SQL} < 15 THEN 'del' END {last} END AS op,
                 CASE WHEN event_type IN ('view', 'click') THEN event_type
                      WHEN event_type = 'purchase' THEN 'view' END AS field,
                 CASE WHEN event_type = 'signup' THEN ({AMOUNT_SQL} - 1) * 1200
                      ELSE {AMOUNT_SQL} END AS amount
          FROM events WHERE ts <= TIMESTAMP '{LOG_AS_OF}') WHERE op IS NOT NULL
    """


@query(f"""
    WITH log AS ({_log_sql(False)}),
    alive AS (SELECT *, max(CASE WHEN op = 'hset' THEN seq END)
                          OVER (PARTITION BY key, field) AS base
              FROM (SELECT *, coalesce(max(CASE WHEN op = 'del' THEN seq END)
                                         OVER (PARTITION BY key), -1) AS cut FROM log)
              WHERE seq > cut AND op <> 'del')
    SELECT key, field, CAST(sum(amount) AS BIGINT) AS value, CAST(NULL AS TIMESTAMP) AS expire_at
    FROM alive WHERE base IS NULL OR seq >= base GROUP BY key, field
""")
def agg09_log_fold(spark, folder):
    log = operation_log(spark, folder, expiring=False)
    return oplog.fold_log(log, ["key"], LOG_AS_OF)


# the same fold step by step: one operation of every key per turn
EXPIRING_FOLD_SQL = f"""
    WITH RECURSIVE log AS (
      SELECT *, row_number() OVER (PARTITION BY key ORDER BY us, seq) AS rn
      FROM ({_log_sql(True)})),
    state(key, rn, living, deadline, birth) AS (
      SELECT DISTINCT key, CAST(0 AS BIGINT), false, CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM log
      UNION ALL
      SELECT l.key, l.rn,
             CASE WHEN l.op IN ('hset', 'hincrby') THEN true WHEN l.op = 'del' THEN false
                  ELSE l.amount > 0 AND s.living AND coalesce(s.deadline > l.us, true) END,
             CASE WHEN l.op IN ('hset', 'hincrby')
                    THEN CASE WHEN s.living AND s.deadline > l.us THEN s.deadline END
                  WHEN l.op = 'expire' AND l.amount > 0 AND s.living
                       AND coalesce(s.deadline > l.us, true) THEN l.us + l.amount * 1000000 END,
             CASE WHEN l.op IN ('hset', 'hincrby')
                       AND NOT (s.living AND coalesce(s.deadline > l.us, true)) THEN l.rn
                  ELSE s.birth END
      FROM state s JOIN log l ON l.key = s.key AND l.rn = s.rn + 1),
    final AS (
      SELECT key, arg_max(living, rn) AS living, arg_max(coalesce(deadline, -1), rn) AS deadline,
             arg_max(birth, rn) AS birth FROM state GROUP BY key),
    writes AS (
      SELECT l.*, f.deadline, max(CASE WHEN op = 'hset' THEN rn END)
                                OVER (PARTITION BY l.key, field) AS base
      FROM log l JOIN final f ON f.key = l.key
      WHERE f.living AND (f.deadline = -1 OR f.deadline > epoch_us(TIMESTAMP '{LOG_AS_OF}'))
        AND op IN ('hset', 'hincrby') AND rn >= f.birth)
    SELECT key, field, CAST(sum(amount) AS BIGINT) AS value,
           make_timestamp(nullif(max(deadline), -1)) AS expire_at
    FROM writes WHERE base IS NULL OR rn >= base GROUP BY key, field
"""


@query(EXPIRING_FOLD_SQL)
def agg09_expiring_log_fold(spark, folder):
    log = operation_log(spark, folder, expiring=True)
    return oplog.fold_log(log, ["key"], LOG_AS_OF)


@query("""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS tick, count(*) AS "rows", count(*) / CAST(3600 AS DOUBLE) AS per_second
    FROM events GROUP BY 1
""")
def agg10_delivery_rate(spark, folder):
    rate = counters.delivery_rate(table(spark, folder, "events"), "ts", 3600)
    return rate.withColumn("tick", F.col("tick").cast("timestamp_ntz"))
