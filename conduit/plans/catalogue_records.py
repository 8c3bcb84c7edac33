"""Queries: records, types, predicates, SQL and row changes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.operators import dml, predicates, records, typing
from conduit.operators.textual import frame_lines
from conduit.plans.pages import write_pages
from conduit.plans.registry import query, table
from conduit.session import scratch_path
from conduit.sources.objects import NameFilter

# -- projection, schema and records ---------------------------------------------


@query("""
    SELECT p_partkey AS id, p_name AS name,
           CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS BIGINT) END AS size,
           CASE WHEN p_partkey % 3 = 2 THEN 'spare' END AS note
    FROM part
""")
def rec01_declared_rows(spark, folder):
    part = table(spark, folder, "part")
    # two, three or five values per line against four declared columns
    line = F.concat_ws(
        "|",
        "p_partkey",
        "p_name",
        F.when(F.col("p_partkey") % 3 > 0, F.col("p_size").cast("string")),
        F.when(F.col("p_partkey") % 3 == 2, F.lit("spare|extra")),
    )
    schema = T.StructType.fromDDL("id bigint, name string, size bigint, note string")
    return part.select(*records.build_rows(F.split(line, r"\|"), schema))


@query("SELECT c_name, c_custkey, c_mktsegment FROM customer")
def rec02_project_by_name_or_position(spark, folder):
    return records.project(table(spark, folder, "customer"), "c_name", 0, "c_mktsegment")


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def rec03_strict_types(spark, folder):
    wanted = {"l_orderkey": "bigint", "l_quantity": "double", "l_returnflag": "string"}
    return records.project_typed(table(spark, folder, "lineitem"), wanted)


@query("""
    SELECT c_custkey, coalesce(first_order, -1) AS value, first_order IS NOT NULL AS present
    FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS first_order
                             FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def rec04_null_keeps_default(spark, folder):
    first = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderkey").alias("first_order"))
    )
    customer = table(spark, folder, "customer").select("c_custkey")
    joined = customer.join(first, customer["c_custkey"] == first["o_custkey"], "left")
    value = records.value_or_default(F.col("first_order"), -1)
    return joined.select("c_custkey", value.alias("v")).select("c_custkey", "v.*")


@query("""
    SELECT doc_id, hex(array_slice(encode(text), 1, 16)) AS prefix,
           least(16, octet_length(encode(text))) AS copied
    FROM documents
""")
def rec05_binary_prefix(spark, folder):
    documents = table(spark, folder, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("body")
    )
    prefix = records.binary_prefix(documents, "body", 16)
    return documents.select("doc_id", prefix.alias("p")).select(
        "doc_id", F.hex("p.bytes").alias("prefix"), F.col("p.copied").cast("bigint").alias("copied")
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def rec06_leading_columns(spark, folder):
    return records.leading_columns(table(spark, folder, "orders"), 3)


@query("""
    SELECT o_orderkey,
           CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,
                            'status', nullif(o_orderstatus, 'F'),
                            'digest', to_base64(encode(o_orderpriority))) AS VARCHAR) AS row_json
    FROM orders
""")
def rec07_row_to_json(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"),
        F.col("o_orderpriority").cast("binary").alias("digest"),
    )
    return orders.select("o_orderkey", records.to_json_row(orders).alias("row_json"))


@query("""
    SELECT event_id,
           CASE WHEN event_id % 5 IN (0, 3) THEN CAST(json_extract_string(props, '$.k') AS BIGINT)
           END AS k,
           CASE WHEN event_id % 5 = 3 THEN event_type END AS label,
           CASE event_id % 5 WHEN 1 THEN 'type mismatch: k' WHEN 2 THEN 'not a JSON object'
                WHEN 4 THEN 'type mismatch: label' END AS json_error
    FROM events
""")
def rec08_json_to_row(spark, folder):
    events = table(spark, folder, "events")
    number = F.get_json_object("props", "$.k")
    variant = F.col("event_id") % 5
    text = (
        F.when(variant == 1, F.format_string('{"k": "%s"}', number))
        .when(variant == 2, F.format_string("[%s]", number))
        .when(variant == 3, F.format_string('{"k": %s, "label": "%s"}', number, "event_type"))
        .when(variant == 4, F.format_string('{"k": %s, "label": 7}', number))
        .otherwise(F.col("props"))
    )
    schema = T.StructType.fromDDL("k bigint, label string")
    rows = records.parse_json_rows(events.select("event_id", text.alias("line")), "line", schema)
    return rows.drop("line")


@query("""
    SELECT c_custkey, 'c_custkey=' || c_custkey || ' | segment=' ||
           coalesce(nullif(c_mktsegment, 'MACHINERY'), 'NULL') ||
           ' | name=[' || octet_length(encode(c_name)) || ' bytes] | debtor=' ||
           (c_acctbal < 0) AS line
    FROM customer
""")
def rec09_row_to_text(spark, folder):
    customer = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.col("c_name").cast("binary").alias("name"),
        (F.col("c_acctbal") < 0).alias("debtor"),
    )
    return customer.select("c_custkey", records.to_text_row(customer).alias("line"))


_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "bigint",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "string",
}


@query(
    " UNION ALL ".join(
        f"SELECT {at} AS position, '{name}' AS name, '{kind}' AS type, "
        f'count(*) AS "rows", count({name}) AS filled FROM lineitem'
        for at, (name, kind) in enumerate(_LINEITEM_TYPES.items())
    )
)
def rec10_describe(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    filled = records.fill_counts(lineitem)
    return records.describe(lineitem).join(filled, "name").select("position", "name", "type", "rows", "filled")


@query("SELECT event_type AS kind, count(*) AS n, 'events' AS source FROM events GROUP BY 1")
def rec11_source_tag(spark, folder):
    kinds = table(spark, folder, "events").groupBy(F.col("event_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return records.with_source(kinds, "events")


@query("""
    SELECT o_orderkey, row_no, (row_no - 1) // 256 AS batch_id
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no
          FROM orders)
""")
def rec12_pagination(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    pages = records.paginate(orders, ["o_orderdate", "o_orderkey"], 256, total=True)
    return pages.select("o_orderkey", "row_no", "batch_id")


@query("""
    SELECT o_orderkey, row_no
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no, count(*) OVER () AS n FROM orders)
    WHERE row_no <= 256 OR row_no > (n // 512) * 256 AND row_no <= (n // 512) * 256 + 256
""")
def rec12_pages(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    pages = write_pages(orders, ["o_orderdate", "o_orderkey"], scratch_path(spark, "pages"), total=True)
    middle = pages.rows // 512
    shown = pages.page(0) if middle == 0 else pages.page(0).union(pages.page(middle))
    return shown.select("o_orderkey", "row_no")


@query("""
    SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_mktsegment AS segment
    FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
""")
def set01_union_of_sources(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return records.union_sources({"customer": customer, "supplier": supplier})


# -- type normalisation ------------------------------------------------------------


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_returnflag,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM lineitem
""")
def typ00_six_types(spark, folder):
    wanted = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]
    return typing.to_six_types(table(spark, folder, "lineitem").select(*wanted))


_DECLARED = (
    "INTEGER", "BIGINT", "REAL", "FLOAT", "DOUBLE PRECISION", "BLOB",
    "BOOLEAN", "VARCHAR(20)", "int", "POINT", "NUMERIC(10,2)",
)


def _pick(values, key):
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def _pick_sql(values, key):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], CAST({key} % {len(values)} AS INTEGER) + 1)"


@query(f"""
    SELECT p_partkey, {_pick_sql(_DECLARED, 'p_partkey')} AS declared,
           {_pick_sql(('bigint', 'bigint', 'double', 'double', 'double', 'binary', 'boolean',
                       'string', 'string', 'bigint', 'string'), 'p_partkey')} AS mapped
    FROM part
""")
def typ01_sqlite_affinity(spark, folder):
    part = table(spark, folder, "part")
    declared = _pick(_DECLARED, F.col("p_partkey"))
    return part.select(
        "p_partkey", declared.alias("declared"), typing.sqlite_type(declared).alias("mapped")
    )


@query("""
    SELECT o_orderkey AS id, o_totalprice AS price, CAST(round(o_totalprice) AS BIGINT) AS whole,
           o_orderstatus AS code, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed,
           CAST(NULL AS VARCHAR) AS body, 'binary' AS body_type
    FROM orders
""")
def typ02_oracle_map(spark, folder):
    # the frame a JDBC read of an Oracle table gives: NUMBERs are decimals
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("decimal(10,0)").alias("id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.round("o_totalprice").cast("decimal(12,0)").alias("whole"),
        F.rpad("o_orderstatus", 10, " ").alias("code"),
        F.col("o_orderdate").alias("placed"),
        F.col("o_orderpriority").alias("body"),
    )
    rows = typing.from_oracle_frame(orders, large_objects=("body",))
    return rows.withColumn("body_type", F.typeof("body")).withColumn("body", F.hex("body"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
                       THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS placed,
           CASE WHEN o_orderstatus = 'P' THEN '0000-00-00 00:00:00'
                ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03' END AS stored,
           o_orderpriority AS code
    FROM orders
""")
def typ03_oracle_date_text(spark, folder):
    placed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    byte = lambda value: F.lpad(F.hex(value), 2, "0")
    year = F.year("o_orderdate")
    century = F.when(F.col("o_orderstatus") == "P", 0).otherwise((year / 100).cast("int") + 100)
    stored = F.concat(
        byte(century), byte(year % 100 + 100), byte(F.month("o_orderdate")),
        byte(F.day("o_orderdate")), *[byte(F.lit(n)) for n in (2, 3, 4)],
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        typing.oracle_date(placed).alias("placed"),
        typing.oracle_stored_date(F.unhex(stored)).alias("stored"),
        F.rtrim(F.rpad("o_orderpriority", 20, " ")).alias("code"),
    )


_CASSANDRA = (
    "tinyint", "counter", "float", "decimal", "boolean", "blob", "text", "uuid", "bigint",
)


@query(f"""
    SELECT p_partkey, {_pick_sql(_CASSANDRA, 'p_partkey')} AS declared,
           {_pick_sql(('bigint', 'bigint', 'double', 'double', 'boolean', 'binary', 'string',
                       'string', 'bigint'), 'p_partkey')} AS mapped
    FROM part
""")
def typ04_cassandra_map(spark, folder):
    part = table(spark, folder, "part")
    declared = _pick(_CASSANDRA, F.col("p_partkey"))
    return part.select(
        "p_partkey", declared.alias("declared"), typing.cassandra_type(declared).alias("mapped")
    )


@query("""
    SELECT vec_id, CAST(NULL AS VARCHAR) AS embedding, CAST(label AS BIGINT) AS label
    FROM embeddings
""")
def typ05_avro_map(spark, folder):
    return typing.from_avro_frame(table(spark, folder, "embeddings"))


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND length(o_orderpriority) >= 6 AND o_totalprice > 250000.5
""")
def typ06_bind_values(spark, folder):
    return dml.sql(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} "
        "WHERE o_orderstatus = ? AND length(o_orderpriority) >= ? AND o_totalprice > ?",
        ["F", 6, 250000.5],
        orders=table(spark, folder, "orders"),
    )


# -- predicates ------------------------------------------------------------------


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE abs(l_quantity - 17) < 1e-12 OR l_quantity >= 49.5 OR l_quantity < 2
""")
def prd01_numeric_comparison(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    kept = predicates.where(lineitem, "l_quantity == 17 or l_quantity >= 49.5 or l_quantity < 2")
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query("""
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment > 'HOUSEHOLD' AND c_mktsegment <> 'MACHINERY')
""")
def prd02_string_comparison(spark, folder):
    text = """c_mktsegment == 'BUILDING'
              or c_mktsegment > "HOUSEHOLD" and c_mktsegment != 'MACHINERY'"""
    return predicates.where(table(spark, folder, "customer"), text).select(
        "c_custkey", "c_mktsegment"
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
    WHERE NOT (l_returnflag = 'N') AND (l_linestatus = 'O' OR l_linenumber <= 2)
       OR NOT l_quantity > 1
""")
def prd03_boolean_logic(spark, folder):
    text = (
        "not l_returnflag == 'N' and (l_linestatus == 'O' or l_linenumber <= 2) "
        "or not not not l_quantity > 1"
    )
    return predicates.where(table(spark, folder, "lineitem"), text).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )


@query("""
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > -500.25 AND c_name <> 'a "b" c'
       AND c_acctbal < 100
""")
def prd04_literals(spark, folder):
    text = """c_acctbal>-500.25 and c_name!='a "b" c'and c_acctbal<100"""
    return predicates.where(table(spark, folder, "customer"), text).select(
        "c_custkey", "c_acctbal"
    )


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey = 7 OR c_nationkey > 20.5")
def prd05_field_binding(spark, folder):
    customer = table(spark, folder, "customer")
    return predicates.where(customer, "c_nationkey == 7 or c_nationkey > 20.5").select(
        "c_custkey", "c_nationkey"
    )


@query("""
    SELECT event_id, user_id, value FROM events WHERE value > 100 AND NOT event_type = 'error'
""")
def prd06_compiled_predicate(spark, folder):
    events = table(spark, folder, "events")
    return predicates.where(events, "value > 100 and not event_type == 'error'").select(
        "event_id", "user_id", "value"
    )


@query("""
    SELECT event_id, 'big' AS rule FROM events WHERE value > 200
    UNION ALL SELECT event_id, 'sale' FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT event_id, 'vip' FROM events WHERE event_type = 'view' AND value >= 50
""")
def prd07_rule_set(spark, folder):
    rules = {
        "big": "value > 200",
        "sale": "event_type == 'purchase'",
        "vip": "event_type == 'view' and value >= 50",
    }
    return predicates.match_rules(table(spark, folder, "events"), rules).select("event_id", "rule")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice < 5000 OR o_orderpriority = '1-URGENT'")
def prd08_bound_parameters(spark, folder):
    return dml.sql(
        spark,
        "SELECT o_orderkey FROM {orders} "
        "WHERE o_totalprice < :most OR o_orderpriority = :priority",
        {"most": 5000, "priority": "1-URGENT"},
        orders=table(spark, folder, "orders"),
    )


@query(r"""
    SELECT o_orderkey,
           CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS placeholders,
           CASE o_orderkey % 4
             WHEN 0 THEN 'SELECT * FROM orders WHERE k = ? AND c = ?'
             WHEN 1 THEN 'SELECT '':' || o_orderpriority || ' it''''s :x'' WHERE k=?'
             WHEN 2 THEN 'SELECT k:?, a:b FROM t'
             ELSE 'SELECT '':only''' END AS positional
    FROM orders
""")
def prd09_placeholders(spark, folder):
    variant = F.col("o_orderkey") % 4
    text = (
        F.when(variant == 0, F.lit("SELECT * FROM orders WHERE k = :key AND c = :cust_1"))
        .when(
            variant == 1,
            F.concat(F.lit("SELECT ':"), "o_orderpriority", F.lit(" it''s :x' WHERE k=:k")),
        )
        .when(variant == 2, F.lit("SELECT k::int, a:b FROM t"))
        .otherwise(F.lit("SELECT ':only'"))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dml.count_placeholders(text).alias("placeholders"),
        dml.positional_placeholders(text).alias("positional"),
    )


# -- names and lines ---------------------------------------------------------------


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE regexp_full_match(p_name, 'red .*') OR regexp_full_match(p_name, '.*(ring|rod)')
""")
def src02_name_filter(spark, folder):
    names = NameFilter("red .*", ".*(ring|rod)", "", "(unclosed", "ring")
    part = table(spark, folder, "part")
    return part.filter(names.matches(F.col("p_name"))).select("p_partkey", "p_name")


@query(r"""
    SELECT doc_id, line_no, line FROM (
      SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no
      FROM (SELECT doc_id, string_split_regex(text, '[\r\n]') AS lines FROM documents))
    WHERE length(line) > 20
""")
def src04_line_framing(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    lines = frame_lines(documents, "text", longer_than=20)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


# -- SQL, sort, limit and row changes ------------------------------------------------


@query("""
    SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'O' GROUP BY n_name
""")
def sql01_parameterised(spark, folder):
    text = """
        SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey
        WHERE o_orderstatus = :status GROUP BY n_name
    """
    names = ("orders", "customer", "nation")
    return dml.sql(
        spark, text, {"status": "O"}, **{n: table(spark, folder, n) for n in names}
    )


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def srt01_order_by(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return part.orderBy(F.desc("p_retailprice"), "p_partkey")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""")
def srt02_limit(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""
    SELECT c_custkey, c_name, c_nationkey FROM customer
    UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey FROM supplier
""")
def dml01_insert(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    added = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
    )
    return dml.insert_rows(customer, added)


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
""")
def dml02_update(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    # both assignments see the old row
    changes = {"c_acctbal": F.lit(0.0), "c_mktsegment": F.lit("DEBTOR")}
    return dml.update_rows(customer, changes, F.col("c_acctbal") < 0)


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false)
""")
def dml03_delete(spark, folder):
    orders = table(spark, folder, "orders")
    known = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return dml.delete_rows(orders, known == "F").select("o_orderkey", "o_custkey")
