"""Queries: listing, digests, bulk copy, compression and snapshots."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from conduit.operators import dml
from conduit.plans.registry import query, table
from conduit.session import cut_lineage, scratch_path
from conduit.sources import objects
from conduit.sources.snapshots import SnapshotTable


def _tables(spark, folder):
    """Listing of the table files, be each a file or a folder of parts."""
    names = objects.NameFilter(r".*\.parquet(/.*)?")
    return objects.list_objects(spark, folder, names)


# Objects made of table rows: one per supplier, some of them empty, in folders by nation.
_NAME_SQL = "'n' || s_nationkey || '/' || s_suppkey || '.txt'"
_BODY_SQL = "repeat(s_name || chr(10), CAST(s_suppkey % 40 AS INTEGER))"
_RANGE = 100  # bytes, so that small objects have several ranges


def _supplier_objects(spark, folder):
    """The suppliers stored as objects, and listed again."""
    rows = table(spark, folder, "supplier").select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.lit(".txt")).alias("name"),
        F.expr("repeat(concat(s_name, chr(10)), cast(s_suppkey % 40 as int))").cast("binary").alias("content"),
    )
    path = scratch_path(spark, "suppliers")
    objects.write_objects(rows, path)
    return objects.list_objects(spark, path)


@query(f"""
    SELECT {_NAME_SQL} AS name, strlen({_BODY_SQL}) AS size, 'FILE' AS flag, 'FILE' AS protocol
    FROM supplier
""")
def src01_object_listing(spark, folder):
    return _supplier_objects(spark, folder).select("name", "size", "flag", "protocol")


@query()
def src01_table_files(spark, folder):
    return _tables(spark, folder).select("name", "size", "flag", "protocol")


@query(f"SELECT {_NAME_SQL} AS name, strlen({_BODY_SQL}) AS bytes, md5({_BODY_SQL}) AS md5 FROM supplier")
def src03_object_content(spark, folder):
    return objects.plain_digests(_supplier_objects(spark, folder)).select("name", "bytes", "md5")


@query(f"SELECT count(*) AS objects, CAST(sum(strlen({_BODY_SQL})) AS BIGINT) AS bytes FROM supplier")
def agg11_listing_totals(spark, folder):
    return objects.listing_totals(_supplier_objects(spark, folder))


def _arrived(copied, name="name"):
    """What a copy left at its destination, read back, beside the digest of what was sent."""
    listing = copied.select(F.col("dest").alias("path"), F.expr(name).alias("name"), F.col("bytes").alias("size"))
    sent = copied.select(F.expr(name).alias("name"), F.col("ranges_md5").alias("sent"))
    read = objects.digest_objects(listing, _RANGE).select("name", F.col("ranges_md5").alias("read"))
    plain = objects.plain_digests(listing)
    return plain.join(read, "name").join(sent, "name").select(
        "name", "bytes", "md5", (F.col("sent") == F.col("read")).alias("same")
    )


_SENT_SQL = f"""
    SELECT {_NAME_SQL} AS name, strlen({_BODY_SQL}) AS bytes, md5({_BODY_SQL}) AS md5, true AS same
    FROM supplier
"""


@query(_SENT_SQL)
def snk01_bulk_copy(spark, folder):
    source = _supplier_objects(spark, folder)
    return _arrived(objects.copy_objects(source, scratch_path(spark, "copies"), range_bytes=_RANGE))


@query()
def snk01_table_copy(spark, folder):
    source = _tables(spark, folder)
    return _arrived(objects.copy_objects(source, scratch_path(spark, "copies"), range_bytes=_RANGE * 4096)).select("name", "bytes", "md5")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def snk01_dataset_copy(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    path = scratch_path(spark, "orders-json")
    orders.write.json(path)
    return spark.read.schema(orders.schema).json(path)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def snk02_compressed_text(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "orders-csv")
    orders.write.option("compression", "bzip2").csv(path)
    return spark.read.schema(orders.schema).csv(path)


@query(_SENT_SQL)
def snk02_compressed_objects(spark, folder):
    source = _supplier_objects(spark, folder)
    packed = objects.copy_objects(source, scratch_path(spark, "packed"), "compress", _RANGE)
    listing = packed.select(
        F.col("dest").alias("path"),
        F.concat("name", F.lit(".bz2")).alias("name"),
        F.col("bytes").alias("size"),
    )
    opened = objects.copy_objects(listing, scratch_path(spark, "opened"), "decompress", _RANGE)
    return _arrived(opened, "regexp_replace(name, '[.]bz2$', '')")


@query("SELECT count(*) AS accepted, 0 AS stored FROM lineitem")
def snk03_null_sink(spark, folder):
    seen = Observation("accepted")
    lineitem = table(spark, folder, "lineitem").observe(seen, F.count(F.lit(1)).alias("n"))
    stored = objects.discard(lineitem)
    return spark.range(1).select(
        F.lit(seen.get["n"]).cast("bigint").alias("accepted"), F.lit(stored).alias("stored")
    )


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def snk04_staged_publish(spark, folder):
    path = scratch_path(spark, "published")
    objects.publish_dataset(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), path
    )
    return spark.read.parquet(path)


@query("""
    SELECT s_suppkey, CASE WHEN s_acctbal < 1000 THEN 'blocked' ELSE s_name END AS s_name
    FROM supplier WHERE s_nationkey <> 3
    UNION ALL SELECT c_custkey + 1000000000, c_name FROM customer
""")
def snk06_transaction(spark, folder):
    supplier = table(spark, folder, "supplier")
    store = SnapshotTable(spark, scratch_path(spark, "supplier"))
    store.commit(supplier)
    added = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1000000000).alias("s_suppkey"), F.col("c_name").alias("s_name")
    )
    store.transaction(
        lambda df: dml.delete_rows(df, F.col("s_nationkey") == 3),
        lambda df: dml.update_rows(df, {"s_name": F.lit("blocked")}, F.col("s_acctbal") < 1000),
        lambda df: dml.insert_rows(df, added),
    )
    return store.read().select("s_suppkey", "s_name")


@query("""
    SELECT s_suppkey, CASE WHEN s_acctbal < 1000 THEN 'blocked' ELSE s_name END AS s_name
    FROM supplier WHERE s_nationkey <> 3
    UNION ALL SELECT c_custkey + 1000000000, c_name FROM customer
""")
def snk06_change_set(spark, folder):
    supplier = table(spark, folder, "supplier")
    store = SnapshotTable(spark, scratch_path(spark, "supplier"))
    store.commit(supplier)
    added = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1000000000).alias("s_suppkey"), F.col("c_name").alias("s_name")
    )
    mine, other = store.begin(), store.begin()
    other.insert(added).commit()  # comes first, and changes no row of ours
    mine.delete(F.col("s_nationkey") == 3)
    mine.update({"s_name": F.lit("blocked")}, F.col("s_acctbal") < 1000).commit()
    return store.read().select("s_suppkey", "s_name")


@query("SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand")
def dml04_create_and_drop_table(spark, folder):
    path = scratch_path(spark, "parts")
    name = "conduit_" + path.rsplit("-", 1)[1]
    dml.create_table(table(spark, folder, "part").select("p_partkey", "p_brand"), name, path)
    counts = cut_lineage(
        spark.table(name).groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts")), "brands"
    )
    dml.drop_table(spark, name)
    return counts
