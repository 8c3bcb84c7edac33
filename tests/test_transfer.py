"""Listing, digests, copy, compression, sinks, snapshots and JDBC options."""

import bz2
import hashlib
import os
import random

import duckdb
import harness
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conduit.operators import dml
from conduit.plans import catalogue
from conduit.sources import bzip, objects, relational
from conduit.sources.snapshots import CommitConflict, SnapshotTable


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "source"
    (root / "sub").mkdir(parents=True)
    files = {
        "big.bin": os.urandom(1_000_003),
        "empty.txt": b"",
        "sub/nul.bin": b"\0\1\0" * 100,
        "sub/odd name [1].csv": b"a,b\n",
    }
    for name, body in files.items():
        (root / name).write_bytes(body)
    return root, files


def test_listing(spark, tree):
    root, files = tree
    listing = objects.list_objects(spark, str(root))
    got = {r.name: r.size for r in listing.collect()}
    assert got == {name: len(body) for name, body in files.items()}
    assert listing.select("flag", "protocol").distinct().collect() == [("FILE", "FILE")]
    assert objects.listing_totals(listing).first() == (4, sum(map(len, files.values())))
    os.symlink(root / "big.bin", root / "link")
    flat = objects.list_objects(spark, str(root), recursive=False)
    assert {r.name: r.flag for r in flat.collect()} == {
        "big.bin": "FILE", "empty.txt": "FILE", "sub": "DIR", "link": "LINK",
    }
    contents = {bytes(r.content) for r in objects.read_objects(spark, str(root / "sub")).collect()}
    assert contents == {files["sub/nul.bin"], files["sub/odd name [1].csv"]}


def test_name_filter(spark, tree):
    names = objects.NameFilter()
    assert names.add("") and names.add(r"sub/.*\.bin") and not names.add("(")
    assert names.patterns == [r"sub/.*\.bin"]
    found = objects.list_objects(spark, str(tree[0]), names)
    assert [r.name for r in found.collect()] == ["sub/nul.bin"]
    whole = objects.list_objects(spark, str(tree[0]), objects.NameFilter("big", "empty.txt"))
    assert [r.name for r in whole.collect()] == ["empty.txt"]


def digest_of(body, size):
    parts = [body[i : i + size] for i in range(0, len(body), size)] or [b""]
    sums = [hashlib.md5(p).digest() for p in parts]
    return f"{hashlib.md5(b''.join(sums)).hexdigest()}-{len(sums)}"


@pytest.mark.parametrize("size", [100_000, objects.RANGE_BYTES])
def test_digests(spark, tree, size):
    root, files = tree
    got = objects.digest_objects(objects.list_objects(spark, str(root)), size)
    assert {r.name: (r.bytes, r.ranges_md5) for r in got.collect()} == {
        name: (len(body), digest_of(body, size)) for name, body in files.items()
    }


@pytest.mark.parametrize("size", [65_536, objects.RANGE_BYTES])
def test_copy_is_exact(spark, tree, tmp_path, size):
    root, files = tree
    dest = tmp_path / "copy"
    rows = objects.copy_objects(objects.list_objects(spark, str(root)), str(dest), range_bytes=size)
    assert {r.name: r.bytes for r in rows.collect()} == {n: len(b) for n, b in files.items()}
    for name, body in files.items():
        assert (dest / name).read_bytes() == body
    assert not [n for n in os.listdir(dest) if n.startswith(".staging")]


@pytest.mark.parametrize("size", [65_536, objects.RANGE_BYTES])
def test_bzip2_both_ways(spark, tree, tmp_path, size):
    root, files = tree
    packed, opened = tmp_path / "packed", tmp_path / "opened"
    objects.copy_objects(objects.list_objects(spark, str(root)), str(packed), "compress", size)
    for name, body in files.items():
        assert bz2.decompress((packed / f"{name}.bz2").read_bytes()) == body
    objects.copy_objects(objects.list_objects(spark, str(packed)), str(opened), "decompress")
    for name, body in files.items():
        assert (opened / name).read_bytes() == body


@pytest.mark.parametrize("codec", [None, "compress"])
def test_copy_to_an_object_store(spark, tree, tmp_path, monkeypatch, codec):
    """A store without writes at an offset, played by a folder."""
    root, files = tree
    base = str(tmp_path / "store")

    def store_of(path):
        import os

        from pyarrow import fs

        inner = base + "/" + path.partition("://")[2]
        os.makedirs(os.path.dirname(inner), exist_ok=True)
        return fs.LocalFileSystem(), inner

    class NoStaging:
        def delete(self, path, recursive):
            pass

    real = objects.hadoop_path
    monkeypatch.setattr(objects, "_store_of", store_of)
    monkeypatch.setattr(
        objects,
        "hadoop_path",
        lambda spark, path: (NoStaging(), path) if path.startswith("play:") else real(spark, path),
    )
    listing = objects.list_objects(spark, str(root))
    rows = objects.copy_objects(listing, "play://bucket/x", codec, range_bytes=1000).collect()
    assert {r.name for r in rows} == set(files)
    for name, body in files.items():
        stored = f"{base}/bucket/x/{name}" + (".bz2" if codec else "")
        with open(stored, "rb") as handle:
            data = handle.read()
        assert (bz2.decompress(data) if codec else data) == body


def test_all_forms_have_the_digest_of_the_plain_bytes(spark, tree, tmp_path):
    root, files = tree
    listing, size = objects.list_objects(spark, str(root)), 70_000
    want = {name: digest_of(body, size) for name, body in files.items()}
    packed = objects.copy_objects(listing, str(tmp_path / "p"), "compress", size)
    opened = objects.copy_objects(objects.list_objects(spark, str(tmp_path / "p")), str(tmp_path / "o"), "decompress", size)
    copied = objects.copy_objects(listing, str(tmp_path / "c"), range_bytes=size)
    for got in (objects.digest_objects(listing, size), packed, copied):
        assert {r.name: r.ranges_md5 for r in got.collect()} == want
    assert {r.name.removesuffix(".bz2"): r.ranges_md5 for r in opened.collect()} == want
    plain = {r.name: r.md5 for r in objects.plain_digests(listing).collect()}
    assert plain == {name: hashlib.md5(body).hexdigest() for name, body in files.items()}


def test_rows_become_objects(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", b"one"), ("b.txt", b"")], "name string, content binary")
    objects.write_objects(rows, str(tmp_path / "made"))
    got = objects.list_objects(spark, str(tmp_path / "made"))
    assert {r.name: r.size for r in got.collect()} == {"a/x.txt": 3, "b.txt": 0}


def test_copy_onto_itself_is_refused(spark, tree):
    listing = objects.list_objects(spark, str(tree[0]))
    with pytest.raises(objects.TransferError):
        objects.copy_objects(listing, str(tree[0]))
    with pytest.raises(ValueError):
        objects.copy_objects(listing, "/nowhere", "zip")


# On a cluster, a mount in the checkpoint folder needs no word that executors share it.
IN_THE_SHARED_FOLDER = [
    "agg11_listing_totals",
    "snk01_bulk_copy",
    "snk01_table_copy",
    "snk02_compressed_objects",
    "src01_object_listing",
    "src03_object_content",
]


@pytest.mark.parametrize("name", IN_THE_SHARED_FOLDER)
def test_objects_in_the_shared_folder_of_a_cluster(spark, tmp_path, monkeypatch, name):
    tables = str(tmp_path / "tables")
    rows = [(k, f"Supplier {k}", k % 3) for k in (1, 2, 40, 79)]
    suppliers = spark.createDataFrame(rows, "s_suppkey bigint, s_name string, s_nationkey int").coalesce(1)
    suppliers.write.parquet(f"{tables}/supplier.parquet")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster:7077")
    got = catalogue.QUERIES[name](spark, tables)
    if name in catalogue.ORACLES:
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tables}/supplier.parquet/*.parquet'")
        assert harness.differences(got, duck, catalogue.ORACLES[name]) is None
    else:
        listing = objects.list_objects(spark, tables, objects.NameFilter(r".*\.parquet(/.*)?"))
        assert sorted(got.collect()) == sorted(objects.plain_digests(listing).select(got.columns).collect())


def test_other_mounts_of_a_cluster_are_refused(spark, tree, tmp_path, monkeypatch):
    listing, shared = objects.list_objects(spark, str(tree[0])), spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster:7077")
    for dest in (str(tmp_path / "x"), f"{shared}-other/x", f"{shared}/../x"):
        with pytest.raises(objects.TransferError, match="shared=True"):
            objects.copy_objects(listing, dest)
    assert objects.copy_objects(listing, str(tmp_path / "x"), shared=True).count() == len(tree[1])


def test_short_source_fails_and_publishes_nothing(spark, tree, tmp_path):
    listing = objects.list_objects(spark, str(tree[0])).withColumn("size", F.col("size") + 5)
    dest = tmp_path / "short"
    with pytest.raises(Exception, match="ended 5 bytes early"):
        objects.copy_objects(listing, str(dest))
    assert [n for n in os.listdir(dest) if not n.startswith(".")] == []


def test_null_sink(spark):
    assert objects.discard(spark.range(1000)) == 0


def test_publish_is_all_or_nothing(spark, tmp_path):
    dest = str(tmp_path / "table")
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("string"))
    with pytest.raises(Exception):
        objects.publish_dataset(broken, dest)
    assert not os.path.exists(dest)
    objects.publish_dataset(spark.range(10), dest)
    assert spark.read.parquet(dest).count() == 10
    with pytest.raises(objects.TransferError):
        objects.publish_dataset(spark.range(3), dest)


def archives():
    """Plain and packed bytes: one stream of many blocks, many streams, none, and what may follow the last."""
    draw = random.Random(3)
    body = draw.randbytes(700_000) + b"abc" * 300_000 + b"hello world\n" * 60_000
    streams = [b"a" * 10, b"", b"b" * 1_000_000, body[:300_000], b""]
    return {
        "one-1": (body, bz2.compress(body, 1)),
        "one-9": (body, bz2.compress(body, 9)),
        "many": (b"".join(streams), b"".join(map(bz2.compress, streams))),
        "empty": (b"", bz2.compress(b"")),
        "tail": (body, bz2.compress(body, 2) + b"what follows is no stream"),
    }


@pytest.mark.parametrize("size", [5_000, 200_000, 10**8])
def test_blocks_of_any_archive_are_found(size):
    for name, (plain, packed) in archives().items():
        out, parts = [], []
        for offset in range(0, len(packed), size):
            for piece in bzip.unpacked(lambda o, n: packed[o : o + n], len(packed), offset, min(size, len(packed) - offset)):  # noqa: B023
                (parts if isinstance(piece, bzip.Part) else out).append(piece)
        assert b"".join(out) == plain, name
        assert [p.following for p in parts] == [p.first for p in parts[1:]] + [-1] * bool(parts), name
        assert sum(p.length for p in parts) == len(plain)


def test_one_archive_is_unpacked_by_many_tasks(spark, tmp_path):
    """As many tasks as ranges, and the digest of the plain object whatever the archive."""
    (tmp_path / "plain").mkdir()
    (tmp_path / "packed").mkdir()
    for name, (plain, packed) in archives().items():
        (tmp_path / "plain" / name).write_bytes(plain)
        (tmp_path / "packed" / f"{name}.bz2").write_bytes(packed)
    listing = objects.list_objects(spark, str(tmp_path / "packed"))
    size = 150_000
    want = {r.name: (r.bytes, r.ranges_md5) for r in objects.digest_objects(objects.list_objects(spark, str(tmp_path / "plain")), size).collect()}
    done = objects.copy_objects(listing, str(tmp_path / "opened"), "decompress", size)
    assert {r.name.removesuffix(".bz2"): (r.bytes, r.ranges_md5) for r in done.collect()} == want
    for name, (plain, _) in archives().items():
        assert (tmp_path / "opened" / name).read_bytes() == plain
    assert objects.byte_ranges(listing.where("name = 'one-9.bz2'"), size).count() > 4


def test_damaged_archives_are_refused(spark, tmp_path):
    plain, packed = archives()["one-1"]
    broken = bytearray(packed)
    broken[len(packed) // 2] ^= 1
    for k, data in enumerate((bytes(broken), packed[:-200_000], b"no archive at all")):
        root = tmp_path / f"in{k}"
        root.mkdir()
        (root / "x.bz2").write_bytes(data)
        with pytest.raises(Exception, match="damaged|ended|not a bzip2"):
            objects.copy_objects(objects.list_objects(spark, str(root)), str(tmp_path / f"out{k}"), "decompress", 100_000).collect()
        assert not (tmp_path / f"out{k}" / "x").exists()


def test_snapshots(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    assert store.version() == 0
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.commit(spark.range(10)) == 1
    before = store.read()
    assert store.transaction(
        lambda df: dml.delete_rows(df, F.col("id") < 5),
        lambda df: df.select(F.col("id") * 2),
    ) == 2
    assert sorted(r[0] for r in store.read().collect()) == [10, 12, 14, 16, 18]
    assert before.count() == 10 and store.read(1).count() == 10

    def fail(df):
        return df.select(F.raise_error(F.lit("no")).cast("bigint"))

    with pytest.raises(Exception):
        store.transaction(lambda df: df.limit(1), fail)
    assert store.version() == 2 and store.read().count() == 5
    with pytest.raises(CommitConflict):
        store.commit(spark.range(1), base=1)


def written(path):
    """Rows in every data folder of a snapshot table."""
    return {d.name: pq.read_table(d).num_rows for kind in ("rows", "gone") for d in (path / kind).glob("*")}


def test_change_sets_write_only_what_they_change(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.commit(spark.range(100).withColumn("v", F.lit("a")))
    before = written(tmp_path / "t")
    store.begin().insert(spark.range(500, 501)).commit()
    after = written(tmp_path / "t")
    assert [after[n] for n in after if n not in before] == [1]
    store.begin().update({"v": F.lit("b")}, F.col("id") == 7).delete(F.col("id") > 400).delete(F.col("v") == "zz").commit()
    assert sorted(n for name, n in written(tmp_path / "t").items() if name not in after) == [0, 1, 1, 1]
    held = {r.id: r.v for r in store.read().collect()}
    assert held == {i: "b" if i == 7 else "a" for i in range(100)}
    assert store.read(2).count() == 101 and store.read(1).count() == 100
    assert store.compact() == 4 and {r.id: r.v for r in store.read().collect()} == held
    assert store.read().columns == ["id", "v"]
    with pytest.raises(ValueError):
        store.begin().insert(spark.range(1).withColumnRenamed("id", "other"))


def test_change_sets_of_different_folders_both_succeed(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.commit(spark.range(10))
    store.begin().insert(spark.range(100, 110)).commit()
    one, two, three, late = (store.begin() for _ in range(4))
    one.delete(F.col("id") == 3)
    two.delete(F.col("id") == 103).insert(spark.range(1000, 1001))
    three.insert(spark.range(3, 4))  # a row like the one that goes; it stays
    late.update({"id": F.lit(-1)}, F.col("id") == 4)
    assert [one.commit(), two.commit(), three.commit()] == [3, 4, 5]
    with pytest.raises(CommitConflict):
        late.commit()  # its row lies in the folder that one changed
    want = sorted([*range(10), *range(100, 103), *range(104, 110), 1000])
    assert sorted(r.id for r in store.read().collect()) == want
    replaced = store.begin().delete(F.col("id") == 5)
    store.commit(spark.range(2))
    with pytest.raises(CommitConflict):
        replaced.commit()
    assert sorted(r.id for r in store.read().collect()) == [0, 1]


def test_a_failed_step_changes_nothing(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"))
    store.commit(spark.range(5))
    changes = store.begin().delete(F.col("id") == 1)
    with pytest.raises(Exception):
        changes.insert(spark.range(1).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")))
    assert store.version() == 1 and store.read().count() == 5
    assert sorted(r.id for r in changes.read().collect()) == [0, 2, 3, 4]


def test_tables_are_created_and_dropped(spark, tmp_path):
    dml.create_table(spark.range(3), "made_here", str(tmp_path / "made"))
    assert spark.table("made_here").count() == 3
    with pytest.raises(Exception):
        dml.create_table(spark.range(3), "made_here", str(tmp_path / "made"))
    dml.drop_table(spark, "made_here")
    dml.drop_table(spark, "made_here")
    assert not spark.catalog.tableExists("made_here")


def test_relational_options():
    end = relational.Endpoint("jdbc:x:y", user="u")
    assert relational.read_options(end, "t") == {
        "url": "jdbc:x:y", "user": "u", "fetchsize": "256", "dbtable": "t",
    }
    assert relational.read_options(end, "select 1")["query"] == "select 1"
    split = relational.Split("id", 0, 100, 8)
    options = relational.read_options(end, " SELECT a FROM t", split)
    assert options["dbtable"] == "( SELECT a FROM t) q"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    assert relational.write_options(end, "t", 500)["batchsize"] == "500"
