"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every operator here is written against. None of them sizes
# anything to the machine: partition counts and memory stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key is split even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method above 8000 bytes of byte code; for such a
    # stage the operator-at-a-time code, cut into small methods, is faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # of a member that a JSON object has twice, the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # base64 on one line, so nothing has to take line ends out again
    "spark.sql.chunkBase64String.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which every executor can reach.

    Only a local session without one gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="conduit-")
    context.setCheckpointDir(folder)
    return folder


def in_shared_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path lies in the checkpoint folder that was set for this session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return False
    shared, asked = (
        handle.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
        for fs, handle in (hadoop_path(spark, folder), hadoop_path(spark, path))
    )
    return asked.startswith(f"{shared.rstrip('/')}/")


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/conduit/{application}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to cut lineage.

    Call it when no frame that came from here will be read again.
    """
    fs, root = hadoop_path(spark, scratch_root(spark))
    fs.delete(root, True)


def cut_lineage(df, label: str):
    """Write a frame to the shared folder and read it back.

    Written columns stay prunable, and a lost executor re-reads files
    instead of recomputing (and possibly re-ordering) its upstream stages.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, columns: dict[str, list], kinds: dict[str, str]):
    """A frame of driver-side configuration.

    Arrow input becomes a local relation, so Spark knows its size and decides by
    its own threshold whether to broadcast it.
    """
    import pyarrow as pa

    arrow = {"string": pa.string(), "bigint": pa.int64()}
    data = {n: pa.array(values, arrow[kinds[n]]) for n, values in columns.items()}
    return spark.createDataFrame(pa.table(data))


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` handles of Hadoop for driver-side metadata calls."""
    jvm = spark.sparkContext._jvm
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle
