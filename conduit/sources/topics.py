"""Streaming sources: brokers by format, and replay of stored topics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conduit.session import hadoop_path

# Fixed value: records per poll, unless a subscription says otherwise.
RECORDS_PER_POLL = 128


@dataclass(frozen=True)
class TopicSpec:
    """A subscription: topics of a broker, where to start, how fast to read."""

    servers: str
    topics: tuple[str, ...]
    starting: str = "latest"
    max_records: int | None = RECORDS_PER_POLL
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting,
        }
        if self.max_records:
            chosen["maxOffsetsPerTrigger"] = str(self.max_records)
        return chosen | self.options


def subscribe(spark: SparkSession, spec: TopicSpec, source_format: str = "kafka") -> DataFrame:
    """Raw records of a broker; its connector jar must be on the class path."""
    return spark.readStream.format(source_format).options(**spec.reader_options()).load()


def present_topics(wanted: Sequence[str], existing: Iterable[str]) -> tuple[str, ...]:
    """The wanted topics that exist; missing ones are skipped, but not all of them."""
    known = set(existing)
    found = tuple(topic for topic in wanted if topic in known)
    if not found:
        raise LookupError(f"no such topic: {', '.join(wanted)}")
    return found


# Bytes before an Avro value that name its schema: a zero and a number of four bytes.
AVRO_HEADER = 5


def decode_avro(records: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Typed rows of Avro records, by Spark's own Avro module, which must be on the class path."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substr(F.col(value), F.lit(AVRO_HEADER + 1))
    row = from_avro(body, schema, {"mode": "PERMISSIVE"})
    return records.select(row.alias("_row")).filter(F.col("_row").isNotNull()).select("_row.*")


def decode_json(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed rows of JSON records; a record that does not decode is skipped."""
    corrupt = "_corrupt"
    parsed = F.from_json(
        F.col(value).cast("string"),
        T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]),
        {"columnNameOfCorruptRecord": corrupt},
    )
    rows = records.withColumn("_row", parsed)
    good = F.col("_row").isNotNull() & F.col(f"_row.{corrupt}").isNull()
    return rows.filter(good).select(*[f"_row.`{name}`" for name in schema.names])


def replay(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stored topic as a stream: a folder of parquet files, or one file."""
    fs, handle = hadoop_path(spark, path)
    stream = spark.readStream.schema(schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    if fs.getFileStatus(handle).isDirectory():
        return stream.parquet(path)
    folder, _, name = path.rpartition("/")
    return stream.option("pathGlobFilter", name).parquet(folder)


def shard_envelope(data: Column, sequence: Column, partition_key: Column, ts: Column):
    """``data, sequence_number, partition_key, timestamp``; empty data is NULL."""
    payload = data.cast("binary")
    return [
        F.when(F.octet_length(payload) > 0, payload).alias("data"),
        sequence.cast("string").alias("sequence_number"),
        partition_key.cast("string").alias("partition_key"),
        F.unix_millis(ts.cast("timestamp")).alias("timestamp"),
    ]
