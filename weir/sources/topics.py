"""Message topics as DataFrames of ``(seq, value STRING)``.

``seq`` is the arrival order and is unique. A file topic stores both columns, ``seq`` as BIGINT. For Kafka it
is time, then partition, then offset in one DECIMAL(38,0), which Spark can aggregate by hash, so messages of one
key are in order whatever partitions they went to, as far as their times are. Null messages (tombstones) are dropped. No watermark is set: nothing
downstream uses event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_SCHEMA = "seq BIGINT, value STRING"

SEQ = "DECIMAL(38,0)"

# Header that names a message; see ``weir.sinks.topics``.
ID_HEADER = "weir-id"

# What a task takes of stored messages when all of them meet by id, in bytes as stored.
_ONCE_BYTES = 32 << 20

# Digits of an offset and of a partition inside ``seq``.
_OFFSET, _PARTITION = 19, 5


def messages(df: DataFrame, *more: str) -> DataFrame:
    """Keep ``(seq, value)`` and drop tombstones."""
    return df.select("seq", "value", *more).where("value IS NOT NULL")


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return messages(spark.read.format(fmt).schema(TOPIC_SCHEMA).load(path))


def stream_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(TOPIC_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return messages(reader.load(path))


def from_kafka(df: DataFrame, *more: str) -> DataFrame:
    """The Kafka source's columns to ``(seq, value)``, and ``more`` of its columns."""
    ms = F.greatest(F.unix_millis("timestamp"), F.lit(0)).cast("string")
    partition = F.when(F.col("partition") < 10**_PARTITION, F.lpad(F.col("partition").cast("string"), _PARTITION, "0")).otherwise(
        F.raise_error(F.lit("a topic may have 100,000 partitions"))
    )
    seq = F.concat(ms, partition, F.lpad(F.col("offset").cast("string"), _OFFSET, "0")).cast(SEQ)
    return messages(df.select(seq.alias("seq"), F.col("value").cast("string").alias("value"), *more), *more)


def from_kafka_once(df: DataFrame, within: str = "1 hour") -> DataFrame:
    """``(id, topic, seq, value)``: the Kafka source's columns with headers, a message that was sent again left out.

    Messages without an id are all kept. A stream remembers ids for as long as ``within``, counted from the newest message
    seen, so what it keeps does not grow with its age: set it longer than a batch is ever repeated after. Read with
    ``includeHeaders=true``.
    """
    own = F.filter("headers", lambda h: h["key"] == ID_HEADER)
    place = F.concat_ws("/", F.lit(""), "topic", "partition", "offset")
    named = df.withColumn("id", F.coalesce(F.get(own, 0)["value"].cast("string"), place))
    if df.isStreaming:
        once = named.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["id"])
    else:
        once = _met_by_id(named).dropDuplicates(["id"])
    seen = from_kafka(once, "id", "topic")
    return seen.select("id", "topic", "seq", "value")


def _met_by_id(named: DataFrame) -> DataFrame:
    """Messages dealt out by id into partitions whose number grows with their size, where Spark knows it.

    Left to itself Spark sorts messages twice to find repeats, once before its shuffle, in partitions as large as they come.
    """
    size = int(str(named._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= _ONCE_BYTES or size >= named.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes():
        return named
    return named.repartition(max(-(-size // _ONCE_BYTES), int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "id")


def kafka_options(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The whole topic as it is now, e.g. a compacted topic of routing changes."""
    reader = spark.read.format("kafka").options(**kafka_options(servers, topic))
    return from_kafka(reader.options(**options).load())


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded read; ``max_offsets_per_trigger`` bounds one micro-batch."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, group))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return from_kafka(reader.options(**options).load())
