"""Write ``(seq, topic, position, value)`` rows: to Kafka, to files, to the console.

All streams of a fan-out go out in one write. Messages carry no key. A write is at least once: a batch that is repeated
sends its messages again, each with the id it had the first time in a header, and ``sources.topics.from_kafka_once`` drops
what it has seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.sources.topics import ID_HEADER


def message_id() -> Column:
    """What names a message whenever and however often it is made: its record, its topic, its place there."""
    return F.concat_ws("/", "seq", "topic", "position")


def kafka_messages(rows: DataFrame) -> DataFrame:
    """The columns the Kafka sink takes; the topic is set per row, the id is a header."""
    header = F.struct(F.lit(ID_HEADER).alias("key"), message_id().cast("binary").alias("value"))
    return rows.select("topic", "value", F.array(header).alias("headers"))


def to_kafka(rows: DataFrame, servers: str, **options: str) -> None:
    """Write a batch (or, in ``foreachBatch``, a micro-batch). At least once, with ids."""
    writer = kafka_messages(rows).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.options(**options).save()


def to_files(rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """One directory per topic. Every task writes its own files, so a busy topic needs no shuffle."""
    rows.write.mode(mode).format(fmt).partitionBy("topic").save(path)


def to_console(rows: DataFrame, prefix: str, limit: int = 20) -> StreamingQuery | None:
    """Show rows for debugging, each with ``prefix``; a stream keeps printing until stopped."""
    marked = rows.selectExpr(f"'{prefix}' AS prefix", "*")
    if rows.isStreaming:
        writer = marked.writeStream.format("console").outputMode("append")
        return writer.option("truncate", False).option("numRows", limit).start()
    marked.show(limit, truncate=False)
    return None
