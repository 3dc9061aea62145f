"""The log flow as a Structured Streaming job.

State is a table of first visits, one row per device, kept forever, in buckets of a hash of the device. Each micro-batch
looks up its own first visits in the buckets that it touches, chosen when the batch runs, and writes them next to the table;
then its records are joined with what was written and fanned out. A device that sends a large
part of all records costs one row per task in the first and is split by the adaptive join in
the second; a keyed streaming operator would send all its records to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.functions import dates
from weir.operators import split, visitors
from weir.sources.topics import SEQ
from weir.streaming.storage import BatchTable, KeyedTable, written

Sink = Callable[[DataFrame, int], None]


class LogJob:
    """``sink`` takes ``(seq, topic, position, value, reason)`` and the batch number; by default rows go to
    ``self.streams``. A sink must accept the same batch twice: messages carry an id by which a reader drops repeats, see
    ``weir.sinks.topics``. ``buckets`` is fixed when the job starts for the first time: a
    bucket should hold what one task reads easily.
    """

    def __init__(
        self,
        root: str,
        zone: str = dates.ZONE,
        sink: Sink | None = None,
        compact_every: int = 100,
        buckets: int = 64,
    ):
        self.root = root
        self.zone = zone
        self.buckets = buckets
        # The layout is part of the path, so a job with another one does not mistake it for its own.
        self.visits = KeyedTable(
            f"{root}/visits-of-{buckets}",
            f"mid STRING, first_date DATE, first_seq {SEQ}, known BOOLEAN, bucket INT",
            ("bucket",),
            fixed="known=false",
        )
        self.streams = BatchTable(
            f"{root}/streams", f"seq {SEQ}, topic STRING, position INT, value STRING, reason STRING", ("topic",)
        )
        self.sink = sink or self.streams.write
        self.compact_every = compact_every

    def start(self, topic: DataFrame, **trigger) -> StreamingQuery:
        """Run on a streaming topic ``(seq, value)``; pass a trigger, e.g. ``availableNow=True``."""
        writer = topic.writeStream.foreachBatch(self.process)
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint")
        return (writer.trigger(**trigger) if trigger else writer).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(F.col("seq").cast(SEQ).alias("seq"), "value")
        # All JSON work happens once; the look at visits takes four narrow columns of what is kept.
        pieces = split.cut(visitors.parse_logs(batch)).persist()
        try:
            self.visits.write(self._batch_visits(pieces, batch_id).hint("rebalance", "known", "bucket"), batch_id)
            visits = self.visits.read_batch(spark, batch_id)
            self.sink(split.fan_out(visitors.repair_flags(pieces, visits, self.zone)), batch_id)
        finally:
            pieces.unpersist()
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(spark, batch_id)

    def known_visits(self, spark, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """``(mid, first_date)`` of the devices seen in batches below ``before``; of some buckets, only these are read."""
        parts = None if buckets is None else [f"known=false/bucket={n}" for n in buckets]
        return self.visits.read_parts(spark, parts, before).select("mid", "first_date")

    def compact(self, spark, batch_id: int) -> None:
        """Gather the visits of the buckets that were touched since the last snapshot into a new one."""
        self.visits.compact(spark, batch_id, lambda rows: rows)
        # What the snapshot before this one covers; batches since then may still be repeated.
        self.visits.forget(spark, batch_id - self.compact_every)

    def _batch_visits(self, logs: DataFrame, batch_id: int) -> DataFrame:
        """First visits of the batch's devices; ``known`` where an earlier batch set them."""
        spark = logs.sparkSession
        bucket = F.pmod(F.xxhash64("mid"), F.lit(self.buckets)).cast("int")
        firsts = written(visitors.first_visits(logs, self.zone, undated=True).withColumn("bucket", bucket), "batch-visits")
        # At most as many numbers as there are buckets.
        touched = [row.bucket for row in firsts.select("bucket").distinct().collect()]
        earlier = self.known_visits(spark, before=batch_id, buckets=touched)
        # The inner join first: it may broadcast the batch's devices and leave the large table in place.
        hits = earlier.join(firsts.select("mid"), "mid").withColumnRenamed("first_date", "known_date")
        known = F.col("known_date").isNotNull()
        return (
            firsts.join(hits, "mid", "left")
            .select(
                "mid",
                F.coalesce("known_date", "first_date").alias("first_date"),
                F.when(~known, F.col("first_seq")).alias("first_seq"),
                known.alias("known"),
                F.when(known, -1).otherwise(F.col("bucket")).alias("bucket"),
            )
            .where("first_date IS NOT NULL")
        )
