"""First visit per device as Spark's own keyed streaming state.

A streaming aggregation: one state entry per device, never expired, and combined before the
shuffle. Entries are emitted whenever their device is seen again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.functions import dates
from weir.operators import visitors
from weir.streaming.storage import BatchTable


class VisitStream:
    def __init__(self, root: str, zone: str = dates.ZONE, compact_every: int = 100):
        self.root = root
        self.zone = zone
        self.compact_every = compact_every
        self.updates = BatchTable(f"{root}/visit_updates", "mid STRING, first_date DATE")

    def start(self, topic: DataFrame, **trigger) -> StreamingQuery:
        visits = visitors.first_visits(visitors.parse_logs(topic), self.zone)
        writer = visits.writeStream.outputMode("update").foreachBatch(self.process)
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint")
        return (writer.trigger(**trigger) if trigger else writer).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        self.updates.write(batch.select("mid", "first_date"), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            rows = self.updates.read_through(batch.sparkSession, batch_id)
            self.updates.write_snapshot(_latest(rows), batch_id)
            self.updates.forget(batch.sparkSession, batch_id - self.compact_every)

    def visits(self, spark) -> DataFrame:
        """``(mid, first_date)`` after all batches so far."""
        return _latest(self.updates.read(spark))


def _latest(updates: DataFrame) -> DataFrame:
    return updates.groupBy("mid").agg(F.max_by("first_date", "batch_id").alias("first_date"))
