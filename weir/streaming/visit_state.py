"""First visit per device on Spark's keyed state API: one value for a device, started from a batch table.

The state is set by the first usable record of a device and never again, so an entry is emitted once. Only narrow rows
reach it, (device, order, day), of which each task passes on the first of a device in what it reads at a time: a device with very
many records costs a row for each such portion, never its messages.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from weir import session
from weir.functions import dates
from weir.operators import visitors
from weir.streaming.storage import BatchTable

_VISIT = "mid STRING, first_date DATE"


class FirstVisit(StatefulProcessor):
    """Keeps the day of the first row of each device and gives it out when it is set."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "first_date DATE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.first.exists():
            row = min(rows, key=lambda r: r.seq)
            self.first.update((row.candidate,))
            yield Row(mid=key[0], first_date=row.candidate)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.first.update((initialState.first_date,))

    def close(self) -> None:
        pass


def _firsts(portions: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for portion in portions:
        yield portion.sort_values("seq").drop_duplicates("mid")


class VisitState:
    """``earlier`` is a batch table ``(mid, first_date)`` that the state starts from; give the same one at each restart."""

    def __init__(self, root: str, earlier: DataFrame | None = None, zone: str = dates.ZONE):
        self.root = root
        self.earlier = earlier
        self.zone = zone
        # A device is written once, so what is written is the table itself.
        self.updates = BatchTable(f"{root}/visits", _VISIT)

    def start(self, topic: DataFrame, **trigger) -> StreamingQuery:
        """Run on a streaming topic ``(seq, value)``. The number of state partitions is that of the first start."""
        rows = visitors.candidates(visitors.parse_logs(topic), self.zone).where("mid IS NOT NULL AND candidate IS NOT NULL")
        narrow = rows.mapInPandas(_firsts, rows.schema)
        initial = None if self.earlier is None else self.earlier.select("mid", "first_date").groupBy("mid")
        visits = narrow.groupBy("mid").transformWithState(FirstVisit(), _VISIT, "append", "none", initial)
        writer = visits.writeStream.outputMode("append").foreachBatch(self.updates.write)
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint")
        # Spark's default store cannot hold a keyed processor.
        with session.keyed_state(topic.sparkSession):
            return (writer.trigger(**trigger) if trigger else writer).start()

    def visits(self, spark) -> DataFrame:
        """``(mid, first_date)`` of all devices seen so far."""
        rows = self.updates.read(spark).select("mid", "first_date")
        return rows if self.earlier is None else self.earlier.select("mid", "first_date").unionByName(rows)
