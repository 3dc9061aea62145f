"""The dim flow as a Structured Streaming job.

Rules reach the job in one of two ways. As a second source of the query (``start(topic, rules=...)``) their offsets lie
in the checkpoint next to those of the changes: a micro-batch that is repeated finds the same rules, and what the job keeps of them
advances by the new rules alone. Or ``load_rules`` reads all of them anew for each micro-batch. Either way rules hold as of the
micro-batch; with ``as_of`` each change goes by the rule that was in force at its own place in the order of arrival.

Every change of a batch is written once, accepted ones by dimension table and bucket of their key. A batch changes
the buckets that it touches and no others: in the job's own state, in its snapshots, and in the catalog tables.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.operators import dims, routing
from weir.sinks import tables
from weir.sources import rules as rule_sources
from weir.sources.topics import SEQ
from weir.streaming.storage import BatchTable, KeyedTable, arrival

# Batches whose routing tables are kept, for retries.
KEPT_RULES = 10

_ROUTED = f"seq {SEQ}, source_table STRING, pk STRING, data MAP<STRING,STRING>, sink_table STRING, bucket INT"
_REJECTED = f"seq {SEQ}, source_table STRING, sink_table STRING, reason STRING, value STRING, status STRING"
_ROUTING = (
    "source_table STRING, sink_table STRING, sink_columns STRING, sink_pk STRING, sink_extend STRING, "
    f"columns ARRAY<STRING>, table_columns ARRAY<STRING>, table_pk STRING, from_seq {SEQ}, to_seq {SEQ}"
)

# What becomes of changes, as counted per batch.
_COUNTED = (
    (dims.ACCEPTED, None),
    (dims.UNMATCHED, None),
    (dims.REJECTED, dims.NO_DATA),
    (dims.REJECTED, dims.UNKNOWN_COLUMN),
    (dims.REJECTED, dims.NO_KEY),
    (dims.DIRTY, dims.NOT_JSON),
)

_CHANGE, _RULE = "change", "rule"


def observed(seen: Observation) -> dict[str, int] | None:
    """What was observed, or nothing: Spark loses an observation when it leaves a plan out that it finds to be empty."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


class DimJob:
    """``load_rules`` gives all rule changes so far as ``(seq, rule)``; see ``weir.sources.rules``. It is not needed where
    rules are a source of the query.

    ``tables`` names the catalog database that holds the dimension tables: a new target gets its table in the
    batch that sees its rule, and each batch brings the buckets up to date that it touches. Without it, tables are
    only resolved when read. ``buckets``, of each dimension table, is fixed when the job starts for the first time.
    """

    def __init__(
        self,
        root: str,
        load_rules: Callable[[SparkSession], DataFrame] | None = None,
        match: str = "exact",
        database: str | None = None,
        compact_every: int = 100,
        tables: str | None = None,
        buckets: int = tables.BUCKETS,
        as_of: bool = False,
    ):
        self.root = root
        self.tables = tables
        self.load_rules = load_rules
        self.match = match
        self.database = database
        self.compact_every = compact_every
        self.buckets = buckets
        self.as_of = as_of
        self.rules = BatchTable(f"{root}/rules", f"seq {SEQ}, rule STRUCT<{rule_sources.RULE_SCHEMA}>")
        self.routing = BatchTable(f"{root}/routing", _ROUTING)
        self.routed = KeyedTable(f"{root}/routed-of-{buckets}", _ROUTED, ("sink_table", "bucket"))
        self.rejected = BatchTable(f"{root}/rejected", _REJECTED, ("status",))
        self.counts = BatchTable(f"{root}/counts", "status STRING, reason STRING, n BIGINT")

    def start(self, topic: DataFrame, rules: DataFrame | None = None, **trigger) -> StreamingQuery:
        """Run on a streaming topic ``(seq, value)`` and, if given, a streaming topic of rule changes; pass a trigger, e.g.
        ``availableNow=True``.
        """
        if rules is not None:
            topic = topic.withColumn("kind", F.lit(_CHANGE)).unionByName(rules.withColumn("kind", F.lit(_RULE)))
        writer = topic.writeStream.foreachBatch(self.process)
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint")
        return (writer.trigger(**trigger) if trigger else writer).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = None
        if "kind" in batch.columns:
            arrived = batch.where(F.col("kind") == _RULE)
            batch = batch.where(F.col("kind") == _CHANGE)
        # Written first, so the join sees how large the table really is; a retry finds the rules of its first run.
        if not self.routing.has(spark, batch_id):
            self.routing.write(self._in_force(spark, arrived, batch_id), batch_id)
            self.routing.forget_all_but_last(spark, batch_id - KEPT_RULES)
        table = self.routing.read_batch(spark, batch_id).drop("batch_id")
        if self.tables:
            self._create_tables(table, batch_id)
        batch = batch.select(F.col("seq").cast(SEQ).alias("seq"), "value")
        changes = dims.kept_changes(dims.parse_changes(batch), self.database, with_dirty=True)
        route = dims.route_as_of(changes, table, self.match) if self.as_of else dims.route(changes, table.drop("from_seq", "to_seq"), self.match)
        seen = Observation()
        counted = [F.count_if((F.col("status") == s) & F.col("reason").eqNullSafe(r)).alias(f"n{i}") for i, (s, r) in enumerate(_COUNTED)]
        routed = route.observe(seen, *counted).persist()
        try:
            accepted = routed.where(F.col("status") == dims.ACCEPTED).withColumn("bucket", tables.bucket(self.buckets))
            # Few files per bucket whatever the number of tasks, and several tasks for a large one.
            self.routed.write(accepted.drop("status", "reason", "value").hint("rebalance", "sink_table", "bucket"), batch_id)
            self.rejected.write(routed.where(F.col("status") != dims.ACCEPTED).drop("pk", "data").hint("rebalance", "status"), batch_id)
            # Counted while the rows were made, without another pass.
            numbers = observed(seen) or routed.agg(*counted).first().asDict()
        finally:
            routed.unpersist()
        rows = [(s, r, numbers[f"n{i}"]) for i, (s, r) in enumerate(_COUNTED)]
        self.counts.write(spark.createDataFrame(rows, "status STRING, reason STRING, n BIGINT").coalesce(1), batch_id)
        if self.tables:
            self.publish(spark, self.routed.parts(spark, batch_id - 1, batch_id))
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(spark, batch_id)

    def publish(self, spark: SparkSession, parts: list[str]) -> None:
        """Bring buckets of the catalog tables up to date, the tables one after the other.

        A bucket is made anew from the job's own state, never from the table, so doing it again does no harm.
        """
        by_table: dict[str, list[str]] = {}
        for part in parts:
            by_table.setdefault(part.split("/")[0].removeprefix("sink_table="), []).append(part)
        for table, own in by_table.items():
            tables.publish(spark, self.accepted(spark, own), table, self.tables, arrival(), self.buckets)

    def accepted(self, spark: SparkSession, parts: list[str] | None = None) -> DataFrame:
        """Rows for dimension tables, with ``batch_id`` and ``seq`` as their order."""
        return self.routed.read_parts(spark, parts).select("sink_table", "pk", "data", "batch_id", "seq")

    def audit(self, spark: SparkSession) -> DataFrame:
        """Changes that reached no table: unmatched, rejected or dirty, with the message."""
        return self.rejected.read(spark).select("batch_id", "seq", "source_table", "status", "reason", "value")

    def dimension(self, spark: SparkSession, sink_table: str, columns: list[str]) -> DataFrame:
        """One dimension table as it stands; reads only that table's changes."""
        rows = self.accepted(spark).where(F.col("sink_table") == sink_table)
        return dims.latest_rows(rows, columns, arrival())

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Resolve the buckets touched since the last snapshot into a new one, one row per dimension row."""
        self.routed.compact(spark, batch_id, self._resolved)
        # What the snapshot before this one covers; batches since then may still be repeated.
        self.routed.forget(spark, batch_id - self.compact_every)

    def _resolved(self, changes: DataFrame) -> DataFrame:
        rows = dims.latest_maps(changes, arrival())
        return rows.select(
            F.lit(-1).cast(SEQ).alias("seq"), F.lit(None).cast("string").alias("source_table"), "pk", "data", "sink_table", tables.bucket(self.buckets).alias("bucket")
        )

    def _in_force(self, spark: SparkSession, arrived: DataFrame | None, batch_id: int) -> DataFrame:
        """The routing table of a batch, with periods where changes go by their own time."""
        known = None
        if arrived is None:
            given = self.load_rules(spark)
        else:
            known = self.rules.read_last(spark, batch_id).drop("batch_id")
            given = rule_sources.from_change_feed(arrived.select(F.col("seq").cast(SEQ).alias("seq"), "value"))
            if not routing.valid_rules(given).isEmpty():
                self.rules.write(routing.lasting_rules(known.unionByName(given)).coalesce(1), batch_id)
                self.rules.forget_all_but_last(spark, batch_id - KEPT_RULES)
        if self.as_of:
            table = routing.rule_periods(given, known)
        else:
            nothing = F.lit(None).cast(SEQ)
            table = routing.routing_table(given if known is None else known.unionByName(given))
            table = table.withColumns({"from_seq": nothing, "to_seq": nothing})
        names = [field.split(" ")[0] for field in _ROUTING.split(", ")]
        return table.select(*[F.col(n).cast(SEQ).alias(n) if n.endswith("_seq") else n for n in names])

    def _create_tables(self, table: DataFrame, batch_id: int) -> None:
        """Tables of targets that the batch before did not know."""
        targets = table.select("sink_table", "table_columns", "table_pk").distinct()
        before = self.routing.read_last(table.sparkSession, batch_id).select("sink_table")
        tables.create_tables(table.sparkSession, targets.join(before, "sink_table", "left_anti"), self.tables)
