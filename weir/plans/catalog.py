"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each derives its topic from whole tables, runs the operators on it and returns flat columns,
so results do not depend on the order of JSON keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import fixtures
from weir.functions import dates, records
from weir.operators import dims, routing, split, visitors
from weir.plans import dim_flow, log_flow
from weir.sinks import topics as topic_sinks
from weir.sinks.tables import KEY
from weir.sources import rules, topics
from weir.streaming.dim_job import DimJob
from weir.streaming.log_job import LogJob
from weir.streaming.storage import arrival, new_path, written
from weir.streaming.visit_state import VisitState
from weir.streaming.visit_stream import VisitStream

Query = Callable[[SparkSession, str], DataFrame]

# Streaming queries see their topic arrive in this many steps, each at least one micro-batch.
SLICES = 4


# --- change log -------------------------------------------------------------------------------


def db_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = dims.parse_changes(fixtures.topic_db(spark, sf_dir))
    return dims.dirty_changes(changes).select("seq", "value")


def db_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = dims.parse_changes(fixtures.topic_db(spark, sf_dir))
    return dims.kept_changes(changes).select("seq", "database", "source_table", "type", "ts")


def record_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading, writing and listing the fields of every row image."""
    topic = fixtures.topic_db(spark, sf_dir).select("seq", records.parse("value").alias("v"))
    data = records.get_object("v", "$.data")
    texts = records.get_text_object("v", "$.data")
    changed = records.put(records.remove(data, "c_name", "s_name"), "mark", records.text("x"))
    parsed = topic.select(
        "seq",
        records.present("v", "$.data").alias("has_data"),
        records.get_string("v", "$.ts").alias("ts_text"),
        records.get_long("v", "$.ts").alias("ts_number"),
        F.array_join(F.array_sort(F.map_keys(data)), ",").alias("names"),
        F.array_join(F.map_values(F.map_filter(texts, lambda k, _: k.endswith("_name"))), "','", "").alias(
            "name_values"
        ),
        records.parse(records.to_text(changed)).alias("w"),
    )
    return parsed.select(
        "seq",
        "has_data",
        "ts_text",
        "ts_number",
        "names",
        "name_values",
        records.get_string("w", "$.mark").alias("mark"),
        records.present("w", "$.c_name").alias("still_c_name"),
    )


# --- routing rules ----------------------------------------------------------------------------


def config_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = rules.from_change_feed(fixtures.routing_feed(spark, sf_dir))
    return routing.active_rules(feed).select("source_table", "sink_table", "sink_columns", "sink_pk")


def config_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of a snapshot, several sources sharing a target, followed by the changes made after it."""
    both = rules.snapshot_then_changes(
        rules.from_snapshot(fixtures.routing_snapshot(spark, sf_dir)),
        rules.from_change_feed(fixtures.routing_feed(spark, sf_dir)),
    )
    table = routing.routing_table(both)
    return table.select(
        "source_table", "sink_table", "sink_pk", F.array_join("table_columns", ",").alias("table_columns"), "table_pk"
    )


def config_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from a snapshot and a feed that overlap, in order of the log: what is in force and the tables it writes to."""
    position = rules.log_position(F.lit(fixtures.SNAPSHOT_FILE), F.lit(fixtures.SNAPSHOT_POS))
    given = rules.hand_over(
        rules.from_snapshot(fixtures.routing_snapshot(spark, sf_dir)), position, rules.from_positioned_feed(fixtures.positioned_feed(spark, sf_dir))
    )
    table = routing.routing_table(given)
    return table.select("source_table", "sink_table", "sink_pk", F.array_join("table_columns", ",").alias("table_columns"), "table_pk")


def target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.target_columns(rules.from_change_feed(fixtures.routing_feed(spark, sf_dir)))


# --- dimension tables -------------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return dim_flow.routed_changes(
        fixtures.topic_db(spark, sf_dir), fixtures.routing_changes(spark), **options
    )


def _names(data: Column) -> Column:
    return F.array_join(F.array_sort(F.map_keys(data)), ",")


def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir).where(F.col("status") == dims.ACCEPTED)
    return rows.select("seq", "source_table", "sink_table", "pk")


def dim_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir).where(F.col("status") == dims.UNMATCHED)
    return rows.select("seq", "source_table")


def dim_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir, match="substring", with_dirty=True)
    return rows.where(F.col("status") != dims.ACCEPTED).select("seq", "source_table", "status", "reason")


def dim_project_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir).where(F.col("sink_table").isNotNull())
    return rows.select("seq", "sink_table", _names(F.col("data")).alias("kept"), "status")


def dim_project_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir, match="substring").where(F.col("sink_table").isNotNull())
    return rows.select("seq", "sink_table", _names(F.col("data")).alias("kept"), "status")


def dim_route_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of every change by a join that broadcasts nothing, hot tables spread over many keys."""
    return _routed(spark, sf_dir, spread=True, with_dirty=True).select("seq", "source_table", "sink_table", "status")


def dim_route_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes by the rules that were in force when they arrived, while rules change all through the topic."""
    rows = dim_flow.routed_as_of(fixtures.topic_db(spark, sf_dir), fixtures.routing_history(spark, sf_dir))
    return rows.select("seq", "source_table", "sink_table", "pk", "status", "reason", _names(F.col("data")).alias("kept"))


def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of every cell of the dimension tables."""
    return dim_flow.dimension_cells(fixtures.topic_db(spark, sf_dir), fixtures.routing_changes(spark))


# --- app logs ---------------------------------------------------------------------------------


def first_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = visitors.parse_logs(fixtures.topic_log(spark, sf_dir))
    return visitors.first_visits(logs).select("mid", "first_date")


def is_new_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = log_flow.repaired_logs(fixtures.topic_log(spark, sf_dir))
    return logs.where("reason IS NULL").select("seq", "mid", "is_new", "flipped")


def log_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_flow.dirty_logs(fixtures.topic_log(spark, sf_dir))


def _stream(spark: SparkSession, sf_dir: str, topic: str, schema: str) -> DataFrame:
    """One output topic of the log flow with its messages read back as columns."""
    messages = log_flow.split_logs(fixtures.topic_log(spark, sf_dir), [topic])
    keys = F.array_join(F.array_sort(F.json_object_keys("value")), ",")
    return messages.select("seq", F.from_json("value", schema).alias("m"), keys.alias("keys"))


_COMMON = "STRUCT<mid: STRING, is_new: STRING>"
_ITEMS = "ARRAY<STRUCT<item: STRING>>"


def log_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(
        spark,
        sf_dir,
        split.ERROR,
        f"common {_COMMON}, err STRUCT<error_code: BIGINT>, page STRUCT<page_id: STRING>, displays {_ITEMS}",
    )
    return rows.select(
        "seq",
        "m.common.mid",
        "m.common.is_new",
        "m.err.error_code",
        "m.page.page_id",
        F.coalesce(F.size("m.displays"), F.lit(0)).alias("n_displays"),
        "keys",
    )


def log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(
        spark,
        sf_dir,
        split.START,
        f"common {_COMMON}, start STRUCT<entry: STRING, loading_time: BIGINT>, displays {_ITEMS}, ts BIGINT",
    )
    return rows.select(
        "seq",
        "m.common.mid",
        "m.common.is_new",
        "m.start.entry",
        "m.start.loading_time",
        F.coalesce(F.size("m.displays"), F.lit(0)).alias("n_displays"),
        "m.ts",
        "keys",
    )


def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(
        spark,
        sf_dir,
        split.PAGE,
        f"common {_COMMON}, page STRUCT<page_id: STRING, during_time: BIGINT>, ts BIGINT",
    )
    return rows.select(
        "seq", "m.common.mid", "m.common.is_new", "m.page.page_id", "m.page.during_time", "m.ts", "keys"
    )


def log_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(
        spark,
        sf_dir,
        split.DISPLAY,
        "common STRING, page_id STRING, ts BIGINT, item STRING, order BIGINT",
    )
    return rows.select(
        "seq",
        F.get_json_object("m.common", "$.mid").alias("mid"),
        F.get_json_object("m.common", "$.is_new").alias("is_new"),
        "m.page_id",
        "m.ts",
        F.col("m.order").alias("position"),
        "m.item",
        "keys",
    )


def log_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(
        spark, sf_dir, split.ACTION, "common STRING, page_id STRING, ts BIGINT, action_id STRING"
    )
    return rows.select(
        "seq",
        F.get_json_object("m.common", "$.mid").alias("mid"),
        F.get_json_object("m.common", "$.is_new").alias("is_new"),
        "m.page_id",
        "m.action_id",
        "m.ts",
        "keys",
    )


def _messages(rows: DataFrame) -> DataFrame:
    """Messages of all output topics as one flat table."""
    parsed = rows.select(
        "seq",
        "topic",
        "reason",
        F.from_json(
            "value",
            "common STRING, page STRUCT<page_id: STRING>, page_id STRING, ts BIGINT, "
            "order BIGINT, action_id STRING",
        ).alias("m"),
    )
    return parsed.select(
        "seq",
        "topic",
        "reason",
        F.get_json_object("m.common", "$.mid").alias("mid"),
        F.get_json_object("m.common", "$.is_new").alias("is_new"),
        F.coalesce("m.page_id", "m.page.page_id").alias("page_id"),
        "m.ts",
        F.col("m.order").alias("position"),
        "m.action_id",
    )


def log_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(log_flow.split_logs(fixtures.topic_log(spark, sf_dir)))


def log_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole output texts: numbers as they came, null members gone, whatever else a message holds."""
    rows = log_flow.split_logs(fixtures.topic_numbers(spark, sf_dir), [split.PAGE, split.DISPLAY])
    return rows.select("seq", "topic", "value")


def log_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and new-visitor messages per output topic and day: the whole log flow, counted."""
    rows = log_fanout(spark, sf_dir).where(F.col("topic") != split.DIRTY)
    return (
        rows.select("topic", dates.day(F.col("ts")).alias("day"), "is_new")
        .groupBy("topic", "day")
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count(F.when(F.col("is_new") == visitors.NEW, 1)).alias("n_new"),
        )
    )


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ms = events.select(F.col("event_id").alias("seq"), dates.epoch_ms(F.col("ts")).alias("ms"))
    texts = ms.select(
        "seq",
        "ms",
        dates.to_date(F.col("ms")).alias("day"),
        dates.to_date_time(F.col("ms")).alias("full_text"),
    )
    return texts.select(
        "*",
        dates.to_ms(F.col("day")).alias("day_ms"),
        dates.to_ms(F.col("full_text"), full=True).alias("full_ms"),
    )


# --- streaming twins --------------------------------------------------------------------------


def _run(topic: DataFrame, start: Callable[..., object]) -> None:
    """Let ``topic`` arrive slice by slice; after each, run the job on what is new and stop it.

    Every run restarts the job from its checkpoint.
    """
    spark = topic.sparkSession
    for path in fixtures.write_slices(topic, SLICES, new_path(spark, "topic")):
        start(topics.stream_files(spark, path), availableNow=True).awaitTermination()


def stream_first_visit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First visits on keyed state that starts from those of the first quarter of the topic, made as a batch."""
    topic = written(fixtures.topic_log(spark, sf_dir), "topic")
    start = topic.agg(F.max("seq")).first()[0] // 4
    earlier = written(visitors.first_visits(visitors.parse_logs(topic.where(F.col("seq") <= start))), "earlier-visits")
    state = VisitState(new_path(spark, "visit-state"), earlier)
    _run(topic.where(F.col("seq") > start), state.start)
    return state.visits(spark)


def _log_job(spark: SparkSession, sf_dir: str) -> LogJob:
    job = LogJob(new_path(spark, "log-job"))
    _run(fixtures.topic_log(spark, sf_dir, raw=True), job.start)
    return job


def _dim_job(spark: SparkSession, sf_dir: str, **options) -> DimJob:
    job = DimJob(
        new_path(spark, "dim-job"), lambda s: rules.from_change_feed(fixtures.routing_changes(s)), **options
    )
    _run(fixtures.topic_db(spark, sf_dir, raw=True), job.start)
    return job


def stream_first_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = VisitStream(new_path(spark, "visit-stream"))
    _run(fixtures.topic_log(spark, sf_dir), job.start)
    return job.visits(spark)


def stream_is_new_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log_job(spark, sf_dir).streams.read(spark)
    records_once = rows.where(F.col("topic").isin(split.PAGE, split.START))
    return _messages(records_once).select(F.col("seq").cast("bigint").alias("seq"), "mid", "is_new")


def stream_log_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(_log_job(spark, sf_dir).streams.read(spark))
    return rows.withColumn("seq", F.col("seq").cast("bigint"))


def stream_dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dim_job(spark, sf_dir).routed.read_parts(spark)
    return rows.select(F.col("seq").cast("bigint").alias("seq"), "source_table", "sink_table", "pk")


def stream_log_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a batch that was sent twice, read by their ids: each comes once."""
    path = new_path(spark, "sent")
    # Stands in for a Kafka topic: every write adds messages, also those of a repeated batch.
    job = LogJob(new_path(spark, "log-job"), sink=lambda rows, _: topic_sinks.kafka_messages(rows).write.mode("append").parquet(path))
    batch = fixtures.topic_log(spark, sf_dir)
    for _ in range(2):
        job.process(batch, 0)
    sent = spark.read.parquet(path).select(
        "topic", F.col("value").cast("binary").alias("value"), "headers", F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"),
    )
    rows = topics.from_kafka_once(sent).withColumn("seq", F.split("id", "/")[0].cast("bigint"))
    return _messages(rows.withColumn("reason", F.lit(None).cast("string"))).drop("reason")


def _live_job(spark: SparkSession, sf_dir: str, **options) -> DimJob:
    """Changes and rules as two sources of one query; rules keep changing between its restarts and within its batches."""
    job = DimJob(new_path(spark, "dim-job"), **options)
    path, feed = new_path(spark, "topic"), new_path(spark, "rules")
    for _ in fixtures.write_slices(fixtures.topic_db(spark, sf_dir, raw=True), SLICES, path, (fixtures.routing_history(spark, sf_dir), feed)):
        job.start(topics.stream_files(spark, path), topics.stream_files(spark, feed), availableNow=True).awaitTermination()
    return job


def stream_dim_route_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and other changes by the rules in force when they arrived, rules being a source of the query."""
    job = _live_job(spark, sf_dir, as_of=True)
    accepted = job.routed.read_parts(spark).withColumns({"status": F.lit(dims.ACCEPTED), "reason": F.lit(None).cast("string")})
    kept = ("seq", "source_table", "sink_table", "status", "reason")
    others = job.rejected.read(spark).where(F.col("status") != dims.DIRTY).select(*kept)
    return accepted.select(*kept).unionByName(others).withColumn("seq", F.col("seq").cast("bigint"))


def stream_dim_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of changes, counted while the batches were written."""
    counts = _dim_job(spark, sf_dir).counts.read(spark).groupBy("status", "reason").agg(F.sum("n").alias("n"))
    return counts.where("n > 0")


def stream_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.latest_cells(_dim_job(spark, sf_dir).accepted(spark), arrival())


def stream_dim_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog tables that the job makes and keeps up to date batch by batch, a row per cell that is not NULL."""
    path = new_path(spark, "dim-tables")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{path}'")
    _dim_job(spark, sf_dir, tables=database, compact_every=2)
    cells = None
    for table in sorted(t.name for t in spark.catalog.listTables(database) if t.tableType == "VIEW"):
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{table}`").collect()}
        data = spark.table(f"`{database}`.`{table}`")
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in data.columns]
        own = data.select(
            F.lit(table).alias("sink_table"), F.col(properties[KEY]).alias("pk"), F.inline(F.array(*pairs))
        ).where("value IS NOT NULL")
        cells = own if cells is None else cells.unionByName(own)
    return cells


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        db_dirty,
        db_changes,
        record_functions,
        config_latest,
        config_snapshot,
        config_handover,
        target_columns,
        dim_route,
        dim_unmatched,
        dim_rejects,
        dim_project_exact,
        dim_project_substring,
        dim_route_spread,
        dim_route_as_of,
        dim_upsert,
        first_visit,
        is_new_repair,
        log_dirty,
        log_error,
        log_start,
        log_page,
        log_display,
        log_action,
        log_fanout,
        log_number_text,
        log_daily,
        date_functions,
        stream_first_visit,
        stream_first_visit_state,
        stream_is_new_repair,
        stream_log_fanout,
        stream_log_once,
        stream_dim_route,
        stream_dim_route_live,
        stream_dim_counts,
        stream_dim_upsert,
        stream_dim_tables,
    )
}
