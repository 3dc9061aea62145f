"""The streaming jobs: live rules, restarts, repeated batches, snapshots, sources and sinks."""

import json

from pyspark.sql import functions as F

from tests.test_logs import DAY, T, log
from weir import fixtures
from weir.operators import dims, split
from weir.plans import log_flow
from weir.sinks import tables
from weir.sinks import topics as topic_sinks
from weir.sources import rules, topics
from weir.streaming.dim_job import DimJob
from weir.streaming.log_job import LogJob
from weir.streaming.storage import BatchTable, KeyedTable, new_path
from weir.streaming.visit_stream import VisitStream


def messages(spark, values, first=0):
    rows = [(first + i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def flags(rows):
    kept = rows.where(F.col("topic") == split.PAGE)
    flag = F.get_json_object("value", "$.common.is_new")
    return {r.seq: r.is_new for r in kept.select("seq", flag.alias("is_new")).collect()}


BATCHES = [
    [log(mid="a", ts=T), log(mid="b", is_new="0", ts=T), "junk", log(mid="c", is_new="0", ts="absent")],
    [log(mid="a", ts=T + DAY), log(mid="b", ts=T), log(mid="c", ts=T), log(mid="a", is_new="0", ts="absent")],
    [log(mid="a", ts=T), log(mid="c", ts=T + DAY), log(mid="d", ts=T + DAY)],
]
FLAGS = {0: "1", 1: "0", 10: "0", 11: "0", 12: "1", 13: "0", 20: "1", 21: "0", 22: "1"}


def test_log_job_keeps_state_over_restarts_snapshots_and_repeats(spark):
    path, job = new_path(spark, "topic"), LogJob(new_path(spark, "job"), compact_every=2)
    for n, batch in enumerate(BATCHES):
        messages(spark, batch, n * 10).write.mode("append").parquet(path)
        job.start(topics.stream_files(spark, path), availableNow=True).awaitTermination()
    assert flags(job.streams.read(spark)) == FLAGS
    dirty = job.streams.read(spark).where(F.col("topic") == split.DIRTY)
    assert {(r.seq, r.reason) for r in dirty.collect()} == {(2, "not_json"), (3, "no_ts")}
    # The same batches again, in the middle of the history: nothing changes.
    for n in (1, 2, 0):
        job.process(messages(spark, BATCHES[n], n * 10), n)
    assert flags(job.streams.read(spark)) == FLAGS
    assert job.known_visits(spark).count() == 4
    known = {(r.mid, str(r.first_date)) for r in job.known_visits(spark).collect()}
    assert known == {("a", "2020-06-14"), ("b", "2020-06-13"), ("c", "2020-06-14"), ("d", "2020-06-15")}


def test_adaptive_execution_is_on_inside_a_batch(spark):
    seen, path = [], new_path(spark, "topic")
    messages(spark, ["x"]).write.parquet(path)
    query = topics.stream_files(spark, path, max_files_per_trigger=1).writeStream.foreachBatch(
        lambda df, n: seen.append(df.sparkSession.conf.get("spark.sql.adaptive.enabled"))
    )
    query.trigger(availableNow=True).start().awaitTermination()
    assert set(seen) == {"true"}


def rule(source, sink, columns, pk=None):
    after = {"source_table": source, "sink_table": sink, "sink_columns": columns, "sink_pk": pk}
    return json.dumps({"after": after, "op": "c"})


def change(table, **data):
    return json.dumps({"database": "shop", "table": table, "type": "update", "data": data})


def test_dim_job_reads_rules_anew_and_resolves_over_batches(spark):
    feed, path = new_path(spark, "rules"), new_path(spark, "topic")
    job = DimJob(
        new_path(spark, "job"), lambda s: rules.from_change_feed(topics.read_files(s, feed)), compact_every=2
    )

    def step(n, new_rules, changes):
        if new_rules:
            messages(spark, new_rules, n * 10).write.mode("append").parquet(feed)
        messages(spark, changes, n * 10).write.mode("append").parquet(path)
        job.start(topics.stream_files(spark, path), availableNow=True).awaitTermination()

    step(0, [rule("t", "dim_t", "id,a,b")], [change("t", id=1, a=1, b=1), change("u", code=1), "junk"])
    step(1, [rule("u", "dim_u", "code", "code")], [change("t", id=1, a=2), change("u", code=2)])
    step(2, [], [change("t", id=1, b=None), change("t", id=2, a=5), change("t", a=5)])
    table = {r.pk: (r.id, r.a, r.b) for r in job.dimension(spark, "dim_t", ["id", "a", "b"]).collect()}
    assert table == {"1": ("1", "2", None), "2": ("2", "5", None)}
    assert [r.pk for r in job.dimension(spark, "dim_u", ["code"]).collect()] == ["2"]
    audit = {(r.seq, r.status, r.reason) for r in job.audit(spark).collect()}
    assert audit == {(1, "unmatched", None), (2, "dirty", "not_json"), (22, "rejected", "no_key")}
    job.process(messages(spark, [change("t", id=1, a=2), change("u", code=2)], 10), 1)
    again = {r.pk: (r.id, r.a, r.b) for r in job.dimension(spark, "dim_t", ["id", "a", "b"]).collect()}
    assert again == table


def test_batch_table_ignores_unfinished_writes(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), "a INT")
    assert table.read(spark).count() == 0
    table.write(spark.range(3).selectExpr("CAST(id AS INT) a"), 0)
    table.write(spark.range(3).selectExpr("CAST(id AS INT) a"), 0)
    (tmp_path / "t" / "batches" / "batch_id=1").mkdir()
    assert table.read(spark).count() == 3
    assert table.read(spark, before=0).count() == 0


def test_sources_and_sinks(spark, tmp_path, capfd):
    kafka = spark.createDataFrame(
        [(bytearray(b"x"), 3, 7, 5), (None, 3, 8, 6), (bytearray(b"y"), 0, 7, 9)],
        "value binary, partition int, offset bigint, at bigint",
    ).withColumn("timestamp", F.timestamp_millis("at"))
    found = {tuple(r) for r in topics.from_kafka(kafka).collect()}
    assert found == {(5 * 10**24 + 3 * 10**19 + 7, "x"), (9 * 10**24 + 7, "y")}
    out = log_flow.split_logs(messages(spark, [log(displays=[{"item": "1"}])]))
    sent = topic_sinks.kafka_messages(out)
    assert sent.columns == ["topic", "value", "headers"]
    ids = {bytes(r.headers[0].value).decode() for r in sent.collect()}
    assert ids == {f"0/{split.PAGE}/0", f"0/{split.DISPLAY}/0"} and {r.headers[0].key for r in sent.collect()} == {topics.ID_HEADER}
    topic_sinks.to_files(out, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").glob("topic=*")} == {
        f"topic={split.PAGE}", f"topic={split.DISPLAY}",
    }
    topic_sinks.to_console(out, "page")
    assert "page" in capfd.readouterr().out
    path = new_path(spark, "topic")
    messages(spark, ["x", None]).write.json(path)
    stream = topics.stream_files(spark, path, "json")
    query = topic_sinks.to_console(stream, "raw")
    query.processAllAvailable()
    query.stop()
    assert topics.read_files(spark, path, "json").count() == 1


def test_named_streams_have_no_watermark(spark):
    path = new_path(spark, "topic")
    fixtures.routing_changes(spark).write.parquet(path)
    stream = topics.stream_files(spark, path)
    assert "EventTimeWatermark" not in stream._jdf.queryExecution().analyzed().toString()
    assert stream.isStreaming and dims.parse_changes(stream).isStreaming


def test_a_retry_keeps_the_rules_of_its_first_run(spark):
    feed = new_path(spark, "rules")
    messages(spark, [rule("t", "dim_t", "id,a")]).write.parquet(feed)
    job = DimJob(new_path(spark, "job"), lambda s: rules.from_change_feed(topics.read_files(s, feed)))
    batch = messages(spark, [change("t", id=1, a=1), change("u", id=2)])
    job.process(batch, 0)
    messages(spark, [rule("u", "dim_u", "id")], 10).write.mode("append").parquet(feed)
    job.process(batch, 0)
    assert [r.pk for r in job.accepted(spark).collect()] == ["1"]
    job.process(messages(spark, [change("u", id=3)], 20), 1)
    assert sorted(r.pk for r in job.accepted(spark).collect()) == ["1", "3"]


def test_state_of_a_long_job_stays_small(spark, tmp_path):
    """Directories and rows that a batch reads do not grow with the number of batches before it."""
    table = BatchTable(str(tmp_path / "t"), "a BIGINT")
    seen = []
    for n in range(40):
        table.write(spark.range(2).selectExpr("id AS a"), n)
        if (n + 1) % 5 == 0:
            table.write_snapshot(table.read_through(spark, n).select("a").distinct(), n)
            table.forget(spark, n - 5)
        seen.append((len(list((tmp_path / "t").glob("*/batch_id=*"))), table.read(spark).count()))
    assert max(d for d, _ in seen[20:]) <= max(d for d, _ in seen[10:20]) <= 14
    assert max(r for _, r in seen) <= 12
    assert table.read(spark, before=36).select("a").distinct().count() == 2


def test_files_of_a_batch_stay_few(spark):
    feed = new_path(spark, "rules")
    messages(spark, [rule("t", "dim_t", "id"), rule("u", "dim_u", "id")]).write.parquet(feed)
    job = DimJob(new_path(spark, "job"), lambda s: rules.from_change_feed(topics.read_files(s, feed)), buckets=4)
    batch = spark.range(0, 4000, numPartitions=64).selectExpr(
        "id AS seq",
        "concat('{\"database\":\"shop\",\"table\":\"', if(id % 4 = 0, 'u', 't'), '\",\"type\":\"insert\",\"data\":{\"id\":', id, '}}') AS value",
    )
    job.process(batch, 0)
    files = job.routed.read(spark).inputFiles()
    assert len(files) < 20 and job.accepted(spark).count() == 4000


def test_order_of_messages_over_partitions(spark):
    """Partition and offset order contradict time: time counts, and first visits stay a hash aggregation."""
    from weir.operators import routing, visitors

    def arrived(*messages):
        """``(ms, partition, offset, text)``"""
        df = spark.createDataFrame(messages, "at bigint, partition int, offset bigint, text string")
        kafka = df.select(F.timestamp_millis("at").alias("timestamp"), "partition", "offset", F.col("text").cast("binary").alias("value"))
        return topics.from_kafka(kafka)

    logs = visitors.parse_logs(arrived((3, 0, 1, log(ts=T + 2 * DAY)), (1, 2, 9, log(ts=T)), (2, 1, 5, log(ts=T + DAY))))
    visits = visitors.first_visits(logs)
    assert [(r.mid, str(r.first_date)) for r in visits.collect()] == [("m", "2020-06-14")]
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    feed = arrived((3, 0, 1, rule("t", "dim_c", "id,c")), (1, 2, 9, rule("t", "dim_a", "id,a")), (2, 1, 5, rule("t", "dim_b", "id,b")))
    given = rules.from_change_feed(feed)
    assert [r.sink_table for r in routing.active_rules(given).collect()] == ["dim_c"]
    rows = arrived((3, 0, 1, change("t", id=1, c="new")), (1, 2, 9, change("t", id=1, c="old")), (2, 1, 5, change("t", id=1, c="mid")))
    routed = dims.route(dims.kept_changes(dims.parse_changes(rows)), routing.routing_table(given))
    cells = {r.column: r.value for r in dims.latest_cells(dims.accepted(routed)).collect()}
    assert cells == {"id": "1", "c": "new"}


# --- state by buckets -------------------------------------------------------------------------


def paths(root, pattern="**/*.parquet"):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.glob(pattern)}


def scanned(df):
    """Directories that the scans of a plan read, after pruning by partitions."""
    df.write.format("noop").mode("overwrite").save()
    return {part.split("/part-")[0].split("batch_id=")[1] for part in [r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()]}


def test_keyed_table_reads_and_rewrites_touched_parts_only(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "a BIGINT, known BOOLEAN, bucket INT", ("bucket",), fixed="known=false")

    def write(n, *values):
        rows = [(v, False, v % 4) for v in values] + [(99, True, -1)]
        table.write(spark.createDataFrame(rows, "a BIGINT, known BOOLEAN, bucket INT").coalesce(1), n)

    def values(rows):
        return sorted(r.a for r in rows.select("a").collect())

    write(0, 0, 1, 2, 3)
    write(1, 4, 5)
    assert table.parts(spark, -1, 1) == [f"known=false/bucket={b}" for b in range(4)]
    assert table.compact(spark, 1, lambda rows: rows) == [f"known=false/bucket={b}" for b in range(4)]
    write(2, 8)
    own = ["known=false/bucket=0"]
    assert values(table.read_parts(spark, own)) == [0, 4, 8]
    assert scanned(table.read_parts(spark, own)) == {"1/known=false/bucket=0", "2/known=false/bucket=0"}
    assert values(table.read(spark)) == [0, 1, 2, 3, 4, 5, 8] and values(table.read(spark, before=1)) == [0, 1, 2, 3]
    before = paths(tmp_path, "t/snapshots/batch_id=1/**/*.parquet")
    write(3, 12)
    assert table.compact(spark, 3, lambda rows: rows) == own
    assert {p.split("/")[-2] for p in paths(tmp_path, "t/snapshots/batch_id=3/**/*.parquet")} == {"bucket=0"}
    assert paths(tmp_path, "t/snapshots/batch_id=1/**/*.parquet") == before
    assert values(table.read(spark)) == [0, 1, 2, 3, 4, 5, 8, 12]
    table.forget(spark, 3)
    assert not list(tmp_path.glob("t/batches/batch_id=*")) and not list(tmp_path.glob("t/snapshots/batch_id=1/known=false/bucket=0"))
    assert values(table.read(spark)) == [0, 1, 2, 3, 4, 5, 8, 12]
    for n in range(4, 8):  # every bucket again: nothing of the first snapshot is left
        write(n, *[4 * n + b for b in range(4)])
    table.compact(spark, 7, lambda rows: rows)
    table.forget(spark, 7)
    assert [p.name for p in tmp_path.glob("t/snapshots/*")] == ["batch_id=7"] and len(values(table.read(spark))) == 24


def test_log_job_reads_the_buckets_of_its_batch(spark, monkeypatch):
    job, asked = LogJob(new_path(spark, "job"), buckets=8, compact_every=3), []
    plain = job.known_visits
    monkeypatch.setattr(job, "known_visits", lambda s, before=None, buckets=None: asked.append(buckets) or plain(s, before, buckets))
    for n in range(4):
        job.process(messages(spark, [log(mid=f"device {n % 2}", ts=T + n * DAY)], n), n)
    assert all(len(buckets) == 1 for buckets in asked) and asked[0] == asked[2] != asked[1] == asked[3]
    assert {(r.mid, str(r.first_date)) for r in plain(spark).collect()} == {("device 0", "2020-06-14"), ("device 1", "2020-06-15")}
    assert flags(job.streams.read(spark)) == {0: "1", 1: "1", 2: "0", 3: "0"}


def test_a_job_refuses_another_number_of_buckets(spark):
    import pytest

    root = new_path(spark, "job")
    LogJob(root, buckets=4).process(messages(spark, [log(mid="a", ts=T)]), 0)
    with pytest.raises(ValueError, match="visits-of-4"):
        LogJob(root, buckets=8).process(messages(spark, [log(mid="a", ts=T)], 1), 1)
    LogJob(root, buckets=4).process(messages(spark, [log(mid="b", ts=T)], 1), 1)


def test_jobs_of_great_age_list_few_directories(spark, tmp_path):
    stream = VisitStream(str(tmp_path / "visits"), compact_every=5)
    visits = spark.sql("SELECT 'm' AS mid, DATE'2020-06-14' AS first_date").coalesce(1)
    for n in range(40):
        stream.process(visits, n)
    assert len(list(tmp_path.glob("visits/visit_updates/*/batch_id=*"))) <= 14 and stream.visits(spark).count() == 1
    feed = new_path(spark, "rules")
    messages(spark, [rule("t", "dim_t", "id,a")]).write.parquet(feed)
    job = DimJob(str(tmp_path / "job"), lambda s: rules.from_change_feed(topics.read_files(s, feed)), compact_every=4, buckets=2)
    seen = []
    for n in range(20):
        job.process(messages(spark, [change("t", id=n % 3, a=n)], n), n)
        seen.append(len(list(tmp_path.glob("job/routed-of-2/*/batch_id=*"))))
    assert max(seen[12:]) <= max(seen[:12]) <= 11
    assert {r.pk: r.a for r in job.dimension(spark, "dim_t", ["a"]).collect()} == {"0": "18", "1": "19", "2": "17"}


# --- dimension tables in the catalog ----------------------------------------------------------


def catalog(spark, path):
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{path}'")
    return database


def test_an_update_of_one_key_rewrites_one_bucket(spark, monkeypatch):
    from pathlib import Path

    feed, path = new_path(spark, "rules"), new_path(spark, "tables")
    database, root = catalog(spark, path), Path(path.removeprefix("file:"))
    messages(spark, [rule("t", "dim_t", "id,a"), rule("u", "dim_u", "id")]).write.parquet(feed)
    job = DimJob(new_path(spark, "job"), lambda s: rules.from_change_feed(topics.read_files(s, feed)), tables=database, buckets=8, compact_every=2)
    made = []
    plain = tables.create_tables
    monkeypatch.setattr(tables, "create_tables", lambda *args: made.append(plain(*args)) or made[-1])
    job.process(messages(spark, [change("t", id=i, a=i) for i in range(40)] + [change("u", id=1)]), 0)
    before = paths(root)
    assert len({p.split("/")[-2] for p in before if p.startswith("_dim_t")}) == 8
    job.process(messages(spark, [change("t", id=7, a="new")], 100), 1)
    after = paths(root)
    gone = {p.rsplit("/", 1)[0] for p in before.keys() - after.keys()}
    assert len(gone) == 1 and gone == {p.rsplit("/", 1)[0] for p in after.keys() - before.keys()}
    rows = {r.id: r.a for r in spark.table(f"`{database}`.`dim_t`").collect()}
    assert rows == {str(i): str(i) for i in range(40)} | {"7": "new"}
    # A batch that is repeated after its tables were half written changes nothing.
    job.process(messages(spark, [change("t", id=7, a="new")], 100), 1)
    assert {r.id: r.a for r in spark.table(f"`{database}`.`dim_t`").collect()} == rows
    assert made[0] == ["dim_t", "dim_u"] and made[1] == [] and spark.table(f"`{database}`.`dim_u`").count() == 1


# --- rules as a source ------------------------------------------------------------------------


def tagged(spark, changes, new_rules, first):
    kinds = [(first + i, v, "rule") for i, v in enumerate(new_rules)]
    kinds += [(first + len(new_rules) + i, v, "change") for i, v in enumerate(changes)]
    return spark.createDataFrame(kinds, "seq bigint, value string, kind string")


def test_rules_of_the_stream_are_kept_and_repeated(spark):
    job = DimJob(new_path(spark, "job"))

    def pks():
        return sorted((r.sink_table, r.pk) for r in job.accepted(spark).collect())

    job.process(tagged(spark, [change("t", id=1)], [rule("t", "dim_t", "id,a")], 0), 0)
    job.process(tagged(spark, [change("t", id=2), change("u", id=1)], [], 10), 1)
    assert pks() == [("dim_t", "1"), ("dim_t", "2")]
    batch = tagged(spark, [change("t", id=3), change("u", id=2)], [rule("u", "dim_u", "id"), rule("t", "dim_n", "id"), rule("t", "bad", "x")], 20)
    job.process(batch, 2)
    job.process(batch, 2)
    assert pks() == [("dim_n", "3"), ("dim_t", "1"), ("dim_t", "2"), ("dim_u", "2")]
    assert [n for n in job.rules._complete(spark, "batches", None)] == [0, 2]  # only batches with new valid rules write them
    kept = {(r.seq, r.rule.source_table, r.rule.sink_table) for r in job.rules.read_last(spark, 9).collect()}
    assert kept == {(0, "t", "dim_t"), (20, "u", "dim_u"), (21, "t", "dim_n")}  # the last of each source, the maker of each target


def test_rules_within_a_batch_hold_from_their_place_on(spark):
    job = DimJob(new_path(spark, "job"), as_of=True)
    rows = [(0, change("t", id=0), "change"), (1, rule("t", "dim_a", "id"), "rule"), (2, change("t", id=2), "change"),
            (3, rule("t", "dim_b", "id"), "rule"), (3, change("t", id=3), "change"), (4, rule("t", "bad", "x"), "rule"), (5, change("t", id=5), "change")]
    job.process(spark.createDataFrame(rows, "seq bigint, value string, kind string"), 0)
    job.process(spark.createDataFrame([(6, change("t", id=6), "change"), (7, rule("t", "dim_a", "id"), "rule"), (8, change("t", id=8), "change")], "seq bigint, value string, kind string"), 1)
    assert sorted((r.pk, r.sink_table) for r in job.accepted(spark).collect()) == [("2", "dim_a"), ("3", "dim_b"), ("5", "dim_b"), ("6", "dim_b"), ("8", "dim_a")]
    assert [(r.seq, r.status) for r in job.audit(spark).collect()] == [(0, "unmatched")]
    counts = {(r.batch_id, r.status): r.n for r in job.counts.read(spark).where("n > 0").collect()}
    assert counts == {(0, "accepted"): 3, (0, "unmatched"): 1, (1, "accepted"): 2}


def test_two_sources_of_one_query(spark):
    path, feed = new_path(spark, "topic"), new_path(spark, "rules")
    job = DimJob(new_path(spark, "job"))
    for n in range(3):
        messages(spark, [rule("t", f"dim_{n}", "id")], 10 * n).write.mode("append").parquet(feed)
        messages(spark, [change("t", id=n)], 10 * n + 5).write.mode("append").parquet(path)
        job.start(topics.stream_files(spark, path), topics.stream_files(spark, feed), availableNow=True).awaitTermination()
    assert sorted((r.pk, r.sink_table) for r in job.accepted(spark).collect()) == [("0", "dim_0"), ("1", "dim_1"), ("2", "dim_2")]


# --- messages that were sent again ------------------------------------------------------------


def test_a_stream_of_messages_reads_each_once(spark):
    path, out = new_path(spark, "sent"), new_path(spark, "read")
    schema = "topic string, value binary, headers array<struct<key: string, value: binary>>, partition int, offset bigint, timestamp timestamp"

    def deliver(rows):
        rows = [(t, v.encode(), h and [("weir-id", h.encode())], 0, o, None) for t, v, h, o in rows]
        sent = spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_millis(F.lit(1_600_000_000_000)))
        sent.write.mode("append").parquet(path)
        stream = topics.from_kafka_once(spark.readStream.schema(schema).parquet(path))
        query = stream.writeStream.option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start(out)
        query.awaitTermination()

    deliver([("p", "a", "1/p/0", 0), ("p", "b", "2/p/0", 1), ("p", "a", "1/p/0", 2), ("p", "c", None, 3)])
    deliver([("p", "b", "2/p/0", 4), ("p", "d", "3/p/0", 5), ("p", "c", None, 6)])
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "c", "d"]


# --- keyed state ------------------------------------------------------------------------------


def test_keyed_state_starts_from_a_table_and_keeps_what_it_has(spark):
    from weir.streaming.visit_state import VisitState

    path = new_path(spark, "topic")
    earlier = spark.sql("SELECT 'old' AS mid, DATE'2020-01-01' AS first_date")
    state = VisitState(new_path(spark, "job"), earlier)
    for n, batch in enumerate(BATCHES + [[log(mid="old", ts=T)] + [log(mid="hot", ts=T + i * DAY) for i in range(50)]]):
        messages(spark, batch, n * 100).write.mode("append").parquet(path)
        state.start(topics.stream_files(spark, path), availableNow=True).awaitTermination()
    found = {(r.mid, str(r.first_date)) for r in state.visits(spark).collect()}
    assert found == {("old", "2020-01-01"), ("a", "2020-06-14"), ("b", "2020-06-13"), ("c", "2020-06-14"), ("d", "2020-06-15"), ("hot", "2020-06-14")}


def test_keyed_state_starts_in_a_session_with_the_default_store(spark):
    from weir.streaming.visit_state import VisitState

    setting = "spark.sql.streaming.stateStore.providerClass"
    own, default = spark.conf.get(setting), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    path = new_path(spark, "topic")
    messages(spark, [log(mid="a", ts=T)], 0).write.parquet(path)
    state = VisitState(new_path(spark, "job"), spark.sql("SELECT 'old' AS mid, DATE'2020-01-01' AS first_date"))
    spark.conf.set(setting, default)
    try:
        state.start(topics.stream_files(spark, path), availableNow=True).awaitTermination()
        assert spark.conf.get(setting) == default
    finally:
        spark.conf.set(setting, own)
    assert {r.mid for r in state.visits(spark).collect()} == {"old", "a"}


def test_a_batch_of_logs_is_parsed_once(spark, monkeypatch):
    from weir.operators import visitors

    plans, first_visits = [], visitors.first_visits

    def recorded(logs, *args, **options):
        plans.append(logs._jdf.queryExecution().optimizedPlan().toString())
        return first_visits(logs, *args, **options)

    monkeypatch.setattr(visitors, "first_visits", recorded)
    LogJob(new_path(spark, "job")).process(messages(spark, [log(), log(mid="b")], 0), 0)
    above, kept, _ = plans[0].partition("InMemoryRelation")
    assert kept and "parse_json" not in above


def test_stored_messages_meet_by_id_in_small_partitions(spark, monkeypatch):
    path = new_path(spark, "sent")
    LogJob(new_path(spark, "job"), sink=lambda rows, _: topic_sinks.kafka_messages(rows).write.mode("append").parquet(path)).process(
        messages(spark, [log(mid=f"m{i}", ts=T + i) for i in range(300)], 0), 0
    )
    read = lambda: spark.read.parquet(path).unionByName(spark.read.parquet(path)).select(
        "topic", F.col("value").cast("binary").alias("value"), "headers", F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"),
    )
    monkeypatch.setattr(topics, "_ONCE_BYTES", 500)
    once = topics.from_kafka_once(read())
    ids = [r.id for r in once.collect()]
    assert len(ids) == len(set(ids)) >= 300
    assert once.rdd.getNumPartitions() > 8  # spark.sql.shuffle.partitions
