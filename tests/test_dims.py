"""Routing rules and dimension rows, one literal row per rule."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests import samples
from weir import fixtures
from weir.operators import dims, routing
from weir.sinks import tables
from weir.sources import rules


def feed(spark, *changes):
    """Rule changes ``(source, sink, columns, pk)``; None is a delete."""
    names = ("source_table", "sink_table", "sink_columns", "sink_pk")
    rows = [
        (seq, json.dumps({"after": None if c is None else dict(zip(names, c)), "op": "u", "ts_ms": seq}))
        for seq, c in enumerate(changes)
    ]
    return rules.from_change_feed(spark.createDataFrame(rows, "seq bigint, value string"))


def changes(spark, *messages):
    rows = [(seq, m if isinstance(m, str) or m is None else json.dumps(m)) for seq, m in enumerate(messages)]
    return dims.parse_changes(spark.createDataFrame(rows, "seq bigint, value string"))


def change(data, table="t", type="insert", **more):
    return {"database": "shop", "table": table, "type": type, "ts": 1652499161, "data": data, **more}


@pytest.mark.parametrize(
    "columns, pk, valid",
    [
        ("id,name", None, True),
        ("id,name,,", "id", True),
        ("id, name", "name", False),  # the key must equal a listed name exactly
        ("id,,name", "id", False),
        ("", "id", False),
        (",", "id", False),
        ("id,name", "code", False),
        ("a,b", "a,b", False),
        ("id,ID", "id", False),
        ("id,na me", "id", False),
        (None, "id", False),
    ],
)
def test_which_rules_are_valid(spark, columns, pk, valid):
    assert (routing.valid_rules(feed(spark, ("t", "dim_t", columns, pk))).count() == 1) is valid


def test_rules_without_names_are_invalid(spark):
    bad = [(None, "dim", "id", None), ("t", None, "id", None), ("t", "dim;x", "id", None), None]
    assert routing.valid_rules(feed(spark, *bad)).count() == 0


def test_last_valid_rule_wins_and_tables_are_not_altered(spark):
    given = feed(
        spark,
        ("t", "dim_t", "id,a", None),
        ("t", "dim_t", "id,a,b", None),
        None,
        ("t", "dim_t", "id,,", "nope"),
    )
    row = routing.routing_table(given).first()
    assert row.columns == ["id", "a", "b"] and row.table_columns == ["id", "a"] and row.table_pk == "id"
    routed = dims.route(changes(spark, change({"id": 1, "a": 2}), change({"id": 1, "b": 2})),
                        routing.routing_table(given))
    assert [(r.status, r.reason) for r in routed.orderBy("seq").collect()] == [
        ("accepted", None), ("rejected", "unknown_column"),
    ]


def test_sample_rule_and_snapshot(spark):
    topic = spark.createDataFrame([(5, samples.RULE_CHANGE), (6, "junk")], "seq bigint, value string")
    snapshot = spark.createDataFrame(
        [("from_here", "old", "id", None, None), ("zz", "dim_z", "id", None, "x")], ", ".join(
            f"{n} string" for n in rules.RULE_FIELDS)
    )
    both = rules.snapshot_then_changes(rules.from_snapshot(snapshot), rules.from_change_feed(topic))
    active = routing.active_rules(both).orderBy("source_table").collect()
    assert [(r.source_table, r.sink_table, r.sink_pk, r.sink_extend) for r in active] == [
        ("from_here", "to_there", "id", "more"), ("zz", "dim_z", "id", "x"),
    ]


def test_sample_change(spark):
    row = changes(spark, samples.CHANGE).first()
    assert (row.database, row.source_table, row.type, row.ts, row.xid, row.commit) == (
        "shop", "maker", "insert", 1700000000, 12, True,
    )
    assert row.data == {"id": "8", "name": "two", "logo": "/logo/8"}


def test_kept_changes(spark):
    messages = [change({}, type=t) for t in ("insert", "update", "bootstrap-insert", "delete", "bootstrap-start")]
    messages += [{"data": {}}, "junk", "[1]", change({}, database="other")]
    parsed = changes(spark, *messages)
    assert [r.seq for r in dims.kept_changes(parsed).orderBy("seq").collect()] == [0, 1, 2, 8]
    assert [r.seq for r in dims.kept_changes(parsed, "shop").orderBy("seq").collect()] == [0, 1, 2]
    assert [r.seq for r in dims.dirty_changes(parsed).orderBy("seq").collect()] == [6, 7]


def test_route(spark):
    table = routing.routing_table(feed(spark, ("t", "dim_t", "spu_id,tm_name,sinkTable", "spu_id")))
    parsed = changes(
        spark,
        change({"spu_id": 1, "tm_name": "it's", "id": 9, "name": "n", "other": 1}),
        change({"tm_name": "x"}),
        change(None),
        change({"spu_id": ""}),
        change({"spu_id": 2, "tm_name": None, "sinkTable": "evil"}),
        change({"id": 1}, table="u"),
        change({"id": 1}, table=None),
        "junk",
    )
    exact = dims.route(parsed, table).orderBy("seq").collect()
    assert [(r.status, r.reason, r.pk, r.data) for r in exact] == [
        ("accepted", None, "1", {"spu_id": "1", "tm_name": "it's"}),
        ("rejected", "no_key", None, {"tm_name": "x"}),
        ("rejected", "no_data", None, None),
        ("rejected", "no_key", None, {"spu_id": None}),
        ("accepted", None, "2", {"spu_id": "2", "tm_name": None}),
        ("unmatched", None, None, None),
        ("unmatched", None, None, None),
        ("dirty", "not_json", None, None),
    ]
    assert [r.value is None for r in exact] == [True, False, False, False, True, False, False, False]
    loose = dims.route(parsed, table, "substring").orderBy("seq").first()
    assert (loose.status, loose.reason) == ("rejected", "unknown_column")
    assert sorted(loose.data) == ["id", "name", "spu_id", "tm_name"]
    with pytest.raises(ValueError):
        dims.project(F.col("data"), "regex")


def brute_force_rows(rows):
    state = {}
    for seq, table, pk, data in sorted(rows):
        state.setdefault((table, pk), {}).update(data)
    return state


def test_latest_rows_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(2000):
        pk = "hot" if rng.random() < 0.4 else str(rng.randrange(60))
        data = {c: rng.choice([None, str(seq)]) for c in "abc" if rng.random() < 0.5}
        rows.append((seq, rng.choice(["x", "y"]), pk, {"k": pk, **data}))
    df = spark.createDataFrame(rows, "seq bigint, sink_table string, pk string, data map<string,string>").repartition(8)
    expected = brute_force_rows(rows)
    wide = {(r.sink_table, r.pk): r for r in dims.latest_rows(df, ["k", "a", "b", "c"]).collect()}
    assert wide.keys() == expected.keys()
    assert all(wide[k][c] == expected[k].get(c) for k in expected for c in "kabc")
    maps = {(r.sink_table, r.pk): r["data"] for r in dims.latest_maps(df).collect()}
    assert maps == expected


def test_tables_are_created_once_and_published(spark):
    given = feed(spark, ("t", "dim_pub", "id,a", None), ("u", "dim_other", "code", "code"))
    assert tables.create_tables(spark, routing.target_tables(given)) == ["dim_other", "dim_pub"]
    later = feed(spark, ("t", "dim_pub", "id,a,b", None))
    tables.create_tables(spark, routing.target_tables(later))
    assert spark.table("dim_pub").dtypes == [("id", "string"), ("a", "string")]
    rows = spark.createDataFrame(
        [(0, "dim_pub", "1", {"id": "1", "a": "x"}), (1, "dim_pub", "1", {"id": "1"}), (2, "dim_other", "2", {"code": "2"})],
        "seq bigint, sink_table string, pk string, data map<string,string>",
    )
    for _ in range(2):
        tables.publish(spark, rows, "dim_pub")
    assert [tuple(r) for r in spark.table("dim_pub").collect()] == [("1", "x")]
    assert spark.table("dim_other").count() == 0


def test_plans(spark, sf_dir):
    """The join with few rules is a broadcast one, no change is shuffled; updates combine before the shuffle."""
    from weir.plans import dim_flow

    routed = dim_flow.routed_changes(fixtures.topic_db(spark, sf_dir), fixtures.routing_changes(spark))
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rows = dim_flow.dimension_cells(fixtures.topic_db(spark, sf_dir), fixtures.routing_changes(spark))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_rules_that_arrive_together_have_one_order(spark):
    names = ", ".join(f"{n} string" for n in rules.RULE_FIELDS)
    rows = [("b", "dim", "id,b", None, None), ("a", "dim", "id,a", None, None), ("a", "dim", "id,c", None, None)]
    found = set()
    for given in (rows, rows[::-1], rows[1:] + rows[:1]):
        table = routing.routing_table(rules.from_snapshot(spark.createDataFrame(given, names)))
        found.add(tuple(sorted((r.source_table, r.sink_columns, tuple(r.table_columns)) for r in table.collect())))
    assert found == {(("a", "id,c", ("id", "a")), ("b", "id,b", ("id", "a")))}


# --- rules in force when a change arrived -----------------------------------------------------


def test_a_change_goes_by_the_rule_of_its_time(spark):
    given = feed(spark, ("t", "dim_a", "id,a", None), None, ("t", "dim_b", "id,a", None), ("t", "bad", "x", None), ("t", "dim_a", "id,b", None), ("u", "dim_u", "id", None))
    periods = routing.rule_periods(given)
    got = {(r.source_table, r.from_seq, r.to_seq, r.sink_table, tuple(r.table_columns)) for r in periods.collect()}
    assert got == {("t", 0, 2, "dim_a", ("id", "a")), ("t", 2, 4, "dim_b", ("id", "a")), ("t", 4, None, "dim_a", ("id", "a")), ("u", 5, None, "dim_u", ("id",))}
    topic = changes(spark, *[change({"id": i, "a": 1}) for i in range(6)], "junk", change({"id": 7}, table="u"), change({"id": 8}, table="none"))
    routed = dims.route_as_of(topic, periods)
    rows = {r.seq: (r.sink_table, r.status) for r in routed.collect()}
    assert rows == {
        0: ("dim_a", "accepted"), 1: ("dim_a", "accepted"), 2: ("dim_b", "accepted"), 3: ("dim_b", "accepted"), 4: ("dim_a", "accepted"),
        5: ("dim_a", "accepted"), 6: (None, "dirty"), 7: ("dim_u", "accepted"), 8: (None, "unmatched"),
    }
    assert {r.seq: sorted(r.data) for r in routed.where("seq > 3 AND seq < 6").collect()} == {4: ["id"], 5: ["id"]}
    early = dims.route_as_of(changes(spark, change({"id": 1}, table="u")), periods)
    assert [r.status for r in early.collect()] == ["unmatched"]
    assert dims.route_as_of(topic, routing.rule_periods(feed(spark))).where("status <> 'unmatched' AND status <> 'dirty'").count() == 0


def test_known_rules_hold_from_the_beginning(spark):
    known = routing.lasting_rules(feed(spark, ("t", "dim_a", "id,a", None), ("t", "dim_b", "id", None), ("t", "dim_c", "id", None)))
    assert {(r.seq, r.rule.sink_table) for r in known.collect()} == {(0, "dim_a"), (1, "dim_b"), (2, "dim_c")}
    new = rules.from_change_feed(spark.createDataFrame([(9, json.dumps({"after": {"source_table": "t", "sink_table": "dim_a", "sink_columns": "id,b", "sink_pk": None}}))], "seq bigint, value string"))
    got = {(r.from_seq, r.to_seq, r.sink_table, tuple(r.table_columns)) for r in routing.rule_periods(new, known).collect()}
    assert got == {(-1, 9, "dim_c", ("id",)), (9, None, "dim_a", ("id", "a"))}


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)"])
def test_many_rules_of_one_source(spark, kind):
    """Places in the order are found through bins, whatever numbers they are, with one row for a change."""
    from weir.streaming.storage import written

    rng, step = random.Random(3), 10**6 if kind == "bigint" else 10**30
    at = sorted(rng.sample(range(1, 400), 150))
    names = ("source_table", "sink_table", "sink_columns")
    rows = [(n * step, json.dumps({"after": dict(zip(names, ("t", f"dim_{n}", "id")))})) for n in at]
    given = rules.from_change_feed(spark.createDataFrame([(str(s), v) for s, v in rows], "seq string, value string").withColumn("seq", F.col("seq").cast(kind)))
    topic = [(str(n * step + d), json.dumps(change({"id": 1}))) for n in range(0, 420, 3) for d in (-1, 0, 1) if n + d >= 0]
    topic = spark.createDataFrame(topic, "seq string, value string").withColumn("seq", F.col("seq").cast(kind))
    routed = dims.route_as_of(dims.parse_changes(topic), written(routing.rule_periods(given), "periods"))
    found = {int(r.seq): r.sink_table for r in routed.collect()}
    assert len(found) == topic.count()
    for seq, sink in found.items():
        before = [n for n in at if n * step <= seq]
        assert sink == (f"dim_{before[-1]}" if before else None)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {int(r.seq): r.sink_table for r in routed.select("*").collect()} == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- rules too many to broadcast, snapshots with a position -----------------------------------


def test_a_hot_table_is_spread(spark):
    """One table with nine tenths of the changes, nothing broadcast: its changes lie in many partitions, rows are the same."""
    body = "concat('{\"table\":\"', if(id % 10 = 0, concat('t', id % 70), 'hot'), '\",\"type\":\"insert\",\"data\":{\"id\":', id, '}}')"
    topic = spark.range(0, 8000, numPartitions=8).selectExpr("id AS seq", f"if(id % 97 = 0, 'junk', {body}) AS value")
    given = routing.routing_table(feed(spark, ("hot", "dim_hot", "id", None), *[(f"t{n}", f"dim_{n}", "id", None) for n in range(0, 70, 20)]))
    made = dims.kept_changes(dims.parse_changes(topic), with_dirty=True)
    assert dims.hot_tables(made) == ["hot"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = dims.route_spread(made, given, salts=16)
        plan = spread._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        got = sorted(tuple(r) for r in spread.select("seq", "sink_table", "pk", "status").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(tuple(r) for r in dims.route(made, given).select("seq", "sink_table", "pk", "status").collect()) and len(got) == 8000
    keys = made.where("source_table = 'hot'").select(F.hash("source_table", F.pmod(F.xxhash64("seq"), F.lit(16)).cast("int")).alias("h"))
    sizes = [r["count"] for r in keys.groupBy("h").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16


def positioned(seq, file, pos, sink, snapshot="false"):
    after = {"source_table": "t", "sink_table": sink, "sink_columns": "id", "sink_pk": None}
    return seq, json.dumps({"after": after, "source": {"file": file, "pos": pos, "snapshot": snapshot}})


def test_hand_over_from_snapshot_to_feed(spark):
    messages = [
        positioned(0, "bin.000003", 50, "late"), positioned(1, "bin.000002", 10, "at"), positioned(2, "bin.000002", 9, "before"),
        positioned(3, "bin.000010", 1, "last"), positioned(4, "bin.000011", 5, "own", "true"), positioned(5, None, 5, "nowhere"), (6, "junk"),
        (7, json.dumps({"after": None, "source": {"file": "bin.000004", "pos": 1}})),
    ]
    fed = rules.from_positioned_feed(spark.createDataFrame(messages, "seq bigint, value string"))
    names = ", ".join(f"{n} string" for n in rules.RULE_FIELDS)
    snapshot = rules.from_snapshot(spark.createDataFrame([("t", "taken", "id", None, None), ("u", "dim_u", "id", None, None)], names))
    given = rules.hand_over(snapshot, rules.log_position(F.lit("bin.000002"), F.lit(10)), fed)
    rows = [(r.seq, r.rule and r.rule.sink_table) for r in given.orderBy("seq").collect()]
    assert [sink for _, sink in rows] == ["taken", "dim_u", "late", None, "last"]
    assert {r.source_table: r.sink_table for r in routing.active_rules(given).collect()} == {"t": "last", "u": "dim_u"}


def test_all_cores_read_the_changes_of_a_large_table(spark, tmp_path):
    rows = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
    rows.coalesce(1).write.parquet(str(tmp_path / "large"))
    rows.limit(10).coalesce(1).write.parquet(str(tmp_path / "small"))
    large, small = (fixtures._spread(spark.read.parquet(str(tmp_path / t)), "id") for t in ("large", "small"))
    assert large.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and small.rdd.getNumPartitions() == 1
    assert large.count() == 60000
