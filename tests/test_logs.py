"""The log flow on samples and on one record per rule."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests import samples
from weir.operators import split, visitors
from weir.plans import log_flow

DAY = 86_400_000


def canonical(value):
    return json.dumps(value, sort_keys=True)


def topic(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def run(spark, values, **options):
    """Messages of each topic, parsed: ``{topic: [(seq, object, reason), ...]}``."""
    result = {name: [] for name in split.TOPICS}
    rows = log_flow.split_logs(topic(spark, values), **options).orderBy("seq", "topic").collect()
    for row in rows:
        body = row.value if row.topic == split.DIRTY else json.loads(row.value)
        if row.topic in (split.DISPLAY, split.ACTION):
            body["common"] = canonical(json.loads(body["common"]))
        result[row.topic].append((row.seq, body, row.reason))
    return result


def log(mid="m", is_new="1", ts=1592140987000, **members):
    common = {"mid": mid, "is_new": is_new}
    members.setdefault("page", {"page_id": "p"})
    record = {"common": {k: v for k, v in common.items() if v is not None}, "ts": ts, **members}
    return json.dumps({k: v for k, v in record.items() if v != "absent"})


def test_samples(spark):
    out = run(spark, samples.APP_LOGS)
    counts = {name: len(rows) for name, rows in out.items()}
    assert counts == {
        split.ERROR: 2, split.START: 2, split.PAGE: 4, split.DISPLAY: 26, split.ACTION: 3, split.DIRTY: 0,
    }
    originals = [json.loads(v) for v in samples.APP_LOGS]
    assert [(s, b) for s, b, _ in out[split.ERROR]] == [(1, originals[1]), (4, originals[4])]
    for seq, body, _ in out[split.START]:
        assert body == {k: v for k, v in originals[seq].items() if k != "err"}
    for seq, body, _ in out[split.PAGE]:
        gone = ("err", "displays", "actions")
        assert body == {k: v for k, v in originals[seq].items() if k not in gone}
    for seq, body, _ in out[split.DISPLAY]:
        assert json.loads(body.pop("common")) == originals[seq]["common"]
        assert body.pop("page_id") == originals[seq]["page"]["page_id"]
        assert body.pop("ts") == originals[seq]["ts"]
        assert body in originals[seq]["displays"]
    for seq, body, _ in out[split.ACTION]:
        assert json.loads(body.pop("common")) == originals[seq]["common"]
        assert body.pop("page_id") == originals[seq]["page"]["page_id"]
        assert body in originals[seq]["actions"]


DIRTY = [
    ("", "not_json"),
    ("not json", "not_json"),
    ("[1]", "not_json"),
    ("null", "not_json"),
    ('{"page":{},"ts":1}', "no_common"),
    ('{"common":5,"page":{},"ts":1}', "no_common"),
    (log(mid=None), "no_mid"),
    (log(ts="absent"), "no_ts"),
    (log(ts=2**63 - 1), "no_ts"),
    (log(page="absent"), "no_page"),
    (log(page=7), "no_page"),
]


@pytest.mark.parametrize("value, reason", DIRTY)
def test_dirty(spark, value, reason):
    out = run(spark, [value])
    assert out[split.DIRTY] == [(0, value, reason)]
    assert sum(len(rows) for rows in out.values()) == 1


def test_error_without_page_is_still_reported(spark):
    out = run(spark, [log(page="absent", err={"error_code": 1})])
    assert len(out[split.ERROR]) == 1 and out[split.DIRTY][0][2] == "no_page"
    assert not out[split.PAGE]


def test_presence(spark):
    out = run(spark, [log(err=None), log(err={}), log(err=""), log(start=None), log(start={}), log(start="x")])
    assert [s for s, *_ in out[split.ERROR]] == [1, 2]
    assert [s for s, *_ in out[split.START]] == [4, 5]
    assert [b["start"] for _, b, _ in out[split.START]] == [{}, "x"]
    assert [s for s, *_ in out[split.PAGE]] == [0, 1, 2, 3]


def test_start_keeps_displays_and_unknown_members_survive(spark):
    out = run(spark, [log(start={"entry": "icon"}, displays=[{"item": "1"}], extra={"a": [1, "x"]}, other=1.5)])
    body = out[split.START][0][1]
    assert body["displays"] == [{"item": "1"}] and body["extra"] == {"a": [1, "x"]} and body["other"] == 1.5
    assert not out[split.DISPLAY] and not out[split.PAGE]


def test_elements(spark):
    elements = [
        {}, None, 5, "s", {"ts": -1}, {"ts": -1, "a": "x,}\"]"}, {"a": {"ts": 1}, "ts": 2}, {"common": "c", "page_id": 1},
        {"b": None, "n": 1},
    ]
    plain = [e for e in elements if isinstance(e, dict)]
    out = run(spark, [log(displays=elements, actions=elements), log(displays=plain, actions=plain)])
    for name, gone in ((split.DISPLAY, ("common", "page_id", "ts")), (split.ACTION, ("common", "page_id"))):
        for seq in (0, 1):
            bodies = [b for s, b, _ in out[name] if s == seq]
            assert len(bodies) == len(plain)
            expected = []
            for element in plain:
                kept = {k: v for k, v in element.items() if k not in gone and v is not None}
                kept["page_id"] = "p"
                if name == split.DISPLAY:
                    kept["ts"] = 1592140987000
                expected.append(kept)
            found = [{k: v for k, v in b.items() if k != "common"} for b in bodies]
            assert sorted(map(canonical, found)) == sorted(map(canonical, expected))
    assert run(spark, [log(displays=[], actions={})])[split.PAGE]


NUMBERS = ["1.0", "100.00", "-0.0", "12345678.90", "1e400", "1E+2", "0.12345678901234567890123", "123456789012345678901234567890", "7"]


@pytest.mark.parametrize("other", ["", '"null"', '"12345678901234567"', "null", '"q\\"12.50, 3:"', "[1.50,null]", '"\u4e2d"'])
def test_numbers_keep_their_text_whatever_else_there_is(spark, other):
    """Texts are compared, not parsed values."""
    values = []
    for i, n in enumerate(NUMBERS):
        x = f',"other":{other}' if other else ""
        values.append(
            f'{{"common":{{"is_new":"1","mid":"m{i}","c":{n}}},"page":{{"page_id":"p","x":{n}}},'
            f'"displays":[{{"item":"a","y":{n},"ts":1}}],"actions":[{{"action_id":"b","z":[{n}]}}],"ts":1592140987000{x}}}'
        )
    rows = log_flow.split_logs(topic(spark, values)).orderBy("seq", "topic").collect()
    rest = f',"other":{other}' if other and other != "null" else ""
    for i, n in enumerate(NUMBERS):
        out = {r.topic: r.value for r in rows if r.seq == i}
        common = f'{{"is_new":"1","mid":"m{i}","c":{n}}}'
        assert out[split.PAGE] == f'{{"common":{common},"page":{{"page_id":"p","x":{n}}},"ts":1592140987000{rest}}}'
        told = json.dumps(common)
        assert out[split.DISPLAY] == f'{{"item":"a","y":{n},"ts":1592140987000,"common":{told},"page_id":"p"}}'
        assert out[split.ACTION] == f'{{"action_id":"b","z":[{n}],"common":{told},"page_id":"p"}}'


def test_nulls_go_at_any_depth(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":null,"f":[null,{"g":null}],"t":"\\"y\\":null,"},"n":null}}},"z":null}'
    value = f'{{"common":{{"mid":"m","is_new":"1"}},"page":{{"page_id":"p","x":{deep}}},"displays":[{{"x":{deep}}}],"ts":1592140987000,"q":{deep}}}'
    kept = '{"a":{"b":{"c":{"d":{"f":[null,{}],"t":"\\"y\\":null,"}}}}}'
    rows = {r.topic: r.value for r in log_flow.split_logs(topic(spark, [value])).collect()}
    assert f'"page":{{"page_id":"p","x":{kept}}}' in rows[split.PAGE] and f'"q":{kept}' in rows[split.PAGE]
    assert f'"x":{kept}' in rows[split.DISPLAY]


@pytest.mark.parametrize("value", ['{"common":{"mid":"m"},"ts":01}', '{1:2}', '{"a":1.}', '{"a":-}', '{"a":1,}', '{"a":"\uffff1"}', '{"a":"\\uffff1"}'])
def test_marks_make_nothing_valid(spark, value):
    assert [r for _, _, r in run(spark, [value])[split.DIRTY]] == ["not_json"]


def repaired(spark, values):
    rows = log_flow.repaired_logs(topic(spark, values)).orderBy("seq").collect()
    return [row.is_new if row.reason is None else row.reason for row in rows]


T = 1592140987000


@pytest.mark.parametrize(
    "values, expected",
    [
        # claims on the first day stand, on any other day they fall, also on an earlier one
        ([log(ts=T), log(ts=T + 1), log(ts=T + DAY), log(ts=T - DAY)], ["1", "1", "0", "0"]),
        # a device that does not claim to be new was there the day before
        ([log(is_new="0", ts=T), log(ts=T), log(ts=T - DAY)], ["0", "0", "1"]),
        # a number counts as its text; a missing flag is no claim
        ([log(is_new=1, ts=T), log(is_new=1, ts=T + DAY)], ["1", "0"]),
        ([log(is_new=None, ts=T), log(ts=T)], [None, "0"]),
        # time as text
        ([log(ts=str(T)), log(ts=str(T + DAY))], ["1", "0"]),
        # a missing time matters to a claim, and to the first record of a device
        ([log(is_new="0", ts="absent"), log(ts=T), log(is_new="0", ts="absent"), log(ts="absent")],
         ["no_ts", "1", "0", "no_ts"]),
        # 15:59:59 and 16:00:00 UTC are two days at +8
        ([log(ts=1592150399999), log(ts=1592150400000)], ["1", "0"]),
    ],
)
def test_flag_rules(spark, values, expected):
    assert repaired(spark, values) == expected


def test_flip_reaches_every_message(spark):
    odd = json.dumps({"common": {"is_new": "1", "x": {"is_new": "1"}, "mid": "m"}, "ts": T + DAY,
                      "page": {"page_id": "p"}, "displays": [{"item": "1"}]})
    out = run(spark, [log(ts=T), log(ts=T + DAY, err={}, displays=[{}]), odd, log(is_new=1, ts=T + DAY)])
    assert [b["common"]["is_new"] for s, b, _ in out[split.PAGE]] == ["1", "0", "0", "0"]
    assert out[split.PAGE][2][1]["common"]["x"] == {"is_new": "1"}
    assert out[split.ERROR][0][1]["common"]["is_new"] == "0"
    assert [json.loads(b["common"])["is_new"] for _, b, _ in out[split.DISPLAY]] == ["0", "0"]


def brute_force_flags(logs):
    """(mid, is_new, day) in arrival order -> settled flags."""
    first, settled = {}, []
    for mid, is_new, day in logs:
        first.setdefault(mid, day if is_new == "1" else day - 1)
        settled.append("0" if is_new == "1" and day != first[mid] else is_new)
    return settled


def test_flags_against_brute_force_with_a_hot_device(spark):
    rng = random.Random(7)
    logs = [
        ("hot" if rng.random() < 0.4 else f"m{rng.randrange(50)}", rng.choice("01"), rng.randrange(4))
        for _ in range(3000)
    ]
    values = [log(mid=m, is_new=n, ts=T + d * DAY) for m, n, d in logs]
    assert repaired(spark, values) == brute_force_flags(logs)


def test_hot_device_is_split_in_the_join(spark):
    """Beyond the broadcast size the join is a shuffled one whose hot partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    ids = spark.range(0, 40_000, numPartitions=16)
    mid = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id").cast("string")))
    common = F.struct(mid.alias("mid"), F.lit("1").alias("is_new"), F.sha2(F.col("id").cast("string"), 512).alias("x"))
    body = F.struct(common.alias("common"), F.lit(T).alias("ts"), F.struct(F.lit("p").alias("page_id")).alias("page"))
    logs = visitors.parse_logs(ids.select(F.col("id").alias("seq"), F.to_json(body).alias("value")))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        visits = log_flow.written(visitors.first_visits(logs), "visits")
        out = visitors.repair_flags(split.cut(logs), visits)
        assert len(out.collect()) == 40_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_plans(spark, sf_dir):
    """One parse per message and side, aggregation combined before its shuffle, sources pruned."""
    from weir import fixtures

    parsed = visitors.parse_logs(fixtures.topic_log(spark, sf_dir)).where("reason IS NULL")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    visits = visitors.first_visits(parsed)
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert "partial_min_by" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "EventTimeWatermark" not in plan
