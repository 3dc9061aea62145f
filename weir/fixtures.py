"""Topics derived from the test tables, and the literal routing rules.

Each topic is computed by Spark from whole tables, so the work of a query on it grows with them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import dates
from weir.sources import topics
from weir.streaming.storage import written

# Routing changes (seq, op, ts_ms, source_table, sink_table, sink_columns, sink_pk).
RULE_CHANGES = (
    (1, "r", 1, "customer", "dim_customer_old", "c_custkey,c_name", "c_custkey"),
    (2, "u", 2, "customer", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey"),
    (3, "r", 1, "supplier", "dim_supplier", "s_suppkey, s_name_full", "s_suppkey"),
    (4, "c", 1, "nation", "dim_nation", "id,n_name", None),
    (5, "d", 5, None, None, None, None),
    (6, "c", 6, None, "dim_x", "id", None),
    (7, "c", 7, "part", "dim_part", None, "p_partkey"),
    (8, "u", 8, "part", "dim_part", "p_partkey,p_name", "p_partkey,p_name"),
    (9, "u", 9, "nation", "dim_nation_bad", "id,n_name", "nope"),
)


# Bytes on disk below which one task writes and reads all messages of a table in little time.
_SMALL_TABLE = 256 << 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _message(seq: Column, junk: Column, body: Column) -> Column:
    return F.when(junk, F.concat(F.lit("junk "), _text(seq))).otherwise(F.to_json(body))


def _with_tombstones(topic: DataFrame, raw: bool) -> DataFrame:
    """Every fiftieth message twice, the second time as a tombstone; the source drops these unless ``raw``."""
    values = F.when(F.col("seq") % 50 == 0, F.array("value", F.lit(None))).otherwise(F.array("value"))
    noisy = topic.select("seq", F.explode(values).alias("value"))
    return noisy if raw else topics.messages(noisy)


def topic_log(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """App logs, one per row of ``events``, and some tombstones."""
    i, kind, ms = F.col("event_id"), F.col("event_type"), F.col("ms")
    even = i % 2 == 0
    shows = kind.isin("view", "purchase") | (kind.isin("signup", "error") & even)
    acts = kind.isin("click", "purchase")

    displays = F.transform(
        F.sequence(F.lit(1), (1 + i % 4).cast("int")),
        lambda n: F.struct(_text("user_id").alias("item"), n.alias("order"), F.lit(-1).alias("ts")),
    )
    actions = F.transform(
        F.sequence(F.lit(1), (1 + i % 2).cast("int")),
        lambda n: F.struct(F.concat(F.lit("a"), _text(n)).alias("action_id"), (ms + n).alias("ts")),
    )
    body = F.struct(
        F.struct(
            F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
            _text("user_id").alias("uid"),
            F.when(i % 3 != 0, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        ms.alias("ts"),
        F.when(
            kind == "signup", F.struct(F.lit("icon").alias("entry"), (i % 20000).alias("loading_time"))
        ).alias("start"),
        F.when(kind != "signup", F.struct(kind.alias("page_id"), (i % 5000).alias("during_time"))).alias("page"),
        F.when(shows, displays).alias("displays"),
        F.when(acts, actions).alias("actions"),
        F.when(kind == "error", F.struct((i % 4000).alias("error_code"))).alias("err"),
    )
    # As many partitions as a topic that all cores read, at every size.
    events = _table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism, "event_id")
    events = events.select(
        "event_id", "user_id", "event_type", dates.epoch_ms(F.col("ts")).alias("ms")
    )
    return _with_tombstones(events.select(i.alias("seq"), _message(i, i % 97 == 0, body).alias("value")), raw)


def topic_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App logs that carry each event's value as a number written in one of five ways; half of them also
    hold text that has nothing to do with it: the word null in quotes, or an id of twenty digits.
    """
    i, cents = F.col("event_id"), F.col("cents")
    whole = _text(F.floor(cents / 100))
    number = (
        F.when(i % 5 == 0, F.concat(whole, F.lit("."), F.lpad(_text(cents % 100), 2, "0")))
        .when(i % 5 == 1, F.concat(whole, F.lit(".0")))
        .when(i % 5 == 2, F.concat(F.lit("98765432"), F.lpad(_text(cents), 12, "0"), F.lit(".50")))
        .when(i % 5 == 3, F.concat(F.lit("-0."), F.lpad(_text(cents), 25, "0")))
        .otherwise(F.concat(_text(cents), F.lit("E+2")))
    )
    other = (
        F.when(i % 4 == 1, F.lit(',"other":"null"'))
        .when(i % 4 == 3, F.concat(F.lit(',"other":"12345678901234567890","gone":{"deep":{"er":[{"still":{"x":null}}]}}')))
        .otherwise("")
    )
    events = _table(spark, sf_dir, "events").select(
        "event_id", "user_id", dates.epoch_ms(F.col("ts")).alias("ms"),
        F.floor(F.abs(F.coalesce("value", F.lit(0.0))) * 100).cast("bigint").alias("cents"),
    )
    value = F.concat(
        F.lit('{"common":{"is_new":"0","mid":"m'), _text("user_id"), F.lit('"},"page":{"page_id":"p","x":'), number,
        F.lit('},"displays":[{"item":"a","y":'), number, F.lit('}],"ts":'), _text("ms"), other, F.lit("}"),
    )
    return events.select(i.alias("seq"), value.alias("value"))


def topic_db(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """Change log of four tables: an insert per row, some updates, some deletes, some tombstones."""
    tables = (
        # table, key, key's name in the record, name, further columns
        ("customer", "c_custkey", "c_custkey", "c_name", ("c_mktsegment", "c_acctbal")),
        ("supplier", "s_suppkey", "s_suppkey", "s_name", ("s_acctbal",)),
        ("nation", "n_nationkey", "id", "n_name", ("n_regionkey",)),
        ("part", "p_partkey", "p_partkey", "p_name", ("p_brand",)),
    )
    topics = [
        _changes(_spread(_table(spark, sf_dir, table).select(key, name, *further), key), table, number, key, key_name, name, further)
        for number, (table, key, key_name, name, further) in enumerate(tables)
    ]
    union = topics[0]
    for topic in topics[1:]:
        union = union.unionByName(topic)
    return _with_tombstones(union, raw)


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows as a topic gives them that all cores read, however few files a table has. One task reads a small table as it is."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size < _SMALL_TABLE else df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _changes(
    df: DataFrame, table: str, number: int, key: str, key_name: str, name: str, further: tuple[str, ...]
) -> DataFrame:
    k, version = F.col("k"), F.col("version")
    versions = F.filter(
        F.array(F.lit(0), F.when(k % 2 == 0, 1), F.when(k % 10 == 0, 2)), lambda n: n.isNotNull()
    )
    seq = (k * 3 + version) * 4 + number
    whole = version != 1
    data = F.struct(
        _text(k).alias(key_name),
        F.concat(F.col(name), F.lit("_v"), _text(version)).alias(name),
        *[F.when(whole, F.col(c)).alias(c) for c in further],
    )
    kind = (
        F.when(version == 1, "update")
        .when(version == 2, "delete")
        .when(k % 5 == 0, "bootstrap-insert")
        .otherwise("insert")
    )
    body = F.struct(
        F.lit("shop").alias("database"),
        F.lit(table).alias("table"),
        kind.alias("type"),
        (F.lit(1652499161) + version).alias("ts"),
        data.alias("data"),
    )
    return (
        df.select(F.col(key).cast("bigint").alias("k"), name, *further)
        .withColumn("version", F.explode(versions))
        .select(seq.alias("seq"), _message(seq, seq % 101 == 0, body).alias("value"))
    )


def routing_changes(spark: SparkSession) -> DataFrame:
    """The nine literal routing changes as Debezium messages ``(seq, value)``."""

    def message(op: str, ts_ms: int, source, sink, columns, pk) -> str:
        fields = {"source_table": source, "sink_table": sink, "sink_columns": columns, "sink_pk": pk}
        after = None if op == "d" else fields
        return json.dumps({"before": None, "after": after, "op": op, "ts_ms": ts_ms})

    rows = [(seq, message(op, ts_ms, *rule)) for seq, op, ts_ms, *rule in RULE_CHANGES]
    values = ", ".join(f"({seq}L, '{value}')" for seq, value in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(seq, value)")


def routing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of rules, one per row of ``nation``; five sources share each target, with different columns."""
    k = F.col("n_nationkey")
    return _table(spark, sf_dir, "nation").select(
        F.concat(F.lit("src_"), _text(k)).alias("source_table"),
        F.concat(F.lit("dim_shared_"), _text(k % 5)).alias("sink_table"),
        F.concat(F.lit("id,n"), _text(k)).alias("sink_columns"),
        F.lit(None).cast("string").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"),
    )


def routing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing changes, one per row of ``part``: about fifty source tables whose rules keep changing."""
    k = F.col("k")

    def pick(modulus: int, *choices: str | None) -> Column:
        chosen = F.lit(None).cast("string")
        for remainder, choice in enumerate(choices):
            if choice is not None:
                chosen = F.when(k % modulus == remainder, F.lit(choice)).otherwise(chosen)
        return chosen

    after = F.struct(
        F.when(k % 13 != 0, F.concat(F.lit("src_"), _text("p_size"))).alias("source_table"),
        F.concat(F.lit("dim_"), F.lower("p_type"), F.lit("_"), _text(k % 3)).alias("sink_table"),
        F.when(
            k % 17 != 0, pick(5, "id,name,", "id, name,extra", "name,id", "code,,id", "code,label")
        ).alias("sink_columns"),
        pick(4, None, "id", "code", "id,name").alias("sink_pk"),
    )
    body = F.struct(
        F.when(k % 11 != 0, after).alias("after"),
        F.when(k % 11 == 0, "d").when(k % 7 == 0, "r").otherwise("u").alias("op"),
        (F.lit(1652513039000) + k).alias("ts_ms"),
    )
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_size", "p_type")
    return part.select(k.alias("seq"), F.to_json(body).alias("value"))


# Where the log stood when the snapshot of :func:`positioned_feed` was taken.
SNAPSHOT_FILE, SNAPSHOT_POS = "bin.000003", 4000


def positioned_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of :func:`routing_feed` with log positions: five files that arrive in the wrong order, some rows of a snapshot
    of the connector's own among them.
    """
    k = F.col("seq")
    source = F.struct(
        F.concat(F.lit("bin."), F.lpad(_text(5 - k % 5), 6, "0")).alias("file"),
        (k * 7).alias("pos"),
        F.when(k % 19 == 0, "true").otherwise("false").alias("snapshot"),
    )
    body = F.concat(F.substring("value", F.lit(1), F.length("value") - 1), F.lit(',"source":'), F.to_json(source), F.lit("}"))
    return routing_feed(spark, sf_dir).select("seq", body.alias("value"))


def routing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing changes, one per row of ``supplier``, that arrive all through :func:`topic_db`.

    Targets, columns and keys of the four sources keep changing; some rules are invalid, some changes are deletes.
    """
    k = F.col("s_suppkey").cast("bigint")
    source, key, name = F.col("names")[0], F.col("names")[1], F.col("names")[2]
    sources = [("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("nation", "id", "n_name"), ("part", "p_partkey", "p_name")]
    names = F.array(*[F.array(*[F.lit(x) for x in names]) for names in sources])
    orders = F.array(F.concat(key, F.lit(","), name), F.concat(name, F.lit(","), key), key, F.concat(key, F.lit(", "), name), F.lit(None))
    after = F.struct(
        source.alias("source_table"),
        F.concat(F.lit("dim_"), source, F.lit("_"), _text(F.floor(k / 4) % 3)).alias("sink_table"),
        F.get(orders, (k % 5).cast("int")).alias("sink_columns"),
        F.when(k % 3 == 0, None).when(k % 7 == 3, "nope").otherwise(key).alias("sink_pk"),
    )
    body = F.struct(F.when(k % 11 != 0, after).alias("after"), F.when(k % 11 == 0, "d").otherwise("u").alias("op"))
    suppliers = _table(spark, sf_dir, "supplier").withColumn("names", F.get(names, (k % 4).cast("int")))
    return suppliers.select((k * 180).alias("seq"), F.to_json(body).alias("value"))


def write_slices(topic: DataFrame, slices: int, path: str, *others: tuple[DataFrame, str]):
    """Append ``topic`` to ``path`` in ``slices`` steps of rising ``seq``; yields after each.

    Stands in for messages that keep arriving. ``others``, each with its path, arrive along with it, cut at the same places.
    """
    staged = [(written(df, "staged-topic"), at) for df, at in ((topic, path), *others)]  # made once, however many slices
    top = staged[0][0].agg(F.max("seq")).first()[0]
    bounds = [top * n // slices for n in range(1, slices)] + [top]
    low = -1
    for high in bounds:
        for df, at in staged:
            df.where((F.col("seq") > low) & (F.col("seq") <= high)).write.mode("append").parquet(at)
        yield path
        low = high
