"""Database changes to dimension tables: filter, route, keep columns, resolve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions import records
from weir.operators import routing
from weir.streaming.storage import written

# Change types that carry a row to keep.
KEPT_TYPES = ("insert", "update", "bootstrap-insert")

# Fixed value: this field of a row is reserved for routing and never stored.
RESERVED = "sinkTable"

ACCEPTED, UNMATCHED, REJECTED, DIRTY = "accepted", "unmatched", "rejected", "dirty"
NO_DATA, NO_KEY, UNKNOWN_COLUMN, NOT_JSON = "no_data", "no_key", "unknown_column", "not_json"


def parse_changes(topic: DataFrame) -> DataFrame:
    """``(seq, value)`` to the change envelope, one row per message.

    ``is_json`` is false for a message that is not a JSON object; ``data`` is the row image as
    text values.
    """
    v = F.col("v")
    row = F.struct(
        "seq",
        "value",
        records.is_object(v).alias("is_json"),
        records.get_string(v, "$.database").alias("database"),
        records.get_string(v, "$.table").alias("source_table"),
        records.get_string(v, "$.type").alias("type"),
        records.get_long(v, "$.ts").alias("ts"),
        records.get_long(v, "$.xid").alias("xid"),
        F.try_variant_get(v, "$.commit", "boolean").alias("commit"),
        records.get_text_object(v, "$.data").alias("data"),
    )
    # The generator keeps later filters from parsing every message again.
    return topic.select("seq", "value", records.parse("value").alias("v")).select(F.inline(F.array(row)))


def kept_changes(
    changes: DataFrame, database: str | None = None, with_dirty: bool = False
) -> DataFrame:
    """Inserts, updates and bootstrap rows; optionally of one database only.

    ``with_dirty`` also lets messages through that are not JSON, for :func:`route` to mark.
    """
    kept = F.col("type").isin(*KEPT_TYPES)
    if database is not None:
        kept = kept & (F.col("database") == database)
    if with_dirty:
        kept = ~F.col("is_json") | kept
    return changes.where(kept)


def dirty_changes(changes: DataFrame) -> DataFrame:
    return changes.where(~F.col("is_json"))


def project(data: Column, match: str = "exact") -> Column:
    """Keep the columns the rule lists.

    ``exact``: the column is in the list. ``substring``: the column's name occurs anywhere in
    the text of the list, so a rule for ``spu_id`` also keeps ``id``.
    """
    if match == "exact":
        def listed(k: Column, _: Column) -> Column:
            return F.array_contains("columns", k)
    elif match == "substring":
        def listed(k: Column, _: Column) -> Column:
            return F.contains(F.col("sink_columns"), k)
    else:
        raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
    return F.map_filter(data, listed)


def route(changes: DataFrame, rules: DataFrame, match: str = "exact") -> DataFrame:
    """Match kept changes with the rules in force (``routing.routing_table``); every change comes out with a ``status``.

    ``seq, source_table, sink_table, pk, data, status, reason, value``; ``value`` is the message,
    kept only where the row is not accepted. The routing table holds one row per source table;
    Spark broadcasts it when its size allows.

    Empty text is stored as NULL, and a row without its key is rejected.
    """
    return _settled(changes.join(rules, "source_table", "left"), match)


# A source table is hot that has more than this share of all changes; there are 20 of them at most.
HOT_SHARE = 0.05
SALTS = 64


def hot_tables(changes: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """The source tables with more than ``share`` of all changes: fewer than ``1 / share`` names."""
    counts = written(changes.groupBy("source_table").agg(F.count("*").alias("n")), "table-counts")
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))
    hot = counts.join(total, F.col("n") > F.col("total") * share).where("source_table IS NOT NULL")
    return sorted(r.source_table for r in hot.collect())


def route_spread(changes: DataFrame, rules: DataFrame, match: str = "exact", salts: int = SALTS) -> DataFrame:
    """:func:`route` where the rules are too many to broadcast: changes are shuffled, those of hot source tables and those without
    one over ``salts`` keys. Only the rules of hot tables are copied, once for each key.

    Looks at ``changes`` twice, the first time at their source tables only.
    """
    hot = hot_tables(changes)
    is_hot, salt = F.col("source_table").isin(hot), F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("int")
    salted = changes.withColumn("salt", F.when(is_hot | F.col("source_table").isNull(), salt).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = rules.withColumn("salt", F.explode(copies))
    return _settled(salted.join(copied.hint("merge"), ["source_table", "salt"], "left"), match)


def route_as_of(changes: DataFrame, periods: DataFrame, match: str = "exact") -> DataFrame:
    """:func:`route` by the rule that was in force when the change arrived; see ``routing.rule_periods``.

    A change before the first rule of its table is unmatched. ``periods`` is a written table; Spark broadcasts it
    when its size allows, else both sides meet on the source table and a range of ``seq``.
    """
    changes, periods = routing.binned(changes, periods)
    periods = periods.withColumnRenamed("source_table", "of_table").withColumnRenamed("bin", "of_bin")
    in_force = (
        (F.col("source_table") == F.col("of_table"))
        & (F.col("bin") == F.col("of_bin"))
        & (F.col("seq") >= F.col("from_seq"))
        & (F.col("to_seq").isNull() | (F.col("seq") < F.col("to_seq")))
    )
    return _settled(changes.join(periods, in_force, "left"), match)


def _settled(joined: DataFrame, match: str) -> DataFrame:
    """What becomes of changes that have their rule beside them, or NULLs."""
    unmatched = F.col("sink_table").isNull()
    listed = F.map_filter(project(F.col("data"), match), lambda k, _: k != RESERVED)
    stored = F.transform_values(listed, lambda _, x: F.nullif(x, F.lit("")))
    strange = F.size(F.array_except(F.map_keys("data"), "table_columns")) > 0
    reason = (
        F.when(~F.col("is_json"), NOT_JSON)
        .when(unmatched, None)
        .when(F.col("data").isNull(), NO_DATA)
        .when(strange, UNKNOWN_COLUMN)
        .when(F.col("pk").isNull(), NO_KEY)
    )
    status = (
        F.when(~F.col("is_json"), DIRTY)
        .when(unmatched, UNMATCHED)
        .when(F.col("reason").isNull(), ACCEPTED)
        .otherwise(REJECTED)
    )
    return (
        joined.withColumn("data", F.when(~unmatched, stored))
        .withColumn("pk", F.try_element_at("data", F.col("table_pk")))
        .withColumn("reason", reason)
        .withColumn("status", status)
        .select(
            "seq",
            "source_table",
            "sink_table",
            "pk",
            "data",
            "status",
            "reason",
            F.when(F.col("status") != ACCEPTED, F.col("value")).alias("value"),
        )
    )


def accepted(routed: DataFrame) -> DataFrame:
    """Rows for a dimension table: ``(seq, sink_table, pk, data)``."""
    return routed.where(F.col("status") == ACCEPTED).select("seq", "sink_table", "pk", "data")


def latest_rows(rows: DataFrame, columns: list[str], order: Column | str = "seq") -> DataFrame:
    """The dimension rows now: ``sink_table, pk`` and, per column, the last value written to it.

    A change that lacks a column leaves it as it was; a NULL overwrites. One aggregation, one
    shuffle on ``(sink_table, pk)``, combined before the shuffle.
    """
    position = F.col(order) if isinstance(order, str) else order

    def last(column: str) -> Column:
        written = F.when(F.map_contains_key("data", column), position)
        cell = F.struct(F.try_element_at("data", F.lit(column)).alias("value"))
        return F.max_by(cell, written)["value"].alias(column)

    return rows.groupBy("sink_table", "pk").agg(*[last(c) for c in columns])


def latest_cells(rows: DataFrame, order: Column | str = "seq") -> DataFrame:
    """``(sink_table, pk, column, value)``: the last value written to each column of each dimension row.

    Names stay in rows, so tables of any columns are resolved together.
    """
    position = F.col(order) if isinstance(order, str) else order
    cells = rows.select("sink_table", "pk", position.alias("at"), F.explode("data").alias("column", "cell"))
    last = F.max_by(F.struct("cell"), "at")["cell"]
    return cells.groupBy("sink_table", "pk", "column").agg(last.alias("value"))


def latest_maps(rows: DataFrame, order: Column | str = "seq") -> DataFrame:
    """The same as :func:`latest_rows` with any columns, as ``(sink_table, pk, data)``.

    Reduces per cell first, so what is gathered per row is bounded by the columns of its table.
    """
    cells = latest_cells(rows, order).groupBy("sink_table", "pk")
    return cells.agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("data"))
