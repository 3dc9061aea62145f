"""Where routing rules come from: a change feed, a database snapshot, or both.

A snapshot taken while changes go on overlaps with the feed. Changes carry their place in the database's log, which
is their order whatever order they arrive in; :func:`hand_over` leaves out those that the snapshot holds already.

All give ``(seq BIGINT, rule STRUCT)``; ``rule`` is NULL for a change that carries none
(a delete, a malformed message).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_FIELDS = ("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")
RULE_SCHEMA = ", ".join(f"{name} STRING" for name in RULE_FIELDS)

# Rows of a snapshot arrive before every change.
_SNAPSHOT_SEQ = -1


def from_change_feed(topic: DataFrame) -> DataFrame:
    """A topic ``(seq, value)`` of Debezium messages; the rule is the row after the change.

    Snapshot rows (``op`` = ``r``) and later changes are read alike, in arrival order.
    """
    change = F.from_json("value", f"after STRUCT<{RULE_SCHEMA}>")
    return topic.select("seq", change["after"].alias("rule"))


def from_snapshot(table: DataFrame) -> DataFrame:
    """A table of rules as it is now, one row per source table."""
    fields = [F.col(name).cast("string").alias(name) for name in RULE_FIELDS]
    return table.select(F.lit(_SNAPSHOT_SEQ).cast("bigint").alias("seq"), F.struct(*fields).alias("rule"))


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """The table as it is now; with a numeric ``key`` and its ``bounds`` in ranges that are read at the same time."""
    ranges = {"column": key, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions} if key and bounds else {}
    return from_snapshot(spark.read.jdbc(url, table, properties=properties or {}, **ranges))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Start from a snapshot and go on with the changes made after it."""
    return snapshot.unionByName(changes)


def log_position(file: Column, pos: Column) -> Column:
    """A place in the database's log as one number: the digits that end the file's name, then the offset in it.

    NULL where either is missing; offsets have up to 19 digits, file numbers up to 18.
    """
    number = F.nullif(F.regexp_extract(file, "([0-9]{1,18})$", 1), F.lit(""))
    return F.concat(number, F.lpad(pos.cast("string"), 19, "0")).cast("decimal(38,0)")


def from_positioned_feed(topic: DataFrame) -> DataFrame:
    """``(seq DECIMAL, rule, in_snapshot)`` of a topic ``(seq, value)`` of Debezium messages, ordered by their log positions.

    ``in_snapshot`` marks rows that the connector read from the table when it started. Messages without a position, which
    it does not write, are left out.
    """
    source = "source STRUCT<file: STRING, pos: BIGINT, snapshot: STRING>"
    change = F.from_json("value", f"after STRUCT<{RULE_SCHEMA}>, {source}")
    rows = topic.select(
        log_position(change["source"]["file"], change["source"]["pos"]).alias("seq"),
        change["after"].alias("rule"),
        F.coalesce(change["source"]["snapshot"].isin("true", "first", "last", "first_in_data_collection", "last_in_data_collection"), F.lit(False)).alias("in_snapshot"),
    )
    return rows.where("seq IS NOT NULL")


def hand_over(snapshot: DataFrame, position: Column, feed: DataFrame) -> DataFrame:
    """``(seq, rule)``: a snapshot ``(seq, rule)`` taken at a log ``position``, then the changes of the positioned feed made after it.

    What the feed says up to that position, its own snapshot included, is in the snapshot already and left out.
    """
    later = feed.where(~F.col("in_snapshot") & (F.col("seq") > position)).select("seq", "rule")
    return snapshot.select(F.col("seq").cast("decimal(38,0)").alias("seq"), "rule").unionByName(later)
