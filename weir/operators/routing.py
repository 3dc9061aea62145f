"""Routing rules: which are valid, which is in force per source table, and the tables they need.

A rule says where the rows of a source table go and which columns to keep. A rule counts only
if its target table can be made from it; an invalid later rule leaves the valid earlier one in
force. Deletes change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.sources.rules import RULE_FIELDS

DEFAULT_KEY = "id"

# Before every message; a snapshot has the same place.
_BEGINNING = -1

# Fixed value: names a table or column can have without quoting.
_NAME = "^[A-Za-z][A-Za-z0-9_]*$"


def valid_rules(rules: DataFrame) -> DataFrame:
    """Rules whose table can be made: ``seq``, the five fields and ``columns`` (the list, trimmed).

    The key defaults to ``id`` and must equal one listed column exactly; empty names (but
    for trailing commas), repeated names and names that need quoting make a rule invalid.
    """
    listed = F.split(F.regexp_replace("sink_columns", ",+$", ""), ",", -1)
    names = F.transform("listed", lambda c: F.trim(c))
    upper = F.transform("columns", lambda c: F.upper(c))
    return (
        rules.where("rule IS NOT NULL")
        .select("seq", *[F.col(f"rule.{name}").alias(name) for name in RULE_FIELDS])
        .where("source_table IS NOT NULL AND sink_table IS NOT NULL AND sink_columns IS NOT NULL")
        .withColumn("sink_pk", F.coalesce("sink_pk", F.lit(DEFAULT_KEY)))
        .withColumn("listed", listed)
        .withColumn("columns", names)
        .where(F.col("sink_table").rlike(_NAME))
        .where(F.array_contains("listed", F.col("sink_pk")))
        .where(F.forall("columns", lambda c: c.rlike(_NAME)))
        .where(F.size(F.array_distinct(upper)) == F.size("columns"))
        .drop("listed")
    )


def active_rules(rules: DataFrame) -> DataFrame:
    """The last valid rule per source table, in arrival order."""
    kept = ("sink_table", "sink_columns", "sink_pk", "sink_extend", "columns")
    return (
        valid_rules(rules)
        .groupBy("source_table")
        # Rows of a snapshot arrive together; their fields settle which one counts.
        .agg(F.max_by(F.struct(*kept), F.struct("seq", *kept)).alias("rule"))
        .select("source_table", "rule.*")
    )


def target_tables(rules: DataFrame) -> DataFrame:
    """``(sink_table, table_columns, table_pk)`` as the first valid rule made it.

    Later rules for the same table find it there and do not alter it. Of rules that arrive together
    the one of the first source table makes it.
    """
    return (
        valid_rules(rules)
        .groupBy("sink_table")
        .agg(F.min_by(F.struct("columns", "sink_pk"), F.struct("seq", "source_table", "columns", "sink_pk")).alias("made"))
        .select(
            "sink_table",
            F.col("made.columns").alias("table_columns"),
            F.col("made.sink_pk").alias("table_pk"),
        )
    )


def target_columns(rules: DataFrame) -> DataFrame:
    """One row per column of each target table: ``(sink_table, pos, column, is_key)``."""
    return target_tables(rules).select(
        "sink_table", F.posexplode("table_columns").alias("pos", "column"), "table_pk"
    ).select("sink_table", "pos", "column", (F.col("column") == F.col("table_pk")).alias("is_key"))


def routing_table(rules: DataFrame) -> DataFrame:
    """Active rules with the table each writes to: one row per source table."""
    return active_rules(rules).join(target_tables(rules), "sink_table")


def lasting_rules(rules: DataFrame) -> DataFrame:
    """The rules, as ``(seq, rule)``, that say as much as all of them: the last valid one of each source table and the one
    that made each target table.
    """
    kept = (*RULE_FIELDS, "columns")
    valid = valid_rules(rules)
    last = valid.groupBy("source_table").agg(F.max_by(F.struct("seq", *RULE_FIELDS), F.struct("seq", *kept[1:])).alias("r")).select("r.*")
    first_of = F.struct("seq", "source_table", "columns", "sink_pk")
    first = valid.groupBy("sink_table").agg(F.min_by(F.struct("seq", *RULE_FIELDS), first_of).alias("r")).select("r.*")
    return last.unionByName(first).distinct().select("seq", F.struct(*RULE_FIELDS).alias("rule"))


def rule_periods(rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Which rule was in force when: the columns of :func:`routing_table` with ``from_seq`` and ``to_seq``.

    A valid rule holds from its own place in the order of arrival up to the next valid rule of its source table, which has
    no end for the last one (NULL). Of rules that arrive together one counts, as in :func:`active_rules`. Changes
    and rules must be numbered alike, e.g. both by the time of their messages. ``known`` are rules that were settled before,
    see :func:`lasting_rules`: the last of each source holds from the beginning.
    """
    kept = ("sink_table", "sink_columns", "sink_pk", "sink_extend", "columns")
    settled = valid_rules(rules).groupBy("source_table", "seq").agg(F.max(F.struct(*kept)).alias("rule")).select("source_table", "seq", "rule.*")
    every = rules
    if known is not None:
        before = active_rules(known).withColumn("seq", F.lit(_BEGINNING).cast(rules.schema["seq"].dataType))
        settled, every = settled.unionByName(before), known.unionByName(rules)
    following = F.lead("seq").over(Window.partitionBy("source_table").orderBy("seq"))
    periods = settled.withColumn("to_seq", following).withColumnRenamed("seq", "from_seq")
    return periods.join(target_tables(every), "sink_table")


def binned(changes: DataFrame, periods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``bin``, for a join on ``(source_table, bin)`` instead of on the source table alone.

    A source whose rules change often would make each of its changes look at all of its periods. Bins are ranges of equal
    width between the first and the last rule, as many as there are rules for a source on average, so periods
    get at most twice as many rows and a change meets about one. ``periods`` is read twice and should be a written table.
    """
    found = periods.agg(
        F.min("from_seq").cast("double").alias("low"),
        F.max("from_seq").cast("double").alias("high"),
        F.ceil(F.count("*") / F.greatest(F.count_distinct("source_table"), F.lit(1))).alias("n"),
    ).first()
    bins, low, width = max(found["n"], 1), found["low"] or 0.0, ((found["high"] or 0.0) - (found["low"] or 0.0)) or 1.0

    def place(seq):
        # The same rising function on both sides, so rounding does no harm.
        at = F.floor((seq.cast("double") - F.lit(low)) / F.lit(width) * F.lit(bins))
        return F.least(F.greatest(at, F.lit(0)), F.lit(bins)).cast("int")

    last = F.when(F.col("to_seq").isNull(), F.lit(bins)).otherwise(place(F.col("to_seq")))
    spread = periods.withColumn("bin", F.explode(F.sequence(place(F.col("from_seq")), last)))
    return changes.withColumn("bin", place(F.col("seq"))), spread
