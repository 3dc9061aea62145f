"""App-log records, first visit per device, and the new-visitor flag repair.

The first record of a device fixes its first day D for good: the day of that record when it
claims a new visitor (``is_new`` = ``1``), else the day before. Every later record that claims a
new visitor on another day loses the claim. That is one reduction per device and one join, so no
device's records are ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions import dates, records

NEW, OLD = "1", "0"

# Why a record cannot be processed.
NOT_JSON, NO_COMMON, NO_MID, NO_TS, NO_PAGE = "not_json", "no_common", "no_mid", "no_ts", "no_page"

# Records without a device are spread over this many join keys that no device uses.
_SPREAD = 4096


def parse_logs(topic: DataFrame) -> DataFrame:
    """``(seq, value)`` to one row per message.

    ===========  =======  ==========================================================
    seq          BIGINT   arrival order
    value        STRING   the message
    text         STRING   the message, its numbers marked
    v            VARIANT  the record
    raw          STRING   the message, only where the record may turn out unusable
    mid          STRING   device
    device       STRING   join key: ``mid``, or a spread key where it is missing
    is_new, ts   STRING, BIGINT (ms)
    reason       STRING   why the record is unusable, else NULL
    ===========  =======  ==========================================================
    """
    v = F.col("v")
    fields = (
        topic.select("seq", "value", records.marked("value").alias("text"))
        .select("*", F.try_parse_json("text").alias("v"))
        .select(
            "seq",
            "value",
            "text",
            "v",
            records.get_string(v, "$.common.mid").alias("mid"),
            records.get_string(v, "$.common.is_new").alias("is_new"),
            records.get_long(v, "$.ts").alias("ts"),
        )
    )
    splittable = records.present(v, "$.start") | records.is_object(v, "$.page")
    reason = (
        F.when(F.col("mid").isNotNull(), F.when(~splittable, NO_PAGE))
        .when(~records.is_object(v), NOT_JSON)
        .when(~records.is_object(v, "$.common"), NO_COMMON)
        .otherwise(NO_MID)
    )
    spread = F.concat(F.lit("\u0000"), F.pmod("seq", F.lit(_SPREAD)).cast("string"))
    row = F.struct(
        "seq",
        "value",
        "text",
        "v",
        F.when(reason.isNotNull() | ~dates.is_dated(F.col("ts")), F.col("value")).alias("raw"),
        "mid",
        F.coalesce("mid", spread).alias("device"),
        "is_new",
        "ts",
        reason.alias("reason"),
    )
    # A filter on a parsed field would be pushed below the projection that parses and parse
    # every message again; filters do not move below a generator.
    return fields.select(F.inline(F.array(row)))


def candidates(logs: DataFrame, zone: str = dates.ZONE) -> DataFrame:
    """``(mid, seq, candidate DATE)``: the first day each record gives its device, should it be the first of them."""
    claims_new = F.col("is_new").eqNullSafe(NEW)
    candidate = F.when(claims_new, dates.day(F.col("ts"), zone)).otherwise(
        dates.previous_day(F.col("ts"), zone)
    )
    return logs.select("mid", "seq", candidate.alias("candidate"))


def first_visits(logs: DataFrame, zone: str = dates.ZONE, undated: bool = False) -> DataFrame:
    """``(mid, first_date DATE, first_seq)``: the first day of each device and the record that set it.

    ``undated`` keeps devices no record of which has a usable time.

    DATE and BIGINT buffers let Spark hash-aggregate and combine before the shuffle, so a
    device with very many records sends one row per task.
    """
    visits = (
        candidates(logs.where("mid IS NOT NULL"), zone)
        .select("mid", "candidate", F.when(F.col("candidate").isNotNull(), F.col("seq")).alias("seq"))
        .groupBy("mid")
        .agg(F.min_by("candidate", "seq").alias("first_date"), F.min("seq").alias("first_seq"))
    )
    return visits if undated else visits.where("first_date IS NOT NULL")


def repair_flags(logs: DataFrame, visits: DataFrame, zone: str = dates.ZONE) -> DataFrame:
    """Join each record with its device's first visit and settle ``is_new``.

    Adds ``flipped``; sets ``reason`` where a time was needed and is missing. ``visits`` holds one
    row per device; a NULL ``first_seq`` says the visit is older than all of ``logs``. Pass
    ``visits`` read from storage (see ``weir.streaming.storage``): its size is then known, so Spark
    broadcasts it when small, and otherwise splits a hot device's records in the shuffled join.
    """
    by_device = visits.select(F.col("mid").alias("device"), "first_date", "first_seq")
    today = dates.day(F.col("ts"), zone)
    claims_new = F.col("is_new").eqNullSafe(NEW)
    first_known = F.col("first_date").isNotNull() & F.coalesce(
        F.col("seq") >= F.col("first_seq"), F.lit(True)
    )
    no_ts = F.col("mid").isNotNull() & F.col("today").isNull() & (claims_new | ~first_known)
    flipped = F.coalesce(claims_new & (F.col("today") != F.col("first_date")), F.lit(False))
    return (
        logs.join(by_device, "device", "left")
        .withColumn("today", today)
        .withColumn("flipped", flipped)
        .withColumn("reason", F.when(no_ts, NO_TS).otherwise(F.col("reason")))
        .withColumn("is_new", F.when(F.col("flipped"), OLD).otherwise(F.col("is_new")))
        .drop("device", "today", "first_date", "first_seq")
    )
