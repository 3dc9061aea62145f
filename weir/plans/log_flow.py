"""The log flow on a batch of messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from weir.functions import dates
from weir.operators import split, visitors
from weir.streaming.storage import written


def repaired_logs(topic: DataFrame, zone: str = dates.ZONE) -> DataFrame:
    """Parsed records with the flag repaired; unusable ones stay, with a ``reason``.

    Reads the topic twice: once for first visits, which are written as a table with a row per
    device, once for the records themselves. The records are shuffled only when that table
    is too large to broadcast.
    """
    logs = visitors.parse_logs(topic)
    return visitors.repair_flags(logs.drop("v", "value", "text"), _visits(logs, zone), zone)


def split_logs(
    topic: DataFrame, topics: Iterable[str] = split.TOPICS, zone: str = dates.ZONE
) -> DataFrame:
    """Messages to ``(seq, topic, value, reason)``, one row per output message."""
    logs = visitors.parse_logs(topic)
    repaired = visitors.repair_flags(split.cut(logs), _visits(logs, zone), zone)
    return split.fan_out(repaired, topics)


def dirty_logs(topic: DataFrame) -> DataFrame:
    """Messages whose form alone makes them unusable, before any state is looked at."""
    return visitors.parse_logs(topic).where("reason IS NOT NULL").selectExpr("seq", "reason", "raw AS value")


def _visits(logs: DataFrame, zone: str) -> DataFrame:
    return written(visitors.first_visits(logs, zone), "first-visits")
