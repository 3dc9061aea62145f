"""The dim flow on a batch of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weir.operators import dims, routing
from weir.sources import rules
from weir.streaming.storage import written


def routed_changes(
    topic: DataFrame, rule_changes: DataFrame, match: str = "exact", with_dirty: bool = False, spread: bool | None = None
) -> DataFrame:
    """Change messages matched with the rules in force; see ``dims.route``.

    The routing table is written first, so its real size decides how it is joined: broadcast, or with the changes of hot
    tables spread over many keys (``dims.route_spread``). ``spread`` settles it beforehand.
    """
    changes = dims.kept_changes(dims.parse_changes(topic), with_dirty=with_dirty)
    table = written(routing.routing_table(rules.from_change_feed(rule_changes)), "routing")
    if spread is None:
        spread = not fits_broadcast(table)
    return dims.route_spread(changes, table, match) if spread else dims.route(changes, table, match)


def fits_broadcast(table: DataFrame) -> bool:
    """Whether Spark would broadcast a written table, by its size on disk."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def routed_as_of(
    topic: DataFrame, rule_changes: DataFrame, match: str = "exact", with_dirty: bool = False
) -> DataFrame:
    """The same for history that is replayed: each change by the rule in force when it arrived."""
    changes = dims.kept_changes(dims.parse_changes(topic), with_dirty=with_dirty)
    periods = written(routing.rule_periods(rules.from_change_feed(rule_changes)), "rule-periods")
    return dims.route_as_of(changes, periods, match)


def dimension_cells(topic: DataFrame, rule_changes: DataFrame) -> DataFrame:
    """What the dimension tables hold after all changes, a row per cell."""
    return dims.latest_cells(dims.accepted(routed_changes(topic, rule_changes)))
