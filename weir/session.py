"""Session settings the jobs are designed for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: join kind by real size, hot keys split, small partitions merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keyed state on local disk with small incremental uploads, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app: str = "weir") -> SparkSession.Builder:
    result = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        result = result.config(key, value)
    return result


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """While a query with a keyed processor starts: the state store such a query needs, whatever store the session was given.

    A query takes its session's settings when it starts and its checkpoint's when it starts again; the session gets its own back.
    """
    own = {key: value for key, value in SETTINGS.items() if ".stateStore." in key}
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
