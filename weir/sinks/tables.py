"""Dimension tables in the catalog: one per sink table, every column text.

A name that readers use is a view with the configured columns. The table below it has the same name with an underscore in
front, which no rule can give, and is partitioned by a bucket of the key, so an update replaces one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import dims

KEY = "weir.key"

# Partition column; no column of a rule can have this name.
BUCKET = "_bucket"

BUCKETS = 16

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def bucket(buckets: int = BUCKETS) -> Column:
    """The bucket of a row by its key ``pk``."""
    return F.pmod(F.xxhash64("pk"), F.lit(buckets)).cast("int")


def create_statements(sink_table: str, columns: list[str], database: str, key: str) -> list[str]:
    names = ", ".join(f"`{column}`" for column in columns)
    body = ", ".join(f"`{column}` STRING" for column in columns)
    rows = f"`{database}`.`_{sink_table}`"
    return [
        f"CREATE TABLE IF NOT EXISTS {rows} ({body}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET})",
        f"CREATE VIEW IF NOT EXISTS `{database}`.`{sink_table}` TBLPROPERTIES ('{KEY}' = '{key}') AS SELECT {names} FROM {rows}",
    ]


def create_tables(spark: SparkSession, targets: DataFrame, database: str = "default") -> list[str]:
    """Create the tables of ``routing.target_tables`` that do not exist; existing ones stay as they are.

    Rows come to the driver one after the other, as each needs statements of its own. Gives the names of new tables.
    """
    made = []
    for row in targets.select("sink_table", "table_columns", "table_pk").toLocalIterator():
        if not spark.catalog.tableExists(f"`{database}`.`{row.sink_table}`"):
            for statement in create_statements(row.sink_table, row.table_columns, database, row.table_pk):
                spark.sql(statement)
            made.append(row.sink_table)
    return sorted(made)


def publish(
    spark: SparkSession, rows: DataFrame, sink_table: str, database: str = "default", order="seq", buckets: int = BUCKETS
) -> None:
    """Replace the buckets of one table that ``rows`` touch by what they should hold now; other buckets stay.

    ``rows`` are all accepted changes ``(sink_table, pk, data, ...)`` of these buckets; only this table's are read. A table
    keeps the number of ``buckets`` it had first.
    """
    columns = spark.table(f"`{database}`.`{sink_table}`").columns
    latest = dims.latest_rows(rows.where(F.col("sink_table") == sink_table), columns, order)
    latest = latest.select(*columns, bucket(buckets).alias(BUCKET)).hint("rebalance", BUCKET)
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        latest.write.mode("overwrite").insertInto(f"`{database}`.`_{sink_table}`")
    finally:
        spark.conf.set(_OVERWRITE, before)
