"""Tables in shared storage that carry results between jobs and micro-batches.

Everything is plain files below one root, written by Spark tasks. A micro-batch writes its own
``batch_id=N`` directory and overwrites it when retried, so a retry changes nothing.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, kept for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="weir-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/weir/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared table and read it back.

    Cuts the lineage, computes a side used twice once, and tells the planner its real size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class BatchTable:
    """An append-only table with one directory per micro-batch and periodic snapshots.

    ``<root>/batches/batch_id=N/[part=value/...]`` and ``<root>/snapshots/batch_id=N/...``. A
    snapshot stands for all batches up to and including N; reads start from the newest complete
    one, so they cost the snapshot and the batches after it, however long the job has run.
    """

    def __init__(self, root: str, schema: str, partitions: tuple[str, ...] = ()):
        self.root = root.rstrip("/")
        self.schema = f"{schema}, batch_id BIGINT"
        self.partitions = partitions

    def write(self, df: DataFrame, batch_id: int) -> None:
        self._write(df, f"{self.root}/batches/batch_id={batch_id}")

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self._read(spark, f"{self.root}/batches", [batch_id])

    def read(
        self, spark: SparkSession, before: int | None = None, snapshots: bool = True
    ) -> DataFrame:
        """All rows written so far, or those of batches below ``before``.

        ``snapshots=False`` reads every batch as it was written.
        """
        base = max(self._complete(spark, "snapshots", before), default=-1) if snapshots else -1
        later = [n for n in self._complete(spark, "batches", before) if n > base]
        batches = self._read(spark, f"{self.root}/batches", later)
        if base < 0:
            return batches
        return self._read(spark, f"{self.root}/snapshots", [base]).unionByName(batches)

    def read_through(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All rows up to and including a batch, without a snapshot of that batch."""
        return self.read(spark, before=batch_id).unionByName(self.read_batch(spark, batch_id))

    def write_snapshot(self, df: DataFrame, batch_id: int) -> None:
        """Store ``df`` as standing for all batches up to ``batch_id``."""
        self._write(df, f"{self.root}/snapshots/batch_id={batch_id}")

    def has(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a batch was written to its end."""
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batches/batch_id={batch_id}/_SUCCESS")
        return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)

    def forget(self, spark: SparkSession, through: int) -> None:
        """Remove batches and snapshots up to ``through`` but the newest snapshot among them.

        For state that a snapshot covers, so that reads list a bounded number of directories.
        """
        old = self._complete(spark, "snapshots", through + 1)
        gone = [("snapshots", n) for n in old[:-1]]
        gone += [("batches", n) for n in self._complete(spark, "batches", through + 1)]
        for kind, n in gone:
            self._delete(spark, f"{kind}/batch_id={n}")

    def read_last(self, spark: SparkSession, before: int) -> DataFrame:
        """The rows of the last batch below ``before``, for tables of which each batch stands for all before it."""
        return self._read(spark, f"{self.root}/batches", self._complete(spark, "batches", before)[-1:])

    def forget_all_but_last(self, spark: SparkSession, through: int) -> None:
        """Remove batches up to ``through`` but the last of them; for the same tables."""
        for n in self._complete(spark, "batches", through + 1)[:-1]:
            self._delete(spark, f"batches/batch_id={n}")

    def _delete(self, spark: SparkSession, below: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").partitionBy(*self.partitions).parquet(path)

    def _read(self, spark: SparkSession, base: str, batch_ids: list[int] | list[str]) -> DataFrame:
        if not batch_ids:
            empty = StructType.fromDDL(self.schema)
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in empty])
        paths = [f"{base}/batch_id={n}" for n in batch_ids]
        return spark.read.schema(self.schema).option("basePath", base).parquet(*paths)

    def _complete(self, spark: SparkSession, kind: str, before: int | None) -> list[int]:
        """Numbers of the directories whose write was committed."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        marks = hadoop.Path(f"{self.root}/{kind}/batch_id=*/_SUCCESS")
        found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
        numbers = [int(f.getPath().getParent().getName().split("=")[1]) for f in found or []]
        return sorted(n for n in numbers if before is None or n < before)


class KeyedTable(BatchTable):
    """State of which a micro-batch reads and rewrites only the parts it touches.

    Rows lie in a directory for each value of ``keys`` (a table, a bucket of a hash). ``parts`` are these directories' paths below
    a batch, such as ``sink_table=x/bucket=3``. A snapshot holds the parts that were touched since the one before it;
    an older snapshot stands for the others. ``fixed`` names leading partition columns, by path, that all state lies
    under; rows elsewhere belong to their batch alone and are in no snapshot.
    """

    def __init__(self, root: str, schema: str, keys: tuple[str, ...], fixed: str = ""):
        self.fixed = f"{fixed}/" if fixed else ""
        leading = tuple(p.split("=")[0] for p in fixed.split("/") if p)
        super().__init__(root, schema, (*leading, *keys))
        self.keys = keys

    def write(self, df: DataFrame, batch_id: int) -> None:
        self._check_layout(df.sparkSession)
        super().write(df, batch_id)

    def _check_layout(self, spark: SparkSession) -> None:
        """Refuse to go on beside a table of another layout, whose rows would be forgotten; roots end in ``-of-<buckets>``."""
        folder, _, own = self.root.rpartition("/")
        name, mark, buckets = own.rpartition("-of-")
        if mark:
            pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-of-*")
            found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
            others = [f.getPath().getName() for f in found if not f.getPath().getName().endswith(f"{mark}{buckets}")]
            if others:
                raise ValueError(f"this job began with another number of buckets: {', '.join(others)}")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows of state, or those of batches below ``before``."""
        return self.read_parts(spark, None, before)

    def parts(self, spark: SparkSession, after: int, through: int) -> list[str]:
        """The parts touched by batches above ``after`` up to ``through``."""
        written = self._complete(spark, "batches", through + 1)
        return sorted({part for n in written if n > after for part in self._parts(spark, "batches", n)})

    def read_parts(self, spark: SparkSession, parts: list[str] | None = None, before: int | None = None) -> DataFrame:
        """Rows of state that batches below ``before`` wrote, of some parts or all."""
        newest = self._newest(spark, before)
        base = max(self._complete(spark, "snapshots", before), default=-1)
        later = [n for n in self._complete(spark, "batches", before) if n > base]
        chosen = [f"{n}/{part}" for part, n in newest.items() if parts is None or part in parts]
        rows = self._read(spark, f"{self.root}/batches", later)
        if self.fixed:
            for pair in self.fixed.rstrip("/").split("/"):
                name, value = pair.split("=")
                rows = rows.where(F.col(name).cast("string") == value)
        if parts is not None:
            # Only partition columns, so directories of other parts are not read.
            path = [F.concat(F.lit(f"{key}="), F.col(key).cast("string")) for key in self.keys]
            rows = rows.where(F.concat_ws("/", *path).isin([part.removeprefix(self.fixed) for part in parts]))
        return self._read(spark, f"{self.root}/snapshots", chosen).unionByName(rows) if chosen else rows

    def compact(self, spark: SparkSession, batch_id: int, resolve: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Write a snapshot of the parts touched since the last one, their rows so far put through ``resolve``."""
        base = max(self._complete(spark, "snapshots", batch_id), default=-1)
        touched = self.parts(spark, base, batch_id)
        earlier = self.read_parts(spark, touched, batch_id)
        own = self.read_batch(spark, batch_id)
        for pair in [p for p in self.fixed.split("/") if p]:
            name, value = pair.split("=")
            own = own.where(F.col(name).cast("string") == value)
        rows = resolve(earlier.unionByName(own)).hint("rebalance", *self.partitions)
        self._write(rows.drop("batch_id"), f"{self.root}/snapshots/batch_id={batch_id}")
        return touched

    def forget(self, spark: SparkSession, through: int) -> None:
        """Remove what snapshots up to ``through`` cover: older batches, and parts that a later snapshot holds."""
        old = self._complete(spark, "snapshots", through + 1)
        if not old:
            return
        newest = self._newest(spark, through + 1)
        for n in self._complete(spark, "batches", old[-1] + 1):
            self._delete(spark, f"batches/batch_id={n}")
        for n in old[:-1]:
            parts = self._parts(spark, "snapshots", n)
            covered = [part for part in parts if newest[part] != n]
            if len(covered) == len(parts):
                self._delete(spark, f"snapshots/batch_id={n}")
            else:
                for part in covered:
                    self._delete(spark, f"snapshots/batch_id={n}/{part}")

    def _newest(self, spark: SparkSession, before: int | None) -> dict[str, int]:
        """The snapshot that holds each part."""
        return {part: n for n in self._complete(spark, "snapshots", before) for part in self._parts(spark, "snapshots", n)}

    def _parts(self, spark: SparkSession, kind: str, number: int) -> list[str]:
        root = f"{self.root}/{kind}/batch_id={number}"
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{self.fixed}" + "/".join(f"{key}=*" for key in self.keys))
        found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        depth = len(self.partitions)
        return ["/".join(f.getPath().toString().split("/")[-depth:]) for f in found]


def arrival() -> Column:
    """Order of rows of a :class:`BatchTable`: by micro-batch, then by ``seq`` within it."""
    return F.struct("batch_id", "seq")
