"""Tables in the shared folder, where iterative jobs cut their lineage.

Executors can vanish at any time, so anything that later jobs reread is written
as a table below ``spark.checkpoint.dir`` rather than kept in executor storage.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Hashable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN: list[Workspace] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only where that is unset and all tasks run on this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (root or f"file://{tempfile.gettempdir()}/checkpoints").rstrip("/")


class Workspace:
    """A folder of its own for the tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: list[str] = []
        _OPEN.append(self)

    def folder(self, label: str) -> str:
        return f"{self.path}/{label}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, label: str, by: str | None = None) -> DataFrame:
        """Writes ``df`` as Parquet, in folders by the column ``by`` if that is given, and returns the written table."""
        at = self.folder(label)
        (df.write.partitionBy(by) if by else df.write).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def sorted_table(self, df: DataFrame, label: str, keys: list[str]) -> DataFrame:
        """Writes ``df`` in buckets by ``keys``, as many as there are shuffle partitions, each sorted by them, and returns the written table.

        Scans of it then need neither a shuffle nor a sort for joins and sums by ``keys``.
        """
        self.spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        # Spark 4.1 takes a union of bucketed scans for aligned by bucket though its columnar form is not, and sums over it come out split
        self.spark.conf.set("spark.sql.unionOutputPartitioning", "false")
        name = f"{label}_{uuid.uuid4().hex}"
        self.names.append(name)
        df.write.bucketBy(partitions(self.spark), *keys).sortBy(*keys).option("path", self.folder(label)).saveAsTable(name)
        return self.spark.table(name)

    def drop(self, path: str | None = None) -> None:
        """Deletes one written folder, or all of them and the names of sorted tables."""
        while path is None and self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path or self.path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release() -> None:
    """Deletes every folder that this process has opened; results that read them end here."""
    while _OPEN:
        try:
            _OPEN.pop().drop()
        except Exception:  # noqa: BLE001  the session may be gone; the folder then stays for the cluster's own sweep
            continue


atexit.register(release)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_within(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` stay within ``limit``; else unhinted, for a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


_KEPT: dict = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The one object that a worker process keeps between its tasks: made where there is none of that key, and dropped when another is asked for.

    Workers outlive a stage, so what the last operator remembered would else stay beside what the next one does.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def bound_arrow(spark: SparkSession, rows: int = 2000, size: str = "4m") -> None:
    """Bounds the session's Arrow batches to so many rows and bytes, and lets workers import this package.

    Texts vary from nothing to many megabytes, so a row count alone bounds no memory.
    The setting stays: a query's plan is made only when its result is asked for.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    env, home = spark.sparkContext.environment, str(Path(__file__).parents[2])
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), home)))
