"""Stage tables: named parquet tables in the shared checkpoint folder.

A stage table cuts the lineage behind it, survives the loss of executors, and gives Catalyst the true size
of a derived table, so that later joins broadcast it only below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for stage tables: ``spark.checkpoint.dir``, or a new local one where there is no cluster."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _roots:
        _roots[context.applicationId] = tempfile.mkdtemp(prefix="rentlens-")
    return _roots[context.applicationId]


class Store:
    """A set of named tables under one new folder."""

    def __init__(self, spark: SparkSession, label: str = "store"):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(self.path(name))
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def remove(self) -> None:
        """Delete the tables of this store, by the file system that holds them."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.names.clear()

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to a new stage table and read it back."""
    return Store(df.sparkSession, label).save(df, "rows")
