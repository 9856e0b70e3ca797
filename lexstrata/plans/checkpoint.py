"""Stage tables for restarts: each stage of a build is written once under a digest of its input and read when it is there.

Once a stage has to be computed, all later ones are computed too. A folder without _SUCCESS counts as missing, so a
lost driver or executor leaves nothing behind that is taken for whole.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset and all runs in one process, a new local one; on a cluster
    that is an error, as executors would write to disks of their own."""
    master = spark.sparkContext.master
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return (found or "file://" + tempfile.mkdtemp(prefix="lexstrata-stages-")).rstrip("/")


class Stages:
    def __init__(self, spark: SparkSession, digest: str, root: str | None = None):
        self.spark, self.root = spark, f"{root or shared_root(spark)}/stages-{digest}"
        self.reading, self.n, self.hits = True, 0, 0

    def _whole(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def stage(self, tag: str, compute: Callable[[], DataFrame]) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{tag}"
        if self.reading and self._whole(path):
            self.hits += 1
        else:
            self.reading = False
            compute().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


class NoStages:
    """Computes every stage and keeps none."""

    def stage(self, tag: str, compute: Callable[[], DataFrame]) -> DataFrame:
        return compute()
