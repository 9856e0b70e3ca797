"""Layers that stay between builds. What a layer says of a node that reads nothing else is kept under the node's hash; what reads
a whole tree is kept under the tree's hash. A build computes what is not there yet and appends it.

A table for each layer and set of options: root/<layer>/<digest of the options>/, rows (hash, element), a row without an element
for what has none. One append is one job's commit, so a build that fails leaves nothing half known; what two builds append at
the same time is there twice, and read once.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layers as L


def options_digest(options: dict) -> str:
    """A digest of a layer's options; tables among them count by their rows, in any order."""

    def plain(x):
        if isinstance(x, DataFrame):
            total = x.select(F.sum(F.xxhash64(*sorted(x.columns)).cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("n")).first()
            return [sorted(x.columns), str(total["h"]), total["n"]]
        return x

    told = {k: plain(v) for k, v in options.items() if v is not None and v != {} and v != []}
    return hashlib.sha256(json.dumps(told, sort_keys=True, default=list).encode()).hexdigest()[:16]


class LayerStore:
    """computed: of each layer that was run, how many nodes (or trees) the last run had to look at."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.computed: dict[str, int] = {}

    def _known(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.format(self.fmt).load(path)
        except AnalysisException:  # nothing there yet
            return None

    def _append(self, name: str, path: str, known: DataFrame | None, asked: DataFrame, find) -> DataFrame:
        """Computes what is asked for (column `hash`) and not known, by find(asked rows) -> (hash, columns); returns the whole table."""
        new = asked if known is None else asked.join(known.select("hash").distinct(), "hash", "left_anti")
        found = find(new)
        columns = [c for c in found.columns if c != "hash"]
        rows = new.select("hash").distinct().join(found.select("hash", F.struct(*columns).alias("element")), "hash", "left")
        batch = uuid.uuid4().hex[:12]
        rows.write.format(self.fmt).mode("append").save(f"{path}/batch={batch}")
        written = self.spark.read.format(self.fmt).schema(rows.schema).load(f"{path}/batch={batch}")
        self.computed[name] = written.select("hash").distinct().count()
        return self.spark.read.format(self.fmt).schema(rows.schema).load(path)

    def run(self, name: str, nodes: DataFrame, **options) -> DataFrame:
        """As layers.run_versions. Own-text layers cost distinct nodes that no build has seen with these options, others the versions of
        trees that are new. Options that are tables take part with their rows."""
        f, own = L.LAYERS[name]
        path = f"{self.root}/{name}/{options_digest(options)}"
        known = self._known(path)
        if own:
            hashed = nodes.withColumn("hash", L.node_hash())
            once = hashed.dropDuplicates(["hash"]).drop("tree").withColumn("tree", F.col("hash"))
            kept = self._append(name, path, known, once, lambda new: f(new, **options).withColumnRenamed("tree", "hash").drop("label_id"))
            at = hashed.select("version", "tree", "label_id", "hash")
        else:
            # a tree's hash: of its nodes with their places, whatever their order
            row = F.xxhash64(F.to_json("path"), L.node_hash()).cast("decimal(38,0)")
            trees = nodes.groupBy("tree", "version").agg(F.sum(row).alias("_h"), F.count(F.lit(1)).alias("_n"))
            trees = trees.select("tree", "version", F.sha2(F.concat_ws("@", F.col("tree").cast("string"), F.col("version").cast("string"), F.col("_h").cast("string"), F.col("_n").cast("string")), 256).alias("hash"))

            # the layer itself sees a tree under its hash, so that what it finds is kept under it
            find = lambda new: f(nodes.withColumn("_of", F.col("tree").cast("string")).join(new, ["tree", "version"]).withColumn("tree", F.col("hash")).drop("hash"), **options).withColumnRenamed("tree", "hash")
            kept = self._append(name, path, known, trees, find)
            at = trees.select("hash", F.concat_ws("@", F.col("tree").cast("string"), F.col("version").cast("string")).alias("tree"))
        found = kept.where("element is not null").select("hash", "element").dropDuplicates().select("hash", "element.*")
        return at.join(found, "hash").drop("hash")
