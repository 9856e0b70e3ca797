"""Reading back what Sink wrote: regulations by version, layers, notices, differences. Every lookup is a filter on
partition columns, so it reads the files of one version only."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.model import Node, from_rows, to_dict


class Store:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _table(self, path: str) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "false").format(self.fmt).load(f"{self.root}/{path}")

    def regulation(self, part: str, version: str) -> DataFrame:
        """The node table of one version."""
        n = self._table("regulation")
        return n.where((F.col("reg").cast("string") == part) & (F.col("version").cast("string") == version))

    def versions(self, part: str) -> DataFrame:
        return self._table("regulation").where(F.col("reg").cast("string") == part).select(F.col("version").cast("string").alias("version")).distinct()

    def as_of(self, part: str, version: str | None = None, date: str | None = None) -> DataFrame:
        """The node table of one version of a history that is kept by content: of the version named, or of the last one in effect on a
        date (ISO). Places that hold are found first, and only their bodies are read."""
        from ..plans.history import joined, versions_of

        numbers = self._table("version").where(F.col("reg").cast("string") == part).drop("reg")
        if version is not None:
            numbers = numbers.where(F.col("version") == version)
        else:
            until = numbers.where(F.col("effective_on").isNull() | (F.col("effective_on").cast("string") <= date))
            numbers = until.orderBy(F.desc("version_no")).limit(1)
        wanted = numbers.first()
        places = self._table("place").where(F.col("reg").cast("string") == part).drop("reg")
        if wanted is None:
            return versions_of(joined(self._table("body"), places.where("false")), numbers)
        no = wanted["version_no"]
        places = places.where((F.col("from_no") <= no) & (F.col("to_no").isNull() | (F.col("to_no") > no)))
        return versions_of(joined(self._table("body"), places), numbers)

    def layer(self, name: str, version: str) -> DataFrame:
        return self._table(f"layer/{name}").where(F.col("version").cast("string") == version)

    def notices(self, part: str | None = None) -> DataFrame:
        n = self._table("notice")
        return n if part is None else n.where(F.col("cfr_part").cast("string") == part)

    def notice(self, number: str) -> DataFrame:
        return self._table("notice").where(F.col("document_number") == number)

    def diff(self, lhs: str, rhs: str) -> DataFrame:
        return self._table("diff").where((F.col("lhs").cast("string") == lhs) & (F.col("rhs").cast("string") == rhs))

    def tree(self, part: str, version: str) -> Node | None:
        """One version in memory, for what works on one document at a time (a document's nodes are its bound)."""
        columns = ["path", "label", "label_id", "node_type", "title", "text", "tagged_text"]
        return from_rows([(list(r[0]), list(r[1]), *r[2:]) for r in self.regulation(part, version).select(*columns).collect()])

    def regulation_as_json(self, part: str, version: str) -> str | None:
        root = self.tree(part, version)
        return None if root is None else json.dumps(to_dict(root), sort_keys=True)
