"""Places and carried values in ordered groups of any size.

A window over a whole group is one task, which a tree with a third of all nodes makes the slowest of a job. Here rows are
dealt by ranges of their order and written to the shared folder, so every cell (a group's rows in one range) is worked on
by itself; what the cells before it add is a window over cells, of which there are few.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.checkpoint import shared_root


def _ranged(df: DataFrame, keys: list[str], order: dict[str, Column]) -> DataFrame:
    """df with the order's columns and _cell: cells follow one another in the order. Ranges are sampled, so they are fixed by writing them."""
    spark, path = df.sparkSession, f"{shared_root(df.sparkSession)}/ranges-{uuid.uuid4().hex[:12]}"
    ranged = df.withColumns(order).repartitionByRange(*keys, *order).withColumn("_cell", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _ordered(order: list[str | Column]) -> dict[str, Column]:
    return {f"_o{i}": F.col(o) if isinstance(o, str) else o for i, o in enumerate(order)}


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """Adds each row's place (from 1) in its group. The order has to be total, and keys not null."""
    by = _ordered(order)
    rows = _ranged(df, keys, by)
    sizes = rows.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    above = F.sum("_n").over(W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1))
    before = sizes.select(*keys, "_cell", F.coalesce(above, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy(*keys, "_cell").orderBy(*by))
    out = rows.withColumn("_place", place).join(before, [*keys, "_cell"])
    return out.withColumn(name, (F.col("_place") + F.col("_before")).cast("int")).drop("_place", "_before", "_cell", *by)


def carried(df: DataFrame, keys: list[str], order: list[str | Column], values: dict[str, Column], here: bool = True) -> DataFrame:
    """Adds for each name the last value that is not null at (if `here`) or before each row of its group."""
    by = _ordered(order)
    rows = _ranged(df.withColumns({f"_v_{n}": v for n, v in values.items()}), keys, by)
    last = {n: F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.struct(*by))).alias(f"_c_{n}") for n in values}
    cells = rows.groupBy(*keys, "_cell").agg(*last.values())
    w = W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    above = cells.select(*keys, "_cell", *[F.last(f"_c_{n}", ignorenulls=True).over(w).alias(f"_a_{n}") for n in values])
    within = W.partitionBy(*keys, "_cell").orderBy(*by).rowsBetween(W.unboundedPreceding, 0 if here else -1)
    out = rows.withColumns({f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(within) for n in values}).join(above, [*keys, "_cell"])
    out = out.withColumns({n: F.coalesce(f"_l_{n}", f"_a_{n}") for n in values})
    return out.drop("_cell", *by, *[f"_{x}_{n}" for x in "vla" for n in values])
