"""Running sums and ranks over keys of any size, without a task for each key; small-side joins behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a side that is broadcast; larger ones are joined on a salted key.
BROADCAST_ROWS = 100_000
SALTS = 32


def hex_digits(rows: int) -> int:
    """Hex digits of a hash that name a cell: about as many cells as rows in the mean cell (the root of the rows)."""
    k = 1
    while 16 ** (2 * k) < rows:
        k += 1
    return k


def running(df: DataFrame, keys: list[str], cell: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum of its column over all rows of the key that come before: by cell, then by order.

    Rows are summed within (key, cell) and cells within the key, so a key with a third of all rows is worked on by as
    many tasks as it has cells. The order has to be total for results to be reproducible.
    """
    df = df.withColumns({f"_{n}": c for n, c in sums.items()})
    within = W.partitionBy(*keys, cell).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    cells = df.groupBy(*keys, cell).agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    above = W.partitionBy(*keys).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(*keys, cell, *[F.coalesce(F.sum(f"_{n}").over(above), F.lit(0)).alias(f"_before_{n}") for n in sums])
    out = df.withColumns({n: F.coalesce(F.sum(f"_{n}").over(within), F.lit(0)) for n in sums}).join(offsets, [*keys, cell])
    out = out.withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in sums})
    return out.drop(*[f"_{n}" for n in sums], *[f"_before_{n}" for n in sums])


def join_small(df: DataFrame, small: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Inner join with a side of `rows` rows that is unique in the keys: broadcast up to a size, else dealt with salt so that no key is hot."""
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(small), keys)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "_salt"]).drop("_salt")
