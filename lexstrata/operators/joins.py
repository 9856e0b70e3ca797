"""Joins that documents need and SQL has no word for: as-of, range, label prefix, and joins with a fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tree import with_prefixes

#: Rows of a side that is broadcast; larger sides are shuffled.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if a count (that stops at the bound) shows it small enough."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def asof_last(rows: DataFrame, partition: list[str], order: list[str], flag: Column, value: Column, name: str) -> DataFrame:
    """The value of the last flagged row at or before each row (a line's page is the last page break before it): one window, no join."""
    w = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(F.when(flag, value), ignorenulls=True).over(w))


def range_join(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, width: int) -> DataFrame:
    """Pairs with equal keys and low <= point <= high, by an equi-join on buckets of the given width.

    A range is put in every bucket it touches, a point in its own, so each pair meets once; open ends are closed by the
    caller. Without buckets, keys of many rows would be joined by nested loops.
    """
    p = points.withColumn("_b", F.floor(F.col(point) / width).cast("long"))
    r = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long"))))
    return p.join(r, [*keys, "_b"]).where(F.col(point).between(F.col(low), F.col(high))).drop("_b")


def prefix_join(rows: DataFrame, scopes: DataFrame, label: str = "label") -> DataFrame:
    """rows (tree, label, ..) with every scope (tree, scope_id, ..) that is a prefix of the label; scope_depth counts from 0."""
    up = with_prefixes(rows, label, name="scope_id").withColumnRenamed("ancestor_depth", "scope_depth")
    return up.join(scopes, ["tree", "scope_id"])


def longest_scope(rows: DataFrame, scopes: DataFrame, term: str, label: str = "label") -> DataFrame:
    """For each row and term, the definition with the longest scope (of equals, the later): what is defined nearer wins."""
    met = prefix_join(rows, scopes, label)
    keep = [c for c in scopes.columns if c not in ("tree", "scope_id", term)]
    best = met.groupBy("tree", "label_id", term).agg(F.max_by(F.struct("scope_id", *keep), F.struct("scope_depth", "seq")).alias("d"))
    return best.select("tree", "label_id", term, "d.*")


def prefix_anti(rows: DataFrame, gone: DataFrame, label: str = "label") -> DataFrame:
    """rows that are not at or under any of the labels gone (tree, label_id)."""
    up = with_prefixes(rows.select("tree", label, "label_id"), label)
    hit = up.join(gone.select("tree", F.col("label_id").alias("ancestor_id")).distinct(), ["tree", "ancestor_id"], "left_semi").select("tree", "label_id").distinct()
    return rows.join(hit, ["tree", "label_id"], "left_anti")


def known_targets(refs: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """References whose target exists."""
    return refs.join(nodes.select(F.col("label_id").alias(key)).distinct(), key, "left_semi")


def match_with_fallback(wanted: DataFrame, found: DataFrame, key: str, weak: str, group: list[str]) -> DataFrame:
    """wanted joined with found on the key; what stays unmatched takes, in its group, the one unmatched found row with the
    same weak key, if there is exactly one. Adds `how`: exact, fallback or null."""
    left = wanted
    f = found.select(*group, F.col(key).alias("found_key"), F.col(weak).alias("_weak"))
    exact = left.join(f.drop("_weak"), (left[key] == f["found_key"]) & _same(left, f, group), "left").select(*[left[c] for c in left.columns], f["found_key"])
    free = f.join(left.select(*group, F.col(key).alias("found_key")), [*group, "found_key"], "left_anti")
    single = free.groupBy(*group, "_weak").agg(F.count(F.lit(1)).alias("_n"), F.min("found_key").alias("_only")).where("_n = 1").select(*group, F.col("_weak").alias(weak), "_only")
    out = exact.join(single, [*group, weak], "left")
    how = F.when(F.col("found_key").isNotNull(), "exact").when(F.col("_only").isNotNull(), "fallback")
    return out.withColumn("how", how).withColumn("found_key", F.coalesce("found_key", "_only")).drop("_only")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (a[c] == b[c])
    return out


def first_source(wanted: DataFrame, sources: list[DataFrame], key: str, value: str) -> DataFrame:
    """The value of the first source that holds the key (local files before remote ones, overrides before defaults)."""
    out, names = wanted, []
    for i, s in enumerate(sources):
        names.append(f"_v{i}")
        out = out.join(s.select(key, F.col(value).alias(names[-1])), key, "left")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)


def not_contained(spans: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Spans that no other span of the same key properly contains; equal spans all stay. One window a key, no self-join.

    By start (and longest first), a span is contained iff some span before it ends at or after its end, and one of the
    two ends differs: iff the largest end of those with a smaller start reaches its end, or of those with an equal
    start goes beyond it.
    """
    before = W.partitionBy(*keys).orderBy(start).rangeBetween(W.unboundedPreceding, -1)
    same = W.partitionBy(*keys, start)
    out = spans.withColumn("_b", F.max(end).over(before)).withColumn("_s", F.max(end).over(same))
    return out.where((F.coalesce(F.col("_b"), F.lit(-1)) < F.col(end)) & (F.col("_s") <= F.col(end))).drop("_b", "_s")
