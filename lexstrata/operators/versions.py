"""Change logs: effective dates, replay to any version, and differences between versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.checkpoint import shared_root
from .tree import LISTED, SEP, with_prefixes

#: What is compared of a node.
FIELDS = ("text", "title")


def group_by_effective_date(notices: DataFrame, date: str, published: str, number: str, final: Column | None = None) -> DataFrame:
    """Final notices by effective date, each date's in order of (published, number): date, notices (numbers, comma-joined), n."""
    rows = notices if final is None else notices.where(final)
    grouped = rows.groupBy(date).agg(F.array_sort(F.collect_list(F.struct(published, F.col(number).cast("string").alias("number")))).alias("g"))
    return grouped.select(date, F.array_join(F.transform("g", lambda x: x["number"]), ",").alias("notices"), F.size("g").cast("long").alias("n"))


def applicable(notices: DataFrame, keys: list[str], effective: str, published: str, number: str) -> DataFrame:
    """How many notices of the same key apply before each: those effective earlier, or on the same day and published earlier.

    A count of smaller (effective, published) pairs is a range frame, so no self-join is made; ties of both do not count.
    """
    w = W.partitionBy(*keys).orderBy(F.struct(effective, published))
    return notices.select(*keys, number, (F.rank().over(w) - 1).cast("long").alias("n_applicable"))


def latest_change(changed: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    """Of several new effective dates for a notice, the one published last."""
    return changed.groupBy(*key).agg(F.max_by(value, F.struct(*order)).alias(value))


# -- replay of keyed changes ------------------------------------------------------------------------------------


def intervals(log: DataFrame, keys: list[str], order: list[str], at: str, action: str, value: str) -> DataFrame:
    """The states of each key with the time from which and before which they hold: keys, valid_from, valid_to, value.

    KEEP leaves the state; POST and PUT set it; DELETE ends it. One window a key gives every version at once.
    """
    real = log.where(F.col(action) != "KEEP")
    w = W.partitionBy(*keys).orderBy(*order)
    spans = real.withColumn("valid_to", F.lead(at).over(w)).withColumnRenamed(at, "valid_from")
    return spans.where(F.col(action) != "DELETE").select(*keys, "valid_from", "valid_to", value)


def state_at(states: DataFrame, cutoff: Column) -> DataFrame:
    """The rows of intervals() that hold just after the cutoff; nothing is replayed again."""
    return states.where((F.col("valid_from") <= cutoff) & (F.col("valid_to").isNull() | (F.col("valid_to") > cutoff)))


def states_at(states: DataFrame, cutoffs: list[tuple[int, str]], kind: str = "timestamp_ntz") -> DataFrame:
    """A row for each version (number, cutoff) in which a state holds."""
    versions = F.array(*[F.struct(F.lit(n).alias("version"), F.lit(c).cast(kind).alias("cutoff")) for n, c in cutoffs])
    holds = F.filter(versions, lambda v: (F.col("valid_from") <= v["cutoff"]) & (F.col("valid_to").isNull() | (F.col("valid_to") > v["cutoff"])))
    return states.withColumn("v", F.explode(holds)).withColumn("version", F.col("v.version")).drop("v", "valid_from", "valid_to")


def version_diff(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """added, deleted and modified keys, with old and new values of the fields."""
    a = old.select(*keys, *[F.col(f).alias(f"old_{f}") for f in fields], F.lit(True).alias("_a"))
    b = new.select(*keys, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(True).alias("_b"))
    both = a.join(b, keys, "full_outer")
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~F.col(f"old_{f}").eqNullSafe(F.col(f"new_{f}"))
    op = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "deleted").when(changed, "modified")
    return both.withColumn("op", op).where("op is not null").drop("_a", "_b")


def all_pairs_diff(states: DataFrame, keys: list[str], versions: list[int], value: str) -> DataFrame:
    """Counts of added, deleted and modified keys for every ordered pair of versions, each with itself too.

    Versions of a key are gathered in one row (one shuffle), and pairs are compared within it.
    """
    maps = states.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("version", value))).alias("m"))
    pairs = F.array(*[F.struct(F.lit(a).alias("lhs"), F.lit(b).alias("rhs")) for a in versions for b in versions])
    p = maps.select("m", F.explode(pairs).alias("p")).select(F.col("p.lhs").alias("lhs"), F.col("p.rhs").alias("rhs"), F.expr("element_at(m, p.lhs)").alias("a"), F.expr("element_at(m, p.rhs)").alias("b"))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return p.groupBy("lhs", "rhs").agg(count(F.col("a").isNull() & F.col("b").isNotNull()).alias("added"), count(F.col("a").isNotNull() & F.col("b").isNull()).alias("deleted"), count(F.col("a") != F.col("b")).alias("modified"))


def pruned_diff(old: DataFrame, new: DataFrame, keys: list[str], group: str, fields: list[str]) -> DataFrame:
    """version_diff after dropping whole groups (subtrees) whose hashes agree in both versions.

    The hash of a group is an order-free sum over its rows, so it is pre-aggregated before the shuffle; only rows of
    groups that differ are joined.
    """
    rows = lambda df: F.xxhash64(*keys, *fields)
    h = lambda df: df.groupBy(group).agg(F.sum(rows(df).cast("decimal(38,0)")).alias("_h"), F.count(F.lit(1)).alias("_n"))
    a, b = h(old), h(new).withColumnsRenamed({"_h": "_h2", "_n": "_n2"})
    differ = a.join(b, group, "full_outer").where("not (_h <=> _h2 and _n <=> _n2)").select(group)
    return version_diff(old.join(differ, group, "left_semi"), new.join(differ, group, "left_semi"), keys, fields)


def moved(old: DataFrame, new: DataFrame, key: str, parent: str) -> DataFrame:
    """Keys that are in both versions under different parents: key, old_parent, new_parent."""
    a, b = old.select(key, F.col(parent).alias("old_parent")), new.select(key, F.col(parent).alias("new_parent"))
    return a.join(b, key).where(~F.col("old_parent").eqNullSafe(F.col("new_parent")))


# -- trees ------------------------------------------------------------------------------------------------------


def _met(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two node tables by label: _old and _new (subtree hashes), old/new text and title."""
    a = old.select("tree", "label_id", F.col("subtree_hash").alias("_old"), *[F.col(f).alias(f"old_{f}") for f in FIELDS])
    b = new.select("tree", "label_id", F.col("subtree_hash").alias("_new"), *[F.col(f).alias(f"new_{f}") for f in FIELDS])
    return a.join(b, ["tree", "label_id"], "full_outer")


def _differing(met: DataFrame) -> DataFrame:
    differ = F.lit(False)
    for f in FIELDS:
        differ = differ | ~F.col(f"old_{f}").eqNullSafe(F.col(f"new_{f}"))
    op = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "deleted").when(differ, "modified")
    return met.where(~F.col("_old").eqNullSafe(F.col("_new"))).withColumn("op", op).where("op is not null").drop("_old", "_new")


def tree_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Differences of two node tables with subtree_hash (see merkle): tree, label_id, op, old/new text and title.

    Labels are joined once. What differs has a differing hash, and so has everything above it; where the hash is the same,
    nothing else is compared. A node that changed its parent but not its label is not a difference.
    """
    return _differing(_met(old, new))


def descended(old: DataFrame, new: DataFrame, root: str | None = None) -> DataFrame:
    """The nodes that a descent from the roots meets, with both sides' hashes, texts and titles: the roots, and the children of every
    node whose subtree hash differs or that only one side has. Every label's shorter label has to be a node of its tree.

    A level is the rows of its depth whose parents are in the frontier, so rows met grow with the changes and their
    siblings, not with the trees. Both tables are read once a level, so they should be stored tables, best in
    parts by `level` (the label's length); a level is written (to root, or
    the shared folder) and read by the next one. The descent ends with the first level that has no difference, or no nodes."""
    spark, root = old.sparkSession, root or f"{shared_root(old.sparkSession)}/descent-{uuid.uuid4().hex[:12]}"
    parent = F.coalesce(F.array_join(F.slice("label", 1, F.size("label") - 1), SEP), F.lit(""))  # never null, so no filter is derived from it
    depth, frontier, whole = 1, None, None
    while True:
        a, b = (side.where((F.col("level") if "level" in side.columns else F.size("label")) == depth) for side in (old, new))
        if frontier is not None:
            if a.isEmpty() and b.isEmpty():
                return whole
            a, b = (side.withColumn("_parent", parent).join(frontier, ["tree", "_parent"], "left_semi") for side in (a, b))
        met = _met(a, b)
        met.write.parquet(f"{root}/level={depth}")
        met = spark.read.schema(met.schema).parquet(f"{root}/level={depth}")
        whole = met if whole is None else whole.unionByName(met)
        frontier = met.where("not (_old <=> _new)").select("tree", F.col("label_id").alias("_parent"))
        n = frontier.limit(LISTED + 1).count()
        if not n:
            return whole
        frontier = F.broadcast(frontier) if n <= LISTED else frontier.hint("shuffle_hash")  # the trees' rows are not sorted for it
        depth += 1


def tree_diff_by_descent(old: DataFrame, new: DataFrame, root: str | None = None) -> DataFrame:
    """tree_diff() of trees that are hierarchies (see descended()); equal subtrees are not joined. Empty tables have no differences."""
    return _differing(descended(old, new, root))


def replay_disjoint(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """A version of node tables after DELETE, PUT and POST of labels that do not lie under one another.

    changes: (tree, label_id, action, and the node's columns). Deleted and replaced subtrees go by an anti-join on label
    prefixes; new rows come by union. Logs with MOVE, DESIGNATE, KEEP, RESERVE or fields need the ordered replay.
    """
    gone = with_prefixes(nodes.select("tree", "label", "label_id")).join(changes.where("action in ('DELETE', 'PUT')").select("tree", F.col("label_id").alias("ancestor_id")), ["tree", "ancestor_id"], "left_semi").select("tree", "label_id").distinct()
    kept = nodes.join(gone, ["tree", "label_id"], "left_anti")
    return kept.unionByName(changes.where("action in ('PUT', 'POST')").select(*nodes.columns))


def split_numbers(rows: DataFrame, number: str, date: str) -> DataFrame:
    """Documents that take effect at several dates get numbers of their own: `number` of each of several rows is number_YYYYMMDD.
    Rows are counted by number and joined back, so a number of many rows is no task of its own."""
    many = rows.groupBy(number).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(number).alias("_number"))
    met = rows.join(many, F.col(number) == F.col("_number"), "left")
    new = F.when(F.col("_number").isNotNull(), F.concat_ws("_", F.col(number).cast("string"), F.date_format(date, "yyyyMMdd"))).otherwise(F.col(number).cast("string"))
    return met.withColumn(number, new).drop("_number")


def merge_changes(log: DataFrame, patches: DataFrame, document: str = "document_number", label: str = "label_id") -> DataFrame:
    """A change log with patches by hand: what a patch says of a document's label takes the place of what the document does to it."""
    fixed = patches.select(document, label).distinct()
    return log.join(fixed, [document, label], "left_anti").unionByName(patches, allowMissingColumns=True)
