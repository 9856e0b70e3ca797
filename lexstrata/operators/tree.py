"""Label trees as tables: one row a node, path-enumerated.

A node table has `tree` (which tree), `path` (array; order by it is pre-order), `label` (array of strings), `label_id`
(the label joined by '-'), `title`, `text` and whatever else. Trees are independent, so every operator partitions by
`tree`; none needs all rows in one place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.checkpoint import shared_root
from .ranks import carried, numbered

SEP = "-"
#: Children whose hashes one group holds; nodes with more of them are listed to all tasks up to this number.
CELL, LISTED = 4096, 100_000


def label_id(label: str | Column = "label") -> Column:
    return F.array_join(label, SEP)


def parent_label(label: str = "label") -> Column:
    """The label without its last part; null for a root."""
    return F.when(F.size(label) > 1, F.slice(label, 1, F.size(label) - 1))


def parent_key(label: str = "label", node_type: str = "node_type") -> Column:
    """The label a node belongs under, by the rules for subparts and interpretations: a subpart is under its part; an
    interpretation of a paragraph under that of the next higher label, up to the part; all else under its shorter label."""
    n, at = F.size(label), F.array_position(label, "Interp")
    last_is_interp = F.element_at(label, -1) == "Interp"
    return (
        F.when(F.col(node_type) == "subpart", F.slice(label, 1, 1))
        .when(last_is_interp & (n == 2), F.slice(label, 1, 1))
        .when(last_is_interp, F.concat(F.slice(label, 1, F.greatest(at - 2, F.lit(1))), F.array(F.lit("Interp"))))
        .when(n > 1, F.slice(label, 1, n - 1))
    )


def walk(nodes: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """Applies an expression in pre-order, leaving out nodes it is null for: tree, pos (from 1), label_id, value."""
    kept = nodes.withColumn(name, value).where(F.col(name).isNotNull())
    return numbered(kept.select("tree", "path", "label_id", name), ["tree"], ["path"], "pos").select("tree", "pos", "label_id", name)


def find(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first node in pre-order of each wanted label_id (labels need not be unique)."""
    rows = nodes.join(wanted.select("label_id").distinct(), "label_id", "left_semi")
    first = rows.groupBy("tree", "label_id").agg(F.min_by(F.struct(*[c for c in nodes.columns if c not in ("tree", "label_id")]), "path").alias("n"))
    return first.select("tree", "label_id", "n.*")


def with_prefixes(df: DataFrame, label: str = "label", proper: bool = False, name: str = "ancestor_id") -> DataFrame:
    """A row for every prefix of the label (shortest first), itself included unless proper; no join."""
    least = 1 if not proper else 2
    prefixes = F.expr(f"transform(sequence(1, size({label}){' - 1' if proper else ''}), n -> array_join(slice({label}, 1, n), '{SEP}'))")
    return df.where(F.size(label) >= least).select("*", F.posexplode(prefixes).alias("ancestor_depth", name))


def ancestors(nodes: DataFrame) -> DataFrame:
    """tree, label_id, ancestor_id, distance for every proper ancestor that exists as a node."""
    up = with_prefixes(nodes.select("tree", "label", "label_id"), proper=True)
    known = nodes.select("tree", F.col("label_id").alias("ancestor_id")).distinct()
    return up.join(known, ["tree", "ancestor_id"], "left_semi").select("tree", "label_id", "ancestor_id", (F.size("label") - F.col("ancestor_depth") - 1).alias("distance"))


def subtree(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes at or under each root (tree, root_id)."""
    down = with_prefixes(nodes, name="root_id").drop("ancestor_depth")
    return down.join(roots.select("tree", "root_id"), ["tree", "root_id"])


def join_text(nodes: DataFrame, sep: str = "") -> DataFrame:
    """Text of every node's subtree, in pre-order: tree, label_id, full_text. A root's row holds its document's whole text, so a
    document has to fit in a row (2 GB)."""
    down = with_prefixes(nodes.select("tree", "path", "label", "text"))
    return down.groupBy("tree", F.col("ancestor_id").alias("label_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "text"))), lambda x: x["text"]), sep).alias("full_text"))


def treeify(rows: DataFrame) -> DataFrame:
    """Flat labelled rows -> forest: each row's parent is its longest proper prefix that exists. tree, label_id, parent_id."""
    up = with_prefixes(rows.select("tree", "label", "label_id"), proper=True)
    known = rows.select("tree", F.col("label_id").alias("ancestor_id")).distinct()
    met = up.join(known, ["tree", "ancestor_id"]).groupBy("tree", "label_id").agg(F.max_by("ancestor_id", "ancestor_depth").alias("parent_id"))
    return rows.select("tree", "label_id").join(met, ["tree", "label_id"], "left")


def merge_duplicates(nodes: DataFrame) -> DataFrame:
    """Siblings of the same label become the first of them: adds `kept` (path of the one that stays) to every node."""
    first = nodes.groupBy("tree", "label_id").agg(F.min("path").alias("kept"))
    return nodes.join(first, ["tree", "label_id"])


def child_table(nodes: DataFrame, value: Column) -> DataFrame:
    """Values of each node's children in order: tree, parent_id, children (array)."""
    rows = nodes.where(F.size("label") > 1).select("tree", "path", label_id(F.slice("label", 1, F.size("label") - 1)).alias("parent_id"), value.alias("v"))
    return rows.groupBy("tree", "parent_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "v"))), lambda x: x["v"]).alias("children"))


def table_of_contents(nodes: DataFrame) -> DataFrame:
    """Index and title of each node's children, for nodes all of whose children are titled: tree, label_id, toc_pos, index, title."""
    rows = nodes.where(F.size("label") > 1).select("tree", "path", label_id(F.slice("label", 1, F.size("label") - 1)).alias("parent_id"), F.element_at("label", -1).alias("index"), "title")
    whole = rows.groupBy("tree", "parent_id").agg(F.bool_and(F.col("title").isNotNull()).alias("ok")).where("ok").select("tree", "parent_id")
    kept = rows.join(whole, ["tree", "parent_id"])
    return numbered(kept, ["tree", "parent_id"], ["path"], "toc_pos").select("tree", F.col("parent_id").alias("label_id"), "toc_pos", "index", "title")


def _celled(own: DataFrame, cell: int) -> DataFrame:
    """own with _cell: -1, but the number of a child's cell among its parent's children where there are more than `cell` of them."""
    rows = own.withColumn("_parent", F.coalesce(label_id(F.slice("label", 1, F.greatest(F.size("label") - 1, F.lit(0)))), F.lit("")))
    crowded = rows.where("_depth > 1").groupBy("tree", "_parent").agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {cell}").select("tree", "_parent")
    path = f"{shared_root(own.sparkSession)}/crowded-{uuid.uuid4().hex[:12]}"
    crowded.write.parquet(path)  # read three times below, and counting is a pass over all rows
    crowded = own.sparkSession.read.schema(crowded.schema).parquet(path)
    n = crowded.limit(LISTED + 1).count()
    if not n:
        return rows.withColumn("_cell", F.lit(-1))
    crowded = F.broadcast(crowded) if n <= LISTED else crowded
    placed = numbered(rows.where("_depth > 1").join(crowded, ["tree", "_parent"], "left_semi"), ["tree", "_parent"], ["path"], "_nth")
    placed = placed.withColumn("_cell", F.expr(f"cast((_nth - 1) div {cell} as int)")).drop("_nth")
    return rows.join(crowded, ["tree", "_parent"], "left_anti").withColumn("_cell", F.lit(-1)).unionByName(placed)


def merkle(nodes: DataFrame, depths: int, fields: tuple[str, ...] = ("text", "title", "label_id"), cell: int = CELL, plain: bool = False, root: str | None = None) -> DataFrame:
    """Adds node_hash (own fields) and subtree_hash (own hash and the children's subtree hashes, in order), bottom up: one aggregation a level.

    More than `cell` children of a node go by cells of so many in order: the hash of each cell stands for it in the node's, so
    no group holds more than `cell` hashes and no node's row more than one for each cell. plain: cells are put together as they are,
    so the hash is that of all children's hashes whatever their number (a node's row then holds 64 bytes a child, 2 GB at most).
    The path is unique in a tree.

    A level is a table, written (to root, or the shared folder) with its hashes and read by the level above and by the result, so
    nodes are computed once, not once for every reader. The label's length tells the level; nodes that have it as `level`, best a constant
    of each branch of a union, are not computed for other levels, and the result is read level by level (see versions.descended)."""
    spark, root = nodes.sparkSession, root or f"{shared_root(nodes.sparkSession)}/merkle-{uuid.uuid4().hex[:12]}"
    at = F.col("level") if "level" in nodes.columns else F.size("label")
    node_hash = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(f), F.lit("")) for f in fields]), 256)
    in_order = lambda at, h: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, h))), lambda x: x[h]), "")
    below = None
    for d in range(depths, 0, -1):
        level = nodes.where(at == d).drop("level")
        if below is None:
            level = level.withColumn("_below", F.lit(""))
        else:
            level = level.join(below, ["tree", "label_id"], "left").withColumn("_below", F.coalesce("_below", F.lit("")))
        level = level.withColumn("subtree_hash", F.sha2(F.concat(node_hash, "_below"), 256)).select(*[c for c in nodes.columns if c != "level"], "subtree_hash")
        level.write.parquet(f"{root}/level={d}")
        if d == 1:
            break
        up = spark.read.schema(level.schema).parquet(f"{root}/level={d}").select("tree", "label", "path", "subtree_hash", F.lit(d).alias("_depth"))
        up = _celled(up, cell)
        below = up.where("_cell < 0").groupBy("tree", "_parent").agg(in_order("path", "subtree_hash").alias("_below"))
        cells = up.where("_cell >= 0").groupBy("tree", "_parent", "_cell").agg(in_order("path", "subtree_hash").alias("_h"))
        if not plain:
            cells = cells.withColumn("_h", F.sha2("_h", 256))
        below = below.unionByName(cells.groupBy("tree", "_parent").agg(in_order("_cell", "_h").alias("_below"))).withColumnRenamed("_parent", "label_id")
    done = spark.read.schema(level.withColumn("level", F.lit(1)).schema).parquet(root)
    return done.withColumn("node_hash", node_hash).select(*nodes.columns, "node_hash", "subtree_hash")


def carry_forward(rows: DataFrame, header: Column, order: str = "path", name: str = "carried") -> DataFrame:
    """Each row gets the last non-null header at or before it in its tree (sections under their subpart)."""
    return carried(rows, ["tree"], [order], {name: header})


def parents_by_level(rows: DataFrame, level: str, levels: int, order: str = "pos", id_col: str = "id") -> DataFrame:
    """The parent of a row is the nearest row before it with a smaller level (a priority stack): adds parent.

    For each level, the last row of that level is carried; it only counts while no smaller level came after it, which
    is so when its position is the largest among all smaller or equal levels.
    """
    held = {f"_last{k}": F.when(F.col(level) == k, F.struct(F.col(order).alias("p"), F.col(id_col).alias("i"))) for k in range(levels)}
    rows, last = carried(rows, ["tree"], [order], held, here=False), [F.col(f"_last{k}") for k in range(levels)]
    best = None
    for k in range(levels):
        candidate = F.when(F.col(level) > k, last[k])
        best = candidate if best is None else F.when(best.isNull() | (candidate["p"] > best["p"]), F.coalesce(candidate, best)).otherwise(best)
    return rows.withColumn("parent", best["i"]).drop(*held)


# -- sort keys --------------------------------------------------------------------------------------------------

def roman(n: int) -> str:
    """Lower-case roman numeral of 1..50."""
    out = ""
    for value, sign in ((50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out, n = out + sign, n - value
    return out


ROMAN = [roman(i) for i in range(1, 51)]


def natural_key(part: Column, as_roman: Column | bool = False) -> Column:
    """A key that sorts label parts: numbers by value, romans by ordinal where flagged, else runs of digits and letters.

    It is an array of (is_text, number, text), so numbers come before texts, as the tree's mixed keys are ordered.
    """
    none = F.lit(None).cast("string")
    runs = F.regexp_extract_all(part, F.lit("([0-9]+|[A-Z]+|[a-z]+)"), 1)
    run_key = lambda x: F.struct((~x.rlike("^[0-9]+$")).alias("is_text"), F.when(x.rlike("^[0-9]+$"), x.cast("long")).alias("number"), F.when(~x.rlike("^[0-9]+$"), x).alias("text"))
    ordinal = F.array_position(F.array(*[F.lit(r) for r in ROMAN]), part)
    flagged = F.lit(as_roman) if isinstance(as_roman, bool) else as_roman
    return F.when(flagged & (ordinal > 0), F.array(F.struct(F.lit(False).alias("is_text"), ordinal.cast("long").alias("number"), none.alias("text")))).otherwise(F.transform(runs, run_key))


def root_rank(node_type: Column) -> Column:
    """Order of a root's children: empty part, subparts, appendices, interpretations."""
    return F.when(node_type == "emptypart", 0).when(node_type == "subpart", 1).when(node_type == "appendix", 2).when(node_type == "interp", 3).otherwise(4)


def replay_order(label: Column) -> tuple[Column, Column, Column]:
    """Labels in the order in which changes to them are applied: subparts first, then by length of the label, ties by the label."""
    return (~label.contains("Subpart")).cast("int"), F.length(label), label
