"""Replay of change logs, split by what depends on what, and histories as intervals.

A document is cut into units: its sections, appendices, and the interpretations as one. Most changes stay within a unit: they
revise, add or remove what is below it, or replace it where it stands. What ties units together (a section that comes, goes
or moves, paragraphs that move to another section, subparts) is replayed together with the skeleton of the document, in which
every independent unit is one node that stands for it. Units and skeletons are replayed by tasks of their own, so a large
document is the work of many; what they give is put together by unit and version.

The result of a task is intervals: a node with its place and text, and the versions from which and before which it is so. So the
rows of a history grow with the changes and not with the number of versions.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.arrow import flat_map
from ..functions.model import Node, from_rows, to_rows
from ..functions.replay import Change, replay
from ..operators.joins import small
from ..operators.notices import version_table

COLUMNS = ("path", "label", "label_id", "node_type", "title", "text", "tagged_text")
#: The unit of what is replayed with the skeleton.
CORE = ""
_STATE = "unit string, stands_for string, path array<int>, label array<string>, label_id string, node_type string, title string, text string, tagged_text string, from_no int, to_no int"


def unit_of(label: Column) -> Column:
    """The label of the unit that a label belongs to; null for roots and subparts."""
    own = F.when(F.array_contains(label, "Interp"), F.concat(label[0], F.lit("-Interp"))).when(F.size(label) > 1, F.concat_ws("-", label[0], label[1]))
    return F.when(~F.array_contains(label, "Subpart"), own)


def units(nodes: DataFrame) -> DataFrame:
    """tree, unit, unit_type, whole: the units of every tree. whole: the tree is no clean hierarchy (a label outside of its unit's
    subtree, a unit that is there twice, a subpart below another node), so nothing in it may be replayed apart."""
    n = nodes.select("tree", "path", "label", "label_id", "node_type", unit_of(F.col("label")).alias("unit"), F.col("node_type").isin("subpart", "emptypart").alias("_sub"))
    n = n.withColumn("unit", F.when(~F.col("_sub"), F.col("unit")))
    roots = n.where("unit = label_id").groupBy("tree", "unit").agg(F.min("path").alias("_at"), F.min("node_type").alias("unit_type"), F.count(F.lit(1)).alias("_n"))
    below = n.where("unit is not null").join(roots, ["tree", "unit"], "left")
    bad = below.where("_at is null or _n > 1 or slice(path, 1, size(_at)) <> _at").select("tree").unionByName(n.where("_sub and size(path) <> 2").select("tree"))
    bad = bad.unionByName(n.groupBy("tree").agg(F.count_distinct(F.col("label")[0]).alias("_parts"), F.count_if(F.size("path") == 1).alias("_roots")).where("_parts <> 1 or _roots <> 1").select("tree"))
    return roots.drop("_at", "_n").join(bad.distinct().withColumn("whole", F.lit(True)), "tree", "left").withColumn("whole", F.coalesce("whole", F.lit(False)))


def independent(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """tree, unit: the units whose changes (if any) all stay within them."""
    known = units(nodes)
    label, to = F.split("label_id", "-"), F.col("destination")
    c = changes.select("tree", "action", "label_id", "field", "destination", unit_of(label).alias("unit"), F.size(F.coalesce("node", F.array())).alias("_size"), (F.coalesce(F.size("destination"), F.lit(0)) > 0).alias("_goes"),
        F.when(F.coalesce(F.size("destination"), F.lit(0)) > 1, unit_of(to)).alias("_to"), F.array_join(to, "-").alias("_to_id"), F.col("node")[0]["label_id"].alias("_node_id"), F.col("node")[0]["node_type"].alias("_type"), F.col("node").alias("_node"))
    within = F.forall(F.coalesce("_node", F.array().cast(changes.schema["node"].dataType)), lambda x: F.coalesce(unit_of(x["label"]) == F.col("unit"), F.lit(False)))
    met = c.join(known.select("tree", "unit", "unit_type"), ["tree", "unit"], "left")
    inside, itself, edit = F.col("label_id") != F.col("unit"), F.col("label_id") == F.col("unit"), F.col("field").isNotNull()
    made = within & (F.col("_node_id") == F.col("label_id"))
    stays = (
        F.when(F.col("unit_type").isNull(), False)
        .when((F.col("action") == "PUT") & edit, True)
        .when(F.col("action").isin("PUT", "RESERVE"), made & (inside | (F.col("_type") == F.col("unit_type"))))
        .when(F.col("action") == "POST", made & inside)
        .when(F.col("action").isin("DELETE", "KEEP"), inside)
        .when(F.col("action") == "MOVE", inside & (F.col("_to") == F.col("unit")) & (F.col("_to_id") != F.col("unit")))
        .otherwise(False)
    )
    met = met.withColumn("_stays", F.coalesce(stays, F.lit(False)))
    tied = met.where("not _stays and unit is not null").select("tree", "unit").unionByName(met.where("not _stays and _to is not null").select("tree", F.col("_to").alias("unit"))).distinct()
    # changes of a subpart or a root as a whole concern all that is below
    whole = met.where("unit is null and field is null and (action in ('DELETE', 'PUT', 'MOVE', 'RESERVE', 'KEEP') or _size > 1)").select("tree").distinct()
    return known.where("not whole").join(tied, ["tree", "unit"], "left_anti").join(whole, "tree", "left_anti").select("tree", "unit")


def _node(rows) -> Node | None:
    return from_rows([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows]) if rows is not None and len(rows) else None


def _replayed(root: Node, log, cut: int, stubs: set[str]):
    """stands_for, COLUMNS, from_no and to_no of the rows of a tree under its changes (by version_no, in order). The first `cut` places of
    paths are left out, with the nodes that have fewer. A node that stands for a unit has a place and a label only."""
    open_: dict[tuple, int] = {}

    def rows(tree: Node):
        for path, label, label_id, node_type, title, text, tagged in to_rows(tree):
            if len(path) >= cut:
                stub = label_id if label_id in stubs else None
                own = (None, None, None) if stub else (title, text, tagged)
                yield (stub, tuple(path[cut:]), tuple(label), label_id, node_type, *own)

    def close(now: set[tuple], no: int):
        for r in [r for r in open_ if r not in now]:
            yield (*r, open_.pop(r), no)
        for r in now:
            open_.setdefault(r, no)

    yield from close(set(rows(root)), 0)
    for no, group in log:
        root = replay(root, group)
        yield from close(set(rows(root)), no)
    for r, since in open_.items():
        yield (*r, since, None)


def states(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """The history of every tree as intervals: tree and the columns of _STATE.

    nodes and changes: as for build.versions. Rows of unit '' are the document's own, with whole paths; where such a row stands for
    a unit, the rows of that unit have paths below its place. A row holds from version from_no on and before version to_no
    (null: still). One task has a unit with its changes, or a skeleton with the units that are tied together.
    """
    numbers = small(version_table(changes).where("version_no > 0").select("tree", F.col("version").alias("_version"), "version_no"))
    log = changes.where("effective_on is not null").withColumn("_version", F.col("document_number").cast("string")).join(numbers, ["tree", "_version"])
    free = independent(nodes, changes).withColumn("_free", F.lit(True))
    keyed = nodes.select("tree", *COLUMNS, unit_of(F.col("label")).alias("unit")).withColumn("unit", F.when(~F.col("node_type").isin("subpart", "emptypart"), F.col("unit")))
    keyed = keyed.join(free, ["tree", "unit"], "left")
    own = keyed.where("_free").select("tree", "unit", *COLUMNS, F.lit(False).alias("_stub"))
    core = keyed.where("_free is null or label_id = unit").select("tree", F.lit(CORE).alias("unit"), *COLUMNS, F.coalesce("_free", F.lit(False)).alias("_stub"))
    label = F.split("label_id", "-")
    wanted = ["tree", "unit", "version_no", "seq", "action", "label_id", "field", "destination", "subpart", "node"]
    told = log.withColumn("unit", unit_of(label)).join(free, ["tree", "unit"], "left").withColumn("unit", F.when(F.col("_free"), F.col("unit")).otherwise(F.lit(CORE))).select(*wanted)

    def fold(unit, rows, log):
        given = [tuple(r[c] for c in COLUMNS) for r in rows]
        if unit:
            top = min(given, key=lambda r: len(r[0]))
            depth = len(top[0])
            root = Node("", [top[1][0]], "regtext")
            root.children = [from_rows([(r[0][depth - 1 :], *r[1:]) for r in given])]
        else:
            root = from_rows(given)
        ordered = sorted(log or (), key=lambda r: (r["version_no"], r["seq"] is None, r["seq"] or 0))
        notices = (
            (no, [Change(r["action"], r["label_id"], _node(r["node"]), r["field"], tuple(r["destination"] or ()), tuple(r["subpart"] or ())) for r in group])
            for no, group in itertools.groupby(ordered, key=lambda r: r["version_no"])
        )
        return _replayed(root, notices, 2 if unit else 0, {r["label_id"] for r in rows if r["_stub"]})

    # A unit with its changes is one row: many small units go in one batch, so that none costs a group of its own. Replay costs more
    # than the bytes of its input tell, so the number of tasks is given.
    spark = nodes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    both = own.unionByName(core).repartition(tasks, "tree", "unit").groupBy("tree", "unit").agg(F.collect_list(F.struct(*COLUMNS, "_stub")).alias("_rows"))
    logs = told.repartition(tasks, "tree", "unit").groupBy("tree", "unit").agg(F.collect_list(F.struct(*wanted[2:])).alias("_log"))
    met = both.join(logs, ["tree", "unit"], "left").withColumn("_unit", F.col("unit"))
    return flat_map(met, ["tree", "unit"], ["_unit", "_rows", "_log"], fold, _STATE.removeprefix("unit string, "))


def versions_of(history: DataFrame, numbers: DataFrame) -> DataFrame:
    """The whole versions of a history (see states): tree, version, version_no and COLUMNS.

    numbers: tree, version, version_no of all versions wanted. Every row is written out for the versions it holds in; rows of a unit
    take the place of the node that stands for it in the same version, which is gathered by a window over (tree, unit, version).
    """
    known = numbers.groupBy("tree").agg(F.array_sort(F.collect_set(F.struct("version_no", "version"))).alias("_known"))
    holds = F.filter("_known", lambda v: (v["version_no"] >= F.col("from_no")) & (F.col("to_no").isNull() | (v["version_no"] < F.col("to_no"))))
    rows = history.join(small(known), "tree").withColumn("_v", F.explode(holds))
    place = W.partitionBy("tree", F.coalesce("stands_for", F.nullif("unit", F.lit(CORE)), F.concat(F.lit("#"), "label_id")), "_v.version_no")
    rows = rows.withColumn("_at", F.max(F.when(F.col("stands_for").isNotNull(), F.col("path"))).over(place)).where("stands_for is null")
    rows = rows.withColumn("path", F.when(F.col("unit") == CORE, F.col("path")).otherwise(F.concat("_at", "path"))).where("path is not null")
    return rows.select("tree", F.col("_v.version").alias("version"), F.col("_v.version_no").alias("version_no"), *COLUMNS)


def all_numbers(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """version_table with the first version of trees that nothing changes."""
    table = version_table(changes)
    quiet = nodes.select("tree").distinct().join(table.select("tree").distinct(), "tree", "left_anti")
    return table.unionByName(quiet.select("tree", F.lit("").alias("version"), F.lit(0).alias("version_no")), allowMissingColumns=True)


def body_hash() -> Column:
    return F.sha2(F.concat_ws("\x1f", F.coalesce("node_type", F.lit("")), F.concat(F.when(F.col("title").isNull(), "-").otherwise("+"), F.coalesce("title", F.lit(""))), F.coalesce("text", F.lit("")), F.coalesce("tagged_text", F.lit(""))), 256)


def bodies_and_places(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A history by content: bodies (node_hash, node_type, title, text, tagged_text), each once whatever the number of versions,
    documents and places it is in; and places (tree, unit, stands_for, path, label, label_id, node_hash, from_no, to_no)."""
    hashed = history.withColumn("node_hash", body_hash())
    bodies = hashed.where("stands_for is null").select("node_hash", "node_type", "title", "text", "tagged_text").dropDuplicates(["node_hash"])
    return bodies, hashed.select("tree", "unit", "stands_for", "path", "label", "label_id", "node_hash", "from_no", "to_no")


def joined(bodies: DataFrame, places: DataFrame) -> DataFrame:
    """The history that bodies_and_places() took apart."""
    return places.join(bodies, "node_hash", "left").drop("node_hash")
