"""Hashes of nodes with many children, and differences found by descent."""

import hashlib

from pyspark.sql import functions as F

from lexstrata.operators import tree as T
from lexstrata.operators import versions as V

SCHEMA = "tree string, path array<int>, label array<string>, label_id string, title string, text string"


def wide(spark, sections, paragraphs, changed=(), without=(), also=()):
    """A tree with so many sections of so many paragraphs each; texts of the changed ones differ."""
    rows = [(("1",), "root"), *[(("1", str(i)), "s") for i in range(sections)], *[(("1", str(i), str(j)), "p") for i in range(sections) for j in range(paragraphs)]]
    rows = [r for r in rows if not any(r[0][: len(w)] == w for w in without)] + [(a, "new") for a in also]
    return spark.createDataFrame([("t", [int(x) for x in label], list(label), "-".join(label), None, "changed" if label in changed else text) for label, text in rows], SCHEMA)


def by_hand(rows, cell):
    """subtree_hash of every label, by recursion."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    below = {}
    for r in sorted(rows, key=lambda r: r["path"]):
        below.setdefault(tuple(r["label"][:-1]), []).append(r)

    def hash_of(r):
        hashes = [hash_of(c) for c in below.get(tuple(r["label"]), [])]
        if len(hashes) > cell:
            hashes = [sha("".join(hashes[i : i + cell])) for i in range(0, len(hashes), cell)]
        out[r["label_id"]] = sha(sha("\x1f".join((r["text"], r["title"] or "", r["label_id"]))) + "".join(hashes))
        return out[r["label_id"]]

    out = {}
    for r in below[()]:
        hash_of(r)
    return out


def test_children_beyond_a_cell(spark):
    nodes = wide(spark, 23, 3).unionByName(wide(spark, 2, 11).withColumn("tree", F.lit("u")))
    for cell in (4, 4096):
        got = T.merkle(nodes, 3, cell=cell)
        for t in ("t", "u"):
            assert {r["label_id"]: r["subtree_hash"] for r in got.where(F.col("tree") == t).collect()} == by_hand(nodes.where(F.col("tree") == t).collect(), cell)
        assert got.count() == nodes.count() and "_cell" not in got.columns


def test_plain_hashes_do_not_depend_on_cells(spark):
    """As SQL has them: of all children's hashes in order, however many there are."""
    nodes = wide(spark, 23, 3)
    want = by_hand(nodes.collect(), 10**9)
    for cell in (4, 4096):
        assert {r["label_id"]: r["subtree_hash"] for r in T.merkle(nodes, 3, cell=cell, plain=True).collect()} == want


def test_query_equals_sql_for_more_children_than_a_cell(spark, tmp_path):
    import duckdb

    from lexstrata.plans import catalog

    c = duckdb.connect()
    made = {"region": "select 0 as r_regionkey, 'R' as r_name", "nation": "select range::int as n_nationkey, 'N' || range as n_name, 0 as n_regionkey from range(2)",
        "customer": "select range as c_custkey, 'C' || range as c_name, (range // 4500)::int as c_nationkey, 'M' as c_mktsegment from range(9000)"}
    for name, sql in made.items():
        c.sql(f"copy ({sql}) to '{tmp_path}/{name}.parquet'")
        c.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    want = {tuple(r) for r in c.sql(catalog.SQL["tree_merkle"]).fetchall()}
    assert {tuple(r) for r in catalog.QUERIES["tree_merkle"](spark, str(tmp_path)).collect()} == want


def test_no_group_holds_more_than_a_cell(spark):
    """Of a node with many children, what is gathered in one row stays within the cell."""
    nodes = wide(spark, 500, 1)
    sizes = T._celled(nodes.withColumns({"node_hash": F.lit(""), "_depth": F.size("label")}), 16).groupBy("_parent", "_cell").count().where("_cell >= 0").collect()
    assert len(sizes) == 32 and max(r["count"] for r in sizes) <= 16 and sum(r["count"] for r in sizes) == 500


def test_nodes_are_computed_once(spark):
    """However many read a level: the count of its children, their places, the level above and the result."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    nodes = wide(spark, 23, 3)
    branches = [nodes.where(F.size("label") == d).mapInArrow(look, SCHEMA).withColumn("level", F.lit(d)) for d in (1, 2, 3)]
    got = T.merkle(branches[0].unionByName(branches[1]).unionByName(branches[2]), 3, cell=4)
    assert {r["label_id"]: r["subtree_hash"] for r in got.collect()} == by_hand(nodes.collect(), 4)
    assert seen.value == 1 + 23 + 23 * 3


def as_set(d):
    return {(r["tree"], r["label_id"], r["op"], r["old_text"], r["new_text"]) for r in d.collect()}


def test_descent_equals_the_join_of_all_labels(spark, tmp_path):
    old = T.merkle(wide(spark, 40, 5, also=[("1", "90"), ("1", "90", "1")]), 3).persist()
    news = {
        "same": wide(spark, 40, 5, also=[("1", "90"), ("1", "90", "1")]),
        "texts": wide(spark, 40, 5, changed={("1", "7", "2"), ("1", "7"), ("1", "9", "4")}, also=[("1", "90"), ("1", "90", "1")]),
        "subtrees": wide(spark, 40, 5, without=[("1", "3"), ("1", "4", "4")], also=[("1", "95"), ("1", "95", "1"), ("1", "5", "77")]),
        "none": wide(spark, 0, 0, without=[("1",)]),
    }
    for name, nodes in news.items():
        new = T.merkle(nodes, 3)
        for a, b in ((old, new), (new, old)) if name == "subtrees" else ((old, new),):
            assert as_set(V.tree_diff_by_descent(a, b)) == as_set(V.tree_diff(a, b)), name
    old.unpersist()


def test_rows_met_grow_with_changes(spark):
    old = T.merkle(wide(spark, 60, 20), 3).persist()
    assert V.descended(old, old).count() == 1
    one = T.merkle(wide(spark, 60, 20, changed={("1", "7", "2")}), 3)
    assert V.descended(old, one).count() == 1 + 60 + 20
    two = T.merkle(wide(spark, 60, 20, changed={("1", "7", "2"), ("1", "8", "2")}), 3)
    assert V.descended(old, two).count() == 1 + 60 + 40
    old.unpersist()


def test_no_level_is_met_below_the_leaves(spark, tmp_path):
    old, new = (T.merkle(wide(spark, 6, 2, changed=changed), 3) for changed in ((), {("1", "4", "1")}))
    assert V.descended(old, new, str(tmp_path)).count() == 1 + 6 + 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["level=1", "level=2", "level=3"]
