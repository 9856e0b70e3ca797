"""Replay by units against the replay of whole trees, and histories by content."""

import random

import pytest
from pyspark.sql import functions as F

from lexstrata.functions.model import Node, from_rows, to_rows
from lexstrata.functions.replay import Change, replay
from lexstrata.operators import notices as O
from lexstrata.plans import build
from lexstrata.plans import history as H
from lexstrata.sources import sinks
from lexstrata.sources.store import Store

NODE = "array<struct<path:array<int>,label:array<string>,label_id:string,node_type:string,title:string,text:string,tagged_text:string>>"
LOG = f"tree string, document_number string, effective_on string, publication_date string, seq int, action string, label_id string, field string, destination array<string>, subpart array<string>, node {NODE}"


def tree(part, rnd, subparts=True, sections=6):
    made = []
    for i in range(1, sections + 1):
        paragraphs = [Node(f"({c}) text {c}", [part, str(i), c], "regtext", None, "", None, [Node(f"({k}) low", [part, str(i), c, str(k)], "regtext") for k in range(1, rnd.randrange(3))]) for c in "abc"]
        made.append(Node("", [part, str(i)], "regtext", f"§ {part}.{i}", "", None, paragraphs))
    if subparts:
        half = sections // 2
        top = [Node("", [part, "Subpart", x], "subpart", f"Subpart {x}", "", None, made[a:b]) for x, a, b in (("A", 0, half), ("B", half, sections))]
    else:
        top = [Node("", [part, "Subpart"], "emptypart", None, "", None, made)]
    top.append(Node("App", [part, "A"], "appendix", "Appendix A", "", None, [Node("one", [part, "A", "1"], "appendix")]))
    comments = [Node("", [part, str(i), "Interp"], "interp", f"Section {i}", "", None, [Node("c", [part, str(i), "Interp", "1"], "interp")]) for i in (1, 3)]
    top.append(Node("", [part, "Interp"], "interp", "Supplement I", "", None, comments))
    return Node("", [part], "regtext", f"PART {part}", "", None, top)


def change(part, rnd, wild):
    """(action, label, node, field, destination, subpart). wild: also what ties units together."""
    i, c, k = str(rnd.randrange(1, 8)), rnd.choice("abcd"), str(rnd.randrange(1, 4))
    label = rnd.choice([[part, i, c], [part, i, c, k], [part, i], [part, "A", k], [part, i, "Interp"], [part, i, "Interp", k], [part, i, c, "Interp"]])
    kind = "interp" if "Interp" in label else "appendix" if label[1] == "A" else "regtext"
    n = Node(f"({label[-1]}) new {rnd.randrange(99)}", label, kind, "new title" if rnd.random() < 0.3 else None)
    if rnd.random() < 0.2:
        n.children = [Node("(9) child", [*label, "9"], kind)]
    if rnd.random() < 0.1:
        n.text, n.title = "", "[Reserved]"
    action = rnd.choice(["PUT", "PUT", "PUT", "POST", "DELETE", "KEEP", "MOVE", "RESERVE", "FIELD"])
    if not wild and len(label) == 2 and action in ("POST", "DELETE", "MOVE", "KEEP"):
        action = "FIELD"
    if action == "FIELD":
        return "PUT", label, n, rnd.choice(["[text]", "[title]", "[heading]"]), [], []
    if action == "MOVE":
        return action, label, None, None, [*label[:-1], rnd.choice("efgh")] if not wild or rnd.random() < 0.6 else [part, str(rnd.randrange(1, 9)), "e"], []
    if wild and rnd.random() < 0.15:
        return "DESIGNATE", [part, i], None, None, [part, "Subpart", rnd.choice("ABC")], []
    if wild and rnd.random() < 0.08:
        return rnd.choice([("DELETE", [part, "Subpart", "B"], None, None, [], []), ("POST", [part, "Subpart", "D"], Node("", [part, "Subpart", "D"], "subpart", "Subpart D"), None, [], []), ("POST", [part, "30"], Node("x", [part, "30"], "regtext", "§ 30"), None, [], [part, "Subpart", "A"])])
    return action, label, n if action in ("PUT", "POST", "RESERVE") else None, None, [], []


def log_of(part, rnd, notices, wild):
    rows, serial = [], []
    for d in range(notices):
        day = f"20{10 + d // 3}-01-01"
        number = f"n{d:02}"
        some = [change(part, rnd, wild) for _ in range(rnd.randrange(1, 6))]
        serial.append((number, [Change(a, "-".join(x), n, f, tuple(to), tuple(sub)) for a, x, n, f, to, sub in some]))
        rows += [(part, number, day, f"2009-01-{d + 1:02}", s, a, "-".join(x), f, to, sub, to_rows(n) if n else None) for s, (a, x, n, f, to, sub) in enumerate(some)]
    return rows, serial


def one_after_the_other(root, serial):
    """All versions of a tree by replays of the whole of it."""
    root = from_rows(to_rows(root))
    out = [("", *r) for r in to_rows(root)]
    for number, changes in serial:
        root = replay(root, [Change(c.action, c.label_id, from_rows(to_rows(c.node)) if c.node else None, c.field, c.destination, c.subpart) for c in changes])
        out += [(number, *r) for r in to_rows(root)]
    return out


@pytest.fixture(scope="module")
def logs(spark):
    """Twelve trees with random logs, half of them such that tie units together; and one that nothing changes."""
    rnd = random.Random(11)
    nodes, rows, want = [], [], []
    for t in range(60):
        part = str(100 + t)
        root = tree(part, rnd, t % 2 == 0)
        if t == 7:
            root.children[0].children.append(Node("twice", [part, "1"], "regtext", "§ again"))  # a section that is there twice
        if t == 9:
            root.children[0].children[0].children.append(Node("astray", [part, "2", "z"], "regtext"))
        some, serial = log_of(part, rnd, 0 if t == 11 else rnd.randrange(1, 7), t % 4 < 2)
        nodes += [(part, *r) for r in to_rows(root)]
        rows += some
        want += [(part, *r) for r in one_after_the_other(root, serial)]
    n = spark.createDataFrame(nodes, f"tree string, {', '.join(f'{c} {k}' for c, k in zip(H.COLUMNS, ('array<int>', 'array<string>', 'string', 'string', 'string', 'string', 'string'), strict=True))}")
    return n.persist(), spark.createDataFrame(rows, LOG).persist(), want


def as_rows(df):
    return sorted((r["tree"], r["version"], tuple(r["path"]), tuple(r["label"]), r["label_id"], r["node_type"], r["title"] or "", r["text"], r["tagged_text"]) for r in df.collect())


def test_units_replayed_apart_give_the_same_versions(logs):
    nodes, changes, want = logs
    got = as_rows(build.versions(nodes, changes))
    assert got == sorted((t, v, tuple(p), tuple(x), i, k, title or "", text, tagged) for t, v, p, x, i, k, title, text, tagged in want)


def test_units_share_batches(logs):
    """A group of its own in Python costs more than a small unit's replay: units are rows of batches."""
    nodes, changes, _ = logs
    plan = H.states(nodes, changes)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroups" not in plan


def test_copies_are_as_deep_as_deepcopy():
    import copy

    from lexstrata.functions import replay as R

    root = tree("5", random.Random(1))
    twin = R._copied(root)
    assert twin == copy.deepcopy(root) and not {id(n) for n in root.walk()} & {id(n) for n in twin.walk()}
    twin.children[0].label.append("x"), twin.children[0].children.pop(), twin.children[1].child_labels.append("y")
    assert root == tree("5", random.Random(1))


def test_what_stays_within_a_unit_is_a_task_of_its_own(logs):
    nodes, changes, _ = logs
    free = H.independent(nodes, changes).groupBy("tree").count().collect()
    tame = {str(100 + t) for t in range(60) if t % 4 >= 2 and t not in (7,)}
    assert {r["tree"] for r in free} >= tame - {"107", "109"} and {"107", "109"}.isdisjoint(r["tree"] for r in free)
    counts = {r["tree"]: r["count"] for r in free}
    in_tame, in_wild = [counts[t] for t in tame & counts.keys()], [counts.get(str(100 + t), 0) for t in range(60) if t % 4 < 2]
    # of eight units, those that an interpretation moved out of or that were not there are tied even in tame logs
    assert 8 in in_tame and min(in_tame) >= 3 and sum(in_tame) / len(in_tame) > sum(in_wild) / len(in_wild) + 1 and min(in_wild) < 4


def test_a_large_tree_is_the_work_of_many_tasks(spark):
    """Rows of the largest task do not grow with the tree."""
    paragraphs = spark.range(20_000).select(F.lit("1").alias("tree"), F.expr("array(0, cast(id div 20 as int), cast(id % 20 as int))").alias("path"), F.expr("array('1', string(id div 20), string(id % 20))").alias("label"), F.lit("regtext").alias("node_type"), F.lit("words").alias("text"))
    sections = spark.range(1000).select(F.lit("1").alias("tree"), F.expr("array(0, cast(id as int))").alias("path"), F.expr("array('1', string(id))").alias("label"), F.lit("regtext").alias("node_type"), F.lit("").alias("text"))
    root = spark.range(1).select(F.lit("1").alias("tree"), F.array(F.lit(0)).alias("path"), F.array(F.lit("1")).alias("label"), F.lit("regtext").alias("node_type"), F.lit("").alias("text"))
    nodes = paragraphs.unionByName(sections).unionByName(root).withColumns({"label_id": F.array_join("label", "-"), "title": F.lit(None).cast("string"), "tagged_text": F.lit("")})
    changes = spark.range(3000).select(F.lit("1").alias("tree"), F.expr("concat('n', id % 3)").alias("document_number"), F.expr("concat('201', id % 3, '-01-01')").alias("effective_on"), F.lit("2009-01-01").alias("publication_date"), F.col("id").cast("int").alias("seq"), F.lit("DELETE").alias("action"), F.expr("concat('1-', id div 3, '-', id % 3)").alias("label_id"), F.lit(None).cast("string").alias("field"), F.expr("cast(array() as array<string>)").alias("destination"), F.expr("cast(array() as array<string>)").alias("subpart"), F.lit(None).cast(NODE).alias("node"))
    states = H.states(nodes, changes).persist()
    sizes = {r["unit"]: r["count"] for r in states.groupBy("unit").count().collect()}
    assert len(sizes) == 1001 and sizes[""] == 1001 and max(n for u, n in sizes.items() if u) <= 21 + 3 * 20
    ends = {r["version"]: r["count"] for r in H.versions_of(states, H.all_numbers(nodes, changes)).groupBy("version").count().collect()}
    assert ends == {"": 21_001, "n0": 20_001, "n1": 19_001, "n2": 18_001}
    states.unpersist()


def test_history_by_content(spark, logs, tmp_path):
    nodes, changes, _ = logs
    states, numbers = H.states(nodes, changes).persist(), H.all_numbers(nodes, changes).persist()
    whole = H.versions_of(states, numbers).persist()
    bodies, places = H.bodies_and_places(states)
    assert bodies.count() == bodies.select("node_hash").distinct().count() < whole.count() / 5
    assert places.count() < whole.count()
    sink = sinks.Sink(str(tmp_path))
    sink.history(bodies, places, numbers)
    sink.history(bodies, places, numbers)  # bodies that are there are not written again
    assert sink.read(spark, "body").count() == bodies.count()
    store = Store(spark, str(tmp_path))
    for part in ("100", "103", "107", "111"):
        for r in whole.where(F.col("tree") == part).select("version").distinct().collect():
            assert as_rows(store.as_of(part, r["version"])) == as_rows(whole.where((F.col("tree") == part) & (F.col("version") == r["version"])))
    last = O.version_table(changes).where("tree = '100'").orderBy(F.desc("version_no")).first()
    assert store.as_of("100", date="2099-01-01").first()["version"] == last["version"]
    assert store.as_of("100", date="2001-01-01").first()["version"] == "" and store.as_of("100", "none").count() == 0
    whole.unpersist(), states.unpersist()


def test_bytes_grow_with_changes_and_not_with_versions(spark):
    """Many versions that change one paragraph each."""
    root = tree("5", random.Random(1), sections=40)
    nodes = spark.createDataFrame([("5", *r) for r in to_rows(root)], "tree string, path array<int>, label array<string>, label_id string, node_type string, title string, text string, tagged_text string")
    rows = [("5", f"n{d:02}", f"2010-01-{d + 1:02}", "2009-01-01", 0, "PUT", f"5-{d + 1}-b", "[text]", [], [], [([0], ["5", str(d + 1), "b"], f"5-{d + 1}-b", "regtext", None, f"(b) changed {d}", "")]) for d in range(25)]
    states = H.states(nodes, spark.createDataFrame(rows, LOG))
    stubs = states.where("stands_for is not null").count()
    assert states.count() - stubs == nodes.count() + 25
