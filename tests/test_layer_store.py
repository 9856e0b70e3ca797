"""Layers kept between builds."""

from pyspark.sql import functions as F

from lexstrata.operators import layers as L
from lexstrata.plans import build
from lexstrata.sources import readers
from lexstrata.sources.layer_store import LayerStore, options_digest

XML = """<ROOT><PART><EAR>Pt. 105</EAR><HD>PART 105—PURPOSES (REGULATION Q)</HD><SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>Definitions.</SUBJECT><P>(a) “Bank” means a thing. See 12 U.S.C. 5511.</P><P>(b) Every bank has x_{2}.</P></SECTION>
<SECTION><SECTNO>§ 105.2</SECTNO><SUBJECT>Scope.</SUBJECT><P>A bank. See ![form](G1) and § 105.1(a).</P></SECTION></PART></ROOT>"""


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_a_second_build_computes_what_is_new(spark, tmp_path):
    tree = readers.regulation_trees(spark.createDataFrame([("105", XML)], "path string, text string")).withColumns({"tree": F.lit("105"), "version": F.lit("")}).persist()
    n = tree.count()
    changed = tree.withColumns({"version": F.lit("n1"), "text": F.when(F.col("label_id") == "105-1-b", F.lit("(b) No bank, y_{3}.")).otherwise(F.col("text"))})
    both = tree.unionByName(changed)
    own, whole = "formatting", "terms"
    store = LayerStore(spark, str(tmp_path))
    for name in (own, whole, "toc"):
        assert same(store.run(name, tree), L.run_versions(name, tree))
    assert store.computed == {own: n, whole: 1, "toc": 1}
    again = LayerStore(spark, str(tmp_path))
    for name in (own, whole, "toc"):
        assert same(again.run(name, both), L.run_versions(name, both))
    assert again.computed == {own: 1, whole: 1, "toc": 1}  # one node, and one version of the tree
    assert same(again.run(own, both), L.run_versions(own, both)) and again.computed[own] == 0
    assert same(again.run("graphics", both), L.run_versions("graphics", both))
    urls = spark.createDataFrame([("G1", "x.png")], "gid string, url string")
    assert {r["url"] for r in again.run("graphics", both, overrides=urls).collect()} == {"x.png"} and again.computed["graphics"] == n + 1  # other options, another table
    assert same(again.run("formatting", both.limit(0)), L.run_versions("formatting", both.limit(0)))
    layers = build.all_layers(both, ["formatting", "keyterms"], {}, run=again.run)
    assert sorted(layers) == ["formatting", "keyterms", "meta"] and again.computed["formatting"] == 0
    tree.unpersist()


def test_options_count_by_value(spark):
    a, b = (spark.createDataFrame(rows, "gid string, url string") for rows in ([("1", "x"), ("2", "y")], [("2", "y"), ("1", "x")]))
    assert options_digest({"overrides": a}) == options_digest({"overrides": b}) != options_digest({"overrides": a.limit(1)})
    assert options_digest({"ignore": {}, "act": None}) == options_digest({})


def test_scanner_finds_what_one_expression_a_term_finds():
    import random

    from lexstrata.functions import terms as T

    rnd = random.Random(8)
    words = ["act", "bank", "account", "open", "Bank", "x-y", "state's", "child", "children", "entity", "“q”", "e.g.", "banks", "İd", "a_b"]
    for _ in range(1500):
        terms = sorted({(" ".join(rnd.choices(words, k=rnd.randrange(1, 4))), f"1-{rnd.randrange(5)}") for _ in range(rnd.randrange(1, 9))})
        terms = list({t: (t, d) for t, d in terms}.values())
        text = "".join(rnd.choice([w, w.upper(), w + "s", T.plural(w)]) + rnd.choice([" ", " ", " ", ", ", "", "-"]) for w in rnd.choices(words, k=rnd.randrange(30)))
        excluded = [(a, a + rnd.randrange(6)) for a in (rnd.randrange(max(1, len(text))) for _ in range(rnd.randrange(3)))]
        without = rnd.choice([None, "1-0", "1-3"])
        assert T.Scanner(terms).uses(text, excluded, without) == T.uses(text, [(t, d) for t, d in terms if d != without], excluded), (terms, text)


def test_scanner_reads_a_text_once():
    import time

    from lexstrata.functions import terms as T

    scanner = T.Scanner([(f"term number {i}", str(i)) for i in range(20_000)])
    text = " ".join(f"of term number {i * 7 % 30_000}" for i in range(20_000))
    began = time.thread_time()
    assert len(scanner.uses(text)) == len({i for i in range(20_000) if i * 7 % 30_000 < 20_000})
    assert time.thread_time() - began < 5
