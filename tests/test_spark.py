import pytest
from pyspark.sql import functions as F
from sql_rows import rows_of

from lexstrata.functions import kernels as K
from lexstrata.operators import joins as J
from lexstrata.operators import layers as L
from lexstrata.operators import text as X
from lexstrata.operators import tree as T
from lexstrata.operators import versions as V
from lexstrata.plans import build, catalog
from lexstrata.sources import readers, sinks
from lexstrata.streaming import replay as S


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, sf_dir, duck, name):
    assert rows_of(catalog.QUERIES[name](spark, sf_dir).toPandas()) == rows_of(duck.sql(catalog.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_kernel_queries_run(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


XML = """<ROOT><PART><EAR>Pt. 105</EAR><HD>PART 105—PURPOSES (REGULATION Q)</HD><SUBPART><HD>Subpart A—General</HD>
<SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>Definitions.</SUBJECT><P>For purposes of this part:</P><P>(a) <E T="03">Bank.</E> “Bank” means a thing. See 12 U.S.C. 5511.</P><P>(b) Every bank under paragraph (a) of this section counts x_{2}.</P></SECTION>
<SECTION><SECTNO>§ 105.2</SECTNO><SUBJECT>Scope.</SUBJECT><P>Banks and § 105.1(b) and § 105.9.</P></SECTION></SUBPART></PART></ROOT>"""
NOTICE = """<RULE><REGTEXT PART="105"><AMDPAR>In § 105.1, revise paragraph (b) to read as follows:</AMDPAR><SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>Definitions.</SUBJECT><STARS/><P>(b) New words.</P></SECTION></REGTEXT>
<REGTEXT PART="105"><AMDPAR>Remove § 105.2.</AMDPAR></REGTEXT></RULE>"""


@pytest.fixture(scope="module")
def nodes(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("reg")
    (d / "reg.xml").write_text(XML)
    return readers.regulation_trees(readers.whole_files(spark, str(d / "reg.xml"))).withColumn("tree", F.lit("105")).persist()


def test_readers(spark, nodes, tmp_path):
    assert [r["label_id"] for r in nodes.orderBy("path").collect()] == ["105", "105-Subpart-A", "105-1", "105-1-a", "105-1-b", "105-2"]
    (tmp_path / "x.txt").write_text("T\nPART 7\n§ 7.1 A\n(a) b\n")
    files = readers.whole_files(spark, str(tmp_path / "x.txt"))
    assert readers.text_trees(files).count() == 4
    with pytest.raises(Exception, match="XML"):
        readers.regulation_trees(files).collect()
    (tmp_path / "e.xml").write_text("<a x='1'>t<b>u</b>v</a>")
    assert [(r["tag"], r["parent_id"], r["text"], r["tail"]) for r in readers.xml_elements(readers.whole_files(spark, str(tmp_path / "e.xml"))).orderBy("elem_id").collect()] == [("a", None, "t", ""), ("b", 0, "u", "v")]
    (tmp_path / "n.json").write_text('{"document_number":"b","publication_date":"2012-02-01","effective_on":"2012-03-01","type":"Rule","cfr_references":[{"title":12,"part":105}]}\n{"document_number":"a","publication_date":"2012-01-01","effective_on":"2013-03-01","type":"Proposed Rule","cfr_references":[{"title":12,"part":105}]}\n')
    assert [r["document_number"] for r in readers.notices(spark, str(tmp_path / "n.json"), 12, 105).collect()] == ["a", "b"]
    assert [r["document_number"] for r in readers.notices(spark, str(tmp_path / "n.json"), 12, 105, True, "2012-12-31").collect()] == ["b"]


def test_layers(nodes):
    got = lambda n, *c: sorted(tuple(r[x] for x in ("label_id", *c)) for r in L.run(n, nodes).collect())
    assert got("external-citations", "citation", "citation_type") == [("105-1-a", "12 U.S.C. 5511", "USC")]
    assert got("internal-citations", "cited") == [("105-1-b", "105-1-a"), ("105-2", "105-1-b")]
    assert got("paragraph-markers", "marker") == [("105-1-a", "(a)"), ("105-1-b", "(b)")]
    assert got("keyterms", "keyterm") == [("105-1-a", "Bank.")]
    assert got("formatting", "kind", "found") == [("105-1-b", "subscript", "x_{2}")]
    assert got("terms", "term", "definition") == [("105-1-b", "bank", "105-1-a"), ("105-2", "banks", "105-1-a")]
    assert got("meta", "statutory_name", "reg_letter") == [("105", "PURPOSES", "Q")]
    assert ("105-2", ) not in got("toc")


def test_versions_layers_and_diffs(spark, nodes):
    files = spark.createDataFrame([("2012-1", NOTICE)], "document_number string, text string")
    log = build.notice_changes(files).withColumns({"tree": F.lit("105"), "effective_on": F.lit("2012-03-01"), "publication_date": F.lit("2012-01-01")})
    assert [(r["action"], r["label_id"]) for r in log.orderBy("seq").collect()] == [("PUT", "105-1-b"), ("DELETE", "105-2")]
    both = build.versions(nodes, log).persist()
    assert [r["text"] for r in build.history_of(both, "105-1-b").orderBy("version").collect()][1] == "(b) New words."
    diffs = sorted((r["lhs"], r["rhs"], r["label_id"], r["op"]) for r in build.version_pairs_diff(both).collect())
    assert diffs == [("", "2012-1", "105-1-b", "modified"), ("", "2012-1", "105-2", "deleted"), ("2012-1", "", "105-1-b", "modified"), ("2012-1", "", "105-2", "added")]
    marks = sorted((r["version"], r["label_id"]) for r in L.run_versions("paragraph-markers", both).collect())
    assert marks == [("", "105-1-a"), ("", "105-1-b"), ("2012-1", "105-1-a"), ("2012-1", "105-1-b")]
    assert {r["tree"] for r in L.run_versions("terms", both).collect()} == {"105@"}


def test_sinks(spark, nodes, tmp_path):
    sink = sinks.Sink(str(tmp_path), "json")
    versioned = nodes.withColumn("reg", F.lit("105")).withColumn("version", F.lit("v1"))
    sink.regulation(versioned)
    assert sink.read(spark, "regulation").count() == nodes.count()
    with pytest.raises(ValueError):
        sinks.Sink("x", "sql")
    for form, part in (("json", '"label_id"'), ("markdown", "# PART 105"), ("xml", '<section label="105-1">')):
        doc = sinks.tree_documents(nodes, ["tree"], form).first()["document"]
        assert part in doc or form == "json" and '"node_type": "subpart"' in doc
    spans = spark.createDataFrame([("105", "105-1-b", 0, 3, "[b]")], "tree string, label_id string, start int, end int, value string")
    assert sinks.annotate(nodes, spans).where("label_id = '105-1-b'").first()["text"].startswith("[b] Every")


def test_joins(spark):
    points = spark.createDataFrame([(1, 5), (1, 50), (2, 5)], "k int, p int")
    ranges = spark.createDataFrame([(1, 0, 7, "x"), (1, 40, 90, "y"), (2, 6, 9, "z")], "k int, lo int, hi int, n string")
    assert sorted((r["k"], r["p"], r["n"]) for r in J.range_join(points, ranges, ["k"], "p", "lo", "hi", 10).collect()) == [(1, 5, "x"), (1, 50, "y")]
    nodes = spark.createDataFrame([("t", ["1", "2"], "1-2"), ("t", ["1", "20"], "1-20"), ("t", ["1", "2", "a"], "1-2-a")], "tree string, label array<string>, label_id string")
    gone = spark.createDataFrame([("t", "1-2")], "tree string, label_id string")
    assert [r["label_id"] for r in J.prefix_anti(nodes, gone).collect()] == ["1-20"]


def test_text_operators(spark):
    df = spark.createDataFrame([("a. b\nc",)], "t string")
    title, body = X.title_body(F.col("t"))
    assert tuple(df.select(title, body).first()) == ("a. b", "\nc")
    assert df.select(X.replace_first(F.col("t"), F.lit("new."))).first()[0] == "new. b\nc"
    assert df.select(F.array_join(X.tokens(F.col("t")), "")).first()[0] == "a. b\nc"


def test_parent_key(spark):
    rows = [(["1", "Subpart", "A"], "subpart", "1"), (["1", "3", "a", "Interp", "4"], "interp", "1-3-a-Interp"), (["1", "3", "a", "Interp"], "interp", "1-3-Interp"), (["1", "Interp"], "interp", "1"), (["1", "2", "a"], "regtext", "1-2")]
    df = spark.createDataFrame(rows, "label array<string>, node_type string, want string")
    assert [r for r in df.select(T.label_id(T.parent_key()).alias("got"), "want").collect() if r["got"] != r["want"]] == []


def test_streaming_replay(spark, sf_dir, tmp_path):
    log = catalog.change_log(spark, sf_dir).select("user_id", "k", F.col("ts").cast("timestamp").alias("ts"), "event_id", "action", "cents")
    log.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = S.current_state(stream, "400 days").writeStream.format("memory").queryName("replayed").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    last = spark.sql("select user_id, k, max_by(value, seq) v, max(seq) s from replayed group by user_id, k")
    want = V.state_at(V.intervals(log, ["user_id", "k"], ["ts", "event_id"], "ts", "action", "cents"), F.lit("2100-01-01").cast("timestamp"))
    assert {(r["user_id"], r["k"], r["cents"]) for r in want.collect()} == {(r["user_id"], r["k"], r["v"]) for r in last.collect() if r["v"] is not None}


def test_sql_functions(spark):
    K.register(spark)
    got = spark.sql("select c.cited from (select 'See paragraph (b)(1).' as t) s, lateral internal_citations(s.t, '105-2') c").collect()
    assert [r["cited"] for r in got] == ["105-2-b-1"]
    assert spark.sql("select marker_depths(array('a', '1', 'b')) d").first()["d"] == [0, 1, 0]


def test_command_line_and_stages(spark, tmp_path):
    from lexstrata.plans import checkpoint, cli

    (tmp_path / "reg.xml").write_text(XML)
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "2012-1.xml").write_text(NOTICE)
    (tmp_path / "dates.csv").write_text("document_number,tree,effective_on,publication_date\n2012-1,105,2012-03-01,2012-01-01\n")
    cli.main(["build", str(tmp_path / "reg.xml"), "--notices", str(tmp_path / "n"), "--dates", str(tmp_path / "dates.csv"), "--out", str(tmp_path / "out")])
    sink = sinks.Sink(str(tmp_path / "out"))
    assert sink.read(spark, "diff").count() == 4
    assert sink.read(spark, "layer/paragraph-markers").count() == 4
    for _, hits in ((1, 0), (2, 2)):
        s = checkpoint.Stages(spark, "d", str(tmp_path / "stages"))
        a = s.stage("a", lambda: spark.range(3).toDF("x"))
        assert s.stage("b", lambda: a.where("x > 0")).count() == 2 and s.hits == hits
