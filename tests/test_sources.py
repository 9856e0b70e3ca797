import http.server
import subprocess
import threading

import pytest
from pyspark.sql import functions as F

from lexstrata.functions import kernels as K
from lexstrata.operators import layers as L
from lexstrata.operators import text as X
from lexstrata.operators import versions as V
from lexstrata.plans import build, checkpoint
from lexstrata.sources import readers, regml, sinks
from lexstrata.sources.store import Store
from lexstrata.streaming import replay as S

XML = """<ROOT><PART><EAR>Pt. 105</EAR><HD>PART 105—PURPOSES (REGULATION Q)</HD><SUBPART><HD>Subpart A—General</HD>
<SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>Definitions.</SUBJECT><P>For purposes of this subpart:</P><P>(a) <E T="03">Bank.</E> “Bank” means a thing. See 12 U.S.C. 5511.</P><P>(b) Every bank under paragraph (a) of this section counts x_{2}.</P></SECTION></SUBPART>
<SUBPART><HD>Subpart B—Rest</HD><SECTION><SECTNO>§ 105.2</SECTNO><SUBJECT>Scope.</SUBJECT><P>Banks and § 105.1(b) and the open account.</P></SECTION></SUBPART></PART></ROOT>"""
FLAT = "<ROOT><PART><EAR>Pt. 7</EAR><HD>PART 7</HD><SECTION><SECTNO>§ 7.1</SECTNO><SUBJECT>One.</SUBJECT><P>a</P></SECTION><SECTION><SECTNO>§ 7.2</SECTNO><SUBJECT>Two.</SUBJECT><P>b</P></SECTION></PART></ROOT>"


@pytest.fixture(scope="module")
def nodes(spark):
    files = spark.createDataFrame([("105", XML), ("7", FLAT)], "path string, text string")
    return readers.regulation_trees(files).persist()


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_toc_of_subparts_and_empty_parts(nodes):
    got = rows(L.run("toc", nodes), "label_id", "toc_pos", "index", "title")
    assert got == [("105", 1, "A", "Subpart A—General"), ("105", 2, "B", "Subpart B—Rest"), ("105-Subpart-A", 1, "1", "§ 105.1 Definitions."), ("105-Subpart-B", 1, "2", "§ 105.2 Scope."), ("7", 1, "1", "§ 7.1 One."), ("7", 2, "2", "§ 7.2 Two."), ("7-Subpart", 1, "1", "§ 7.1 One."), ("7-Subpart", 2, "2", "§ 7.2 Two.")]


def test_terms_by_scope_and_settings(nodes):
    # the definition is for its subpart, which does not hold § 105.2
    assert rows(L.run("terms", nodes), "label_id", "term") == [("105-1-b", "bank")]
    got = rows(L.run("terms", nodes, include={"105": [("account", "105-9")]}, ignore={"ALL": ["every bank"]}), "label_id", "term", "definition")
    assert got == [("105-2", "account", "105-9")]


def test_regml_documents(spark, nodes):
    layers = {n: L.run(n, nodes) for n in ("terms", "internal-citations", "external-citations", "paragraph-markers", "keyterms", "toc")}
    layers["definitions"] = regml.defined(layers["terms"], nodes)
    got = {r["tree"]: regml.checked(r["document"]) for r in regml.documents(nodes, layers).collect()}
    e = got["105"]
    assert {(r.get("target"), r.get("reftype"), r.text) for r in e.iter("ref")} == {("105-1-a", "term", "bank"), ("105-1-a", "internal", "(a)"), ("105-1-b", "internal", "105.1(b)"), ("USC:12-U.S.C.-5511", "external", "12 U.S.C. 5511")}
    assert [d.get("term") for d in e.iter("def")] == ["bank"] and [x.text for x in e.iter("subscript")] == ["2"]
    assert len(list(got["7"].iter("tocSecEntry"))) == 4


def test_store_git_and_post(spark, nodes, tmp_path):
    both = nodes.where("tree = '105'").withColumn("reg", F.lit("105"))
    second = both.withColumn("text", F.concat("text", F.lit(" new"))).where("label_id <> '105-1-b'")
    versioned = both.withColumn("version", F.lit("2012-01-01")).unionByName(second.withColumn("version", F.lit("2013-01-01")))
    sink = sinks.Sink(str(tmp_path / "out"))
    sink.regulation(versioned)
    sink.diffs(build.version_pairs_diff(versioned))
    store = Store(spark, str(tmp_path / "out"))
    assert rows(store.versions("105"), "version") == [("2012-01-01",), ("2013-01-01",)]
    assert store.regulation("105", "2013-01-01").count() == both.count() - 1
    assert store.tree("105", "2012-01-01").find("105-1-b") is not None and '"label": ["105"]' in store.regulation_as_json("105", "2013-01-01")
    assert ("105-1-b", "deleted") in rows(store.diff("2012-01-01", "2013-01-01"), "label_id", "op")

    files = sinks.version_files(versioned)
    assert sinks.commit_versions(files, str(tmp_path / "git")) == 2
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path / "git"), *a], capture_output=True, text=True, check=True).stdout
    assert git("log", "--format=%s", "main").split("\n")[:2] == ["Version 2013-01-01", "Version 2012-01-01"]
    assert "D\tregulation/105/1/b/index.md" in git("diff", "--name-status", "main~1", "main")

    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            got.append((self.path, self.rfile.read(int(self.headers["Content-Length"])).decode()))
            self.send_response(204 if "bad" not in self.path else 404)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    docs = spark.createDataFrame([("regulation/105/1", "{}"), ("bad", "x")], "path string, document string")
    assert rows(sinks.post_documents(docs, f"http://127.0.0.1:{server.server_port}/"), "path", "status") == [("bad", 404), ("regulation/105/1", 204)]
    server.shutdown()
    assert sorted(got) == [("/bad", "x"), ("/regulation/105/1", "{}")]


def test_thumbnails(spark):
    n = spark.createDataFrame([("t", "1", "![a](G1) ![b](G2)")], "tree string, label_id string, text string")
    present = spark.createDataFrame([("https://images.invalid/G1.thumb.gif",)], "url string")
    assert rows(L.graphics(n, present=present), "gid", "thumb_url") == [("G1", "https://images.invalid/G1.thumb.gif"), ("G2", None)]


def test_first_notice(spark):
    n = spark.createDataFrame([("b", "2012-02-01"), ("a", "2012-01-01"), ("0", "2011-01-01")], "document_number string, publication_date string")
    files = spark.createDataFrame([("x/b.xml", "B"), ("x/a_20120101.xml", "A")], "path string, text string")
    assert rows(readers.first_notice_and_text(n, files), "document_number", "text") == [("a", "A")]


def test_many_terms(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "A big bank and Banks, big bank accounts"), (1, "A big bank and Banks, big bank accounts"), (2, "nothing"), (3, None)], "doc_id int, text string")
    terms = spark.createDataFrame([("bank",), ("big bank",), ("account",)], "term string")
    few = rows(K.term_uses(docs, terms, "doc_id"), "doc_id", "term", "start", "stop")
    starts = spark.createDataFrame([(1, "big bank"), (2, "Banks, big b"), (3, "a"), (4, "absent words are many")], "term_id int, term string")
    found = rows(K.first_occurrences(docs, starts), "doc_id", "term_id", "start")
    assert found == [(1, 1, 2), (1, 1, 2), (1, 2, 15), (1, 2, 15), (1, 3, 7), (1, 3, 7)]
    monkeypatch.setattr(K, "MOST_TERMS", 1)
    assert rows(K.term_uses(docs, terms, "doc_id"), "doc_id", "term", "start", "stop") == few and len(few) == 8
    assert rows(K.first_occurrences(docs, starts), "doc_id", "term_id", "start") == found


def test_next_but_and_numbers(spark):
    df = spark.createDataFrame([(1, i, "s" if i % 3 else f"v{i}") for i in range(7)], "k int, o int, v string")
    assert rows(X.next_but(df, ["k"], "o", F.col("v") == "s", "v", "n"), "o", "n") == [(0, "v3"), (1, "v3"), (2, "v3"), (3, "v6"), (4, "v6"), (5, "v6"), (6, None)]
    docs = spark.createDataFrame([("d", "2012-01-01"), ("d", "2012-02-01"), ("e", "2012-01-01")], "n string, at string").withColumn("at", F.col("at").cast("date"))
    assert rows(V.split_numbers(docs, "n", "at"), "n") == [("d_20120101",), ("d_20120201",), ("e",)]


def test_windowed_counts_and_timeouts(spark, tmp_path):
    events = spark.createDataFrame([(1, 1, f"2024-01-0{1 + i % 9} 00:00:00", i, "PUT", i, "view") for i in range(30)], "user_id long, k long, ts string, event_id long, action string, cents long, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = S.windowed_counts(stream()).writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sum(r["n"] for r in spark.sql("select * from counted").collect()) == 30
    q = S.current_state(stream(), "1 day", keep_days=1).writeStream.format("memory").queryName("kept").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert 26 in {r["value"] for r in spark.sql("select value from kept").collect()}  # the last by its date


def test_stages_refuse_a_local_folder_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda *a: None)

    context = type("C", (), {"master": "yarn", "getConf": lambda self: Conf()})()
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        checkpoint.shared_root(type("S", (), {"conf": Conf(), "sparkContext": context})())
