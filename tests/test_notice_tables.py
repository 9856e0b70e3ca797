"""Delays, versions by notice, what applies to a version, and settings in a build."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lexstrata.functions import notices as N
from lexstrata.operators import layers as L
from lexstrata.operators import notices as O
from lexstrata.plans import build, cli
from lexstrata.sources import readers, sinks

FIELDS = "document_number string, type string, publication_date string, effective_on string, volume int, start_page int, end_page int, dates string"


def test_delays_of_later_rules(spark):
    rows = [
        ("outdated", "Rule", "2000-12-12", "2001-01-01", 12, 500, 600, "Has an effective date of January 1, 2001"),
        ("unaltered", "Rule", "2000-12-20", "2001-01-01", 12, 800, 900, "Effective date of January 1, 2001"),
        ("proposal", "Proposed Rule", "2000-12-21", None, 12, 1100, 1200, "We are thinking about delaying the effective date of 12 FR 801 to March 3, 2003. The effective date of 12 FR 801 is delayed until May 3, 2003"),
        ("changer", "Rule", "2000-12-31", "2000-12-31", 12, 9000, 9005, "The effective date of 12 FR 501 has been delayed until March 3, 2003"),
        ("edges", "Rule", "2001-01-05", "2002-01-01", 13, 10, 10, None),
        ("later", "Rule", "2001-02-01", "2002-01-01", 12, 20, 30, "The effective date of 13 FR 10 is delayed until July 1, 2004. The effective date of 13 FR 10 has been delayed until July 2, 2004, not 2005"),
        ("undated", "Rule", "2001-02-01", None, 14, 5, 2000, ""),
        ("last", "Rule", "2001-03-01", None, None, None, None, "The effective date of 14 FR 1999 and 12 FR 501 is delayed until August 1, 2005. Effective date of 12 FR 20 stays; nothing is delayed until 12 FR 30"),
    ]
    df = spark.createDataFrame(rows, FIELDS).withColumn("note", F.lit("x"))
    got = {r["document_number"]: r["effective_on"] for r in O.delayed(df).collect()}
    assert got == {"outdated": "2005-08-01", "unaltered": "2001-01-01", "proposal": None, "changer": "2000-12-31", "edges": "2004-07-02", "later": "2002-01-01", "undated": "2005-08-01", "last": None}
    assert O.delayed(df).columns == df.columns and O.delayed(df.limit(0)).count() == 0
    early = df.where("document_number <> 'last'")
    assert {r["document_number"]: r["effective_on"] for r in O.delayed(early).collect()}["outdated"] == "2003-03-03"


def test_delays_agree_with_one_after_the_other(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(300):
        start = rnd.randrange(2000)
        cited = [f"{rnd.randrange(3)} FR {rnd.randrange(2000)}" for _ in range(rnd.randrange(1, 4))]
        dates = f"The effective date of {' and '.join(cited)} is delayed until March {rnd.randrange(1, 29)}, {rnd.randrange(1990, 2020)}" if i % 3 == 0 else None
        rows.append((f"n{i:03}", "Rule" if i % 7 else "Notice", f"2001-01-{rnd.randrange(1, 29):02}", "2001-06-01", rnd.randrange(3), start, start + rnd.randrange(150), dates))
    names = [f.split()[0] for f in FIELDS.split(", ")]
    serial = N.delayed([dict(zip(names, r, strict=True)) | {"fr_volume": r[4]} for r in rows], {r[0]: [r[7]] for r in rows if r[7]})
    got = O.delayed(spark.createDataFrame(rows, FIELDS), pages=16)
    assert sorted((r["document_number"], r["effective_on"]) for r in got.collect()) == sorted((r["document_number"], r["effective_on"]) for r in serial)


def test_notices_meet_one_row_of_a_page_however_often_it_is_cited(spark):
    """400 rules that cite a page which 400 notices hold: 160,000 pairs of which none is made."""
    rows = [(f"r{i:03}", "Rule", f"2001-{i % 12 + 1:02}-01", "2001-06-01", None, None, None, f"The effective date of 12 FR 501 is delayed until March {i % 28 + 1}, 2003") for i in range(400)]
    rows += [(f"n{i:03}", "Notice", "2000-01-01", "2000-02-01", 12, 501 - i % 90, 501 + i % 70, None) for i in range(400)]
    df = spark.createDataFrame(rows, FIELDS)
    assert [(r["volume"], r["page"], r["said"]["by"]) for r in O.last_said(df).collect()] == [(12, 501, "r395")]
    assert {r["effective_on"] for r in O.delayed(df).where("type = 'Notice'").collect()} == {f"2003-03-{395 % 28 + 1:02}"}


def test_words_after_delayed_are_no_notices():
    assert N.delays("The effective date of 12 FR 501 is delayed, as 13 FR 7 was delayed, until May 1, 2003") == ([(12, 501)], "2003-05-01")
    assert N.delays("It was delayed. The effective date of 12 FR 501 is May 1, 2003") == ([], None)


XML = """<ROOT><PART><EAR>Pt. 105</EAR><HD>PART 105—PURPOSES (REGULATION Q)</HD><SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>Definitions.</SUBJECT><P>(a) “Bank” means a thing under the Act.</P><P>(b) Every bank has an open account, OLDNAME.</P></SECTION>
<SECTION><SECTNO>§ 105.2</SECTNO><SUBJECT>Scope.</SUBJECT><P>A bank. See ![form](G1) and 12 CFR 7.</P></SECTION></PART></ROOT>"""


def notice(text, analysis=""):
    return f'<RULE><SUPLINF>{analysis}</SUPLINF><REGTEXT TITLE="12" PART="105"><AMDPAR>In § 105.1, revise paragraph (b) to read as follows:</AMDPAR><SECTION><SECTNO>§ 105.1</SECTNO><P>(b) {text}</P></SECTION></REGTEXT></RULE>'


def test_notices_of_one_day_are_versions_of_their_own(spark):
    nodes = readers.regulation_trees(spark.createDataFrame([("105", XML)], "path string, text string")).withColumn("tree", F.lit("105"))
    files = spark.createDataFrame([("n2", notice("Two.")), ("n1", notice("One.")), ("n0", notice("Zero."))], "document_number string, text string")
    dates = spark.createDataFrame([("n2", "2012-03-01", "2012-01-02"), ("n1", "2012-03-01", "2012-01-01"), ("n0", "2013-03-01", "2011-01-01")], "document_number string, effective_on string, publication_date string")
    log = build.notice_changes(files).join(dates, "document_number").withColumn("tree", F.lit("105"))
    both = build.versions(nodes, log).persist()
    assert [(r["version"], r["text"]) for r in build.history_of(both, "105-1-b").orderBy("version_no").collect()][1:] == [("n1", "(b) One."), ("n2", "(b) Two."), ("n0", "(b) Zero.")]
    table = O.version_table(log)
    assert sorted(tuple(r) for r in table.collect() if r["version_no"]) == [("105", "n0", 3, "2013-03-01", "2011-01-01"), ("105", "n1", 1, "2012-03-01", "2012-01-01"), ("105", "n2", 2, "2012-03-01", "2012-01-02")]
    notices = dates.withColumn("tree", F.lit("105")).unionByName(spark.createDataFrame([("same", "2012-03-01", "2012-01-01", "105"), ("never", None, "2010-01-01", "105")], "document_number string, effective_on string, publication_date string, tree string"))
    got = {}
    for r in O.applicable_to(table, notices).orderBy("applicable").collect():
        got.setdefault(r["version"], []).append(r["document_number"])
    assert got == {"n1": ["n1"], "n2": ["n1", "same", "n2"], "n0": ["n1", "same", "n2", "n0"]}
    assert {r["version"]: r["n_applicable"] for r in O.applicable_counts(table, notices).collect()} == {"": 0, "n1": 1, "n2": 3, "n0": 4}
    sxs = notices.select(F.col("document_number").alias("doc_number"), "effective_on", "publication_date", F.lit(1).alias("fr_volume"), F.lit(2).alias("fr_page"), F.array(F.lit("105-2")).alias("labels"), F.lit("words").alias("body"))
    found = build.all_layers(both, ["toc"], {"title": "12"}, sxs, table)
    assert sorted((r["tree"], r["ref_no"], r["reference"]) for r in found["analyses"].collect()) == sorted([("105@n1", 1, "n1"), ("105@n2", 1, "n1"), ("105@n2", 2, "same"), ("105@n2", 3, "n2"), ("105@n0", 1, "n0"), ("105@n0", 2, "n1"), ("105@n0", 3, "same"), ("105@n0", 4, "n2")])
    assert {(r["tree"], r["effective_date"]) for r in found["meta"].collect()} == {("105@", None), ("105@n1", "2012-03-01"), ("105@n2", "2012-03-01"), ("105@n0", "2013-03-01")}
    both.unpersist()


def test_document_number_of_the_oldest_rule(spark):
    docs = spark.createDataFrame([("a", "[FR Doc. 2011-5 Filed", "2012-01-01"), ("b", "none", "2012-01-01"), ("c", "none", "2011-06-01"), ("d", "none", "2000-01-01"), ("e", "none", None)], "tree string, frdoc string, original_date string").withColumn("original_date", F.to_date("original_date"))
    rules = spark.createDataFrame([("x", "Rule", "2011-01-05", "2011-06-01"), ("w", "Rule", "2011-01-01", "2011-12-31"), ("v", "Rule", "2010-01-01", "2012-01-02"), ("p", "Notice", "2000-01-01", "2000-01-01"), ("q", "Rule", "2000-01-01", None)], "document_number string, type string, publication_date string, effective_on string").withColumn("effective_on", F.to_date("effective_on"))
    found = readers.document_number(docs, rules)
    assert {r["tree"]: r["document_number"] for r in found.collect()} == {"a": "2011-5", "b": "w", "c": "x", "d": None, "e": None}
    assert "NestedLoop" not in found._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A build by the command line with the given settings, as a function that gives its sink."""
    base = tmp_path_factory.mktemp("build")
    (base / "reg.xml").write_text(XML)
    (base / "n").mkdir()
    about = '<HD SOURCE="HD1">Section-by-Section Analysis</HD><HD SOURCE="HD2">Section 105.2 Scope</HD><P>Words on scope.</P><HD SOURCE="HD1">End</HD>'
    (base / "n" / "n1.xml").write_text(notice("One OLDNAME."))
    (base / "n" / "n2.xml").write_text(notice("Two.", about))
    (base / "n" / "n3.xml").write_text('<RULE><REGTEXT PART="105"/></RULE>')
    (base / "dates.csv").write_text(
        "document_number,tree,effective_on,publication_date,type,volume,start_page,end_page,dates\n"
        "n1,105,2012-03-01,2012-01-01,Rule,77,100,120,\nn2,105,2012-04-01,2012-02-01,Rule,77,500,510,\n"
        'n3,105,2012-01-05,2012-02-02,Rule,77,900,901,"The effective date of 77 FR 101 is delayed until May 1, 2012."\n'
    )
    done = {}

    def run(**settings):
        key = json.dumps(settings, sort_keys=True)
        if key not in done:
            out = base / f"out{len(done)}"
            (base / "s.json").write_text(json.dumps(settings))
            cli.main(["build", str(base / "reg.xml"), "--notices", str(base / "n"), "--dates", str(base / "dates.csv"), "--out", str(out), "--settings", str(base / "s.json")])
            done[key] = sinks.Sink(str(out))
        return lambda path, *columns: sorted(tuple(r[c] for c in columns) for r in done[key].read(spark, path).select(*[F.col(c).cast("string") for c in columns]).fillna("").collect())

    return run


def test_build_without_settings(built):
    read = built()
    # n3 delays n1 behind n2
    assert [x for x in read("regulation", "version", "version_no", "label_id", "text") if x[2] == "105-1-b" and x[0]] == [("n1", "2", "105-1-b", "(b) One OLDNAME."), ("n2", "1", "105-1-b", "(b) Two.")]
    assert [x[1] for x in read("layer/meta", "version", "effective_date") if x[0] in ("n1", "n2")] == ["2012-05-01", "2012-04-01"]
    assert read("layer/analyses", "version", "label_id", "reference", "fr_volume", "fr_page") == [("n1", "105-2", "n2", "77", "500"), ("n2", "105-2", "n2", "77", "500")]
    assert {x for x in read("layer/terms", "label_id", "term")} == {("105-1-b", "bank"), ("105-2", "bank")}


def test_every_setting_changes_its_layer(built):
    read = built(
        title="12", act=["15", "1693"], meta={"contact": "us"}, macros=[["OLDNAME", "NEWNAME"]], image_overrides={"G1": "local/g1.png"}, include_terms={"105": [["open account", "105-9"]]}, ignore_terms={"ALL": ["every bank"]},
        patches={"n2": [{"label_id": "105-1-b", "action": "PUT", "text": "(b) Patched open account."}, {"label_id": "105-2", "action": "DELETE"}]},
    )
    assert {x for x in read("layer/meta", "cfr_title_number", "contact")} == {("12", "us")}
    assert ("105-1-a", "15 1693") in read("layer/external-citations", "label_id", "citation")
    assert {x for x in read("layer/graphics", "gid", "url")} == {("G1", "local/g1.png")}
    text = {x[0]: x[1] for x in read("regulation", "version", "text", "label_id") if x[2] == "105-1-b"}
    assert text["n1"] == "(b) One NEWNAME." and text["n2"] == "(b) Patched open account." and len(text) == 3
    assert "105-2" not in {x[1] for x in read("regulation", "version", "label_id") if x[0] == "n2"}
    assert ("105-1-b", "open account", "105-9") in read("layer/terms", "label_id", "term", "definition") and ("105-1-b", "bank") not in read("layer/terms", "label_id", "term")
    assert {x[0] for x in built(graphics_template="https://x.invalid/%s.svg")("layer/graphics", "url")} == {"https://x.invalid/G1.svg"}


def test_analyses_of_one_tree_need_no_versions(spark):
    nodes = spark.createDataFrame([("t", "105-1")], "tree string, label_id string")
    sxs = spark.createDataFrame([("n1", "2012-01-01", 1, 2, ["105-1"], "x"), ("n2", "2012-01-01", 1, 2, ["105-1"], "")], "doc_number string, publication_date string, fr_volume int, fr_page int, labels array<string>, body string")
    assert [r["reference"] for r in L.run("analyses", nodes, sxs=sxs).collect()] == ["n1"]
