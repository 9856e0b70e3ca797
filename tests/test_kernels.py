import random
import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexstrata.functions import citations as C
from lexstrata.functions import depth as D
from lexstrata.functions import notices as N
from lexstrata.functions import regxml as R
from lexstrata.functions import terms as T
from lexstrata.functions import textdiff as X
from lexstrata.functions.markers import levels_of, marker_of
from lexstrata.functions.model import Node, from_dict, from_rows, merge_duplicates, to_dict, to_rows, treeify
from lexstrata.functions.replay import Change, Tree, natural, replay

HERE = C.Label.of(part="102", section="6")


@pytest.mark.parametrize(
    ("text", "cited"),
    [
        ("in paragraph (a)(4)(iii) of", ["102-6-a-4-iii"]),
        ("date in § 1005.20(h)(1) must", ["1005-20-h-1"]),
        ("More in paragraph 22(a)(4).", ["102-22-a-4"]),
        ("See comment 32(b)(3) blah", ["102-32-b-3-Interp"]),
        ("refer to comment 36(a)(2)-3 of", ["102-36-a-2-Interp-3"]),
        ("See Appendix A-5(R)", ["102-A-5(R)"]),
        ("See comment 3(v)-1.v. Another", ["102-3-v-Interp-1-v"]),
        ("See appendix G, part V.4.D.", ["102-G-V-4-D"]),
        ("See comment 3-1 for things", ["102-3-Interp-1"]),
        ("See the commentary. (a) child", []),
        ("A-5 and Q-2(r) and Z-12(g)(2)(ii) then", ["102-A-5", "102-Q-2(r)", "102-Z-12(g)(2)(ii)"]),
        ("Appendices G and H—Yadda", ["102-G", "102-H"]),
        ("paragraphs (c)(3), (d)(2), (e)(1), (e)(3), and (f) of this section", ["102-6-c-3", "102-6-d-2", "102-6-e-1", "102-6-e-3", "102-6-f"]),
        ("12 CFR 102.10(b) but 13 CFR 102.4", ["102-10-b"]),
    ],
)
def test_internal_citations(text, cited):
    assert ["-".join(c.label.parts()) for c in C.internal(text, HERE, title="12")][: len(cited) or None] == cited


def test_external_citations():
    found = C.external("see 12 U.S.C. 5511, 12 CFR part 1026, 12 CFR 1002.3, the Act, Public Law 111-203 and 124 Stat. 1376", "12", "1002", ["15", "1693"])
    assert [c["citation_type"] for c in found] == ["USC", "CFR", "USC", "PUBLIC_LAW", "STATUTES_AT_LARGE"]
    assert found[2]["citation"] == ["15", "1693"] and found[1]["offsets"] == [(20, 36)]


def test_labels():
    assert HERE.copy(p1="a", p2="1").copy(p1="b").parts() == ["102", "6", "b"]
    assert C.Label.from_node(["1", "3", "a", "Interp", "4", "i"], "interp").parts() == ["1", "3", "a", "Interp", "4", "i"]
    assert C.Label.from_node(["1", "A", "3", "b"], "appendix").copy(section="9").parts() == ["1", "9"]


@pytest.mark.parametrize(("markers", "n"), [("a b c d e f g h i", 2), ("a b c d e f g h i j", 1), ("a b c d e f g h i ii", 1), ("A 1 a STARS B", 4)])
def test_depth_solutions(markers, n):
    assert len(D.depth_sets(markers.split())) == n


def test_depths():
    assert D.depths("a 1 i A b".split(), D.REGTEXT_ORDER) == [0, 1, 2, 3, 0]
    assert D.depth_sets(["i", "a"], ("ints", "lower")) == set()
    assert D.depths([]) is None
    assert levels_of("i") == [0, 2] and marker_of(["1", "2", "a"], "regtext", "") == "(a)"


def test_text_diff_of_small_edits():
    old = "I have a string to change"
    assert X.opcodes(old, "We have a string to change now") == [[("delete", 0, 1), ("insert", 0, "We")], ("insert", 25, " now")]
    assert X.opcodes("I a string to change", old) == [("insert", 2, "have ")]
    assert X.opcodes(old, "have a string to change") == [("delete", 0, 2)]
    assert X.opcodes(old, "I have a change") == [("delete", 9, 19)]
    assert X.opcodes("Howdy howdy. ", "Howdy howdy. More content") == [("insert", 13, "More content")]
    assert X.opcodes("a b c", "x y z") == [[("delete", 0, 5), ("insert", 0, "x y z")]]


def test_common_words_are_as_many_as_can_be(monkeypatch):
    rnd = random.Random(5)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for bits in (1 << 28, 40, 4):
        monkeypatch.setattr(X, "BITS", bits)
        for _ in range(300):
            a, b = (rnd.choices("abcdef", k=rnd.randrange(25)) for _ in range(2))
            places = X.common(a, b)
            assert len(places) == longest(a, b) and all(a[i] == b[j] for i, j in places)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(places, places[1:], strict=False))


def test_long_texts_are_compared_fast():
    import time

    rnd = random.Random(6)
    words = [f"w{rnd.randrange(800)}" for _ in range(20_000)]
    other = [w for w in words if rnd.random() > 0.1]
    for _ in range(2000):
        other.insert(rnd.randrange(len(other)), "new")
    a, b = " ".join(words), " ".join(other)
    began = time.thread_time()
    ops = X.opcodes(a, b)
    assert time.thread_time() - began < 4 and X.apply(a, ops) == b


def test_text_diff():
    assert X.opcodes("This is the old text here", "This is new text here and") == [[("delete", 8, 15), ("insert", 8, "new")], ("insert", 25, " and")]
    assert X.words("a ![x y](z) b") == ["a", " ", "![x y](z)", " ", "b"]


@settings(max_examples=300, deadline=None)
@given(st.text("ab \n", max_size=40), st.text("ab \n", max_size=40))
def test_text_diff_applies(a, b):
    assert "".join(X.words(a)) == a
    assert X.apply(a, X.opcodes(a, b)) == b
    assert (X.opcodes(a, b) == []) == (a == b)


@pytest.mark.parametrize(
    ("text", "terms", "found"),
    [
        ("I am in a rock band. That's a band with a drum, a rock drum. Many bands.", {"rock band": "a", "band": "b", "drum": "c"}, [("a", 10, 19), ("b", 30, 34), ("c", 42, 46), ("c", 55, 59), ("b", 66, 71)]),
        ("an activity, activities", {"activity": "x"}, [("x", 3, 11), ("x", 13, 23)]),
        ("This access device is good", {"access device": "a", "device": "d"}, [("a", 5, 18)]),
        ("I can't get a mad cow disease mad", {"goes mad": "g", "mad cow disease": "m"}, [("m", 14, 29)]),
        ("a transaction is an act", {"act": "a"}, [("a", 20, 23)]),
    ],
)
def test_term_uses(text, terms, found):
    assert [(lab, a, b) for _, lab, a, b in T.uses(text, list(terms.items()))] == found


def test_term_exclusions_and_definitions():
    assert T.uses("act act", [("act", "a")], [(0, 3)]) == [("act", "a", 4, 7)]
    inc, _ = T.definitions("Definition. “Awesome sauce” means great.", "1-2-a")
    assert [(r.term, r.start) for r in inc] == [("awesome sauce", 13)]
    inc, exc = T.definitions("The term “band” does not include solos. Definition", "1-2", known=["band"])
    assert inc == [] and exc[0].term == "band"
    assert T.scopes("For purposes of this section, x means", ["1", "2", "a"]) == [["1", "2"], ["1", "2", "Interp"]]
    assert [T.plural(w) for w in ("activity", "box", "person", "series", "day")] == ["activities", "boxes", "persons", "series", "days"]


def n(label, text="", children=(), kind="regtext", **more):
    return Node(text, label.split("-"), kind, children=list(children), **more)


def labels(root):
    return [x.label_id for x in root.walk()]


def test_replay_cases():
    base = n("205", "", [n("205-1"), n("205-2", "t", [n("205-2-a", "old a"), n("205-2-b", "old b")]), n("205-4")])
    assert [c.label_id for c in replay(base, [Change("POST", "205-3", n("205-3"))]).children] == ["205-1", "205-2", "205-3", "205-4"]
    r = replay(base, [Change("PUT", "205-2", n("205-2", "new")), Change("KEEP", "205-2-a"), Change("PUT", "205-2-b", n("205-2-b", "new b"))])
    assert [x.text for x in r.find("205-2").walk()] == ["new", "old a", "new b"]
    assert replay(base, [Change("PUT", "2055-2", n("2055-2")), Change("DELETE", "205-9")]).digest() == base.digest()
    r = replay(base, [Change("MOVE", "205-2-a", destination=("205", "2", "b")), Change("POST", "205-2-a", n("205-2-a", "aaa")), Change("DELETE", "205-2-b")])
    assert [(x.label_id, x.text) for x in r.find("205-2").children] == [("205-2-a", "aaa"), ("205-2-b", "old a")]
    assert base.find("205-2-a").text == "old a"  # the version before stays
    r = replay(base, [Change("PUT", "205-2", n("205-2", "Intro"), field="[text]"), Change("PUT", "205-4", n("205-4", title="T"), field="[title]")])
    assert r.find("205-2").text == "Intro" and len(r.find("205-2").children) == 2 and r.find("205-4").title == "T"
    assert labels(replay(base, [Change("POST", "205-7-b-1", n("205-7-b-1", "x"))]))[-3:] == ["205-7", "205-7-b", "205-7-b-1"]
    whole = n("205", "other")
    assert replay(base, [Change("PUT", "205", whole)]).text == "other"


def test_replay_subparts_and_reserved():
    base = n("205", "", [n("205-Subpart-A", "", [n("205-1")], "subpart"), n("205-Subpart-B", "", [n("205-2")], "subpart")])
    assert labels(replay(base, [Change("DESIGNATE", "205-2", destination=("205", "Subpart", "A"))])) == ["205", "205-Subpart-A", "205-1", "205-2"]
    assert "205-Subpart-C" in labels(replay(base, [Change("DESIGNATE", "205-2", destination=("205", "Subpart", "C"))]))
    assert labels(replay(base, [Change("POST", "205-3", n("205-3"), subpart=("205", "Subpart", "B"))]))[-1] == "205-3"
    reserved = n("205", "", [n("205-1", "[Reserved]")])
    assert replay(reserved, [Change("POST", "205-1", n("205-1", "now"))]).find("205-1").text == "now"
    t = Tree(n("205-A", kind="appendix"))
    for x in ("p20", "M(10)(b)", "M1", "p3", "M2", "M(10)(a)"):
        t.attach(t.root, Node("", ["205", "A", x], "appendix"))
    assert [c.label[-1] for c in t.root.children] == ["M1", "M2", "M(10)(a)", "M(10)(b)", "p3", "p20"]
    assert natural("ix", True) < natural("x", True) and natural("2") < natural("10") < natural("a")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["PUT", "POST", "DELETE"]), st.sampled_from("abcdef"), st.text("xyz", min_size=1, max_size=3)), max_size=8, unique_by=lambda c: c[1]))
def test_replay_is_idempotent(log):
    base = n("1", "", [n("1-2", "", [n(f"1-2-{x}", x) for x in "ace"])])
    changes = [Change(a, f"1-2-{x}", None if a == "DELETE" else n(f"1-2-{x}", t)) for a, x, t in log if not (a == "POST" and x in "ace")]
    once = replay(base, changes)
    assert replay(once, [c for c in changes if c.action != "DELETE"]).digest() == once.digest()


def test_model_round_trips():
    root = n("1", "r", [n("1-2", "s", [n("1-2-a", "x", title="t")]), n("1-A", "", kind="appendix")])
    assert from_rows(random.sample(to_rows(root), 4)).digest() == root.digest() == from_dict(to_dict(root)).digest()
    assert from_rows([]) is None
    flat = [n("1-2-a"), n("1-2"), n("1-3-b"), n("1-2-a-1")]
    assert [x.label_id for x in treeify(flat)] == ["1-2", "1-3-b"]
    assert len(merge_duplicates([n("1-2", "", [n("1-2-a")]), n("1-2", "", [n("1-2-b")])])[0].children) == 2


SECTION = '<SECTION><SECTNO>§ 8675.309</SECTNO><SUBJECT>Definitions.</SUBJECT>{}</SECTION>'


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<P>Intro.</P><P>(a) something</P>", ["8675-309", "8675-309-a"]),
        ('<P>(a) <E T="03">Transfer</E>—(1) <E T="03">Notice.</E> follow</P><P>(b) More (1) Here</P>', ["8675-309", "8675-309-a", "8675-309-a-1", "8675-309-b", "8675-309-b-1"]),
        ('<P>(a) a</P><P>(1) b</P><P>(i) c</P><P>(A) d</P><P>(<E T="03">1</E>) e</P><STARS/><P>(e) f</P>', ["8675-309", "8675-309-a", "8675-309-a-1", "8675-309-a-1-i", "8675-309-a-1-i-A", "8675-309-a-1-i-A-1", "8675-309-e"]),
        ('<P depth="1">Foo means bar.</P><P depth="2">Bop means baz.</P>', ["8675-309", "8675-309-Foo", "8675-309-Foo-Bop"]),
        ("<P>As in paragraph (a) of this section, see.</P>", ["8675-309"]),
    ],
)
def test_sections(body, want):
    assert labels(R.build_section("8675", ET.fromstring(SECTION.format(body)))[0]) == want


def test_more_xml():
    many = R.build_section("8675", ET.fromstring("<SECTION><SECTNO>§§ 8675.309-8675.311</SECTNO><RESERVED>[Reserved]</RESERVED></SECTION>"))
    assert [x.label[-1] for x in many] == ["309", "310", "311"] and many[1].title == "§ 8675.310 [Reserved]"
    assert R.node_text(ET.fromstring('<P>x<E T="52">n</E>is <E T="03">y</E></P>')) == "x_{n} is y"
    table = ET.fromstring('<GPOTABLE><BOXHD><CHED H="1">1-1</CHED><CHED H="1">1-2</CHED><CHED H="2">2-1</CHED><CHED H="3">3-1</CHED><CHED H="2">2-2</CHED></BOXHD><ROW><ENT>a</ENT><ENT/></ROW></GPOTABLE>')
    assert [[(c["text"], c["colspan"], c["rowspan"]) for c in r] for r in R.header_rows(table)] == [[("1-1", 1, 3), ("1-2", 2, 1)], [("2-1", 1, 1), ("2-2", 1, 2)], [("3-1", 1, 1)]]
    assert R.table_data(table)["rows"] == [["a", ""]]
    doc = R.build_tree("<ROOT><PART><EAR>Pt. 1111</EAR><HD>PART 1111—X</HD><SUBPART><HD>Subpart A—Gen</HD><SECTION><SECTNO>§ 1111.1</SECTNO><SUBJECT>S</SUBJECT><P>(a) x</P></SECTION></SUBPART><APPENDIX><HD SOURCE='HED'>Appendix A to Part 1111</HD><P>i</P></APPENDIX><APPENDIX><HD SOURCE='HED'>Supplement I to Part 1111</HD><HD SOURCE='HD1'>Section 1111.1 S</HD><P>1. c</P></APPENDIX></PART></ROOT>")
    assert labels(doc) == ["1111", "1111-Subpart-A", "1111-1", "1111-1-a", "1111-A", "1111-A-p1", "1111-Interp", "1111-1-Interp", "1111-1-Interp-1"]
    assert R.letter_for(0) == "a" and R.letter_for(27) == "ab"
    text = R.build_text_tree("A Title\nPART 201\n§ 201.1 One\nintro (a) first (1) deep (2) deeper (b) second, see paragraph (a)\n§ 201.2 Two\ntext\n")
    assert labels(text) == ["201", "201-Subpart", "201-1", "201-1-a", "201-1-a-1", "201-1-a-2", "201-1-b", "201-2"]


def test_notices():
    assert N.delays("The effective date of the rule published at 76 FR 7740 and 77 FR 100 is delayed until January 5, 2012") == ([(76, 7740), (77, 100)], "2012-01-05")
    assert N.date_sentence("Comments on effective dates must come by January 3, 2013") == ("comments", "2013-01-03")
    rows = [{"document_number": "a", "publication_date": "2012-01-01", "effective_on": "2012-02-01", "fr_volume": 76, "start_page": 7730, "end_page": 7750}, {"document_number": "b", "publication_date": "2012-01-10", "effective_on": "2012-03-01", "fr_volume": 77, "start_page": 1, "end_page": 2}]
    assert [x["effective_on"] for x in N.delayed(rows, {"b": ["The effective date of 76 FR 7740 is delayed until March 5, 2012"]})] == ["2012-03-05", "2012-03-01"]
    el = ET.fromstring('<REGTEXT PART="105"><AMDPAR>In § 105.1, revise paragraph (b) and remove paragraph (c):</AMDPAR><SECTION><SECTNO>§ 105.1</SECTNO><SUBJECT>P.</SUBJECT><STARS/><P>(b) New.</P></SECTION></REGTEXT>')
    assert [(c.action, c.label_id) for c in N.changes(el)] == [("PUT", "105-1-b"), ("DELETE", "105-1-c")]
    assert N.footnotes(ET.fromstring("<R><FTNT><P><SU>1</SU> See this.</P></FTNT></R>")) == {"1": "See this."}
    add = N.addresses(ET.fromstring("<ADD><HD>ADDRESSES:</HD><P>You may send comments.</P><P>• Mail: Box 1</P><P>Instructions: do it</P></ADD>"))
    assert add == {"intro": "You may send comments.", "methods": [("Mail", "Box 1")], "instructions": ["do it"]}
    sxs = N.analyses(ET.fromstring('<R><HD SOURCE="HD2">Section 105.1</HD><P>One<SU>3</SU> two</P><HD SOURCE="HD3">1(a) More</HD><PRTPAGE P="9"/><P>x</P></R>'), "105", 8)
    assert sxs[0]["labels"] == ["105-1"] and sxs[0]["footnote_refs"][0]["offset"] == 3 and len(sxs[0]["children"]) == 1
    assert [r["document_number"] for r in N.split_by_date([{"document_number": "x", "effective_on": "2012-01-02"}, {"document_number": "x", "effective_on": "2013-01-02"}])] == ["x_20120102", "x_20130102"]
