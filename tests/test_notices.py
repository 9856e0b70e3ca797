import xml.etree.ElementTree as ET

import pytest

from lexstrata.functions import amendments as A
from lexstrata.functions import model, regxml, replay, xmltext
from lexstrata.functions import notices as N
from lexstrata.operators import layers as L
from lexstrata.plans import settings
from lexstrata.sources import regml

RESERVES = '<REGTEXT PART="105"><AMDPAR>1. Remove and reserve § 105.2.</AMDPAR></REGTEXT><REGTEXT PART="105"><AMDPAR>2. In § 105.1, remove and reserve paragraph (b).</AMDPAR></REGTEXT>'
SUBPART = '<REGTEXT PART="105"><AMDPAR>3. Add subpart C to read as follows:</AMDPAR><SUBPART><HD SOURCE="HED">Subpart C—New</HD><SECTION><SECTNO>§ 105.30</SECTNO><SUBJECT>Thing.</SUBJECT><P>(a) One.</P></SECTION></SUBPART></REGTEXT>'
APPENDIX = '<REGTEXT PART="105"><AMDPAR>4. Revise appendix A to part 105 to read as follows:</AMDPAR><HD SOURCE="HD1">Appendix A to Part 105—Forms</HD><EXTRACT><HD SOURCE="HD1">A-1 First</HD><P>words</P></EXTRACT></REGTEXT>'
SUPPLEMENT = '<REGTEXT PART="105"><AMDPAR>5. In Supplement I to part 105, under 3(b), paragraph 1 is revised to read as follows:</AMDPAR><HD SOURCE="HD1">Supplement I to Part 105—Official Interpretations</HD><HD SOURCE="HD2">3(b) Header</HD><P>1. <E T="03">Words.</E> New.</P></REGTEXT>'
COLON = '<REGTEXT PART="105"><AMDPAR>6. In § 105.4, revise paragraph (a) to read as follows:</AMDPAR><SECTION><SECTNO>§ 105.4</SECTNO><SUBJECT>X.</SUBJECT><P>(a) These are:</P><STARS/><P>(2) * * *</P></SECTION></REGTEXT>'
STARS = '<REGTEXT PART="105"><AMDPAR>7. In § 105.4, revise paragraph (a) to read as follows:</AMDPAR><SECTION><SECTNO>§ 105.4</SECTNO><SUBJECT>X.</SUBJECT><P>(a) New words. (1) * * *</P><P>(2) Two.</P></SECTION></REGTEXT>'


def found(body):
    return [(c.action, c.label_id, c.field) for c in N.notice_changes(ET.fromstring(f"<RULE>{body}</RULE>"))]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (RESERVES, [("RESERVE", "105-2", None), ("RESERVE", "105-1-b", None)]),
        (SUBPART, [("POST", "105-Subpart-C", None)]),
        (APPENDIX, [("PUT", "105-A", None)]),
        (SUPPLEMENT, [("PUT", "105-3-b-Interp-1", None)]),
        (COLON, [("PUT", "105-4-a", "[text]")]),
        (STARS, [("KEEP", "105-4-a-1", None), ("PUT", "105-4-a", None)]),
        # the instruction that ends a REGTEXT belongs to the next one
        ('<REGTEXT PART="105"><P>x</P><AMDPAR>1. In § 105.9, add paragraph (c) to read as follows:</AMDPAR></REGTEXT><REGTEXT PART="105"><SECTION><SECTNO>§ 105.9</SECTNO><SUBJECT>Y.</SUBJECT><STARS/><P>(c) New.</P></SECTION></REGTEXT>', [("POST", "105-9-c", None)]),
        # another part's instructions are no changes of this one
        ('<REGTEXT PART="105"><AMDPAR>Remove § 205.3.</AMDPAR></REGTEXT>', []),
        ('<REGTEXT PART="105"><AMDPAR>Remove § 105.3.</AMDPAR><AMDPAR>Remove § 105.3.</AMDPAR></REGTEXT>', [("DELETE", "105-3", None)]),
        ('<REGTEXT PART="105"><AMDPAR>Designate §§ 105.1 through 105.2 as subpart A.</AMDPAR></REGTEXT>', [("DESIGNATE", "105-1", None), ("DESIGNATE", "105-2", None)]),
    ],
)
def test_changes(body, want):
    assert found(body) == want


def tree():
    sections = [model.Node("", ["105", str(i)], title=f"§ 105.{i} T", children=[model.Node(f"({x}) old {x}", ["105", str(i), x], children=[model.Node(f"({n}) old", ["105", str(i), x, str(n)]) for n in (1, 2)]) for x in "ab"]) for i in (1, 2, 4)]
    return model.Node("", ["105"], title="PART 105", children=[model.Node("", ["105", "Subpart"], "emptypart", children=sections)])


def test_notice_is_replayed():
    after = replay.replay(tree(), N.notice_changes(ET.fromstring(f"<RULE>{RESERVES}{SUBPART}{STARS}</RULE>")))
    text = lambda label: after.find(label).text
    assert after.find("105-2").reserved and after.find("105-2").children == []
    assert text("105-1-b") == "(b) [Reserved]" and text("105-1-a") == "(a) old a"
    assert [c.label_id for c in after.find("105-Subpart-C").children] == ["105-30"]
    assert text("105-4-a").startswith("(a) New words.") and text("105-4-a-1") == "(1) old" and text("105-4-a-2") == "(2) Two."


def test_reserved_nodes_of_every_kind():
    assert [N._reserved(x, "105").text or N._reserved(x, "105").title for x in (("105", "2"), ("105", "2", "b"), ("105", "A"), ("105", "2", "Interp", "1"))] == ["§ 105.2 [Reserved]", "(b) [Reserved]", "Appendix A to Part 105 [Reserved]", "1. [Reserved]"]


def test_mended_markup():
    got = N.repaired(ET.fromstring('<R><REGTEXT PART="1"><P>Supplement I is amended:</P><P>a. Revise x.</P><HD SOURCE="HD1">Supplement I to Part 1</HD><P>(<E T="03">1)</E> x</P><P><E T="03">(i)</E> y</P></REGTEXT></R>'))
    assert [e.tag for e in got[0]] == ["AMDPAR", "AMDPAR", "HD", "P", "P"]
    assert [regxml.tagged_text(p) for p in got.iter("P")] == ['(<E T="03">1</E>) x', '(<E T="03">i</E>) y']


def test_moves_and_words():
    moves, _ = A.parse("In § 1.2, paragraphs (a) and (b) are redesignated as paragraphs (c) and (d)", ("1",))
    assert [(a.label_id, "-".join(a.destination)) for a in moves] == [("1-2-a", "1-2-c"), ("1-2-b", "1-2-d")]
    moves, _ = A.parse("In § 1.2, remove paragraph (e), and paragraphs (a) and (b) are redesignated as paragraphs (c) and (d)", ("1",))
    assert [a.action for a in moves] == ["DELETE", "MOVE", "MOVE"]
    n = model.Node("text", ["1"], title="Title")
    C = replay.Change
    assert [N.described(c) for c in (C("PUT", "1", n, "[title]"), C("PUT", "1", n), C("POST", "1", model.Node("t", ["1"])), C("DELETE", "1"), C("DESIGNATE", "1", destination=("1", "Subpart", "A")), C("RESERVE", "1", n), C("KEEP", "1"))] == ["Title changed to: Title", "Modified (title: Title): text", "Added: t", "Deleted", "Moved to 1-Subpart-A", "Reserved", "Mentioned but not modified"]
    assert [c.action for _, c in N.merged([("d", C("PUT", "1", n)), ("d", C("DELETE", "2"))], {"d": [C("KEEP", "1")]})] == ["DELETE", "KEEP"]


def test_trees_in_memory():
    t = tree()
    flat = model.flatten(t)
    assert [n.label_id for n in flat][-1] == "105" and len(flat) == 23 and flat[0].children == [] and flat[-1].child_labels == ["105-Subpart"]
    assert model.prepend_label(model.Node(label=["a"]), ["x", "y"]).label_id == "x-y-a"
    assert model.is_empty(model.Node(" ")) and not model.is_empty(t)


def test_xml_text():
    e = ET.fromstring("<P>word<PRTPAGE P='3'/>more <E T='03'>em</E>end</P>")
    assert xmltext.body_text(e) == "word more <EM>em</EM>end"
    assert "".join(xmltext.spaced(e, "E").itertext()) == "wordmore em end"
    assert "".join(xmltext.clear_between(ET.fromstring("<P>a[x y]b[z]c</P>"), "[", "]").itertext()) == "abc"
    assert ET.tostring(xmltext.without_char(ET.fromstring("<P>a▸b<E>▸</E></P>"), "▸"), encoding="unicode") == "<P>ab<E /></P>"


def test_plain_interpretations():
    assert regxml.merged_label([["1", "a"], ["1", "b"], ["1"]]) == ["1", "a_b"]
    text = "Supplement I to Part 7\nSection 7.3 Rules\nIntro.\nParagraph 3(a) First\n1. One.\ni. Inner.\n2. Two.\nAppendix A Forms\n1. Form.\n"
    assert regxml.supplement_start("x\n" + text) == 2 and regxml.supplement_start("none") is None
    got = [(n.label_id, n.text) for n in regxml.build_interpretations(text, "7").walk()]
    assert got == [("7-Interp", ""), ("7-3-Interp", "Intro."), ("7-3-a-Interp", ""), ("7-3-a-Interp-1", "1. One."), ("7-3-a-Interp-1-i", "i. Inner."), ("7-3-a-Interp-2", "2. Two."), ("7-A-Interp", ""), ("7-A-Interp-1", "1. Form.")]


def test_guessed_keyterms():
    got = [L.guessed_keyterm(t) for t in ("(a) Key term. More words here.", "(a) One long sentence without an end", "(1) See 12 U.S.C. 5511 for it", "(b) Coverage—", "")]
    assert got == ["Key term.", None, None, "Coverage—", None] and L.guessed_keyterm("A. B.", "appendix") is None


def test_settings(tmp_path):
    (tmp_path / "a.json").write_text('{"title": "12", "meta": {"x": 1}, "macros": [["a", "b"]]}')
    s = settings.layered(str(tmp_path / "a.json"), str(tmp_path / "none.json"), {"meta": {"y": 2}, "macros": [["b", "c"]]})
    assert (s["title"], s["meta"], s["patches"]) == ("12", {"x": 1, "y": 2}, {})
    assert settings.apply_macros("a", s["macros"]) == "c" and settings.first_holding("k", {}, {"k": 1}, {"k": 2}) == 1


def test_regml():
    root = model.Node("", ["1"], title="PART 1", children=[model.Node("", ["1", "Subpart", "A"], "subpart", "Subpart A", children=[model.Node("", ["1", "2"], title="§ 1.2 <T>", children=[model.Node("(a) Key. A bank & x_{1}\nSign_____\n```note\nl1\nl2\n```", ["1", "2", "a"])])])])
    marks = {"1-2-a": [(0, 3, "", "", False), (11, 15, '<ref target="1-3" reftype="term">', "</ref>", True), (12, 14, "<lost>", "</lost>", True)]}
    doc = regml.to_regml(root, marks, {"1-Subpart-A": [("1-2", "§ 1.2 <T>")]}, {"1-2-a": "Key."})
    e = regml.checked(doc)
    assert e.find(".//subpart").get("subpartLetter") == "A" and e.find(".//tocSecEntry").get("target") == "1-2" and e.find(".//section/title").text == "§ 1.2 <T>"
    p = e.find(".//paragraph")
    assert p.get("marker") == "a" and p.find("title").text == "Key." and [x.tag for x in p.find("content")] == ["ref", "variable", "dash", "callout"]
    assert "".join(p.find("content").itertext()).split() == "A bank & x1 Sign l1l2".split() and len(p.findall(".//line")) == 2


def test_notice_xml():
    section = {"title": "S", "labels": ["1-2"], "paragraphs": ["Text here."], "footnote_refs": [{"paragraph": 0, "reference": "1", "offset": 4}], "children": [{"title": "C", "labels": [], "paragraphs": ["c"], "children": []}]}
    notice = {"document_number": "n1", "publication_date": "2012-01-01", "fr_url": "u", "footnotes": {"1": "note"}}
    e = regml.checked(regml.notice_xml(notice, tree(), {"105-1-a": "modified", "105-9": "deleted"}, {"cfr_title_number": "12"}, "n0", [section], ["1-2"]))
    assert [(c.get("operation"), c.get("label"), len(c)) for c in e.iter("change")] == [("modified", "1-2", 0), ("modified", "105-1-a", 1), ("deleted", "105-9", 0)]
    assert e.find(".//analysisParagraph/footnote").text == "note" and e.find(".//analysisSection/analysisSection/title").text == "C" and e.find("fdsys/cfrTitleNum").text == "12"
    with pytest.raises(KeyError):
        regml.footnoted("x", [(0, "9")], {})
