"""Readers of citations are asked only where they can find something, and find what they find anywhere."""

import random
import re

from lexstrata.functions import citations as C

WORDS = "paragraph paragraphs subparagraphs Section sections § §§ comment comments official interpretations supplement I of to the appendix appendices Appendix A B-5 A-3 -4 (a) (1) (i) (A) (b)(2) <E>1</E> 100.5 100.5(a) 12 3(v)-1.v 22(a)-1 5 . , and or through except for - part IV.A.1 12 CFR 100.7(b) this section V II \n ſection PARAGRAPH ٣(a) part.".split(" ")


def test_leads_lose_nothing(monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(WORDS) + rnd.choice([" ", "", " "]) for _ in range(rnd.randrange(1, 25))) for _ in range(400)]
    here = C.Label.from_node(["100", "5", "a"], "regtext")
    found = [C.internal(t, here, marked, "12") for t in texts for marked in (False, True)]
    scan, anywhere = C._scan, re.compile(r"\S")
    monkeypatch.setattr(C, "_scan", lambda text, read, lead: scan(text, read, anywhere))
    assert found == [C.internal(t, here, marked, "12") for t in texts for marked in (False, True)] and sum(map(len, found)) > 500


def test_words_between_citations_cost_no_readers(monkeypatch):
    asked, cursor = [], C.Cursor
    monkeypatch.setattr(C, "Cursor", lambda *a: asked.append(a) or cursor(*a))
    assert [c.label.parts() for c in C.internal("words of 12 customers " * 200 + "See § 5.1." + " and so on" * 200, C.Label())] == [["5", "1"]]
    assert len(asked) < 20
