"""Citations within a regulation (`paragraph (a)(1)`, `comment 3(b)-1`, `Appendix A-5`) and to other law, with offsets."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from .amendments import APPENDIX, APPENDIX_SECTION, APPENDIX_WORD, Atom, COMMENT, Cursor, NUMBER, PARAGRAPH, PARAGRAPHS, PART_SECTION, SECTION_SIGN, SECTIONS_SIGN, appendix_section, sequence, word
from .amendments import DIGIT, EM_DIGIT, EM_ROMAN, LOWER, ROMAN, UPPER, _p

# -- labels -----------------------------------------------------------------------------------------------------

P = ("p1", "p2", "p3", "p4", "p5", "p6")
SCHEMAS = {"section": ("part", "section", *P), "appendix": ("part", "appendix", *P), "appendix_section": ("part", "appendix", "appendix_section", *P)}
COMMENT_FIELDS = ("comment", "c1", "c2", "c3", "c4")


def schema_of(fields: Iterable[str]) -> str | None:
    for name in ("appendix_section", "appendix", "section"):
        if name in fields:
            return name
    return None


@dataclass(frozen=True)
class Label:
    """A position in a regulation, by named fields in the order of a schema."""

    fields: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def of(**fields) -> Label:
        return Label(tuple((k, v) for k, v in fields.items() if v))

    @staticmethod
    def from_node(label: list[str], node_type: str) -> Label:
        """The best guess at what a node's label names."""
        appendix = node_type == "appendix" or (node_type == "interp" and len(label) > 2 and label[1].isalpha())
        names = SCHEMAS["section" if not appendix else "appendix_section" if len(label) > 2 and label[2].isdigit() else "appendix"]
        at = label.index("Interp") if "Interp" in label else len(label)
        fields = dict(zip(names, label[:at], strict=False)) | dict(zip(COMMENT_FIELDS[1:], label[at + 1 :], strict=False))
        if node_type == "interp":
            fields["comment"] = "1"
        return Label.of(**fields)

    def copy(self, **new) -> Label:
        """Fields up to the first one that is given anew; from there on only those given."""
        now = dict(self.fields)
        names = SCHEMAS[schema_of(new) or schema_of(now) or "section"] + COMMENT_FIELDS
        out, given = {}, False
        for n in names:
            given = given or bool(new.get(n))
            value = new.get(n) if given else now.get(n)
            if value:
                out[n] = value
        return Label.of(**out)

    def parts(self) -> list[str]:
        f = dict(self.fields)
        out = [f[n] for n in SCHEMAS[schema_of(f) or "section"] if n in f]
        if f.get("comment"):
            out += ["Interp", *[f[n] for n in COMMENT_FIELDS[1:4] if n in f]]
        return out


# -- readers ----------------------------------------------------------------------------------------------------

_PARAGRAPH_STEPS = [[LOWER], [DIGIT], [ROMAN], [UPPER], [EM_DIGIT, DIGIT], [EM_ROMAN, ROMAN]]


def paragraph_fields(c: Cursor, first: int = 0) -> dict | None:
    out = {}
    for i in range(first, 6):
        m = next((m for p in _PARAGRAPH_STEPS[i] if (m := c.take(p))), None)
        if m is None:
            break
        out[P[i]] = m[1]
        if i == first == 0 and UPPER.match(c.text, c.at):
            return None
    return out or None


def any_paragraph(c: Cursor) -> dict | None:
    for first in range(6):
        d = c.fork()
        if out := paragraph_fields(d, first):
            c.at = d.at
            return out
    return None


def comment_fields(c: Cursor) -> dict | None:
    """-1.v.A"""
    m = c.take(re.compile(r"\s*-\s*?(\d+)(?:\s*\.([ivxlcdm]+)(?:\s*\.([A-Z]+)(?![a-z]))?)?"))
    return {"c1": m[1], "c2": m[2], "c3": m[3]} if m else None


def part_section(c: Cursor) -> dict | None:
    m = c.take(PART_SECTION)
    return {"part": m[1], "section": m[2]} if m else None


def number(c: Cursor) -> dict | None:
    m = c.take(NUMBER)
    return {"section": m[1]} if m else None


def appendix_with_section(c: Cursor) -> dict | None:
    got = appendix_section(c)
    return {"appendix": got[0], "appendix_section": got[1]} if got else None


def appendix_name(c: Cursor) -> dict | None:
    m = c.take(APPENDIX)
    return {"appendix": m[1]} if m else None


def all_of(*readers) -> Callable[[Cursor], dict | None]:
    """Merged fields of readers one after another; a reader in a tuple is optional."""
    read = sequence(*readers)

    def merged(c: Cursor) -> dict | None:
        got = read(c)
        if got is None:
            return None
        out: dict = {}
        for g in got:
            if isinstance(g, dict):
                out |= g
        return out

    return merged


def first_of(*readers) -> Callable[[Cursor], dict | None]:
    def read(c: Cursor) -> dict | None:
        for r in readers:
            d = c.fork()
            if (got := r(d)) is not None:
                c.at = d.at
                return got
        return None

    return read


marked_appendix = all_of(APPENDIX_WORD, first_of(appendix_with_section, appendix_name))
section_paragraph = all_of(number, paragraph_fields)
inner = first_of(any_paragraph, all_of(part_section, (paragraph_fields,)), section_paragraph, appendix_with_section, marked_appendix)
comment_target = first_of(all_of(number, comment_fields), section_paragraph, all_of(part_section, (paragraph_fields,)), all_of(SECTION_SIGN, part_section, (paragraph_fields,)))
_CONJUNCTION = _p(r"(?:,\s*(?:and\b|or\b)?|and\b|or\b|except\s+for\b|-|through\b)", flags=re.I)
_OPEN, _CLOSE = _p(r"\("), _p(r"\)")
COMMENTS, APPENDICES = word("comments"), word("appendices")
COMMENT_MARK = sequence(COMMENT, (word("of", "to"),))
ANY_MARK = first_of(lambda c: c.take(PARAGRAPHS), lambda c: c.take(PARAGRAPH), lambda c: c.take(SECTIONS_SIGN), lambda c: c.take(SECTION_SIGN))


@dataclass(frozen=True)
class Citation:
    start: int
    end: int
    label: Label
    full_start: int
    full_end: int
    in_clause: bool = False

    def covers(self, other: Citation) -> bool:
        """Properly, by the full spans."""
        a, b = (self.full_start, self.full_end), (other.full_start, other.full_end)
        return a != b and a[0] <= b[0] and b[1] <= a[1]


def _starts(text: str, at: int) -> int:
    while at < len(text) and text[at].isspace():
        at += 1
    return at


def _lead(*atoms: Atom, then: str = "") -> re.Pattern:
    """What a text has to have at a place where a reader that begins with one of the atoms (and goes on with `then`) finds something."""
    plain = (a.pattern.pattern.removeprefix(r"\s*") for a in atoms)
    return re.compile("|".join(f"(?i:{p}){then}" if a.pattern.flags & re.I else f"(?:{p}){then}" for a, p in zip(atoms, plain, strict=True)))


def _scan(text: str, read: Callable[[Cursor], object], lead: re.Pattern):
    """What a reader finds, leftmost first and apart: (value, start, end). It is asked only where its lead is, which one search of
    the regular expression tells for all places between."""
    at = 0
    while m := lead.search(text, at):
        at = m.start()
        c = Cursor(text, at)
        got = read(c)
        if got is not None and c.at > at:
            yield got, at, c.at
            at = c.at
        else:
            at += 1


def _single(mark, target, comment: bool = False):
    """A marked (or unmarked) citation: (fields, place behind the mark)."""

    def read(c: Cursor):
        begin = None
        if mark is not None:
            if mark(c) is None:
                return None
            begin = _starts(c.text, c.at)
        got = target(c)
        return None if got is None else [(got | ({"comment": "1"} if comment else {}), begin)]

    return read


def _multiple(mark, head, tail, comment: bool = False, closing: bool = True):
    """A list of citations: [(fields, (start, end)), ..], two at least."""

    def item(c: Cursor, reader):
        begin = _starts(c.text, c.at)
        got = reader(c)
        return None if got is None else (got | ({"comment": "1"} if comment else {}), (begin, c.at))

    def read(c: Cursor):
        if mark is not None and mark(c) is None:
            return None
        first = item(c, head)
        if first is None:
            return None
        out = [first]
        while True:
            d = c.fork()
            if closing:
                d.take(_OPEN)
            x = item(d, tail) if d.take(_CONJUNCTION) else None
            if x is None:
                break
            if closing:
                d.take(_CLOSE)
            out.append(x)
            c.at = d.at
        return out if len(out) > 1 else None

    return read


def _pattern(p: re.Pattern):
    return lambda c: c.take(p)


_APPENDIX_PART = _p(r"\bappendix\b\s*([A-Z]+[0-9]*)\b\s*,\s*part\b\s*([IVXLCDM]+)((?:\.(?:[A-Z]+(?![a-z])|\d+)){0,3})", flags=re.I)
_PARAGRAPH_OF_PART = _p(r"\bparagraph\b\s*([A-Z]+|\d+)((?:\.(?:[A-Z]+|\d+)){0,2})\s*\.\s*of\s+part\s+([IVXLCDM]+)")


_CFR = _p(r"(\d+)\s*CFR")
_SECTION_OF_APPENDIX = _p(r"(?:§|Section|section)\s*([IVXLCDM]+)\s*of the appendix to this part")
_NEXT_NUMBER = _p(r"\.\s*(\d+)")
_APPENDIX_PART_LEAD, _PARAGRAPH_OF_PART_LEAD, _CFR_LEAD = _lead(_APPENDIX_PART), _lead(_PARAGRAPH_OF_PART), _lead(_CFR)
#: Readers of citations, each with its lead. A number without a mark needs a paragraph after it.
_NUMBERED = _lead(NUMBER, then=r"\s*\(")
_LISTS = [
    (_multiple(ANY_MARK, inner, inner), _lead(PARAGRAPHS, PARAGRAPH, SECTIONS_SIGN, SECTION_SIGN)),
    (_multiple(None, appendix_with_section, inner), _lead(APPENDIX_SECTION)),
    (_multiple(first_of(lambda c: c.take(COMMENTS), COMMENT_MARK), all_of((SECTION_SIGN,), inner, (comment_fields,)), first_of(all_of(inner, (comment_fields,)), comment_fields), comment=True), _lead(COMMENTS, COMMENT)),
    (_multiple(_pattern(APPENDICES), appendix_name, appendix_name, closing=False), _lead(APPENDICES)),
    (_multiple(_pattern(SECTIONS_SIGN), part_section, lambda c: (m := c.take(_NEXT_NUMBER)) and {"section": m[1]}, closing=False), _lead(SECTIONS_SIGN)),
]
_SINGLES = [
    (_single(COMMENT_MARK, all_of(comment_target, (comment_fields,)), comment=True), _lead(COMMENT)),
    (_single(_pattern(APPENDIX_WORD), first_of(appendix_with_section, appendix_name)), _lead(APPENDIX_WORD)),
    (_single(None, appendix_with_section), _lead(APPENDIX_SECTION)),
    (_single(None, lambda c: (m := c.take(_SECTION_OF_APPENDIX)) and {"appendix": "A", "appendix_section": m[1]}), _lead(_SECTION_OF_APPENDIX)),
    (_single(first_of(lambda c: c.take(PARAGRAPH), lambda c: c.take(PARAGRAPHS)), paragraph_fields), _lead(PARAGRAPH, PARAGRAPHS)),
    (_single(_pattern(SECTION_SIGN), all_of(part_section, (paragraph_fields,))), _lead(SECTION_SIGN)),
    (_single(_pattern(PARAGRAPH), section_paragraph), _lead(PARAGRAPH)),
]
_UNMARKED_SINGLES = [(_single(None, section_paragraph), _NUMBERED), (_single(None, all_of(part_section, paragraph_fields)), _lead(PART_SECTION, then=r"\s*\("))]
_UNMARKED_LISTS = [(_multiple(None, section_paragraph, inner), _NUMBERED)]


def internal(text: str, initial: Label = Label(), require_marker: bool = False, title: str | None = None) -> list[Citation]:
    """Citations of this regulation, as labels completed from where the text stands (initial); those within another are left out."""
    out: list[Citation] = []
    singles, lists = (_SINGLES, _LISTS) if require_marker else (_SINGLES + _UNMARKED_SINGLES, _LISTS + _UNMARKED_LISTS)
    for reader, lead in singles:
        for [(fields, begin)], start, end in _scan(text, reader, lead):
            out.append(Citation(start if begin is None else begin, end, initial.copy(**fields), start, end))
    for reader, lead in lists:
        for items, start, end in _scan(text, reader, lead):
            label = initial
            for fields, (a, b) in items:
                label = label.copy(**fields)
                out.append(Citation(a, b, label, start, end, True))
    for m, start, end in _scan(text, _pattern(_APPENDIX_PART), _APPENDIX_PART_LEAD):
        begin = _starts(text, m.start(1))
        rest = dict(zip(P, [x for x in m[3].split(".") if x], strict=False))
        out.append(Citation(begin, end, initial.copy(appendix=m[1], appendix_section=m[2], **rest), start, end))
    for m, start, end in _scan(text, _pattern(_PARAGRAPH_OF_PART), _PARAGRAPH_OF_PART_LEAD):
        rest = dict(zip(P, [m[1], *[x for x in m[2].split(".") if x]], strict=False))
        out.append(Citation(_starts(text, m.start(1)), end, initial.copy(appendix_section=m[3], **rest), start, end))
    part = (initial.parts() or [None])[0]
    for items, start, end in _scan(text, _cfr, _CFR_LEAD):
        if items[0] == str(title):
            label = initial
            for fields, (a, b) in items[1]:
                if fields["part"] == part:
                    label = label.copy(**fields)
                    out.append(Citation(a, b, label, start, end, len(items[1]) > 1))
    return sorted({c for c in out if not any(o.covers(c) for o in out)}, key=lambda c: (c.start, c.end, c.full_start))


def _cfr(c: Cursor):
    m = c.take(_CFR)
    if not m:
        return None
    target, begin = all_of(part_section, (paragraph_fields,)), _starts(c.text, m.start())
    got = target(c)
    if got is None:
        return None
    items = [(got, (begin, c.at))]
    while True:
        d = c.fork()
        if not d.take(_CONJUNCTION):
            break
        a = _starts(d.text, d.at)
        if (got := target(d)) is None:
            break
        items.append((got, (a, d.at)))
        c.at = d.at
    return m[1], items


def without_citations(text: str, markers: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Markers that do not overlap a citation; the text is scanned once for all of them."""
    spans = [(c.start, c.end) for c in internal(text)]
    return [(m, a, b) for m, a, b in markers if not any(s <= a <= e or s <= b <= e or (a <= s and e <= b) for s, e in spans)]


# -- other law --------------------------------------------------------------------------------------------------

_EXTERNAL = re.compile(r"(?P<usc>(\d+)\s+U\.?\s?S\.?\s?C\.?\s+(?:§\s*)?(\d+[a-z]*))|(?P<cfr>(\d+)\s+CFR\s+(?:parts?\s+)?(\d+)(?:\.(\d+))?)|(?P<law>Public\s+Law\s+(\d+)-(\d+))|(?P<stat>(\d+)\s+Stat\.\s+(\d+))|(?P<act>\bthe\s+Act\b)")
KINDS = {"usc": "USC", "cfr": "CFR", "law": "PUBLIC_LAW", "stat": "STATUTES_AT_LARGE", "act": "USC"}


def external(text: str, title: str | None = None, part: str | None = None, act: list[str] | None = None) -> list[dict]:
    """{citation, citation_type, offsets} of each law that is cited; the regulation itself (title and part) is not. `the Act` is the configured one."""
    found: dict[tuple, dict] = {}
    for m in _EXTERNAL.finditer(text):
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m[k])
        parts = [x for x in re.findall(r"[0-9]+[a-z]*", m[0])] if kind != "act" else list(act or [])
        if not parts or (kind == "cfr" and parts[:2] == [str(title), str(part)]):
            continue
        words = {"usc": ["U.S.C."], "cfr": ["CFR"], "law": ["Public", "Law"], "stat": ["Stat."], "act": []}[kind]
        citation = [parts[0], *words, *parts[1:]] if kind in ("usc", "cfr", "stat") else [*words, *parts]
        key = (KINDS[kind], tuple(citation))
        found.setdefault(key, {"citation": citation, "citation_type": KINDS[kind], "offsets": []})["offsets"].append(m.span())
    return list(found.values())
