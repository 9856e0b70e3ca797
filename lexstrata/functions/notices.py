"""Notices: their dates, addresses, section-by-section analyses, footnotes, delays, and the changes they make."""

from __future__ import annotations

import copy
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from datetime import date, datetime

from . import amendments as A
from .model import INTERP, Node
from .regxml import OPEN, build_appendix, build_section, build_subpart, build_supplement, node_text
from .replay import Change

MONTHS = "January February March April May June July August September October November December".split()
_DATE = re.compile(rf"({'|'.join(MONTHS)})\s+(\d{{1,2}}),\s+(\d{{4}})")


def parse_dates(text: str) -> list[date]:
    return [date(int(y), MONTHS.index(m) + 1, int(d)) for m, d, y in _DATE.findall(text)]


def date_sentence(sentence: str) -> tuple[str, str] | None:
    """(comments, effective or other; ISO date) of a sentence that ends with a date."""
    m = re.search(_DATE.pattern + r"[^\d]*$", sentence)
    if not m:
        return None
    low = sentence.lower()
    kind = "comments" if "comment" in low else "effective" if "effective" in low else "other"
    return kind, parse_dates(m[0])[0].isoformat()


def dates(el: ET.Element) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for p in el.iterfind(".//EFFDATE/P"):
        for sentence in node_text(p, True).split("."):
            if found := date_sentence(sentence.strip()):
                out.setdefault(found[0], []).append(found[1])
    return out


# -- addresses --------------------------------------------------------------------------------------------------


def clean_address(text: str) -> str:
    """Leading bullets go, a colon is followed by a space."""
    return re.sub(r":(?=\S)(?!//)", ": ", re.sub(r"^[^A-Za-z0-9]+", "", text)).strip()


def addresses(el: ET.Element) -> dict | None:
    """Of an ADD element: intro, methods (label, content) and instructions (what follows a header or says `Instructions`)."""
    blocks = [(c.tag, clean_address(node_text(c, True))) for c in el if c.tag in ("P", "HD")]
    paragraphs = [t for tag, t in blocks if tag == "P" and t]
    if not paragraphs:
        return None
    out: dict = {"methods": [], "instructions": []}
    for i, p in enumerate(paragraphs):
        label, colon, rest = p.partition(":")
        if label.lower().startswith("instructions") or out["instructions"]:
            out["instructions"].append(rest.strip() if label.lower() == "instructions" else p)
        elif i == 0 and (not colon or len(label) > 60 or not rest.strip()):
            out["intro"] = p
        elif colon and rest.strip() and not rest.startswith("//"):
            out["methods"].append((label, rest.strip()))
        else:
            out["instructions"].append(p)
    return out


# -- section by section -----------------------------------------------------------------------------------------


def analysis_elements(el: ET.Element) -> list[ET.Element]:
    """Between the header `section-by-section analysis` and the next header of its level."""
    out, level = [], None
    for c in el:
        if c.tag == "HD" and level is None and re.search(r"section.by.section", node_text(c), re.I):
            level = c.get("SOURCE")
        elif level is not None:
            if c.tag == "HD" and c.get("SOURCE", "HD9") <= level:
                break
            out += list(c) if c.tag == "EXTRACT" else [c]
    return out


def labels_of_header(title: str, part: str) -> list[str]:
    """What an analysis is about: sections and paragraphs of its part, or interpretations."""
    out = []
    for m in re.finditer(rf"(?:{re.escape(part)}\.|(?:§|Section|[Cc]omment)\s*(?!{re.escape(part)}\.)|(?<![\d.])(?=\d+\())(\d+)((?:\([a-zA-Z0-9]+\))*)(?:-(\d+))?", title):
        label = [part, m[1], *re.findall(r"\(([^)]+)\)", m[2])]
        if m[0].lower().startswith("comment") or m[3]:
            label += [INTERP, *([m[3]] if m[3] else [])]
        out.append("-".join(label))
    return out


def analyses(elements: Iterable[ET.Element], part: str, page: int = 0) -> list[dict]:
    """Analyses by header level: {title, labels, page, paragraphs, footnote_refs, children}; pages go on at page breaks."""
    top: list[dict] = []
    stack: list[tuple[str, dict]] = []
    for e in elements:
        if e.tag == "PRTPAGE":
            page = int(e.get("P", page))
        elif e.tag == "HD":
            node = {"title": node_text(e, True), "page": page, "paragraphs": [], "footnote_refs": [], "children": []}
            node["labels"] = labels_of_header(node["title"], part)
            while stack and stack[-1][0] >= e.get("SOURCE", "HD1"):
                stack.pop()
            (stack[-1][1]["children"] if stack else top).append(node)
            stack.append((e.get("SOURCE", "HD1"), node))
        elif e.tag in ("P", "FP") and stack:
            node = stack[-1][1]
            text, at = e.text or "", len(node["paragraphs"])
            for c in e:
                if c.tag == "SU":
                    node["footnote_refs"].append({"paragraph": at, "reference": c.text, "offset": len(text)})
                elif c.tag == "PRTPAGE":
                    page = int(c.get("P", page))
                else:
                    text += c.text or ""
                text += c.tail or ""
            node["paragraphs"].append(text.strip())
    return top


def footnotes(el: ET.Element) -> dict[str, str]:
    out = {}
    for p in el.iterfind(".//FTNT/P"):
        ref = p.find("SU")
        if ref is not None:
            rest = (p.text or "") + "".join((c.text or "") * (c is not ref) + (c.tail or "") for c in p)
            out[ref.text] = rest.strip()
    return out


# -- delays -----------------------------------------------------------------------------------------------------

_DELAY = re.compile(rf"(?P<effective>effective\s+dates?)|(?P<fr>(\d+)\s+FR\s+(\d+))|(?P<delayed>delayed)|(?P<date>{_DATE.pattern})", re.I)


def delays(sentence: str) -> tuple[list[tuple[int, int]], str | None]:
    """Notices (volume, page) whose effective date a sentence delays, and to when: it names the effective date, the
    notices, `delayed`, and then the date."""
    kinds = [(m.lastgroup if m.lastgroup in ("effective", "fr", "delayed", "date") else next(k for k in ("effective", "fr", "delayed", "date") if m[k]), m) for m in _DELAY.finditer(sentence)]
    order = [k for k, _ in kinds]
    if "effective" not in order or "delayed" not in order[order.index("effective") :]:
        return [], None
    a = order.index("effective")
    b = order.index("delayed", a)
    notices = [(int(m[3]), int(m[4])) for k, m in kinds[a:b] if k == "fr"]
    later = [m for k, m in kinds[b:] if k == "date"]
    return (notices, parse_dates(later[-1]["date"])[0].isoformat()) if notices and later else ([], None)


def delayed(notices: list[dict], texts: dict[str, list[str]]) -> list[dict]:
    """Effective dates after the delays that later rules name, in order of publication."""
    out = [dict(n) for n in notices]
    for n in sorted(notices, key=lambda n: (n["publication_date"], n["document_number"])):
        for sentence in texts.get(n["document_number"], []) if n.get("type", "Rule") == "Rule" else []:
            hit, to = delays(sentence)
            for m in out:
                if any(m["fr_volume"] == v and m["start_page"] <= p <= m["end_page"] for v, p in hit):
                    m["effective_on"] = to
    return out


# -- changes ----------------------------------------------------------------------------------------------------


_APPENDIX_HEAD = re.compile(r"Appendix\s+([A-Z]+[0-9]*)\s+to\s+Part\s+(\d+)", re.I)


def repaired(root: ET.Element) -> ET.Element:
    """A notice with frequent slips of its markup mended: an instruction that ends a REGTEXT goes to the next one of its
    part; paragraphs that announce Supplement I are instructions; parentheses of emphasised markers stand outside the emphasis."""
    root = copy.deepcopy(root)
    for above in root.iter():
        for here, after in zip(list(above), list(above)[1:], strict=False):
            if len(here) and here[-1].tag == "AMDPAR" and here.get("PART") == after.get("PART"):
                moved = here[-1]
                here.remove(moved)
                after.insert(0, moved)
    for regtext in root.iter("REGTEXT"):
        blocks = list(regtext)
        heads = [i for i, c in enumerate(blocks) if c.tag == "HD" and c.get("SOURCE") == "HD1" and "Supplement I" in node_text(c)]
        announced = [i for i, c in enumerate(blocks) if c.tag in ("P", "AMDPAR") and "supplement i" in node_text(c).lower()]
        for head in heads if announced else []:
            first = max([i for i in announced if i < head], default=0)
            for c in blocks[first:head]:
                c.tag = "AMDPAR" if c.tag == "P" else c.tag
    for p in root.iter("P"):
        if not len(p) or p[0].tag != "E":
            continue
        em, before = p[0], p.text or ""
        inside, after = em.text or "", em.tail or ""
        opened, closed = inside[:1] == "(", inside[-1:] == ")"
        if (before[-1:] == "(" or opened) and (closed or after[:1] == ")"):
            if opened and before[-1:] != "(":
                p.text, inside = before + "(", inside[1:]
            if closed and after[:1] != ")":
                inside, em.tail = inside[:-1], ")" + after
            em.text = inside
    return root


def _printed_supplement(el: ET.Element) -> ET.Element | None:
    """Interpretations printed in a REGTEXT without an element of their own: from the header of Supplement I on."""
    flat = [x for c in el for x in (c if c.tag in ("EXTRACT", "APPENDIX", "SUBPART") else [c])]
    at = next((i for i, c in enumerate(flat) if c.tag == "HD" and "Supplement I" in node_text(c)), None)
    if at is None:
        return None
    out = ET.Element("APPENDIX")
    out.extend(c for c in flat[at:] if c.tag in ("HD", "P", "FP", "STARS"))
    return out


def _printed_appendices(el: ET.Element) -> list[ET.Element]:
    """Whole appendices printed as a header and an extract."""
    out = []
    for above in el.iter():
        for head, body in zip(list(above), list(above)[1:], strict=False):
            if head.tag == "HD" and body.tag == "EXTRACT" and _APPENDIX_HEAD.search(node_text(head)):
                whole = ET.Element("APPENDIX")
                title = copy.copy(head)
                title.set("SOURCE", "HED")
                whole.append(title)
                for c in body:
                    if c.tag == "AMDPAR":
                        break
                    whole.append(c)
                out.append(whole)
    return out


def parsed_nodes(el: ET.Element, part: str, interpretations: bool = True) -> list[Node]:
    """The nodes of what an amendment shows: sections, appendices, interpretations. A single section takes the loose
    paragraphs that follow the instructions after it."""
    out, sections, appendices = [], [c for c in el.iter("SECTION")], [c for c in el.iter("APPENDIX")]
    blocks = list(el)
    if len(sections) == 1 and sections[0] in blocks:
        after = blocks[blocks.index(sections[0]) + 1 :]
        loose = [c for i, c in enumerate(after) if c.tag in ("P", "STARS") and any(x.tag == "AMDPAR" for x in after[:i])]
        if loose:
            whole = copy.copy(sections[0])
            whole.extend(loose)
            sections = [whole]
    for c in sections:
        out += build_section(part, c)
    supplement = None
    for c in [*appendices, *_printed_appendices(el)]:
        heading = next((node_text(h, True) for h in c if h.tag == "HD"), "")
        if "Supplement I" in heading:
            supplement = c
        elif (n := build_appendix(c, part)) is not None:
            out.append(n)
    if interpretations:
        supplement = _printed_supplement(el) if supplement is None or _printed_supplement(el) is not None else supplement
        n = build_supplement(supplement, part) if supplement is not None else None
        out += [n] if n is not None else []
    return out


def amended(el: ET.Element, ctx: tuple = ()) -> list[A.Amendment]:
    """Amendments of a REGTEXT's instructions in order; the context goes from one to the next. Repeated ones count once."""
    ctx, out = ctx or (el.get("PART"),), []
    for p in el.findall("AMDPAR"):
        found, ctx = A.parse(node_text(p, True), ctx)
        out += [a for a in found if a not in out]
    return out


def candidates(label_id: str, nodes: list[Node], used: set[str]) -> Node | None:
    """A node that an amendment can mean though its label differs: the single one with an impossible label, or else the
    single unused one with the same last part."""
    free = [n for n in nodes if n.label_id not in used]
    start = label_id.split("-")[0]
    odd = [n for n in free if not n.label_id.startswith(start)]
    if len(odd) == 1:
        return odd[0]
    last = [n for n in free if n.label and n.label[-1] == label_id.rpartition("-")[2]]
    return last[0] if len(last) == 1 else None


def _reserved(label: tuple, part: str) -> Node:
    """The node that `remove and reserve` leaves where nothing is printed for it."""
    if len(label) == 2 and label[1].isdigit():
        return Node("", list(label), "regtext", f"§ {label[0]}.{label[1]} [Reserved]")
    kind = "interp" if INTERP in label else "appendix" if len(label) > 1 and not label[1].isdigit() else "regtext"
    text = "[Reserved]" if len(label) < 2 else f"{label[-1]}. [Reserved]" if kind == "interp" else f"({label[-1]}) [Reserved]"
    return Node("", list(label), kind, f"Appendix {label[1]} to Part {part} [Reserved]") if kind == "appendix" and len(label) == 2 else Node(text, list(label), kind)


def _only_stars(n: Node) -> bool:
    return re.sub(r"^\s*(?:\([^)]*\)|\w+\.)?", "", n.text).strip() == "* * *"


def _printed(n: Node) -> tuple[Node, list[Change]]:
    """A node without descendants that are printed as stars, and that these are to stay as they are."""
    n, kept = copy.deepcopy(n), []
    for x in n.walk():
        kept += [Change("KEEP", c.label_id) for c in x.children if _only_stars(c)]
        x.children = [c for c in x.children if not _only_stars(c)]
    return n, kept


def changes(el: ET.Element, part: str = "", printed: ET.Element | None = None) -> list[Change]:
    """Changes of one REGTEXT: amendments matched with the nodes that it (or `printed`, where it shows none itself) shows.

    Nodes of only stars are kept; a node that ends with a colon before stars changes its own text; a new subpart is added
    with its sections, and sections that are added in a printed subpart belong to it. What is reserved without being
    printed is left as a node that says so. Amendments whose node is not found, and those of other parts, make no change.
    """
    part = part or el.get("PART") or ""
    found = [a for a in amended(el, (part,)) if a.action == "DESIGNATE" or a.label[:1] in ((part,), ())]
    holder = el if printed is None else printed
    shown = [n for top in parsed_nodes(holder, part, any(INTERP in a.label for a in found)) for n in top.walk()]
    by_label = {n.label_id: n for n in shown}
    subparts = {n.label[-1]: n for n in (build_subpart(part, s) for s in holder.iter("SUBPART")) if n.label[-1:] != ["Subpart"]}
    inside = {c.label_id: n.label for n in subparts.values() for c in n.children}
    used = {a.label_id for a in found if a.label_id in by_label}
    out: list[Change] = []
    for a in found:
        if a.action == "DELETE":
            out.append(Change("DELETE", a.label_id))
        elif a.action == "MOVE":
            out.append(Change("MOVE", a.label_id, destination=tuple(x for x in a.destination or () if x != "?")))
        elif a.action == "DESIGNATE":
            out += [Change("DESIGNATE", x, destination=tuple(re.split(r"-|:", "-".join(a.destination or ())))) for x in a.labels]
        elif a.action == "POST" and a.subpart and not any(x.isdigit() for x in a.label[1:]):
            if (new := subparts.get(a.subpart)) is not None:
                out.append(Change("POST", new.label_id, new))
        else:
            n = by_label.get(a.label_id) or candidates(a.label_id, shown, used)
            if n is None and a.action == "RESERVE":
                n = _reserved(a.label, part)
            if n is None:
                continue
            field = f"[{a.field}]" if a.field else None
            if a.action == "PUT" and field is None and _only_stars(n):
                out.append(Change("KEEP", a.label_id))
                continue
            if a.action == "PUT" and field is None and n.marker == OPEN:
                field = "[text]"
            if field is None:
                n, kept = _printed(n)
                out += kept
            out.append(Change(a.action, a.label_id, n, field, subpart=tuple(inside.get(n.label_id, ())) if a.action == "POST" else ()))
    return [c for i, c in enumerate(out) if c not in out[:i]]


def notice_changes(root: ET.Element, part: str = "") -> Iterator[Change]:
    """Changes of a whole notice, its markup mended first. Instructions that show nothing are matched with the next REGTEXT's
    section, where that has no instructions of its own."""
    blocks = list(repaired(root).iter("REGTEXT"))
    for i, el in enumerate(blocks):
        after = blocks[i + 1] if i + 1 < len(blocks) else None
        bare = all(c.tag == "AMDPAR" for c in el) and after is not None and after.find("AMDPAR") is None
        if el.find(".//AMDPAR") is not None:
            yield from changes(el, part or el.get("PART") or "", after if bare else None)


def merged(rows: Iterable[tuple[str, Change]], patches: dict[str, Iterable[Change]]) -> list[tuple[str, Change]]:
    """(document, change) rows with the patches of each document after its own changes; a patch of a label replaces what the
    document does to that label."""
    rows = list(rows)
    fixed = {(d, c.label_id) for d, cs in patches.items() for c in cs}
    return [(d, c) for d, c in rows if (d, c.label_id) not in fixed] + [(d, c) for d in sorted(patches) for c in patches[d]]


def described(c: Change) -> str:
    """A change in words."""
    n = c.node
    if c.action in ("PUT", "POST") and n is not None:
        if c.action == "PUT" and c.field:
            return f"{c.field.strip('[]').title()} changed to: {n.title or n.text}"
        verb = "Modified" if c.action == "PUT" else "Added"
        return f"{verb} (title: {n.title}): {n.text}" if n.title else f"{verb}: {n.text}"
    if c.action == "DESIGNATE":
        return "Moved to " + "-".join(c.destination)
    return {"DELETE": "Deleted", "RESERVE": "Reserved", "KEEP": "Mentioned but not modified"}.get(c.action, c.action)


def fields(j: dict) -> list[dict]:
    """Notice rows of an API record: one for each CFR title's parts."""
    parts = sorted({str(r["part"]) for r in j.get("cfr_references", [])})
    out = {k: j.get(k) for k in ("abstract", "action", "agency_names", "document_number", "publication_date", "regulation_id_numbers", "comments_close_on")}
    out |= {"cfr_parts": parts, "cfr_title": next((r["title"] for r in j.get("cfr_references", [])), None), "fr_url": j.get("html_url"), "fr_citation": j.get("citation"), "fr_volume": j.get("volume"), "effective_on": j.get("effective_on"), "initial_effective_on": j.get("effective_on")}
    out["meta"] = {k: j.get(k) for k in ("dates", "end_page", "start_page", "type")}
    return [out]


def split_by_date(rows: list[dict]) -> list[dict]:
    """Notices that take effect at several dates get numbers of their own: number_YYYYMMDD."""
    many = len(rows) > 1
    return [r | {"document_number": f"{r['document_number']}_{datetime.fromisoformat(r['effective_on']):%Y%m%d}"} if many else dict(r) for r in rows]
