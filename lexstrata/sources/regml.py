"""RegML: a regulation with its layers written into it, and the notice of a version, as XML documents.

Layers become replacements (tree, label_id, start, stop, before, after, kept) by kind; a node's replacements are gathered
in its row, so a tree is written by one task from its own rows, and trees are independent.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable
from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.model import Node, from_rows
from .sinks import tag_of

INLINE: dict[str, Callable[[DataFrame], DataFrame]] = {}


def inline(name: str):
    """Registers how a layer's rows are written into texts."""

    def register(f):
        INLINE[name] = f
        return f

    return register


def _replacement(rows: DataFrame, start, stop, before: Column, after: str, kept: bool = True) -> DataFrame:
    return rows.select("tree", "label_id", F.col(start).cast("int").alias("start") if isinstance(start, str) else start.cast("int").alias("start"), F.col(stop).cast("int").alias("stop") if isinstance(stop, str) else stop.cast("int").alias("stop"), before.alias("before"), F.lit(after).alias("after"), F.lit(kept).alias("kept"))


def _tag(head: str, value: Column, tail: str) -> Column:
    quoted = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit("<"), F.lit("&lt;"))
    return F.concat(F.lit(head), quoted, F.lit(tail))


@inline("terms")
def terms(rows: DataFrame) -> DataFrame:
    return _replacement(rows, "start", "stop", _tag('<ref target="', F.col("definition"), '" reftype="term">'), "</ref>")


@inline("internal-citations")
def internal_citations(rows: DataFrame) -> DataFrame:
    return _replacement(rows, "start", "stop", _tag('<ref target="', F.col("cited"), '" reftype="internal">'), "</ref>")


@inline("external-citations")
def external_citations(rows: DataFrame) -> DataFrame:
    """The target is the kind of citation and its parts; which address that is, the reader of the document knows."""
    target = F.concat(F.col("citation_type"), F.lit(":"), F.replace("citation", F.lit(" "), F.lit("-")))
    return _replacement(rows, "start", "stop", _tag('<ref target="', target, '" reftype="external">'), "</ref>")


@inline("paragraph-markers")
def paragraph_markers(rows: DataFrame) -> DataFrame:
    """Markers are attributes of their paragraphs and leave the text."""
    return _replacement(rows, "location", F.col("location") + F.length("marker"), F.lit(""), "", False)


@inline("definitions")
def definitions(rows: DataFrame) -> DataFrame:
    """rows: (tree, label_id, term, start, stop), see defined()."""
    return _replacement(rows, "start", "stop", _tag('<def term="', F.col("term"), '">'), "</def>")


def defined(uses: DataFrame, nodes: DataFrame) -> DataFrame:
    """Where terms that are used are defined: tree, label_id, term, start, stop, from the terms layer and the defining texts."""
    # Quoted, if it is; a use may be a plural, which the defining text need not have.
    named = uses.select("tree", F.col("definition").alias("label_id"), "term").distinct()
    met = named.join(nodes.select("tree", "label_id", "text"), ["tree", "label_id"]).withColumn("at", F.expr("coalesce(nullif(instr(lower(text), concat('“', lower(term), '”')), 0) + 1, instr(lower(text), lower(term)))")).where("at > 0")
    return met.select("tree", "label_id", "term", (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.length("term")).alias("stop"))


def replacements(layers: dict[str, DataFrame]) -> DataFrame | None:
    """All replacements of the layers that are written into texts."""
    out = None
    for name in sorted(layers):
        if name in INLINE:
            one = INLINE[name](layers[name])
            out = one if out is None else out.unionByName(one)
    return out


# -- one document -----------------------------------------------------------------------------------------------

_FORMATS = re.compile(r"(?P<variable>[a-zA-Z0-9]+)_\{(?P<subscript>\w+)\}|(?P<dash>[^_\n]*)_{5,}|```(?P<kind>[^\n]*)\n(?P<lines>.*?)\n```|(?P<table>^\|.*\|$(?:\n^\|.*\|$)*)", re.S | re.M)


def _formatted(text: str) -> str:
    """Escaped text with subscripts, dashes, fences and tables as elements."""

    def one(m: re.Match) -> str:
        if m["subscript"] is not None:
            return f"<variable>{escape(m['variable'])}<subscript>{escape(m['subscript'])}</subscript></variable>"
        if m["dash"] is not None:
            return f"<dash>{escape(m['dash'])}</dash>"
        if m["table"] is not None:
            return table_xml([line.strip("|").split("|") for line in m["table"].split("\n")])
        return f'<callout type="{escape(m["kind"])}">' + "".join(f"<line>{escape(x)}</line>" for x in m["lines"].split("\n")) + "</callout>"

    out, at = [], 0
    for m in _FORMATS.finditer(text):
        out += [escape(text[at : m.start()], quote=False), one(m)]
        at = m.end()
    return "".join([*out, escape(text[at:], quote=False)])


def table_xml(rows: list[list[str]]) -> str:
    """Rows of cells; the row before one of dashes is the header."""
    heads = [rows[i - 1] for i, r in enumerate(rows) if i and all(set(c) == {"-"} for c in r)]
    body = [r for r in rows if r not in heads and not all(set(c) == {"-"} for c in r)]
    head = "".join("<columnHeaderRow>" + "".join(f'<column colspan="1" rowspan="1">{escape(c)}</column>' for c in r) + "</columnHeaderRow>" for r in heads)
    return f"<table><header>{head}</header>" + "".join("<row>" + "".join(f"<cell>{escape(c)}</cell>" for c in r) + "</row>" for r in body) + "</table>"


def written(text: str, marks: Iterable[tuple[int, int, str, str, bool]], keyterm: str | None = None) -> str:
    """A text's XML: replacements where they stand (of overlapping ones the first, of equal starts the longest), the key
    term left out, as it is the title."""
    marks = list(marks)
    if keyterm and (at := text.find(keyterm)) >= 0:
        marks.append((at, at + len(keyterm), "", "", False))
    out, at = [], 0
    for a, b, before, after, kept in sorted(marks, key=lambda m: (m[0], -m[1])):
        if a < at or b > len(text):
            continue
        out += [_formatted(text[at:a]), before, _formatted(text[a:b]) if kept else "", after]
        at = b
    return "".join([*out, _formatted(text[at:])]).strip()


def toc_xml(entries: Iterable[tuple[str, str]], label: str) -> str:
    """(target label, title) of a subpart's or a document's children: sections by number, appendices by letter."""
    out = []
    for target, title in entries:
        last = target.split("-")[-1]
        if last.isdigit():
            out.append(f'<tocSecEntry target="{escape(target)}"><sectionNum>{escape(last)}</sectionNum><sectionSubject>{escape(title)}</sectionSubject></tocSecEntry>')
        else:
            out.append(f'<tocAppEntry target="{escape(target)}"><appendixLetter>{escape(last)}</appendixLetter><appendixSubject>{escape(title)}</appendixSubject></tocAppEntry>')
    return f'<tableOfContents label="{escape(label)}-TOC">{"".join(out)}</tableOfContents>'


def footnoted(text: str, refs: Iterable[tuple[int, str]], footnotes: dict[str, str]) -> str:
    """A paragraph's XML with its footnotes at their offsets. A reference without a footnote is an error."""
    out, at = [], 0
    for offset, ref in sorted(refs):
        out += [escape(text[at:offset], quote=False), f'<footnote ref="{escape(ref)}">{escape(footnotes[ref], quote=False)}</footnote>']
        at = offset
    return "".join([*out, escape(text[at:], quote=False)])


def analysis_xml(section: dict, footnotes: dict[str, str], target: str = "", notice: str = "", date: str = "") -> str:
    """A section-by-section analysis with its paragraphs and sections below. section: see notices.analyses()."""
    head = f' target="{escape(target)}" notice="{escape(notice)}" date="{escape(date)}"' if target else ""
    paragraphs = [footnoted(p, [(r["offset"], r["reference"]) for r in section.get("footnote_refs", []) if r["paragraph"] == i], footnotes) for i, p in enumerate(section["paragraphs"])]
    inner = "".join(f"<analysisParagraph>{p}</analysisParagraph>" for p in paragraphs) + "".join(analysis_xml(c, footnotes) for c in section.get("children", []))
    return f"<analysisSection{head}><title>{escape(section['title'], quote=False)}</title>{inner}</analysisSection>"


def analysis_of(sections: Iterable[dict], label: str) -> dict | None:
    """The analysis that is about a label, at any depth."""
    for s in sections:
        if label in s.get("labels", ()):
            return s
        if (found := analysis_of(s.get("children", ()), label)) is not None:
            return found
    return None


def fdsys(meta: dict, original_date: str = "", volume: str = "8") -> str:
    values = (("cfrTitleNum", meta.get("cfr_title_number")), ("cfrTitleText", meta.get("cfr_title_text")), ("volume", volume), ("date", meta.get("effective_date")), ("originalDate", original_date), ("title", meta.get("statutory_name")))
    return "<fdsys>" + "".join(f"<{k}>{escape(str(v or ''), quote=False)}</{k}>" for k, v in values) + "</fdsys>"


def preamble(meta: dict, part: str, document_number: str, url: str, agency: str = "") -> str:
    e = lambda x: escape(str(x or ""), quote=False)
    return f"<preamble><agency>{e(agency)}</agency><cfr><title>{e(meta.get('cfr_title_number'))}</title><section>{e(part)}</section></cfr><documentNumber>{e(document_number)}</documentNumber><effectiveDate>{e(meta.get('effective_date'))}</effectiveDate><federalRegisterURL>{e(url)}</federalRegisterURL></preamble>"


def to_regml(root: Node, marks: dict[str, list] | None = None, tocs: dict[str, list] | None = None, titles: dict[str, str] | None = None) -> str:
    """A tree with its layers: replacements, tables of contents and key terms (which title their paragraphs) by label."""
    marks, tocs, titles = marks or {}, tocs or {}, titles or {}
    out: list[str] = []
    stack: list[tuple[Node | None, str]] = [(root, "")]
    while stack:
        n, closing = stack.pop()
        if n is None:
            out.append(closing)
            continue
        tag, label = tag_of(n), n.label_id
        head = f'<{tag} label="{escape(label)}"'
        if tag == "section":
            head += f' sectionNum="{escape(n.label[-1])}"'
        elif tag == "subpart" and len(n.label) == 3:
            head += f' subpartLetter="{escape(n.label[-1])}"'
        elif "aragraph" in tag:
            head += f' marker="{escape(n.label[-1])}"'
        title = n.title or titles.get(label)
        out.append(head + ">" + (f"<title>{escape(title, quote=False)}</title>" if title else ""))
        if label in tocs:
            out.append(toc_xml(tocs[label], label))
        if n.text.strip():
            out.append(f"<content>{written(n.text, marks.get(label, ()), titles.get(label))}</content>")
        stack += [(None, f"</{tag}>"), *[(c, "") for c in reversed(n.children)]]
    return "".join(out)


def documents(nodes: DataFrame, layers: dict[str, DataFrame], key: str = "tree") -> DataFrame:
    """(key, document): the RegML of every tree. layers: rows by name, see operators.layers; kinds that are not written into
    texts, tables of contents or titles are not read."""
    given = replacements(layers)
    rows = nodes
    empty = "array<struct<start:int,stop:int,before:string,after:string,kept:boolean>>"
    if given is not None:
        held = given.groupBy("tree", "label_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "before", "after", "kept"))).alias("marks"))
        rows = rows.join(held, ["tree", "label_id"], "left")
    else:
        rows = rows.withColumn("marks", F.lit(None).cast(empty))
    toc = layers.get("toc")
    if toc is not None:
        entries = toc.groupBy("tree", "label_id").agg(F.array_sort(F.collect_list(F.struct("toc_pos", F.concat_ws("-", "label_id", "index").alias("target"), "title"))).alias("toc"))
        rows = rows.join(entries, ["tree", "label_id"], "left")
    else:
        rows = rows.withColumn("toc", F.lit(None).cast("array<struct<toc_pos:int,target:string,title:string>>"))
    named = layers.get("keyterms")
    rows = rows.join(named.select("tree", "label_id", "keyterm"), ["tree", "label_id"], "left") if named is not None else rows.withColumn("keyterm", F.lit(None).cast("string"))
    columns = ["path", "label", "label_id", "node_type", "title", "text", "tagged_text"]
    kind = nodes.schema[key].dataType.simpleString()

    def build(pdf):
        import pandas as pd

        root = from_rows([(list(r[0]), list(r[1]), *r[2:]) for r in pdf[columns].itertuples(index=False, name=None)])
        has = lambda c: [(r[0], r[1]) for r in pdf[["label_id", c]].itertuples(index=False, name=None) if r[1] is not None and (isinstance(r[1], str) or len(r[1]))]
        marks = {k: [(m["start"], m["stop"], m["before"], m["after"], m["kept"]) for m in v] for k, v in has("marks")}
        tocs = {k: [(t["target"], t["title"]) for t in v] for k, v in has("toc")}
        return pd.DataFrame([[pdf[key].iloc[0], to_regml(root, marks, tocs, dict(has("keyterm"))) if root else ""]], columns=[key, "document"])

    return rows.select(key, *columns, "marks", "toc", "keyterm").groupBy(key).applyInPandas(build, f"{key} {kind}, document string")


def notice_xml(notice: dict, root: Node, changes: dict[str, str], meta: dict, before: str = "", sections: Iterable[dict] = (), analysed: Iterable[str] = ()) -> str:
    """A notice: what it is, its analyses, and what differs between two versions of a regulation (label -> added, modified
    or deleted), with the nodes that are new. Labels that are analysed count as modified."""
    sections, analysed = list(sections), list(analysed)
    all_ = {label: "modified" for label in analysed} | dict(changes)
    parts = [fdsys(meta, notice.get("publication_date", "")), preamble(meta, root.label_id, notice["document_number"], notice.get("fr_url", ""), ", ".join(notice.get("agency_names") or ()))]
    found = [(label, s) for label in analysed if (s := analysis_of(sections, label)) is not None]
    parts.append("<analysis>" + "".join(analysis_xml(s, notice.get("footnotes", {}), label, notice["document_number"], notice.get("publication_date", "")) for label, s in found) + "</analysis>")
    rows = []
    for label, op in sorted(all_.items()):
        n = root.find(label) if op in ("added", "modified") else None
        rows.append(f'<change operation="{escape(op)}" label="{escape(label)}">{to_regml(n) if n is not None else ""}</change>')
    return f'<notice><!-- from {escape(before)} -->{parts[0]}{parts[1]}{parts[2]}<changeset leftDocumentNumber="{escape(before)}" rightDocumentNumber="{escape(notice["document_number"])}">{"".join(rows)}</changeset></notice>'


def checked(document: str) -> ET.Element:
    """The document as elements; an error if it is not well-formed."""
    return ET.fromstring(document)

