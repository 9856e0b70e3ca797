"""Layers: one table of annotations for every kind, derived from a node table.

A layer is a function registered by name, DataFrame (nodes) -> DataFrame (label_id, elements). Layers that only read a
node's own text are marked: they are computed once for every distinct node_hash and joined back to all versions, so
unchanged paragraphs cost nothing in later versions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import citations as C
from ..functions import terms as T
from ..functions.arrow import flat_map
from .joins import known_targets, small
from .notices import applies, notice_struct
from .ranks import numbered
from .tree import with_prefixes

#: Nodes whose texts one task's automaton of terms reads.
NODES = 4096

LAYERS: dict[str, tuple[Callable[..., DataFrame], bool]] = {}


def layer(name: str, own_text: bool = False):
    """Registers a layer. own_text: it depends on nothing but the node itself."""

    def register(f):
        LAYERS[name] = (f, own_text)
        return f

    return register


def run(name: str, nodes: DataFrame, **options) -> DataFrame:
    return LAYERS[name][0](nodes, **options)


def node_hash():
    """Of what layers read of a node: label, type, title and texts."""
    return F.sha2(F.concat_ws("\x1f", "label_id", "node_type", F.coalesce("title", F.lit("")), "text", F.coalesce("tagged_text", F.lit(""))), 256)


def run_versions(name: str, nodes: DataFrame, **options) -> DataFrame:
    """A layer over many versions (column version): own-text layers over distinct nodes only."""
    f, own = LAYERS[name]
    if not own:
        return f(nodes.withColumn("_of", F.col("tree").cast("string")).withColumn("tree", F.concat_ws("@", F.col("tree").cast("string"), F.col("version").cast("string"))), **options)
    hashed = nodes.withColumn("node_hash", node_hash())
    once = hashed.dropDuplicates(["node_hash"]).drop("tree").withColumn("tree", F.col("node_hash"))
    found = f(once, **options).withColumnRenamed("tree", "node_hash").drop("label_id")
    return hashed.select("version", "tree", "label_id", "node_hash").join(found, "node_hash").drop("node_hash")


@layer("external-citations", own_text=True)
def external_citations(nodes: DataFrame, title: str | None = None, part: str | None = None, act: list[str] | None = None) -> DataFrame:
    def find(text):
        for c in C.external(text or "", title, part, act):
            yield from ((" ".join(c["citation"]), c["citation_type"], a, b) for a, b in c["offsets"])

    return flat_map(nodes, ["tree", "label_id"], ["text"], find, "citation string, citation_type string, start int, stop int")


@layer("internal-citations")
def internal_citations(nodes: DataFrame, title: str | None = None) -> DataFrame:
    """Citations of labels that exist in the tree, without surrounding spaces."""

    def find(text, label, kind):
        for c in C.internal(text or "", C.Label.from_node(list(label), kind), title=title):
            raw = text[c.start : c.end]
            a, b = c.start + len(raw) - len(raw.lstrip()), c.end - len(raw) + len(raw.rstrip())
            yield a, b, "-".join(c.label.parts())

    # A table may be one file with one row group, which would be one task; reading a text costs more than moving it.
    spread = nodes.select("tree", "label_id", "text", "label", "node_type").repartition(4 * nodes.sparkSession.sparkContext.defaultParallelism)
    found = flat_map(spread, ["tree", "label_id"], ["text", "label", "node_type"], find, "start int, stop int, cited string")
    return known_targets(found, nodes, "cited").select("tree", "label_id", "start", "stop", "cited")


@layer("toc")
def toc(nodes: DataFrame) -> DataFrame:
    """Entries of each node's children (by place in the tree), where all of them are titled: tree, label_id, toc_pos, index, title.
    An empty part (sections without subparts) is no entry; what it holds is also listed by the node above it."""
    above = F.slice("path", 1, F.size("path") - 1)
    slim = nodes.select("tree", "path", "label_id", F.element_at("label", -1).alias("index"), "title", (F.col("node_type") == "emptypart").alias("empty"))
    held = slim.where("size(path) > 1 and not empty").select("tree", F.col("path").alias("at"), above.alias("path"), "index", "title")
    direct = held.join(slim.select("tree", "path", "label_id", "empty"), ["tree", "path"])
    lifted = direct.where("empty").select("tree", "at", above.alias("path"), "index", "title").join(slim.select("tree", "path", "label_id"), ["tree", "path"])
    entries = direct.select("tree", "label_id", "at", "index", "title").unionByName(lifted.select("tree", "label_id", "at", "index", "title"))
    whole = entries.groupBy("tree", "label_id").agg(F.bool_and(F.col("title").isNotNull()).alias("ok")).where("ok").select("tree", "label_id")
    return numbered(entries.join(whole, ["tree", "label_id"]), ["tree", "label_id"], ["at"], "toc_pos").select("tree", "label_id", "toc_pos", "index", "title")


@layer("paragraph-markers", own_text=True)
def paragraph_markers(nodes: DataFrame) -> DataFrame:
    last = F.element_at("label", -1)
    dotted = (F.array_contains("label", "Interp")) | ((F.col("node_type") == "appendix") & F.startswith(F.trim("text"), F.concat(last, F.lit("."))))
    marker = F.when(dotted, F.concat(last, F.lit("."))).otherwise(F.concat(F.lit("("), last, F.lit(")")))
    return nodes.withColumn("marker", marker).where(F.startswith(F.trim("text"), F.col("marker"))).select("tree", "label_id", "marker", F.lit(0).alias("location"))


@layer("keyterms", own_text=True)
def keyterms(nodes: DataFrame) -> DataFrame:
    """An emphasised phrase right after the paragraph's marker; `See` at its end is not part of it."""
    tagged = F.regexp_replace(F.coalesce("tagged_text", F.lit("")), r"^\s*(?:\([^)]*\)|\w+\.)?\s*", "")
    term = F.regexp_replace(F.trim(F.regexp_extract(tagged, '^<E T="03">([^<]*)</E>', 1)), r"\.?\s+See(?: also)?$", ".")
    return nodes.withColumn("keyterm", term).where("keyterm <> ''").select("tree", "label_id", "keyterm")


#: Periods that end no sentence: of an abbreviation, within a number.
_ABBREVIATED = re.compile(r"\bU\.S\.(?:C\.)?|\b\d+\.\d+|\be\.g\.|\bi\.e\.")


def guessed_keyterm(text: str | None, node_type: str = "regtext") -> str | None:
    """The key term of a paragraph without emphasis: its first sentence after the marker, if more follows it and it is short
    and no citation; or the whole text, if that ends with a dash. Appendices have none."""
    body = re.sub(r"^\s*(?:\([^)]*\)|\w+\.)?\s*", "", text or "")
    if not body or node_type == "appendix":
        return None
    spared = [m.span() for m in _ABBREVIATED.finditer(body)] + [(c.start, c.end) for c in C.internal(body, C.Label())]
    ends = [m.start() for m in re.finditer(r"\.(?!,)", body) if not any(a <= m.start() <= b for a, b in spared)]
    if not ends:
        return body if body.endswith("—") and len(body.split()) <= 12 else None
    first = body[: ends[0] + 1]
    return first if len(first.split()) <= 12 and (len(ends) > 1 or body[ends[0] + 1 :].strip()) and first.count("(") == first.count(")") else None


@layer("guessed-keyterms", own_text=True)
def guessed_keyterms(nodes: DataFrame) -> DataFrame:
    """Key terms, guessed where the source has none marked (plain-text regulations)."""
    marked = keyterms(nodes)
    rest = nodes.join(marked.select("tree", "label_id"), ["tree", "label_id"], "left_anti")
    guessed = flat_map(rest, ["tree", "label_id"], ["text", "node_type"], lambda t, k: [(g,) for g in [guessed_keyterm(t, k)] if g], "keyterm string")
    return marked.unionByName(guessed)


@layer("formatting", own_text=True)
def formatting(nodes: DataFrame) -> DataFrame:
    """Subscripts, dashes and fences: kind, found (as written), n occurrences."""
    # (?U): letters of all alphabets; (?d): lines end at \n alone
    parts = [("subscript", r"(?U)([a-zA-Z0-9]+)_\{(\w+)\}"), ("dash", r"[^_\n]*_{5,}"), ("fence", r"(?s)```[^\n]*\n.*?\n```"), ("table", r"(?dm)^\|.*\|$")]
    of = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("found"))
    found = F.concat(*[F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), of(kind)) for kind, pattern in parts])
    return nodes.select("tree", "label_id", F.explode(found).alias("f")).groupBy("tree", "label_id", "f.kind", "f.found").agg(F.count(F.lit(1)).alias("n"))


@layer("graphics", own_text=True)
def graphics(nodes: DataFrame, template: str = "https://images.invalid/%s.gif", overrides: DataFrame | None = None, present: DataFrame | None = None) -> DataFrame:
    """Pictures with their addresses. overrides: (gid, url). present: (url) of files that are known to be there; a picture
    whose thumbnail (name.thumb.ext) is among them gets a thumb_url."""
    pattern = F.lit(r"!\[([^\]]*)\]\(([^)]*)\)")
    found = nodes.select("tree", "label_id", F.explode(F.arrays_zip(F.regexp_extract_all("text", pattern, 1).alias("alt"), F.regexp_extract_all("text", pattern, 2).alias("gid"))).alias("g")).select("tree", "label_id", "g.alt", "g.gid")
    counted = found.groupBy("tree", "label_id", "alt", "gid").agg(F.count(F.lit(1)).alias("n"))
    url = F.format_string(template, "gid")
    if overrides is None:
        out = counted.withColumn("url", url)
    else:
        out = counted.join(overrides.select("gid", F.col("url").alias("_url")), "gid", "left").withColumn("url", F.coalesce("_url", url)).drop("_url")
    if present is None:
        return out
    thumbs = present.select(F.col("url").alias("_thumb")).distinct()
    wanted = out.withColumn("_thumb", F.regexp_replace("url", r"\.(png|gif|jpg)$", r".thumb.$1"))
    return wanted.join(thumbs.withColumn("_there", F.lit(True)), "_thumb", "left").withColumn("thumb_url", F.when(F.col("_there"), F.col("_thumb"))).drop("_thumb", "_there")


@layer("interpretations")
def interpretations(nodes: DataFrame) -> DataFrame:
    """Interpretations of each node, leaving out empty ones that only hold other interpretations."""
    interp = nodes.where("element_at(label, -1) = 'Interp'")
    parents = nodes.where("element_at(label, -1) <> 'Interp' and size(label) > 1").select("tree", F.expr("array_join(slice(label, 1, size(label) - 1), '-')").alias("label_id")).distinct().withColumn("_full", F.lit(True))
    filled = interp.join(parents, ["tree", "label_id"], "left").where("trim(text) <> '' or _full")
    return filled.select("tree", F.expr("array_join(slice(label, 1, size(label) - 1), '-')").alias("label_id"), F.col("label_id").alias("reference")).distinct()


@layer("meta")
def meta(nodes: DataFrame, effective_on: str | None = None, title: str | None = None, extra: dict | None = None, versions: DataFrame | None = None) -> DataFrame:
    """Of each root: its number, name and letter, the effective date, and configured fields.

    versions (see notices.version_table): the effective date is that of the root's own version, null where that has none."""
    root = nodes.where("size(label) = 1")
    effective = F.lit(effective_on)
    if versions is not None:
        root = root.join(small(versions.select(F.col("tree").cast("string").alias("_of"), "version", F.col("effective_on").cast("string").alias("_effective"))), ["_of", "version"], "left")
        effective = F.col("_effective")
    name = F.trim(F.regexp_replace(F.regexp_extract("title", r"^[^—-]*[—-]?\s*(.*?)(?:\s*\(|$)", 1), r"\s+", " "))
    fields = [F.lit(v).alias(k) for k, v in (extra or {}).items()]
    return root.select("tree", "label_id", F.lit(title).alias("cfr_title_number"), name.alias("statutory_name"), F.regexp_extract("title", r"\(REGULATION (\w+)\)", 1).alias("reg_letter"), effective.alias("effective_date"), *fields)


@layer("analyses")
def analyses(nodes: DataFrame, sxs: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """References to analyses of a label: sxs (doc_number, publication_date, fr_volume, fr_page, labels, body). By date, then number.

    versions (see notices.version_table; sxs then has effective_on too): a version's nodes have the analyses of the notices that
    apply to it, none of later ones. Rows meet by label and are then compared in time, so versions and notices are not paired."""
    refs = sxs.where("body <> ''").withColumn("label_id", F.explode("labels"))
    if versions is None:
        refs = refs.join(nodes.select("tree", "label_id"), "label_id")
    else:
        dated = versions.select(F.col("tree").cast("string").alias("_of"), "version", notice_struct("version").alias("_v"))
        at = nodes.select("tree", "_of", "version", "label_id").join(small(dated), ["_of", "version"])
        refs = refs.withColumn("_n", notice_struct("doc_number")).join(at, "label_id").where(applies("_n", "_v"))
    w = W.partitionBy("tree", "label_id").orderBy("publication_date", "doc_number")
    return refs.select("tree", "label_id", F.row_number().over(w).alias("ref_no"), F.col("doc_number").alias("reference"), "publication_date", "fr_volume", "fr_page")


@layer("terms")
def terms(nodes: DataFrame, include: dict[str, list[tuple[str, str]]] | None = None, ignore: dict[str, list[str]] | None = None) -> DataFrame:
    """Uses of defined terms: tree, label_id, term, definition (label), start, stop.

    Definitions are found paragraph by paragraph with the texts above them; each holds for the scope that the paragraph
    or the nearest one above it names, else for the whole tree. Scopes are joined on label prefixes; one automaton for all terms
    of a node's scopes (the nearest definition of each) reads its text, longest term first. Terms are not linked where they are defined.

    include: of a part (or ALL), phrases that are terms though no paragraph says so, with the label that explains them.
    ignore: of a part (or ALL), phrases in which no term is seen. Both are settings, small enough to send along.
    """
    include, ignore = include or {}, ignore or {}
    slim = nodes.select("tree", "path", "label", "label_id", "title", "text", F.coalesce("tagged_text", F.lit("")).alias("tagged_text"), "node_type")
    up = with_prefixes(slim.where("node_type in ('regtext', 'subpart', 'emptypart')")).drop("ancestor_depth")
    texts = slim.select("tree", F.col("label_id").alias("ancestor_id"), F.concat_ws("\n", "title", "text").alias("_t"), F.size("label").alias("_d"))
    above = up.join(texts, ["tree", "ancestor_id"]).groupBy("tree", "path", "label", "label_id", "text", "tagged_text").agg(F.array_sort(F.collect_list(F.struct("_d", "_t"))).alias("above"))

    # Sections by the subpart that they stand in: a definition may hold for all of them.
    inside = slim.where("node_type = 'subpart'").select("tree", F.col("path").alias("_sub"))
    sections = slim.where("size(label) = 2 and node_type = 'regtext'").withColumn("_sub", F.expr("slice(path, 1, size(path) - 1)")).join(inside, ["tree", "_sub"])
    mates = sections.groupBy("tree", "_sub").agg(F.array_sort(F.collect_set("label_id")).alias("mates"))
    of_section = sections.select("tree", F.col("label_id").alias("_section"), "_sub").join(mates, ["tree", "_sub"]).drop("_sub")
    above = above.withColumn("_section", F.expr("array_join(slice(label, 1, 2), '-')")).join(of_section, ["tree", "_section"], "left")

    def find(label, text, tagged, chain, mates):
        lines = [c["_t"] or "" for c in chain]
        included, _ = T.definitions(text or "", "-".join(label), lines[:-1], tagged)
        if included:
            scopes: list = []
            for i in range(len(lines), 0, -1):
                scopes = T.scopes(lines[i - 1], list(label)[: max(1, len(label) - (len(lines) - i))], [m.split("-") for m in mates or ()])
                if scopes:
                    break
            scopes = scopes or [list(label)[:1], [*list(label)[:1], "Interp"]]
            for r in included:
                yield from (("-".join(s), r.term, r.label, r.start, r.end) for s in scopes)

    defined = flat_map(above, ["tree"], ["label", "text", "tagged_text", "above", "mates"], find, "scope_id string, term string, definition string, start int, stop int")
    named = [(part, phrase.lower(), label) for part, phrases in include.items() for phrase, label in phrases]
    if named:
        roots = slim.where("size(label) = 1").select("tree", "label_id")
        listed = slim.sparkSession.createDataFrame(named, "part string, term string, definition string")
        extra = roots.join(F.broadcast(listed), (F.col("part") == F.col("label_id")) | (F.col("part") == "ALL")).select("tree", F.col("label_id").alias("scope_id"), "term", "definition", F.lit(0).alias("start"), F.lit(0).alias("stop"))
        defined = defined.unionByName(extra)
    # Nodes of a tree that stand under the same scopes have the same terms: their chain of scopes is their key. Terms are gathered
    # once for each chain, the nearest definition of each, and meet the chain's nodes in cells of bounded size.
    scoped = defined.groupBy("tree", "scope_id", "term").agg(F.max("definition").alias("definition"))
    under = with_prefixes(slim.select("tree", "label", "label_id"), name="scope_id").join(scoped.select("tree", "scope_id").distinct(), ["tree", "scope_id"])
    chains = under.groupBy("tree", "label_id").agg(F.array_sort(F.collect_set(F.struct("ancestor_depth", "scope_id"))).alias("chain"))
    sized = chains.groupBy("tree", "chain").agg(F.count(F.lit(1)).alias("n")).select("tree", "chain", F.ceil(F.col("n") / NODES).cast("int").alias("cells"))
    every = sized.select("tree", "chain", F.explode("chain").alias("s")).select("tree", "chain", "s.*").join(scoped, ["tree", "scope_id"])
    nearest = every.groupBy("tree", "chain", "term").agg(F.max_by("definition", "ancestor_depth").alias("definition"))
    listed = nearest.groupBy("tree", "chain").agg(F.array_sort(F.collect_list(F.struct("term", "definition"))).alias("ts"))
    key = lambda df: df.withColumn("chain", F.to_json("chain"))
    sent = key(listed.join(sized, ["tree", "chain"]).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells"))
    asked = key(slim.select("tree", "label_id", "text").join(chains, ["tree", "label_id"]).join(sized, ["tree", "chain"]).withColumn("cell", F.pmod(F.xxhash64("label_id"), F.col("cells")).cast("int")).drop("cells"))
    kind = nodes.schema["tree"].dataType.simpleString()

    def match(left, right):
        import pandas as pd

        out = []
        if len(left) and len(right):
            ts = [(t["term"], t["definition"]) for t in right["ts"].iloc[0]]
            scanner, of = T.Scanner(ts), {}
            for term, definition in ts:
                of.setdefault(definition, []).append(term)
            for tree, label_id, text in left[["tree", "label_id", "text"]].itertuples(index=False, name=None):
                text = text or ""
                spared = [p for k in ("ALL", label_id.split("-")[0]) for p in ignore.get(k, ())]
                own = [m.span() for p in spared for m in re.finditer(rf"(?i)\b{re.escape(p)}\b", text)]
                own += [m.span() for t in of.get(label_id, ()) for m in [re.search(rf"(?i)\b{re.escape(t)}\b", text)] if m]
                out += [(tree, label_id, *u) for u in scanner.uses(text, own, label_id)]
        return pd.DataFrame(out, columns=["tree", "label_id", "term", "definition", "start", "stop"])

    by = ["tree", "chain", "cell"]
    sent = sent.select(*[F.col(c).alias(f"_{c}") for c in by], "ts")
    return asked.groupBy(*by).cogroup(sent.groupBy(*[f"_{c}" for c in by])).applyInPandas(match, f"tree {kind}, label_id string, term string, definition string, start int, stop int")


@layer("model-form-text", own_text=True)
def model_form_text(nodes: DataFrame) -> DataFrame:
    """First and last words of model forms: paragraphs under appendix sections whose title says so."""
    forms = nodes.where("node_type = 'appendix' and (title like '%Model Form%' or title like '%Model Clause%')")
    words = F.split(F.trim("text"), r"\s+")
    return forms.where("trim(text) <> ''").select("tree", "label_id", F.element_at(words, 1).alias("start_word"), F.element_at(words, -1).alias("end_word"))
