"""The whole build: trees, notices, versions, layers and differences, each stage a table.

Parts of a document that changes do not tie together are replayed apart, as intervals (see history.py); versions are read from
these. Layers and differences are computed for all versions at once, over distinct nodes.
"""

from __future__ import annotations

import itertools
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import notices as N
from ..functions.arrow import flat_map
from ..functions.model import to_rows
from ..operators import layers as L
from . import history as H
from .settings import DEFAULTS

CHANGE_SCHEMA = "seq int, action string, label_id string, field string, destination array<string>, subpart array<string>, node array<struct<path:array<int>,label:array<string>,label_id:string,node_type:string,title:string,text:string,tagged_text:string>>"


def notice_changes(files: DataFrame) -> DataFrame:
    """The change log of notice files (document_number, text): one row a change, with its node's subtree."""

    def find(text):
        seq = itertools.count()
        for c in N.notice_changes(ET.fromstring(text)):
            yield next(seq), c.action, c.label_id, c.field, list(c.destination), list(c.subpart), to_rows(c.node) if c.node else None

    return flat_map(files, ["document_number"], ["text"], find, CHANGE_SCHEMA)


def notice_analyses(files: DataFrame) -> DataFrame:
    """Section-by-section analyses of notice files (document_number, part, start_page, text): document_number, ord, fr_page,
    title, labels, body (its paragraphs; empty where only what is below it says something)."""

    def find(part, page, text):
        held = next((found for e in ET.fromstring(text).iter() for found in [N.analysis_elements(e)] if found), [])
        stack = list(reversed(N.analyses(held, str(part), page or 0)))
        for i in itertools.count():
            if not stack:
                return
            a = stack.pop()
            stack += reversed(a["children"])
            own = [*a["paragraphs"], *(p for c in a["children"] if not c["labels"] for p in [c["title"], *c["paragraphs"]])]
            yield i, a["page"], a["title"], a["labels"], "\n".join(own)

    return flat_map(files, ["document_number"], ["part", "start_page", "text"], find, "ord int, fr_page int, title string, labels array<string>, body string")


def patch_rows(spark: SparkSession, patches: dict[str, list[dict]], changes: DataFrame) -> DataFrame:
    """Patches by hand (of a document's number, changes as tables) as rows of the change log; dates are those of the document."""
    columns = "document_number string, seq int, action string, label_id string, field string, destination array<string>, subpart array<string>, title string, text string, node_type string"
    rows = [(number, 1_000_000 + i, p["action"], p["label_id"], p.get("field"), p.get("destination") or [], p.get("subpart") or [], p.get("title"), p.get("text"), p.get("node_type", "regtext")) for number, ps in patches.items() for i, p in enumerate(ps)]
    made = spark.createDataFrame(rows, columns)
    label = F.split("label_id", "-")
    node = F.array(F.struct(F.array(F.lit(0)).alias("path"), label.alias("label"), "label_id", "node_type", "title", "text", F.lit("").alias("tagged_text")))
    made = made.withColumn("node", F.when(F.col("text").isNotNull(), node).cast(changes.schema["node"].dataType)).drop("title", "text", "node_type")
    own = changes.select("document_number", "tree", "effective_on", "publication_date").distinct()
    return made.join(own, "document_number")


def versions(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """All versions of every tree: the first, and one for each notice that changes it, in order of time.

    nodes: (tree, path, label, label_id, node_type, title, text, tagged_text). changes: (tree, effective_on, publication_date,
    document_number) and the columns of notice_changes. Result: nodes with version (the notice's number; '' is the first) and
    version_no, its place (see notices.version_table). Notices of one day are versions of their own. Parts of a tree that do not
    depend on one another are replayed by different tasks (see history.states).
    """
    return H.versions_of(H.states(nodes, changes), H.all_numbers(nodes, changes))


#: Layers of a build, besides meta and analyses.
NAMES = ("external-citations", "internal-citations", "toc", "paragraph-markers", "keyterms", "formatting", "graphics", "interpretations", "terms")


def layer_options(spark: SparkSession, settings: dict, sxs: DataFrame | None = None, versions: DataFrame | None = None) -> dict[str, dict]:
    """What the settings mean to each layer. title, meta: of regulations; act: (title, section) of the law they rest on; include_terms and
    ignore_terms by part (or ALL); image_overrides by picture, graphics_template for all others."""
    title = settings.get("title")
    overrides = settings.get("image_overrides")
    return {
        "meta": {"title": title, "extra": settings.get("meta"), "versions": versions},
        "analyses": {"sxs": sxs, "versions": versions},
        "external-citations": {"title": title, "act": settings.get("act")},
        "internal-citations": {"title": title},
        "graphics": {"template": settings["graphics_template"] if settings.get("graphics_template") else DEFAULTS["graphics_template"], "overrides": spark.createDataFrame(sorted(overrides.items()), "gid string, url string") if overrides else None},
        "terms": {"include": {k: [tuple(x) for x in v] for k, v in (settings.get("include_terms") or {}).items()}, "ignore": settings.get("ignore_terms")},
    }


def all_layers(nodes: DataFrame, names: list[str] | None = None, settings: dict | None = None, sxs: DataFrame | None = None, versions: DataFrame | None = None, run=L.run_versions) -> dict[str, DataFrame]:
    """Layers of all versions, by name, with the settings that concern them. analyses are there if sxs (the notices' section-by-section
    rows, see layers.analyses) is given. versions (see notices.version_table) says when each version takes effect: meta shows it,
    and a version has the analyses of notices up to it. run: layers.run_versions, or that of a LayerStore, which keeps what it computes."""
    options = layer_options(nodes.sparkSession, settings or {}, sxs, versions)
    wanted = ["meta", *(["analyses"] if sxs is not None else []), *(names or NAMES)]
    return {n: run(n, nodes, **options.get(n, {})) for n in wanted}


def version_pairs_diff(nodes: DataFrame) -> DataFrame:
    """Differences of every ordered pair of versions of each tree: tree, lhs, rhs, label_id, op.

    Versions of a label are gathered in one row, so a tree's versions are compared without joining them in pairs.
    """
    body = F.sha2(F.concat_ws("\x1f", F.coalesce("title", F.lit("")), "text"), 256)
    by_label = nodes.groupBy("tree", "label_id").agg(F.map_from_entries(F.collect_list(F.struct("version", body.alias("h")))).alias("m"))
    known = nodes.groupBy("tree").agg(F.array_sort(F.collect_set("version")).alias("vs"))
    pairs = by_label.join(known, "tree").withColumn("lhs", F.explode("vs")).withColumn("rhs", F.explode("vs"))
    a, b = F.expr("try_element_at(m, lhs)"), F.expr("try_element_at(m, rhs)")
    op = F.when(a.isNull() & b.isNotNull(), "added").when(a.isNotNull() & b.isNull(), "deleted").when(a != b, "modified")
    return pairs.withColumn("op", op).where("op is not null").select("tree", "lhs", "rhs", "label_id", "op")


def history_of(nodes: DataFrame, label_id: str) -> DataFrame:
    """One node through all versions."""
    return nodes.where(F.col("label_id") == label_id).select("tree", "version", "version_no", "label_id", "title", "text")
