"""Command line: build all versions of regulations, list notices in order, follow one node through its versions.

    python -m lexstrata.plans.cli build REGULATION.xml --notices 'NOTICES/*.xml' --dates DATES.csv --out DIR
    python -m lexstrata.plans.cli tree REGULATION.xml --out DIR
    python -m lexstrata.plans.cli layers REGULATION.xml --layer terms --layer toc --out DIR
    python -m lexstrata.plans.cli order NOTICES.json --title 12 --part 1005
    python -m lexstrata.plans.cli watch DIR 1005-2-a
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import layers as L
from ..operators import notices as O
from ..operators.versions import group_by_effective_date, merge_changes
from ..sources import readers, sinks
from ..sources.layer_store import LayerStore
from . import build, history
from .checkpoint import NoStages, Stages
from .settings import layered


#: A notice's line: the tree it changes, its dates, and (for delays and analyses) its type, volume, pages and text on dates.
DATES = "document_number string, tree string, effective_on string, publication_date string, type string, volume int, start_page int, end_page int, dates string"


def build_command(spark: SparkSession, a: argparse.Namespace) -> None:
    settings = layered(*(a.settings or ()))
    files = readers.with_macros(readers.whole_files(spark, a.regulation), settings["macros"])
    digest = files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256)).first()[0]
    stages = Stages(spark, digest) if a.checkpoint else NoStages()
    nodes = stages.stage("trees", lambda: readers.regulation_trees(files).withColumn("tree", F.element_at("label", 1)))
    listed = spark.read.csv(a.dates, header=True, schema=DATES)
    dates = O.delayed(listed.withColumn("type", F.coalesce("type", F.lit("Rule")))).where("effective_on is not null")
    notices = readers.with_macros(readers.whole_files(spark, a.notices), settings["macros"]).withColumn("document_number", F.regexp_extract("path", r"([^/]+)\.\w+$", 1))
    own = dates.select("document_number", "tree", "effective_on", "publication_date")
    log = stages.stage("changes", lambda: build.notice_changes(notices).join(own, "document_number"))
    if settings["patches"]:
        log = merge_changes(log, build.patch_rows(spark, settings["patches"], log))
    states = stages.stage("states", lambda: history.states(nodes, log))
    numbers = history.all_numbers(nodes, log)
    versions = stages.stage("versions", lambda: history.versions_of(states, numbers))
    sink = sinks.Sink(a.out, a.format)
    if a.by_content:
        sink.history(*history.bodies_and_places(states), numbers)
    sink.regulation(versions.withColumn("reg", F.col("tree")))
    said = build.notice_analyses(notices.join(dates.select("document_number", F.col("tree").alias("part"), "start_page"), "document_number"))
    sxs = said.join(dates, "document_number").select(F.col("document_number").alias("doc_number"), "effective_on", "publication_date", F.col("volume").alias("fr_volume"), "fr_page", "labels", "body")
    for name, rows in build.all_layers(versions, settings=settings, sxs=sxs, versions=numbers, run=LayerStore(spark, a.keep_layers).run if a.keep_layers else L.run_versions).items():
        sink.layer(name, rows if "version" in rows.columns else rows.withColumns({"version": F.substring_index("tree", "@", -1), "tree": F.substring_index("tree", "@", 1)}))
    sink.diffs(build.version_pairs_diff(versions))


def order_command(spark: SparkSession, a: argparse.Namespace) -> None:
    n = readers.notices(spark, a.notices, a.title, a.part)
    group_by_effective_date(n, "effective_on", "publication_date", "document_number", F.col("type") == "Rule").orderBy("effective_on").show(1000, False)


def tree_command(spark: SparkSession, a: argparse.Namespace) -> None:
    """Writes the tree of each regulation (XML, or plain text) as a JSON document."""
    files = readers.whole_files(spark, a.regulation)
    trees = readers.text_trees(files) if a.plain else readers.regulation_trees(files)
    sinks.tree_documents(trees, ["tree"], "json").write.mode("overwrite").json(a.out)


def layers_command(spark: SparkSession, a: argparse.Namespace) -> None:
    """Writes the named layers of regulations."""
    nodes = readers.regulation_trees(readers.whole_files(spark, a.regulation)).withColumn("tree", F.element_at("label", 1))
    for name in a.layer:
        L.run(name, nodes).write.mode("overwrite").json(f"{a.out}/{name}")


def watch_command(spark: SparkSession, a: argparse.Namespace) -> None:
    nodes = sinks.Sink(a.out, a.format).read(spark, "regulation")
    build.history_of(nodes.withColumn("tree", F.col("reg").cast("string")), a.label).orderBy("tree", "version_no").show(1000, False)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(required=True)
    b = sub.add_parser("build")
    b.add_argument("regulation")
    b.add_argument("--notices", required=True)
    b.add_argument("--dates", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--checkpoint", action="store_true")
    b.add_argument("--keep-layers", help="folder of layers that stay between builds: only what is new is computed")
    b.add_argument("--by-content", action="store_true", help="also keep the history by content: each body once, places with the versions they hold in")
    b.set_defaults(run=build_command)
    b.add_argument("--settings", action="append", help="JSON files, later ones over earlier ones")
    t = sub.add_parser("tree")
    t.add_argument("regulation")
    t.add_argument("--out", required=True)
    t.add_argument("--plain", action="store_true")
    t.set_defaults(run=tree_command)
    y = sub.add_parser("layers")
    y.add_argument("regulation")
    y.add_argument("--layer", action="append", required=True)
    y.add_argument("--out", required=True)
    y.set_defaults(run=layers_command)
    o = sub.add_parser("order")
    o.add_argument("notices")
    o.add_argument("--title", type=int)
    o.add_argument("--part", type=int)
    o.set_defaults(run=order_command)
    w = sub.add_parser("watch")
    w.add_argument("out")
    w.add_argument("label")
    w.set_defaults(run=watch_command)
    for x in (b, w):
        x.add_argument("--format", default="parquet", choices=sinks.FORMATS)
    a = p.parse_args(argv)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
