"""Writers: node tables, layers, notices and differences as partitioned tables, JSON documents, Markdown or XML."""

from __future__ import annotations

from html import escape

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.model import Node, from_rows, to_json

FORMATS = ("parquet", "orc", "json")


class Sink:
    """Tables under one root, by the layout regulation/, layer/<name>/, notice/, diff/; each is partitioned by what it is looked up by."""

    def __init__(self, root: str, fmt: str = "parquet"):
        if fmt not in FORMATS:
            raise ValueError(f"unknown format {fmt!r}: one of {', '.join(FORMATS)}")
        self.root, self.fmt = root.rstrip("/"), fmt

    def _write(self, df: DataFrame, path: str, *by: str) -> str:
        df.write.format(self.fmt).mode("overwrite").partitionBy(*by).save(f"{self.root}/{path}")
        return f"{self.root}/{path}"

    def regulation(self, nodes: DataFrame) -> str:
        return self._write(nodes, "regulation", "reg", "version")

    def history(self, bodies: DataFrame, places: DataFrame, numbers: DataFrame) -> str:
        """A history by content (see plans.history): bodies under body/, added to those that are there; places and the versions' numbers
        under place/ and version/, which are small beside them and written anew. What is written grows with the changes."""
        path = f"{self.root}/body"
        try:
            bodies = bodies.join(self.read(bodies.sparkSession, "body").select("node_hash"), "node_hash", "left_anti")
        except AnalysisException:  # nothing there yet
            pass
        bodies.write.format(self.fmt).mode("append").save(path)
        self._write(numbers.withColumn("reg", F.col("tree")), "version", "reg")
        return self._write(places.withColumn("reg", F.col("tree")), "place", "reg")

    def layer(self, name: str, elements: DataFrame) -> str:
        return self._write(elements, f"layer/{name}", "version")

    def notices(self, rows: DataFrame) -> str:
        """Without what only building needs (meta)."""
        return self._write(rows.drop("meta"), "notice", "cfr_part")

    def diffs(self, rows: DataFrame) -> str:
        return self._write(rows, "diff", "lhs", "rhs")

    def read(self, spark, path: str) -> DataFrame:
        return spark.read.format(self.fmt).load(f"{self.root}/{path}")


def tree_documents(nodes: DataFrame, keys: list[str], form: str = "json") -> DataFrame:
    """A document for each tree (keys): sorted JSON, Markdown, or XML. One tree is one task's work; trees are many."""
    render = {"json": to_json, "markdown": to_markdown, "xml": to_xml}[form]
    kinds = ", ".join(f"{k} {nodes.schema[k].dataType.simpleString()}" for k in keys)

    def build(pdf):
        import pandas as pd

        rows = pdf[["path", "label", "label_id", "node_type", "title", "text", "tagged_text"]].itertuples(index=False, name=None)
        root = from_rows([(list(r[0]), list(r[1]), *r[2:]) for r in rows])
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), render(root) if root else ""]], columns=[*keys, "document"])

    return nodes.groupBy(*keys).applyInPandas(build, f"{kinds}, document string")


def version_files(nodes: DataFrame) -> DataFrame:
    """A file for every node of every version, as a repository would hold it: (reg, version, path, content). A node's folder
    is its label, those of interpretations and subparts apart."""
    folder = F.array_join(F.col("label"), "/")
    front = F.concat(F.lit("---\nlabel: "), "label_id", F.lit("\ntype: "), "node_type", F.lit("\n---\n"))
    content = F.concat(front, F.coalesce(F.concat(F.lit("# "), "title", F.lit("\n\n")), F.lit("")), F.trim("text"), F.lit("\n"))
    number = ["version_no"] if "version_no" in nodes.columns else []
    return nodes.select("reg", "version", *number, F.concat(F.lit("regulation/"), folder, F.lit("/index.md")).alias("path"), content.alias("content"))


def commit_versions(files: DataFrame, repository: str, messages: dict[str, str] | None = None) -> int:
    """Writes one regulation's versions into a git repository, a commit for each version in order; returns their number.

    Rows are streamed in order, a partition at a time, into `git fast-import`, so the driver holds one file at a time. For
    many regulations, call it for each; tables are the way to write all of them at once."""
    import subprocess

    subprocess.run(["git", "init", "-q", repository], check=True)
    feed = subprocess.Popen(["git", "-C", repository, "fast-import", "--quiet", "--force"], stdin=subprocess.PIPE)
    data = lambda b: feed.stdin.write(b"data %d\n%s\n" % (len(b), b))
    seen: list[str] = []
    for r in files.orderBy("version_no" if "version_no" in files.columns else "version", "path").toLocalIterator():
        if not seen or seen[-1] != r["version"]:
            seen.append(r["version"])
            feed.stdin.write(f"commit refs/heads/main\ncommitter writer <writer@localhost> {len(seen)} +0000\n".encode())
            data(((messages or {}).get(r["version"]) or f"Version {r['version'] or 'first'}").encode())
            feed.stdin.write(b"deleteall\n")
        feed.stdin.write(f"M 100644 inline {r['path']}\n".encode())
        data(r["content"].encode())
    feed.stdin.close()
    if feed.wait():
        raise RuntimeError("git fast-import failed")
    return len(seen)


def post_documents(documents: DataFrame, base: str, path: str = "path", body: str = "document", tries: int = 3) -> DataFrame:
    """POSTs every document to base/path from the executors; (path, status) of each. Tasks may be run again, so what
    receives them has to take a document twice."""
    from ..functions.arrow import flat_map

    def send(where, what):
        import time
        import urllib.error
        import urllib.request

        request = urllib.request.Request(f"{base.rstrip('/')}/{where.lstrip('/')}", (what or "").encode(), {"Content-Type": "application/json"}, method="POST")
        for i in range(tries):
            try:
                with urllib.request.urlopen(request, timeout=30) as answer:
                    yield (answer.status,)
                    return
            except urllib.error.HTTPError as e:
                if e.code < 500 or i + 1 == tries:
                    yield (e.code,)
                    return
            except urllib.error.URLError:
                if i + 1 == tries:
                    raise
            time.sleep(0.2 * 2**i)

    return flat_map(documents.withColumn("_p", F.col(path)), [path], ["_p", body], send, "status int")


def to_markdown(root: Node) -> str:
    """Front matter with label, type and title; then text and children."""
    out, stack = [], [(root, 1)]
    while stack:
        n, depth = stack.pop()
        out.append(f"{'#' * min(depth, 6)} {n.title or n.label_id}\n\n<!-- label: {n.label_id}; type: {n.node_type} -->\n\n{n.text.strip()}".rstrip() + "\n")
        stack += [(c, depth + 1) for c in reversed(n.children)]
    return "\n".join(out)


def tag_of(n: Node) -> str:
    if n.node_type == "subpart" or n.node_type == "emptypart":
        return "subpart"
    if n.node_type == "appendix":
        return "appendix" if len(n.label) == 2 else "appendixSection" if n.title else "paragraph"
    if n.node_type == "interp":
        return "interpretations" if len(n.label) == 2 else "interpSection" if n.label[-1] == "Interp" and len(n.label) == 3 else "interpParagraph"
    return "part" if len(n.label) == 1 else "section" if len(n.label) == 2 else "paragraph"


def to_xml(root: Node) -> str:
    """Nested elements by node type and place; text is spliced in escaped."""
    out: list[str] = []
    stack: list[tuple[Node | None, str]] = [(root, "")]
    while stack:
        n, closing = stack.pop()
        if n is None:
            out.append(closing)
            continue
        tag = tag_of(n)
        out.append(f'<{tag} label="{escape(n.label_id)}">' + (f"<title>{escape(n.title)}</title>" if n.title else "") + (f"<content>{escape(n.text)}</content>" if n.text.strip() else ""))
        stack += [(None, f"</{tag}>"), *[(c, "") for c in reversed(n.children)]]
    return "".join(out)


def annotate(nodes: DataFrame, spans: DataFrame) -> DataFrame:
    """Text with replacements at spans (tree, label_id, start, end, value) of all layers. Tables (texts with pipe rows) stay as they are."""
    from ..operators.text import splice

    grouped = spans.groupBy("tree", "label_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "value"))).alias("_s"))
    joined = nodes.join(grouped, ["tree", "label_id"], "left")
    plain = F.col("_s").isNull() | F.col("text").rlike(r"(?m)^\|.*\|$")
    return joined.withColumn("text", F.when(plain, F.col("text")).otherwise(splice(F.col("text"), F.col("_s")))).drop("_s")
