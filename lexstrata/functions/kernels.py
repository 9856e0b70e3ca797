"""The kernels as DataFrame operators: Arrow batches in, rows out."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import amendments as A
from . import citations as C
from . import depth as D
from . import terms as T
from . import textdiff as X
from .arrow import flat_map


def text_diffs(pairs: DataFrame, keys: list[str], old: str, new: str) -> DataFrame:
    """op, start, stop (null for insertions), text (null for deletions) of every difference, numbered by op_no."""

    def run(a, b):
        for i, op in enumerate(X.flat(X.opcodes(a or "", b or ""))):
            yield (i, "insert", op[1], None, op[2]) if op[0] == "insert" else (i, "delete", op[1], op[2], None)

    return flat_map(pairs, keys, [old, new], run, "op_no int, op string, start int, stop int, text string")


def depths(rows: DataFrame, key: str, markers: str = "markers", order=None) -> DataFrame:
    """pos, marker, depth of every marker of a sequence; nothing for sequences without a solution."""

    def run(ms):
        kept = D.without_trailing_stars(ms or [])
        yield from ((i, m, d) for i, (m, d) in enumerate(zip(kept, D.depths(kept, order) or [], strict=False)))

    return flat_map(rows, [key], [markers], run, "pos int, marker string, depth int")


def amendments(rows: DataFrame, key: str, sentence: str) -> DataFrame:
    """seq, action, label_id, field, destination of every amendment of a sentence."""

    def run(text):
        for i, a in enumerate(A.parse(text or "")[0]):
            yield i, a.action, a.label_id, a.field, "-".join(a.destination) if a.destination else None

    return flat_map(rows, [key], [sentence], run, "seq int, action string, label_id string, field string, destination string")


def amendment_sequence(rows: DataFrame, group: str, order: str, sentence: str) -> DataFrame:
    """Amendments of instructions that carry their context on, in order within a group (a notice's section): group, order, seq, action, label_id, field."""
    kind, okind = rows.schema[group].dataType.simpleString(), rows.schema[order].dataType.simpleString()

    def run(pdf):
        import pandas as pd

        ctx, out = (), []
        for g, o, text in pdf.sort_values(order)[[group, order, sentence]].itertuples(index=False):
            found, ctx = A.parse(text or "", ctx)
            out += [(g, o, i, a.action, a.label_id, a.field) for i, a in enumerate(found)]
        return pd.DataFrame(out, columns=[group, order, "seq", "action", "label_id", "field"])

    return rows.groupBy(group).applyInPandas(run, f"{group} {kind}, {order} {okind}, seq int, action string, label_id string, field string")


def citations(rows: DataFrame, key: str, text: str, label: str, node_type: str = "regtext") -> DataFrame:
    """start, stop, cited (label id) of every citation in a node's text."""

    def run(t, lab):
        for c in C.internal(t or "", C.Label.from_node(list(lab or []), node_type)):
            yield c.start, c.end, "-".join(c.label.parts())

    return flat_map(rows, [key], [text, label], run, "start int, stop int, cited string")


def external_citations(rows: DataFrame, key: str, text: str, **options) -> DataFrame:
    def run(t):
        for c in C.external(t or "", **options):
            yield from ((" ".join(c["citation"]), c["citation_type"], a, b) for a, b in c["offsets"])

    return flat_map(rows, [key], [text], run, "citation string, citation_type string, start int, stop int")


#: Terms that are broadcast to executors at once; of more, each text gets its own by a join, or they are sent in several rounds.
MOST_TERMS = 200_000


def _heads(term: str) -> set[str]:
    """First words of a term and of its plural: a text that uses the term has one of them."""
    return {(re.findall(r"\w+", form.lower()) or [""])[0] for form in (term, T.plural(term))}


def term_uses(rows: DataFrame, terms: DataFrame, key: str, text: str = "text") -> DataFrame:
    """term, start, stop of every use of the terms, longer ones first, apart. Each text is matched only with the terms whose
    first word it has: by a broadcast index of words, or for many terms by a join on words."""
    listed = terms.select("term").limit(MOST_TERMS + 1).toArrow()[0].to_pylist()
    schema = "term string, start int, stop int"
    if len(listed) <= MOST_TERMS:
        by_word: dict[str, list[str]] = {}
        for t in sorted(listed):
            for head in _heads(t):
                by_word.setdefault(head, []).append(t)
        index = rows.sparkSession.sparkContext.broadcast(by_word)

        def run(t):
            here = {x for w in set(re.findall(r"\w+", (t or "").lower())) for x in index.value.get(w, ())}
            yield from ((term, a, b) for term, _, a, b in T.uses(t or "", [(x, x) for x in sorted(here)]))

        return flat_map(rows, [key], [text], run, schema)
    heads = flat_map(terms.select("term").distinct(), ["term"], ["term"], lambda t: [(h,) for h in sorted(_heads(t))], "word string")
    texts = rows.select(key, text, F.xxhash64(text).alias("_h"))
    words = flat_map(texts, [key, "_h"], [text], lambda t: [(w,) for w in sorted(set(re.findall(r"\w+", (t or "").lower())))], "word string")
    own = words.distinct().join(heads, "word").groupBy(key, "_h").agg(F.collect_set("term").alias("_terms"))

    def match(t, here):
        yield from ((term, a, b) for term, _, a, b in T.uses(t or "", [(x, x) for x in sorted(here)]))

    return flat_map(texts.join(own, [key, "_h"]), [key], [text, "_terms"], match, schema)


def _window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(out) + i]
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def first_occurrences(rows: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", anchor: int = 12) -> DataFrame:
    """term_id, start of the first occurrence of each term in each text.

    The hash of every window of `anchor` characters of a text is looked up among the terms' first ones (shorter terms have
    windows of their own lengths), so the cost of a text does not grow with the number of terms. More than MOST_TERMS are
    sent in rounds, by hash."""
    kind = terms.schema["term_id"].dataType.simpleString()
    terms = terms.where("term <> ''").select("term_id", "term")
    rounds = max(1, -(-terms.count() // MOST_TERMS))
    out = None
    for i in range(rounds):
        part = terms.where(F.pmod(F.xxhash64("term_id", "term"), F.lit(rounds)) == i) if rounds > 1 else terms
        found: dict[int, dict[int, list[tuple]]] = {}
        for row in part.toArrow().to_pylist():
            n = min(anchor, len(row["term"]))
            h = int(_window_hashes(_codes(row["term"][:n]), n)[0])
            found.setdefault(n, {}).setdefault(h, []).append((row["term_id"], row["term"]))
        index = rows.sparkSession.sparkContext.broadcast([(n, np.array(sorted(hs), np.uint64), hs) for n, hs in found.items()])

        def run(t, index=index):
            t = t or ""
            codes = _codes(t)
            for n, hashes, items in index.value:
                if len(codes) < n:
                    continue
                seen, at = set(), _window_hashes(codes, n)
                place = np.minimum(np.searchsorted(hashes, at), len(hashes) - 1)
                for start in np.flatnonzero(hashes[place] == at).tolist():
                    for number, (term_id, term) in enumerate(items[int(at[start])]):
                        if (int(at[start]), number) not in seen and t.startswith(term, start):
                            seen.add((int(at[start]), number))
                            yield term_id, start

        one = flat_map(rows, [key], [text], run, f"term_id {kind}, start int")
        out = one if out is None else out.unionByName(one)
    return out


def register(spark) -> None:
    """The kernels as SQL table functions, for use with LATERAL: internal_citations(text, label), amendments(text), tokens(text)."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="start_ int, stop_ int, cited string")
    class InternalCitations:
        def eval(self, text: str, label: str):
            for c in C.internal(text or "", C.Label.from_node((label or "").split("-"), "regtext")):
                yield c.start, c.end, "-".join(c.label.parts())

    @udtf(returnType="seq int, action string, label_id string, field string")
    class Amendments:
        def eval(self, text: str):
            for i, a in enumerate(A.parse(text or "")[0]):
                yield i, a.action, a.label_id, a.field

    spark.udtf.register("internal_citations", InternalCitations)
    spark.udtf.register("amendments", Amendments)
    spark.udf.register("marker_depths", F.udf(lambda ms: D.depths(list(ms or [])), "array<int>"))
