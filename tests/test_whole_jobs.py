import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lexstrata.functions import depth as D
from lexstrata.functions import terms as T
from lexstrata.plans import catalog


def test_terms_in_every_language(spark, sf_dir):
    """terms_longest_first over all documents, against the kernel without its word index."""
    listed = sorted({w.lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for w in re.findall("[A-Za-z]{10,}", r["text"] or "")})
    heads = re.compile("|".join(sorted({re.escape(f.lower()) for t in listed for f in (t, T.plural(t))})))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    want, langs = [], set()
    for r in docs:
        if heads.search((r["text"] or "").lower()):  # no use without one of the terms in the text
            found = T.uses(r["text"], [(t, t) for t in listed])
            want += [(r["doc_id"], t, a, b) for t, _, a, b in found]
            langs |= {r["lang"]} if found else set()
    assert langs - {"en"}
    got = catalog.QUERIES["terms_longest_first"](spark, sf_dir).select("doc_id", "term", "start", "stop").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_depths_of_whole_sequences(spark, tmp_path):
    """Markers a 1 i A B ii 2 b c, drawn from eight orders: none behind the sixth is left out."""
    keys = [1, 2, 3, 7, 16, 25, 34, 48]
    spark.createDataFrame([(k, 5) for k in keys], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    rows = catalog.QUERIES["depth_solver"](spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["marker"], r["depth"]) for r in rows] == [("a", 0), ("1", 1), ("i", 2), ("A", 3), ("B", 3), ("ii", 2), ("2", 1), ("b", 0), ("c", 0)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "1", "i", "A", "b", "2", "ii", "B", "c", "STARS", "* * *"]), min_size=1, max_size=8), st.sampled_from([None, D.REGTEXT_ORDER, D.INTERP_ORDER]))
def test_depths_are_the_best(markers, order):
    """The search on the weight, against the enumeration of all solutions."""
    solutions = D.solve(markers, order)
    assert D.depths(markers, order) == ([p.depth for p in max(solutions, key=D.weight)] if solutions else None)
