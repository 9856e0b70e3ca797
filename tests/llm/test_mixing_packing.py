import itertools
import random

import pytest

from lexstrata.llm import mixing as M
from lexstrata.llm import packing as P


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: by source, None last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def test_targets_and_takes(make):
    rnd = random.Random(5)
    docs, n = [], {"a": 900, "b": 20, "c": 700, "d": 60, None: 300}
    for source, count in n.items():
        for _ in range(count):
            docs.append((len(docs), "w " * rnd.randint(0, 60), "en", source))
    df = make(docs)
    rows = {r["doc_id"]: r for r in M.mixed_rows(df).collect()}
    assert len(rows) == len(docs)
    sizes, taken = {}, {}
    for i, text, _, s in docs:
        assert rows[i]["size"] == len(text.split())
        assert 0 <= rows[i]["taken"] <= 3 * rows[i]["size"]
        sizes[s] = sizes.get(s, 0) + rows[i]["size"]
        taken[s] = taken.get(s, 0) + rows[i]["taken"]
    want = brute_targets(sizes)
    for i, _, _, s in docs:
        assert rows[i]["source_size"] == sizes[s]
        assert rows[i]["target"] == pytest.approx(want[s])
    for s in want:
        assert abs(taken[s] - want[s]) <= 8, s
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = {r["doc_id"]: r["taken"] for r in M.mixed_rows(df.repartition(7)).collect()}
    assert again == {i: r["taken"] for i, r in rows.items()}


def test_pieces_join_the_schedule(make):
    df = make([(i, "x " * 30, "en", "ab"[i % 2]) for i in range(40)])
    m = M.mix(df)
    pieces = m.pieces.collect()
    assert len({(p["ix"], p["slot"]) for p in pieces}) == len({p["slot"] for p in pieces})
    assert sum(p["taken"] for p in pieces) == sum(r["taken"] for r in m.taken.collect())


def test_mixed_documents(make):
    df = make([(i, f"doc {i} " + "w " * (i % 17), "en", f"s{i % 4}") for i in range(200)])
    taken = {r["doc_id"]: r["taken"] for r in M.mixed_rows(df).collect()}
    got = {}
    for r in M.mixed_documents(df).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {i: t for i, t in taken.items() if t}


def test_odd_documents(odd_documents, make):
    assert M.mixed_rows(odd_documents).count() == odd_documents.count()
    assert M.mixed_documents(odd_documents).columns == odd_documents.columns
    assert M.mixed_rows(make([])).count() == 0
    assert M.mixed_documents(make([])).count() == 0
    assert M.mixed_rows(make([None, "", None])).count() == 3


def padding(ends, histogram):
    return sum((min(e for e in ends if e >= x) - x) * c for x, c in histogram.items())


def test_boundaries_are_optimal():
    rnd = random.Random(1)
    for _ in range(200):
        histogram = {rnd.randint(0, 40): rnd.randint(1, 9) for _ in range(rnd.randint(1, 9))}
        k = rnd.randint(1, 5)
        ends = P.boundaries(histogram, k)
        best = min(padding((*c, max(histogram)), histogram) for n in range(k) for c in itertools.combinations(sorted(histogram)[:-1], min(n, len(histogram) - 1)))
        assert len(ends) <= k and max(ends) == max(histogram)
        assert padding(ends, histogram) == best


def test_packs_hold_everything(make):
    rnd = random.Random(2)
    df = make(["w " * rnd.randint(0, 700) for _ in range(400)])
    rows = P.pack(df, max_len=256, buckets=4, budget=1024).collect()
    by_doc = {}
    for r in rows:
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["length"]
        assert r["length"] <= r["bucket_len"] <= 256
        assert r["slot"] < max(1, 1024 // max(1, r["bucket_len"]))
    assert by_doc == {r["doc_id"]: len(r["text"].split()) for r in df.collect()}
    places = [(r["bucket_len"], r["batch"], r["slot"]) for r in rows]
    assert len(set(places)) == len(places)
    for b in {p[0] for p in places}:  # only the last batch of a bucket is not full
        room = max(1, 1024 // max(1, b))
        n = sum(1 for p in places if p[0] == b)
        assert sorted((p[1], p[2]) for p in places if p[0] == b) == [(i // room, i % room) for i in range(n)]


def test_pack_odd_documents(odd_documents, make):
    assert P.pack(odd_documents).select("doc_id").distinct().count() == odd_documents.select("doc_id").distinct().count()
    assert P.pack(make([])).count() == 0
