import random
from collections import Counter

import numpy as np
import pytest

from lexstrata.llm import ngram_join as J
from lexstrata.llm.common import Tables
from lexstrata.llm.graph import components


def shingles(text, k):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(ws)} if 0 < len(ws) < k else {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def brute(texts, k, num, den):
    """doc -> (size, smallest linked doc), by all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, words=60):
    """Texts with copies, chains of small edits, a common passage, common short lines and repeated words."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(60):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 5, 8, 20, 40, 60]))]
        if rnd.random() < 0.3:
            base += passage
        texts.append(" ".join(base))
        now = base
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            now = list(now)
            if rnd.random() < 0.7:
                now[rnd.randrange(len(now))] = rnd.choice(vocabulary)
            texts.append((" ".join(now)).upper() if rnd.random() < 0.2 else "\t".join(now))
    for _ in range(40):  # many edits of one text: most are similar to it, not to each other
        now = [f"h{i}" for i in range(60)]
        now[rnd.randrange(60)] = "x" + str(rnd.randrange(9))
        texts.append(" ".join(now))
    texts += [" ".join(["same"] * n) for n in (1, 3, 4, 9)] + ["", None, " \n"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "k", "num", "den", "hot"), [(1, 4, 85, 100, 16), (2, 5, 4, 5, 2), (3, 2, 7, 10, 3)])
def test_against_all_pairs(make, monkeypatch, seed, k, num, den, hot):
    monkeypatch.setattr(J, "LEAST_HOT", hot)  # so that frequent tokens occur
    monkeypatch.setattr(J, "GROUP", 4)
    texts = dict(enumerate(corpus(seed)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.ngram_components(make(list(texts.values())), k, num, den).collect()}
    assert got == brute(texts, k, num, den)


def test_join_beyond_named_sets(make, monkeypatch):
    monkeypatch.setattr(J, "NAMED", 1)
    texts = dict(enumerate(corpus(9)[:60]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.ngram_components(make(list(texts.values())), 4, 85, 100).collect()}
    assert got == brute(texts, 4, 85, 100)


def test_prefixes_of_linked_sets_meet():
    """Prefixes as long as those here share what the join asks for, whatever the order of tokens."""
    rng = np.random.default_rng(0)
    for _ in range(500):
        n = int(rng.integers(1, 60))
        a = set(rng.permutation(200)[:n].tolist())
        b = set(a)
        for x in rng.permutation(sorted(a))[: rng.integers(0, 1 + n // 8)]:
            b.discard(int(x))
        b |= {int(x) + 1000 for x in range(int(rng.integers(0, 1 + n // 10)))}
        both = len(a & b)
        if not b or 100 * both < 85 * len(a | b):
            continue
        order = {t: int(rng.integers(1 << 40)) for t in a | b}
        heads, ells = [], []
        for s in (a, b):
            need = int(J.required(len(s), 85, 100))
            ell = min(need, J.ELL)
            heads.append(set(sorted(s, key=order.get)[: len(s) - need + ell]))
            ells.append(ell)
        assert len(heads[0] & heads[1]) >= min(ells)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2001 + i) for i in range(30)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), Tables(spark, "test")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}


def test_keep_one(make):
    df = make(["a b c d e f g h", "a b c d e f g h", "x", "", None, "X", "other words here now ok fine"])
    assert sorted(r["doc_id"] for r in J.keep_one_of_each(df).collect()) == [0, 2, 3, 4, 6]


def test_odd_documents(odd_documents, make):
    rows = J.ngram_components(odd_documents, 4, 85, 100).collect()
    assert len(rows) == odd_documents.count()
    by_id = Counter((r["doc_id"], r["component_id"]) for r in rows)
    assert by_id[(6, 5)] == 1 and by_id[(7, 7)] == 2 and by_id[(2, 2)] == 1 and by_id[(None, None)] == 1
    kept = J.keep_one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == Counter([1, 2, 3, 4, 5, 7, None, 8])
    assert J.ngram_components(make([])).count() == 0
    assert J.ngram_components(make([None, ""])).count() == 2
