import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexstrata.llm import language_id as L
from lexstrata.llm import quality_classifier as Q
from lexstrata.llm import quality_rules as R
from lexstrata.llm import toxicity as X

BLANK = [1, 2, 3]


def held_out(rows, k, r):
    return all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % k == r) for x in rows if x["doc_id"] is not None)


# -- quality rules


def brute_rules(text):
    text = text or ""
    spaces = " \t\n\v\f\r"
    ws, now = [], ""
    for c in text + " ":
        if c in spaces:
            if now:
                ws.append(now)
            now = ""
        else:
            now += c
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + d for i, w in enumerate(windows) if w in twice for d in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(spaces):
            dup += line in seen
            seen.add(line)
    n = len(ws)
    return n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_rules_against_brute_force(make, labels):
    rnd = random.Random(6)
    texts = [None, "", " ", "a\n\na\n a\na", "é é é é é é|<é"]
    for _ in range(60):
        texts.append("".join(rnd.choice(["a", "b", "ç", "😀", "#", "|", " ", " ", "\n", "\t", "\x0b"]) for _ in range(rnd.randint(0, 300))))
    df = make(texts)
    got = {r["doc_id"]: r for r in R.quality_rules(df, labels([])).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_rules(t), repr(t)
        assert r["llr"] == 0 and r["kept"] == (not r["base_failed"])


def test_llr_tells_target_from_rest(make, labels):
    rnd = random.Random(8)
    good = [" ".join(rnd.choice(["the", "of", "and", "river", "stone"]) + rnd.choice(["", "s"]) for _ in range(1500)) for _ in range(40)]
    bad = [" ".join(rnd.choice(["xx##", "yy%%", "zz&&", "qq$$", "vv**"]) for _ in range(1500)) for _ in range(20)]
    df = make(good + bad)
    rows = {r["doc_id"]: r for r in R.quality_rules(df, labels([(i, 1, 0) for i in range(20)])).collect()}
    assert all(rows[i]["llr"] > R.THRESHOLD for i in range(40)) and all(rows[i]["llr"] < R.THRESHOLD for i in range(40, 60))


def test_rules_odd(odd_documents, labels, make):
    assert R.quality_rules(odd_documents, labels([(None, 1, 0), (1, None, None), (4, 1, 0), (4, 1, 1)])).count() == odd_documents.count()
    assert R.quality_rules(make([]), labels([])).count() == 0


# -- quality classifier


def test_classifier_held_out(spark, sf_dir):
    docs, lab = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.classify(docs, lab).join(lab, "doc_id").collect()
    assert held_out(rows, 5, 0)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.8 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_ftrl_keeps_useless_weights_at_zero():
    m = Q.Ftrl(4)
    for i in range(200):
        y = i % 2
        m.learn(np.array([y, 3]), np.array([1.0, 1.0]), y)
    w = m.weights()
    assert w[1] > 0.5 > -0.5 > w[0] and w[2] == 0


def test_accepted(make, labels):
    good, bad = ["calm words in a row here"] * 30, ["### ### ### ###"] * 30
    df = make(good + bad)
    kept = Q.accepted(df, labels([(i, int(i < 30), 0) for i in range(60)]))
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(30))


def test_classifiers_odd(odd_documents, labels, make):
    for lab in (labels([]), labels([(None, 1, 1), (4, None, None), (5, 1, 0), (5, 0, 1), (8, 0, 1), (7, 1, 0), (999, 1, 1)])):
        for f in (Q.classify, X.classify):
            rows = f(odd_documents, lab).collect()
            assert len(rows) == odd_documents.count()
            assert all(0 <= r["score"] <= 1 for r in rows)
            assert len({r["score"] for r in rows if r["doc_id"] in BLANK}) == 1
            assert f(make([]), lab).count() == 0


# -- toxicity


def brute_kernel(a, b):
    """The kernel by its definition, over pairs of subsequences."""

    def features(unit):
        c = X.Units([unit]).codes.tolist()
        out = {}
        for i in range(len(c)):
            for g in X.GAPS:
                for h in X.GAPS:
                    if i + g + h < len(c):
                        s = (c[i], c[i + g], c[i + g + h])
                        out[s] = out.get(s, 0) + X.LAMBDA ** (g + h)
        return out

    x, y = features(a), features(b)
    return sum(w * y.get(s, 0) for s, w in x.items())


def test_kernel_and_folding():
    marks_of, units = ["idiot", "stupid", "the"], ["idiot", "idxiot", "theory", "a"]
    marks, keys, column = X._marks(X.Units(marks_of))
    got = X._kernel(X.Units(units), marks, column)
    norms = X.Units(units).norms()
    for i, u in enumerate(units):
        for j, m in enumerate(marks_of):
            assert got[i, j] == pytest.approx(brute_kernel(u, m) / (norms[i] * X.Units([m]).norms()[0]), rel=1e-4)
    weights = np.array([0.3, -1.2, 0.7])
    table = np.zeros(X.ALPHABET**3, np.float32)
    table[keys] = weights @ marks
    assert X.Units(units).apply(table) == pytest.approx(got @ weights, rel=1e-4)


def test_units():
    u = X.Units(["an i d i o t, r-ot\n", "", "x"])
    parts = ["".join(chr(95 + c) for c in u.codes[a + 1 : a + n - 1]) for a, n in zip(u.first, u.size, strict=True)]
    assert parts == ["an", "idiot", "rot", "x"] and u.doc.tolist() == [0, 0, 0, 2]


def test_insults_with_gaps_are_caught():
    rnd = random.Random(2)
    vocabulary = ["".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    insults = ["idiot", "moron", "scum", "clown", "stupid"]
    texts, ys = [], []
    for i in range(300):
        ws = [rnd.choice(vocabulary) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(3):
                ws.insert(rnd.randrange(40), rnd.choice(insults))
        texts.append(" ".join(ws)), ys.append(int(i % 4 == 0))
    m = X.train(texts, ys)
    p = lambda t: m.probability(m.worst([t]))[0]
    clean = " ".join(vocabulary[:50])
    assert p(clean) < 0.3 and p("") < 0.3
    for pair in ("idiot moron", "i d i o t and s t u p i d", "st.u-pid mo_ron", "stuupid idxiot"):
        assert p(f"{clean} {pair} {clean}") >= 0.7, pair
    assert m.worst(["a b", ""]).shape == (2, X.WORST)


# -- language


def test_gradients():
    rng = np.random.default_rng(0)
    net = L.Net(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    run = L.Net.run

    def exact(self, x, direction, keep=None):
        wx, wh, n = self.p[f"wx{direction}"], self.p[f"wh{direction}"], L.HIDDEN
        h, out = np.zeros((len(x), n)), np.zeros((x.shape[1], len(x), n))
        for t in range(x.shape[1]) if direction == "f" else range(x.shape[1] - 1, -1, -1):
            fx, fh = wx[x[:, t]], h @ wh
            gates = np.clip((fx + fh)[:, : 2 * n] * 0.25 + 0.5, 0, 1)
            z, r = gates[:, :n], gates[:, n:]
            raw = fx[:, 2 * n :] + r * fh[:, 2 * n :]
            if keep is not None:
                keep.append((t, h, gates, raw, fh[:, 2 * n :]))
            c = np.clip(raw, -1, 1)
            h = c + z * (h - c)
            out[t] = h
        return out

    L.Net.run = exact
    try:
        x, y = rng.integers(97, 103, (5, 7)), rng.integers(0, 3, 5)
        _, g = net.gradients(x, y)
        for k in net.p:
            for at in [tuple(rng.integers(0, s) for s in net.p[k].shape) for _ in range(6)] + ([(int(x[0, 3]), 5)] if k.startswith("wx") else []):
                keep, e = net.p[k][at], 1e-5
                net.p[k][at] = keep + e
                up = net.gradients(x, y)[0]
                net.p[k][at] = keep - e
                down = net.gradients(x, y)[0]
                net.p[k][at] = keep
                assert g[k][at] == pytest.approx((up - down) / (2 * e), abs=1e-5)
    finally:
        L.Net.run = run


def test_pooling_reads_every_byte():
    net = L.Net(["a", "b"])
    texts = [b"", b"x", b"hello world " * 30, b"z" * (L.WINDOW * (L.TOGETHER + 3) + 5)]
    got = L.pooled(net, texts)
    for t, p in zip(texts, got, strict=True):
        if t:
            each = np.concatenate([net.probabilities(w[None, :])[: min(L.WINDOW, len(t) - i * L.WINDOW), 0] for i, w in enumerate(L._cut(t)[:400])])
            assert len(t) > 400 * L.WINDOW or p == pytest.approx(each.mean(axis=0), abs=1e-4)


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert held_out(rows, 3, 1)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.9 * len(out)


def test_language_odd(odd_documents, make):
    rows = {r["doc_id"]: r for r in L.identify(odd_documents).collect()}
    assert L.identify(odd_documents).count() == odd_documents.count()
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in BLANK)
    assert {r["lang_pred"] for r in L.identify(make([(1, "ab", None, "a"), (2, "12 34", None, "a")])).collect()} == {"und"}
    assert L.identify(make([])).count() == 0
    assert not L.has_letter("12 — 😀".encode()) and L.has_letter("١ ж".encode())


def test_models_do_not_see_held_out_rows(make, labels):
    """Labels of held-out rows change nothing."""
    texts = [f"word{i % 7} thing{i % 5} more" for i in range(80)]
    for f, k, r in ((Q.classify, 5, 0), (X.classify, 3, 1)):
        flip = lambda on: labels([(i, v, v) for i in range(80) for v in [(i % 2) ^ int(on and zlib.crc32(str(i).encode()) % k == r)]])  # noqa: B023, E731
        a, b = (f(make(texts), flip(on)).orderBy("doc_id").agg(F.collect_list("score")).first()[0] for on in (False, True))
        assert a == b
