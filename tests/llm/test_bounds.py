"""Long matches, deep pages, repeated rows and ids, several rounds of queries, little evidence; and the classifier by its definition."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import types as T

import test_ngram_join
from lexstrata.llm import common
from lexstrata.llm import html_text as H
from lexstrata.llm import max_score as M
from lexstrata.llm import mixing, ngram_join, packing
from lexstrata.llm import quality_classifier as Q
from lexstrata.llm import quality_rules as R
from lexstrata.llm import secret_scan as S
from lexstrata.llm import word_grams as G

WORDS = r"[^\x20\x09-\x0D]+"


# -- secrets


def test_a_long_match_is_one_entry():
    machine = S.compile()
    data = b"x token=" + b"aB3/" * 300_000 + b" y AKIA" + b"Q" * 20
    found = S.accepted(machine, data)
    assert len(found) == 2
    spans = S.spans_of(machine, [S._Backward(r) for r in machine.rules], S._heads(machine.rules), data)
    assert [(a, b, machine.rules[r].kind) for a, b, r in spans] == [(2, 1_200_008, "assign"), (1_200_011, 1_200_035, "access")]


# -- pages


def test_depth_costs_nothing():
    began = time.perf_counter()
    text, _, _ = H.render("<p>" + "<b>" * 30_000 + "<p>x" * 50 + "<table><td>" + "<i>" * 5_000 + "<div>y</div>" * 500)
    assert text.split() == ["x"] * 50 + ["y"] * 500
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d", "b\nd"),
        ("<table><tr><td>日本<td>x<tr><td>abcd<td>y</table>", "日本  x\nabcd  y"),
        ("x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>n</annotation></math> y", "x a+b y"),
        ("x<svg><title>n</title><desc>n</desc><g>n<text>label</text><path/></g></svg>y", "x labely"),
    ],
)
def test_what_a_reader_sees(html, text):
    assert H.render(html)[0] == text


def test_deep_lists_stop_indenting():
    text, items, _ = H.render("<ul><li>" * 400 + "x")
    assert items == 400 and text.strip() == "- x" and len(text) <= H.MOST_INDENT + 1


# -- mixing and packing


def test_copies_share_every_word(make, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 16)
    df = make([(7, "a b c", "en", "s")] * 1000 + [(i, "w " * (i % 9 + 1), "en", "t") for i in range(100, 400)] + [(None, "n n", "en", None)] * 50)
    plan = mixing.mix(df)
    want = {(r["doc_id"], r["source"], r["size"]): r["taken"] for r in plan.taken.collect()}
    rows = mixing.mixed_rows(df).collect()
    assert len(rows) == df.count()
    assert sum(r["taken"] for r in rows) == sum(want.values())
    shares = [r["taken"] for r in rows if r["doc_id"] == 7]
    assert sum(shares) == want[(7, "s", 3)] and max(shares) - min(shares) <= 1 and max(shares) <= 9
    words = [len(re.findall(WORDS, r["text"])) for r in mixing.mixed_documents(df).collect()]
    assert sum(words) == sum(want.values())


def test_cut_texts_keep_their_lines(make):
    df = make([(i, f"one two\n  three {i}\n\nfour\tfive six", "en", f"s{i % 3}") for i in range(60)])
    whole = {r["doc_id"]: r["text"] for r in df.collect()}
    got = mixing.mixed_documents(df).collect()
    assert any(r["text"] != whole[r["doc_id"]] for r in got)
    assert all(whole[r["doc_id"]].startswith(r["text"]) for r in got)


def test_packed_texts_join_to_documents(make):
    rnd = random.Random(2)
    docs = [(i % 40, " ".join(rnd.choice(["a", "bé", "c\n"]) for _ in range(rnd.choice([0, 3, 40, 700]))), "en", "s") for i in range(60)] + [(None, None, None, None)] * 2
    rows = packing.pack_texts(make(docs), max_len=64, budget=256).collect()
    assert len({(r["bucket_len"], r["batch"], r["slot"]) for r in rows}) == len(rows)
    assert all(len(re.findall(WORDS, r["text"])) == r["length"] for r in rows)
    assert sorted(w for r in rows for w in re.findall(WORDS, r["text"])) == sorted(w for _, t, _, _ in docs for w in re.findall(WORDS, t or ""))
    assert sum(r["piece"] == 0 for r in rows) == len(docs)


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("C", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

        def getConf(self):
            return Conf()

    session = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.shared_dir(session)


# -- search

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("v", T.ArrayType(T.LongType()))])


def test_rounds_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 600)
    rng = np.random.default_rng(3)
    rows = [(int(i), [int(x) for x in rng.integers(-50, 50, 8)]) for i in rng.integers(0, 90, 200)] + [(5, [1, 2])] * 2 + [(10, [3, -4])]
    got = sorted(tuple(r) for r in M.top_k(spark.createDataFrame(rows, VECTORS), "vec_id % 5 = 0", 4).collect())
    want = []
    asked = {(i, tuple(v)) for i, v in rows if i % 5 == 0}
    for q in {i for i, _ in asked}:
        found = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for p, x in asked if p == q for i, v in rows if i != q and len(v) == len(x))[:4]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    assert got == sorted(want)


def test_bounds_lose_nothing():
    rng = np.random.default_rng(4)
    values = rng.integers(-3, 4, (9000, 30)) * (rng.random((9000, 30)) < 0.2) * np.arange(30, 0, -1)  # a few terms count most
    ids, asked = np.arange(9000), np.arange(0, 9000, 300)
    q, i, s = M.shard_top(ids, values, ids[asked], values[asked], 10)
    every = (values[asked] @ values.T).astype(np.int64)
    for n, a in enumerate(asked):
        order = sorted((x for x in range(9000) if x != a), key=lambda x: (-every[n, x], x))[:10]
        mine = q == a
        assert i[mine].tolist() == order and s[mine].tolist() == every[n, order].tolist()


# -- quality


def test_little_evidence_condemns_nobody(make, labels):
    rnd = random.Random(8)
    good = [" ".join(rnd.choice(["the", "of", "and", "river", "stone"]) + rnd.choice(["", "s"]) for _ in range(80)) for _ in range(400)]
    rows = R.quality_rules(make(good), labels([(i, 1, 0) for i in range(5)])).collect()
    assert all(r["llr"] > R.THRESHOLD for r in rows)


def test_ratio_by_its_definition(make, labels):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["ab", "Cd", "e1", "#", "é"]) for _ in range(rnd.randint(0, 40))) for _ in range(30)] + [None, ""]
    trusted = {1, 2, 3, 4}
    raw, target, held = {}, {}, []
    for n, t in enumerate(texts):
        bs = brute_grams(t or "", R.BITS)
        held.append(bs)
        for b in bs:
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + (n in trusted)
    all_raw, all_target = sum(raw.values()), sum(target.values())
    p = {b: (raw[b] + 1) / (all_raw + (1 << R.BITS)) for b in raw}
    ratio = {b: math.log((target[b] + R.PRIOR * p[b]) / (all_target + R.PRIOR) / p[b]) for b in raw}
    rows = {r["doc_id"]: r for r in R.quality_rules(make(texts), labels([(i, 1, 0) for i in trusted] + [(9, 0, 0), (None, 1, 0)])).collect()}
    for n, bs in enumerate(held):
        assert rows[n]["llr"] == pytest.approx(sum(ratio[b] for b in bs) / max(len(bs), 1), abs=1e-5)
        assert rows[n]["kept"] == (not rows[n]["base_failed"] and rows[n]["llr"] >= R.THRESHOLD)


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_marks_by_array_or_by_join(make, spark, monkeypatch, most):
    monkeypatch.setattr(R, "BROADCAST_IDS", most)
    df = make([(1, "a", None, None), (2, "b", None, None), (None, "c", None, None), (1, "d", None, None)]).select("doc_id", "text")
    got = R.mark_labelled(df, spark.createDataFrame([(1,), (0,)], "doc_id long"), "yes").collect()
    assert sorted((r["text"], r["yes"]) for r in got) == [("a", True), ("b", False), ("c", False), ("d", True)]


def test_repeated_ids_are_learned_once(make, labels):
    df = make([(1, f"words number {i}", "en", "s") for i in range(500)] + [(2, "x " * 200_000, "en", "s"), (3, None, "en", "s")])
    got = Q.labelled_sample(df, labels([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 1, 0)]), "quality", Q.F.lit(True), 10).collect()
    assert sorted((r["doc_id"], r["text"] and bytes(r["text"]), r["label"]) for r in got) == [(1, b"words number 0", 0), (3, None, 1)]


# -- hashed n-grams and the classifier, by their definitions in plain integers

MASK = (1 << 64) - 1


def mix64(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def brute_word(w):
    return mix64((sum(int(common.BYTE64[b]) * pow(common.BASE, i, 1 << 64) for i, b in enumerate(w)) + len(w)) & MASK)


def brute_shape(w, repeated):
    upper, lower = sum(65 <= b < 91 for b in w), sum(97 <= b < 123 for b in w)
    letter = lambda b: 65 <= b < 91 or 97 <= b < 123 or b >= 128
    case = 0 if not upper else 2 if not lower and upper > 1 else 1 if upper == 1 and 65 <= w[0] < 91 else 3
    ending = 0 if letter(w[-1]) else 1 if w[-1] in b".,;:?" else 2 if len(w) > 1 and w[-1] == w[-2] else 3
    length = sum(len(w) >= x for x in (2, 4, 8, 13, 21))
    return ((((case * 4 + ending) * 2 + any(48 <= b < 58 for b in w)) * 2 + any(map(letter, w))) * 6 + length) * 2 + repeated


def brute_grams(text, bits):
    ws = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode()) if w]
    h = [brute_word(bytes(b + 32 if 65 <= b < 91 else b for b in w)) for w in ws]
    shapes = [mix64(brute_shape(w, int(i > 0 and h[i] == h[i - 1])) + (1 << 20)) for i, w in enumerate(ws)]
    out = []
    for values, most in ((h, 2), (shapes, 3)):
        for n in range(1, most + 1):
            for i in range(len(values) - n + 1):
                v = values[i]
                if n > 1:
                    v = 0
                    for x in values[i : i + n]:
                        v = mix64((v * common.BASE + x) & MASK)
                out.append(v >> (64 - bits))
    return out


TEXTS = ["The Cat, the cat!! sat; 12", "AAA bbb Cc dD!! ééé 日本", "", " one ", "one one one", "x" * 30 + " #$%"]


def test_grams_by_definition():
    s = next(common.slices([t.encode() for t in TEXTS]))
    doc, bucket = G.grams(s, 18)
    for i, t in enumerate(TEXTS):
        assert sorted(bucket[doc == i].tolist()) == sorted(brute_grams(t, 18))


def test_classifier_by_definition(make, labels):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["calm", "River", "of", "##", "!!", "x9"][(i % 2) * 3 :][:3]) for _ in range(rnd.randint(0, 12))) for i in range(24)]
    vectors = []
    for t in texts:
        bs = brute_grams(t, Q.BITS)
        x = {b: np.float32(Q.SCALE * bs.count(b) / max(len(bs), 1)) for b in set(bs)}
        vectors.append(x | {1 << Q.BITS: np.float32(1.0)})
    z, n = {}, {}

    def weight(b):
        v = z.get(b, 0.0)
        return 0.0 if abs(v) <= Q.L1 else -(v - math.copysign(Q.L1, v)) / ((Q.BETA + math.sqrt(n.get(b, 0.0))) / Q.ALPHA + Q.L2)

    order = np.random.default_rng(9)
    for _ in range(Q.EPOCHS):
        for i in order.permutation(len(texts)):
            x, y = vectors[i], i % 2
            w = {b: weight(b) for b in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[b] * float(x[b]) for b in x)))))
            for b in x:
                g = (p - y) * float(x[b])
                sigma = (math.sqrt(n.get(b, 0.0) + g * g) - math.sqrt(n.get(b, 0.0))) / Q.ALPHA
                z[b], n[b] = z.get(b, 0.0) + g - sigma * w[b], n.get(b, 0.0) + g * g
    df = make(texts)
    got = {r["doc_id"]: r["score"] for r in Q.score(df, Q.train(df, labels([(i, i % 2, 0) for i in range(len(texts))]))).collect()}
    for i, x in enumerate(vectors):
        want = 1 / (1 + math.exp(-sum(weight(b) * float(v) for b, v in x.items())))
        assert got[i] == pytest.approx(want, abs=1e-4)


# -- near copies


def test_large_families_against_all_pairs(make):
    """Edits of one text, by one to twenty words, copies of some of them, and one large group of exact copies."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(350):
        now = list(base)
        for _ in range(rnd.choice([1, 2, 3, 5, 9, 20])):
            now[rnd.randrange(len(now))] = f"e{rnd.randrange(400)}"
        texts.append(" ".join(now[: rnd.choice([120, 120, 110, 90])]))
    texts += texts[:40] + [" ".join(base)] * 150
    rnd.shuffle(texts)
    want = test_ngram_join.brute(dict(enumerate(texts)), 4, 85, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(make(texts), 4, 85, 100).collect()}
    assert got == want
