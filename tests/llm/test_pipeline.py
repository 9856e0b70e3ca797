import re

import pytest
from test_ngram_join import brute
from test_secret_scan import brute as brute_secrets

import corpus_pipeline as P
from lexstrata.llm import mixing, quality_classifier


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's input and result."""
    d, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in P.STAGES:
        path = str(d / name)
        f(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages, spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "secrets", "mix", "pack"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == spark.read.parquet(f"{sf_dir}/documents.parquet").columns


def test_quality_keeps_what_the_classifier_accepts(stages, spark, sf_dir):
    before, after = stages["quality"]
    scores = quality_classifier.score(before, quality_classifier.train(before, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    assert set(texts(after)) == {r["doc_id"] for r in scores.collect() if r["score"] >= 0.3}
    assert 0 < after.count() < before.count()


def test_one_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near_copies"])
    assert after == {i: before[i] for i, (_, root) in brute(before, 5, 4, 5).items() if i == root}


def test_secrets_are_replaced(stages, make, spark, sf_dir):
    docs = stages["secrets"][0]
    planted = make([(10**9 + i, f"words before {x} and after", "en", "s") for i, x in enumerate(["token=abcdEFGH1234", "Password: 'hunter2hunter2'", "AKIA" + "Q7" * 8, "0123456789abcdef" * 2, "no secret"])])
    whole = docs.unionByName(planted.select(*[planted[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))
    before, after = texts(whole), texts(P.secrets(spark, whole, sf_dir))
    assert {i: t for i, t in after.items() if i < 10**9} == texts(stages["secrets"][1])
    assert set(before) == set(after)
    changed = 0
    for i, t in before.items():
        spans = brute_secrets(t.encode())
        changed += bool(spans)
        assert bool(spans) == (t != after[i]) or re.search("gh[pousr]_|xox|AIza|BEGIN", t)
        assert brute_secrets(after[i].encode()) == []
    assert changed


def test_mix_takes_what_is_planned(stages):
    before, after = stages["mix"]
    want = {r["doc_id"]: r["taken"] for r in mixing.mixed_rows(before).collect() if r["taken"]}
    got = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert got == want


def test_pack_holds_every_word(stages):
    before, after = stages["pack"]
    rows = after.collect()
    assert sum(r["length"] for r in rows) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before.collect())
    assert len({(r["bucket_len"], r["batch"], r["slot"]) for r in rows}) == len(rows)


def test_run_is_the_stages_in_turn(stages, spark, sf_dir):
    assert sorted(map(tuple, P.run(spark, sf_dir).collect())) == sorted(map(tuple, stages["pack"][1].collect()))


def test_empty_corpus(spark, make, labels, tmp_path):
    make([]).write.parquet(str(tmp_path / "documents.parquet"))
    labels([]).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_odd_corpus(spark, odd_documents, labels, tmp_path):
    odd_documents.write.parquet(str(tmp_path / "documents.parquet"))
    labels([(4, 1, 0), (5, 0, 0), (None, 1, 1)]).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() > 0
