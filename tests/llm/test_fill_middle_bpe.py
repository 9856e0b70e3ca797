import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexstrata.llm import bpe as B
from lexstrata.llm import fill_middle as M

PATH = public_tokenizers.path("byte_bpe_50k.json")


# -- fill-in-middle


def brute(doc_id, text):
    """The definition, unit by unit."""
    text = text or ""
    units = regex.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not n or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_forms_of_odd_texts(odd_documents):
    docs = odd_documents.unionByName(odd_documents.select([F.lit(f"a<{c}> b").alias("text") if c == "text" else c for c in odd_documents.columns]).limit(0))
    want = sorted(((r["doc_id"], *brute(r["doc_id"], r["text"])) for r in docs.collect()), key=repr)
    rows = M.forms(docs).collect()
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows), key=repr) == want
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in rows:
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert M.forms(docs.limit(0)).count() == 0


def test_transform_and_restore(make):
    rnd = random.Random(4)
    alphabet = ["a", "Bc", " ", "\n", "é", "<", ">", "P", "S", "M", "<P", "S>", "😀", "1", "\x00", "<M>"]
    docs = make([(i, "".join(rnd.choices(alphabet, k=rnd.randrange(40))), "en", "s") for i in range(600)])
    made = M.transform(docs)
    assert made.columns == docs.columns
    both = M.forms(docs).withColumn("back", M.restore(F.col("output"), F.col("form"))).join(docs, "doc_id").join(made.select("doc_id", F.col("text").alias("new")), "doc_id").collect()
    assert len(both) == 600 and all(r["back"] == r["text"] and r["new"] == r["output"] for r in both)
    forms = [r["form"] for r in both]
    assert 0 < forms.count("spm") < forms.count("psm") and forms.count("plain") > 40
    assert all((r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"]) for r in both)


def test_shares_of_forms_are_parameters():
    assert {M.transformed(str(i), "some text", plain=0, spm=100)[1] for i in range(50)} == {"spm"}
    assert {M.transformed(str(i), "some text", plain=100)[1] for i in range(50)} == {"plain"}


# -- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return B.Bpe(B.read_vocabulary(PATH))


def odd_texts():
    rnd = random.Random(1)
    alphabet = ["a", "b", " ", "\n", "é", "ß", "<|endoftext|>", "<|", "😀", "1", "२", "'s", "'", "՘", "　", "\x1c", "\x85", "\x00", "中", "ก", "Z", "the", "ing", "‍", "\U0003d000", "\t", "\r"]
    some = ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(3000)]
    letters = "".join(rnd.choices("abcdefghij", k=5000))
    return [*some, "", " ", letters, "a" * 5001, "ab" * 4000, "中文" * 3000, "=-" * 3000 + "=" * 4001, " " * 5000 + "x", "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(8000))]


def test_encodes_as_the_library(bpe, library, monkeypatch):
    texts = odd_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in bpe.encode(texts)] == want
    monkeypatch.setattr(B, "LONG", 40), monkeypatch.setattr(B, "TOGETHER", 7), monkeypatch.setattr(B, "KNOWN", 100)
    own = B.Bpe(bpe.v)
    assert [x.tolist() for x in own.encode(texts)] == want


def test_decodes_as_the_library(bpe, library, monkeypatch):
    rnd = random.Random(2)
    monkeypatch.setattr(B, "IDS", 5)
    for _ in range(800):
        ids = [rnd.randrange(50300) for _ in range(rnd.randrange(12))]
        assert bpe.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_every_letter_number_and_space_splits_as_in_the_library(library):
    before = library.pre_tokenizer
    chars = [chr(c) for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000] + [chr(int(x, 16)) for r in B.LATER.split() for x in r.split("-")]
    for ch in chars:
        text = f"a{ch}a1{ch}1 {ch} {ch}{ch}."
        assert [w for part in B.Bpe.split(text) for w in part] == [text[a:b] for _, (a, b) in before.pre_tokenize_str(text)], hex(ord(ch))


def test_round_trip_of_documents(odd_documents, library):
    rows = B.encode(odd_documents, PATH, back=True).collect()
    texts = odd_documents.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids, r["text"] or "") for r in texts), key=repr)
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in rows), key=repr) == want
    for r in rows:
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    assert B.encode(odd_documents.limit(0), PATH).count() == 0
    again = B.decode(B.encode(odd_documents, PATH), PATH).collect()
    assert sorted((repr(r["doc_id"]), r["text"]) for r in again) == sorted((repr(i), t) for i, _, t in want)


def test_decode_of_odd_ids(spark, library):
    df = spark.createDataFrame([([464, None, 50256, 99999],), ([],), (None,), ([197, 255, 128],)], "ids array<int>")
    assert [r["text"] for r in B.decode(df, PATH).collect()] == ["The<|endoftext|>", "", None, library.decode([197, 255, 128])]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        B.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_query_and_sql_agree(spark, duck, sf_dir):
    from lexstrata.llm import queries as Q

    df = Q.op12_fill_middle(spark, sf_dir)
    columns = sorted(df.columns)
    sql = duck.sql(Q.oracle_sql()["op12_fill_middle"])
    assert sorted(sql.columns) == columns
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(sql.select(*columns).fetchall())


def test_bpe_query_and_library_agree(spark, sf_dir, library):
    from lexstrata.llm import queries as Q

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = Q.op13_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
