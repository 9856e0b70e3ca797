from collections import Counter

from lexstrata.llm import mixing as M
from lexstrata.llm import ngram_join as J


def test_tiny_sources_get_their_target(make, monkeypatch):
    """Blocks of many words: sources below a block are neither left out nor taken whole."""
    monkeypatch.setattr(M, "SLOTS", 16)
    docs = [(i, "w " * 50, "en", "hot") for i in range(200)] + [(1000 + i, "w " * (3 + i % 5), "en", f"t{i // 4:02}") for i in range(160)] + [(5000, "w", "en", None), (5001, "", "en", "zero")]
    df = make(docs)
    rows = {r["doc_id"]: r for r in M.mixed_rows(df).collect()}
    taken, target = Counter(), {}
    for i, _, _, s in docs:
        taken[s] += rows[i]["taken"]
        target[s] = rows[i]["target"]
    assert {s: (taken[s], t) for s, t in target.items() if abs(taken[s] - t) >= 1} == {}
    assert sum(taken.values()) == sum(len(t.split()) for _, t, _, _ in docs)
    pieces = M.mix(df).pieces.collect()
    assert len({(p["ix"], p["slot"]) for p in pieces}) == len({p["slot"] for p in pieces}) and sum(p["taken"] for p in pieces) == sum(taken.values())
    words = Counter()
    for r in M.mixed_documents(df).collect():
        words[r["source"]] += len(r["text"].split())
    assert words == +taken


def test_keep_one_of_rows_that_share_an_id(make):
    """Rows with a null or repeated id are kept by text: one of each group of near copies."""
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(30)) for c in "abcd")
    near = one.replace("a29", "z")
    df = make([(None, two, "en", "s"), (None, three, "en", "s"), (None, two, "en", "s"), (None, None, "en", "s"), (None, "", "en", "s"), (1, one, "en", "s"), (7, near, "en", "s"), (7, four, "en", "s"), (7, four, "en", "s"), (8, three, "en", "s"), (9, "", "en", "s")])
    kept = Counter((r["doc_id"], r["text"]) for r in J.keep_one_of_each(df).collect())
    assert kept == Counter([(None, two), (None, None), (None, ""), (1, one), (7, four), (8, three), (9, "")])
