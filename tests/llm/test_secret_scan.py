import random
import re

import pytest

from lexstrata.llm import secret_scan as S

ASSIGN = re.compile(rb"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(rb"AKIA[A-Z0-9]+"), re.compile(rb"[0-9a-f]+")


def brute(data):
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(data) if len(m[1]) >= 8]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(data) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[0], x[2]))


@pytest.fixture(scope="module")
def scan():
    automaton = S.compile()
    backward, heads = [S._Backward(r) for r in S.RULES], S._heads(S.RULES)
    return lambda data: S.spans_of(automaton, backward, heads, data)


def test_against_regular_expressions(scan):
    rnd = random.Random(7)
    parts = ["password", "passwd", "secret", "token", "apikey", "API_Key", "Toke", "sec", "AKIA", "AKI", "A1", "='", '"', " ", ":", "=", "a" * 31, "0123456789abcdef" * 2, "f", "x_", "abcdefgh", "é", "Z9"]
    for _ in range(5000):
        data = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))).encode()
        assert [x for x in scan(data) if x[2] < 3] == brute(data), data


def test_more_rules_and_code_points(scan):
    text = "é ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456789012"
    data = text.encode()
    found = S.code_points(data, scan(data))
    assert [text[a:b] for a, b, _ in found] == ["ghp_" + "a1B2" * 9, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-123456789012"]


def test_rule_that_stops_accepting_is_refused():
    with pytest.raises(ValueError):
        S.compile((S.Rule("bad", "ab(cd)*"),))


def test_minimal(scan):
    automaton = S.compile((S.Rule("x", "ab|cb"), S.Rule("y", "[0-9]{3}")))
    assert automaton.states <= automaton.built
    assert S.accepted(automaton, b"zabcb123") == [(3, S.accepted(automaton, b"ab")[0][1]), (5, S.accepted(automaton, b"ab")[0][1]), (8, S.accepted(automaton, b"123")[0][1])]


def test_odd_documents(odd_documents):
    rows = S.digest(S.find_secrets(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["n_assign"] == 0 and r["spans"] == "" for r in rows)


def test_redact(make, odd_documents):
    df = make([f"my password = hunter2hunter2 and {'ab' * 20}!", None, "clean"])
    assert [r["text"] for r in S.redact(df).orderBy("doc_id").collect()] == ["my [REDACTED] and [REDACTED]!", None, "clean"]
    assert S.redact(odd_documents).columns == odd_documents.columns
    assert S.redact(odd_documents).count() == odd_documents.count()
