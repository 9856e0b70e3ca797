import random

import numpy as np
import pytest
from pyspark.sql import types as T

from lexstrata.llm import html_text as H
from lexstrata.llm import max_score as M

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])


def brute(vectors, every, k, scale=64):
    ok = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ok if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 24)]) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(40)]  # ties
    vectors += [(900, None), (901, [None] * 24), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (None, [0.0] * 24), (904, [0.0] * 24), (920, [1.0, 2.0]), (921, [-1.0, 0.5])]
    rows = M.search(spark.createDataFrame([(i, v, "x") for i, v in vectors], SCHEMA), every=10, k=20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows) == brute(vectors, 10, 20)


def test_shard_with_large_values():
    ids, values = np.arange(6), np.array([[2**40, 1], [2**40, 2], [-(2**40), 5], [0, 0], [1, 1], [2**40, 2]])
    q, i, s = M.shard_top(ids, values, np.array([0]), values[:1], 3)
    assert list(zip(q.tolist(), i.tolist(), s.tolist(), strict=True)) == [(0, 1, M.MOST), (0, 5, M.MOST), (0, 4, 2**40 + 1)]


def test_top_k_of_little(spark):
    assert M.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert M.search(spark.createDataFrame([(0, [0.5], None)], SCHEMA)).count() == 0
    assert [tuple(r) for r in M.search(spark.createDataFrame([(0, [0.5], None), (3, [-0.1], None)], SCHEMA)).collect()] == [(0, 1, 3, 32 * -7)]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>one<p>two", "one\n\ntwo"),
        ("a<br>b <b>c</b>d", "a\nb cd"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>x<li>y</ol>z", "9. x\n10. y\n\nz"),
        ("<table><tr><th>A<th>Bbb<tr><td>longer<td>1</table>", "A       Bbb\nlonger  1"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<table><tr><td>x<table><tr><td>in</table><td>y</table>", "x   y\n\nin"),
        ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
        ("<script>var t='</p>'</script><style>x</style><!-- c --><noscript>n</noscript>s", "s"),
        ("<div hidden>n</div><span style='DISPLAY : none'>n</span>y<input type=text>", "y"),
        ("<details><summary>s</summary>n<p>n</details>y", "s\ny"),
        ("<details open><summary>s</summary>n</details>", "s\nn"),
        ("<head><title>t</title><p>b", "b"),
        ("a &amp; b&lt;c &nbsp;d < e <3", "a & b<c \xa0d < e <3"),
        ("<div>a</span></div></div>b", "a\nb"),
        ("<a title='>'>x</a>", "x"),
        ("x<!-- open", "x"),
        ("", ""),
    ],
)
def test_render(html, text):
    assert H.render(html)[0] == text


def test_deep_and_broken_pages():
    assert H.render("<div>" * 20000 + "x")[0] == "x"
    rnd = random.Random(1)
    parts = ["<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<ul>", "<li>", "</ul>", "<b", "</", "<!--", "-->", "text ", "&am", "<pre>", "</pre>", "<details>", "<caption>", "</caption>", "<ol start=x>", "'", '"', ">", "<select><option>", "<div hidden>", "</div>"]
    for _ in range(3000):
        H.render("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))))


def test_every_visible_word_stays(spark, sf_dir):
    """A plain walk over the parser's events finds the same words."""
    from html.parser import HTMLParser

    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.off, self.words = 0, []

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("head", "script", "style")

        def handle_endtag(self, tag):
            self.off -= tag in ("head", "script", "style")

        def handle_data(self, data):
            if not self.off:
                self.words += data.split()

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        w = Words()
        w.feed(r["html"])
        assert "".join(w.words) == "".join(x for x in got[r["page_id"]]["text"].split() if x != "-"), r["page_id"]


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, "<p>x", None)], "page_id long, html string, text string")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in H.extract(df).collect()) == [(0, "x", 1), (1, "", 0), (1, "", 0)]
    assert H.extract(df.limit(0)).count() == 0
