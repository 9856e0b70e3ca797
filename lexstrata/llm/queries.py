"""The registered queries of this subpackage, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fill_middle, html_text, language_id, max_score, mixing, ngram_join, packing, quality_classifier, quality_rules, secret_scan, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that are not held out."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every query, by integer inner product."""
    return max_score.search(_table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by the combined automaton over all rules."""
    return secret_scan.digest(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken. Sources give their targets to the word."""
    return mixing.mixed_rows(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a Jaccard similarity of 0.85 of four-word shingles."""
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op7_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every page, as laid out."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows that are not held out."""
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countable properties, base rules and log-likelihood ratio of every document."""
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened vectors: the first eight components of every embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's fill-in-middle form, and of the text restored from it."""
    return fill_middle.forms(_table(spark, sf_dir, "documents")).drop("output")


def op13_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Digests of every document's token ids, and of the text decoded from them. vocabulary: path of a tokenizer file."""
    import public_tokenizers

    encoded = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("byte_bpe_50k.json"), back=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _op3_sql() -> str:
    words = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
    head = rf"""(?:{words})["'']?\x20*[:=]\x20*["'']?"""
    value = "[A-Za-z0-9+/_.=-]+"
    kinds = [
        ("assign", head + value, f"length(regexp_extract(m, '^{head}({value})$', 1)) >= 8"),
        ("access", "AKIA[A-Z0-9]+", "length(m) >= 16"),
        ("hex", "[0-9a-f]+", "length(m) >= 32"),
        ("github", "gh[pousr]_[A-Za-z0-9]+", "length(m) >= 40"),
        ("slack", "xox[abprs]-[A-Za-z0-9-]+", "length(m) >= 15"),
        ("google", "AIza[A-Za-z0-9_-]+", "length(m) >= 39"),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    ]
    parts = " union all ".join(
        f"select doc_id, {i} as k, '{kind}' as kind, m, coalesce(list_sum(list_transform(sp[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as a "
        f"from (select doc_id, sp, ms, unnest(ms) as m, unnest(range(1, len(ms) + 1)) as i from (select doc_id, regexp_extract_all(text, '{p}') as ms, string_split_regex(text, '{p}') as sp from t)) where {ok}"
        for i, (kind, p, ok) in enumerate(kinds)
    )
    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
s as (select doc_id, k, kind, cast(a as bigint) as a, cast(a + length(m) as bigint) as b from ({parts}))
select t.doc_id,
  count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, k) filter (where k < 3), '')) as base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, k) filter (where k is not null), '') as spans
from t left join s on s.doc_id = t.doc_id group by t.doc_id"""


def _op5_sql() -> str:
    return rf"""
with u as (select doc_id, source, size, count(*) as copies, size * count(*) as words from
    (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents) group by doc_id, source, size),
tot as (select source, cast(sum(words) as hugeint) as source_size from u group by source),
s0 as (select *, row_number() over (order by source nulls last) as ix from tot),
s1 as (select *, case (ix - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w from s0),
s2 as (select *, source_size * (10 // w) as ratio, cast(sum(source_size) over () as hugeint) as total, cast(sum(w) over () as hugeint) as all_w from s1),
s3 as (select *, row_number() over (order by ratio, ix) as rk,
    total - coalesce(cast(sum(3 * source_size) over (order by ratio, ix rows between unbounded preceding and 1 preceding) as hugeint), 0) as left_words,
    all_w - coalesce(cast(sum(w) over (order by ratio, ix rows between unbounded preceding and 1 preceding) as hugeint), 0) as left_w from s2),
s4 as (select *, min(case when 3 * source_size * left_w > w * left_words then rk end) over () as first_free from s3),
s5 as (select *, coalesce(rk >= first_free, false) as free, coalesce(min(case when rk = first_free then left_words end) over (), 1) as rest,
    coalesce(min(case when rk = first_free then left_w end) over (), 1) as rest_w from s4),
s6 as (select *, case when free then cast(w * rest as double) / cast(rest_w as double) else cast(3 * source_size as double) end as target,
    case when free then w * rest else 3 * source_size * rest_w end as num from s5),
s7 as (select *, cast(sum(num) over (order by ix rows between unbounded preceding and current row) as hugeint) as cum from s6),
s8 as (select source, ix, cast(source_size as bigint) as source_size, target, cum // rest_w - (cum - num) // rest_w as quota from s7),
p as (select u.*, s8.source_size, s8.target, s8.quota,
    coalesce(sum(u.words) over (partition by s8.ix order by md5('mix:' || coalesce(cast(doc_id as varchar), '')), doc_id, size rows between unbounded preceding and 1 preceding), 0) as place
    from u join s8 on u.source is not distinct from s8.source),
q as (select *, greatest(0, least(quota, place + words) - place) + greatest(0, least(quota, place + source_size + words) - (place + source_size))
    + greatest(0, least(quota, place + 2 * source_size + words) - (place + 2 * source_size)) as all_taken from p)
select doc_id, size, source_size, target, cast(all_taken // copies + case when c < all_taken % copies then 1 else 0 end as bigint) as taken from (select *, unnest(range(copies)) as c from q)"""


_OP2_SQL = """
with v as (select cast(vec_id as bigint) as vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
    where vec_id is not null and embedding is not null and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(cast(x as double)))), true)),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
    from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v))
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20"""

# Brute force over the pairs that share a shingle; components by walking links.
_OP6_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') as ws from documents),
sets as materialized (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as g from w),
t as materialized (select doc_id, unnest(g) as g, len(g) as n from sets),
o as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as both_ from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
l as materialized (select x, y from o where 100 * both_ >= 85 * (nx + ny - both_) union all select y, x from o where 100 * both_ >= 85 * (nx + ny - both_)),
r(doc_id, reach) as (select doc_id, doc_id from sets union select r.doc_id, l.y from r join l on l.x = r.reach)
select sets.doc_id, cast(any_value(len(g)) as bigint) as n_shingles, min(reach) as component_id from sets join r on r.doc_id = sets.doc_id group by sets.doc_id"""


_OP12_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units, sha256('1:' || cast(doc_id as varchar)) as h from documents),
d as (select *, cast(len(units) as bigint) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from t),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from d),
p as (select *, array_to_string(units[1:lo], '') as prefix, array_to_string(units[lo + 1:hi], '') as middle, array_to_string(units[hi + 1:n], '') as suffix from f)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256 from p"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_max_score": op2_max_score,
        "op3_secret_scan": op3_secret_scan,
        "op4_language_id": op4_language_id,
        "op5_source_mix": op5_source_mix,
        "op6_ngram_join": op6_ngram_join,
        "op7_length_packing": op7_length_packing,
        "op8_html_text": op8_html_text,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_quality_rules": op10_quality_rules,
        "op11_whitening": op11_whitening,
        "op12_fill_middle": op12_fill_middle,
        "op13_bpe": op13_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_max_score": _OP2_SQL, "op3_secret_scan": _op3_sql(), "op5_source_mix": _op5_sql(), "op6_ngram_join": _OP6_SQL, "op12_fill_middle": _OP12_SQL}
