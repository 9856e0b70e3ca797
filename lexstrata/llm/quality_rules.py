"""Quality rules: countable properties of each text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-gram buckets are counted over whole tables: the raw corpus (every document) and the
trusted target (documents labelled as good). A document's score is the mean over its n-grams of
log(p_target / p_raw), so it does not grow with length, and one fixed threshold decides for every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, Slice, SpanHash, as_bytes, chained, per_doc, slices, words
from .word_grams import grams

#: log2 of the number of buckets. The counts that reach the driver are two vectors of this size.
BITS = 16
#: Documents whose mean log-ratio is below this are dropped.
THRESHOLD = -0.5
#: N-grams that the raw corpus lends the target: with few trusted documents, ratios stay near 0.
PRIOR = 1 << BITS
#: Labelled ids up to this number (8 bytes each) are sent to every executor; more are joined by a shuffle.
BROADCAST_IDS = 4_000_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _repeats(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each (doc, key): does it occur twice or more; is it not the first."""
    order = np.lexsort((key, doc))  # stable, so equal ones stay in the text's order
    d, k = doc[order], key[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    out = np.empty((2, len(d)), bool)
    out[0, order], out[1, order] = twice, same
    return out[0], out[1]


def base_counts(s: Slice) -> dict[str, np.ndarray]:
    d, n = s.data, s.n
    start, end, doc = words(s)
    hash_of = SpanHash(d)
    first_byte = (d & 0xC0) != 0x80
    chars = np.flatnonzero(first_byte & ~SPACE[d])
    out = {"n_words": per_doc(doc, n), "word_chars": per_doc(s.doc_of(chars), n), "n_symbols": per_doc(s.doc_of(np.flatnonzero(_SYMBOL[d])), n)}
    # Lines: every slice ends its documents with a newline of its own, so a line is what stands between newlines.
    line_end = np.flatnonzero(d == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1))
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_doc = s.doc_of(line_start)
    later = _repeats(line_doc, hash_of(line_start, line_end))[1] if len(line_doc) else np.zeros(0, bool)
    out["n_dup_lines"] = per_doc(line_doc[later], n)
    covered = np.zeros(len(start) + 3, bool)
    if len(start) >= 3:
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        twice = inside[_repeats(doc[inside], chained(hash_of(start, end), 3)[inside])[0]]
        for i in range(3):
            covered[twice + i] = True
    out["n_repeat_words"] = per_doc(doc[covered[: len(doc)]], n)
    return out


def mark_labelled(documents: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """documents (doc_id, text) with a boolean column: is doc_id among ids (one column, distinct, not null)?

    Integral ids are sent as one sorted array and looked up in it, if they are not too many; others are joined by shuffle."""
    integral = all(d.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long") for d in (documents, ids))
    if not integral or ids.limit(BROADCAST_IDS + 1).count() > BROADCAST_IDS:
        return documents.join(ids.withColumn(flag, F.lit(True)), "doc_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    known = np.sort(ids.select(F.col("doc_id").cast("long")).toArrow()[0].to_numpy())
    held = documents.sparkSession.sparkContext.broadcast(known)

    def mark(batches):
        for batch in batches:
            column = batch.column(0)
            x = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            found = np.zeros(len(x), bool)
            if len(held.value):
                found = held.value[np.minimum(np.searchsorted(held.value, x), len(held.value) - 1)] == x
            found &= column.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, flag])

    return documents.mapInArrow(mark, T.StructType([*documents.schema.fields, T.StructField(flag, T.BooleanType())]))


def multinomials(documents: DataFrame, labels: DataFrame, bits: int = BITS) -> np.ndarray:
    """log(p_target / p_raw) of every bucket, from all documents; all 0 if no document is trusted.

    Raw counts are smoothed by one. The target's are smoothed by PRIOR n-grams shared out as the raw corpus has them, so a
    bucket of which the target says nothing has the same ratio however rare it is, and ratios tend to 0 as evidence does."""
    good = labels.where("quality = 1").select("doc_id").where("doc_id is not null").distinct()
    marked = mark_labelled(documents.select("doc_id", "text"), good, "trusted").select("trusted", F.col("text").cast("binary").alias("text"))

    def count(batches):
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            trusted = batch.column(0).to_numpy(zero_copy_only=False)
            for s in slices(as_bytes(batch.column(1))):
                doc, bucket = grams(s, bits)
                total[0] += np.bincount(bucket, minlength=1 << bits)
                total[1] += np.bincount(bucket[trusted[s.lo : s.hi][doc]], minlength=1 << bits)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "raw", "target"])

    rows = marked.mapInArrow(count, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    counts = np.zeros((2, 1 << bits))
    for i, name in enumerate(("raw", "target")):
        counts[i, rows["bucket"].to_numpy(np.int64)] += rows[name].to_numpy(np.float64)
    raw = (counts[0] + 1) / (counts[0].sum() + (1 << bits))
    return np.log((counts[1] / raw + PRIOR) / (counts[1].sum() + PRIOR)).astype(np.float32)


def quality_rules(documents: DataFrame, labels: DataFrame, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, llr (mean log-ratio; 0 without words) and kept, a row per document.

    Null texts have no words. Labels may be empty (then llr is 0 everywhere), null or repeated; other columns are not read.
    """
    ratio = documents.sparkSession.sparkContext.broadcast(multinomials(documents, labels, bits))

    def score(batches):
        for batch in batches:
            parts = []
            for s in slices(as_bytes(batch.column(1))):
                counts = base_counts(s)
                doc, bucket = grams(s, bits)
                total, n = np.bincount(doc, weights=ratio.value[bucket], minlength=s.n), np.bincount(doc, minlength=s.n)
                parts.append([*counts.values(), total / np.maximum(n, 1)])
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", *counts, "llr"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out = documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(score, f"doc_id {kind}, {SCHEMA}, llr double")
    out = out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
