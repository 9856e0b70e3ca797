"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A document is a sparse vector of n-gram shares (its counts divided by their number), so its score does not depend on
its length. FTRL-proximal keeps a sum of adjusted gradients and of squared gradients for each bucket and derives the
weight from them on use; L1 keeps most weights at 0. Scoring is one sparse dot product a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Tables, as_bytes, fold, slices
from .word_grams import grams

BITS = 18
#: Labelled rows the model is fitted on, at most: those with the smallest hash of their id. It bounds what the driver holds.
SAMPLE = 6000
#: Bytes of a text that is learned from, at most, and of all texts of a sample: this bounds what the driver holds, whatever the texts. Every text is scored whole.
LONGEST, SAMPLE_BYTES = 1 << 18, 48 << 20
#: Labelled ids that are looked at for each one of the sample, so that others take the place of texts that are too long or not there.
SPARE = 2
EPOCHS = 4
#: FTRL-proximal: learning rate, smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-3, 1e-6
#: Shares are scaled by this before the dot product.
SCALE = 20.0


class Ftrl:
    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _vectors(s, bits: int):
    """For each document of the slice: buckets (distinct) and shares; the last bucket is the bias."""
    doc, bucket = grams(s, bits)
    key, count = np.unique(doc * (1 << bits) + bucket, return_counts=True)
    doc, bucket = key >> bits, key & ((1 << bits) - 1)
    total = np.bincount(doc, weights=count, minlength=s.n)
    cuts = np.searchsorted(doc, np.arange(s.n + 1))
    for i in range(s.n):
        a, b = cuts[i], cuts[i + 1]
        yield np.append(bucket[a:b], 1 << bits), np.append(SCALE * count[a:b] / max(total[i], 1), 1.0)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, keep, most: int) -> DataFrame:
    """(doc_id, text, label): up to `most` labelled documents that keep (a condition on doc_id) allows, by hash of id, while their
    texts have SAMPLE_BYTES at most. An id has one row: of repeated ones, the smallest text, and the smallest label. Texts
    beyond LONGEST bytes are left out, and the next ids take their place (of SPARE times as many as are asked for)."""
    rows = labels.where(keep & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("label"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SPARE * most)
    short = documents.select("doc_id", F.col("text").cast("binary").alias("text")).where(f"text is null or octet_length(text) <= {LONGEST}")
    found = short.join(F.broadcast(rows), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    found = Tables(documents.sparkSession, "sample").put(found.withColumn("_hash", F.xxhash64("doc_id")), label)
    upto = W.orderBy("_hash", "doc_id")  # over ids and lengths of SPARE * most rows
    sizes = found.select("doc_id", F.row_number().over(upto).alias("_no"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(upto).alias("_bytes"))
    chosen = sizes.where((F.col("_no") <= most) & (F.col("_bytes") <= SAMPLE_BYTES)).select("doc_id")
    return found.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def train(documents: DataFrame, labels: DataFrame, keep=None, bits: int = BITS, sample: int = SAMPLE) -> np.ndarray:
    """Weights of all buckets and, last, the bias. keep: a condition on labels.doc_id. Without usable labels all are 0."""

    def vectors(batches):
        for batch in batches:
            at, xs = [], []
            for s in slices(as_bytes(batch.column(1))):
                for a, x in _vectors(s, bits):
                    at.append(a.astype(np.int32)), xs.append(x.astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([x.tobytes() for x in xs], pa.binary())], names=["doc_id", "label", "at", "x"])

    rows = labelled_sample(documents, labels, "quality", F.lit(True) if keep is None else keep, sample)
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(vectors, f"doc_id {kind}, label int, at binary, x binary").toArrow()
    ids, label, at, x = rows["doc_id"], rows["label"].to_pylist(), _views(rows["at"], np.int32), _views(rows["x"], np.float32)
    model = Ftrl((1 << bits) + 1)
    order, by_id = np.random.default_rng(9), pc.sort_indices(ids).to_numpy()
    for _ in range(EPOCHS):
        for i in by_id[order.permutation(len(by_id))]:
            model.learn(at[i], x[i], label[i])
    del rows, ids, at, x
    pa.default_memory_pool().release_unused()  # the driver goes on without the sample
    return model.weights().astype(np.float32)


def _views(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The values of a binary column as arrays that lie where Arrow has them."""
    out, size = [], np.dtype(kind).itemsize
    for chunk in column.cast(pa.binary()).chunks:
        ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else ()
        out += [np.frombuffer(chunk.buffers()[2], kind, (b - a) // size, a) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def _probabilities(s, weights: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each document of the slice: the sparse dot product of its shares and the weights."""
    doc, bucket = grams(s, (len(weights) - 1).bit_length() - 1)
    n = np.bincount(doc, minlength=s.n)
    x = SCALE * np.bincount(doc, weights=weights[bucket], minlength=s.n) / np.maximum(n, 1) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score (probability of label 1) of every document, from its whole text; null and empty texts get the bias alone."""
    w = documents.sparkSession.sparkContext.broadcast(weights)

    def dot(batches):
        for batch in batches:
            out = [np.zeros(0)]
            for s in slices(as_bytes(batch.column(1))):
                out.append(_probabilities(s, w.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(dot, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Scores of all documents by a model that never saw rows with crc32(doc_id) mod 5 = 0: doc_id, held_out, score, predicted.

    Labels that are null or not 0/1 are not learned; of a repeated id the smaller label counts. Extra columns are not read.
    """
    weights = train(documents, labels, fold("doc_id", 5) != 0)
    out = score(documents, weights)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of documents whose text scores at least the threshold, all columns; trained on all labels."""
    w = documents.sparkSession.sparkContext.broadcast(train(documents, labels))
    at = documents.columns.index("text")

    def keep(batches):
        for batch in batches:
            chosen = [np.zeros(0, bool)]
            for s in slices(as_bytes(batch.column(at))):
                chosen.append(_probabilities(s, w.value) >= threshold)
            yield batch.filter(pa.array(np.concatenate(chosen)))

    return documents.mapInArrow(keep, documents.schema)
