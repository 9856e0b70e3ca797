"""Language identification with a bidirectional gated recurrent network over bytes, trained in numpy.

Texts are read in windows of WINDOW bytes, many windows in step. Two gated recurrent layers run over a window, forwards
and backwards; a softmax over both states labels every byte, and a document's probabilities are the mean over all its
bytes. Gates and states use piecewise linear activations (clipped lines), which numpy computes fastest. Training is
backpropagation through time over labelled windows, with Adam.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_bytes, fold, received, send

WINDOW, HIDDEN = 64, 8
#: The labelled sample: documents by language (in all at most SAMPLE), and windows of each.
PER_LANGUAGE, SAMPLE, WINDOWS = 800, 32000, 6
STEPS, BATCH, RATE = 500, 256, 0.01
#: Windows that are computed together.
TOGETHER = 2048

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.clip(x * np.float32(0.25) + np.float32(0.5), 0, 1)


class Net:
    """wx: what each byte adds to the two gates and the candidate; wh: what the state adds; one pair for each direction."""

    def __init__(self, langs: list[str], seed: int = 4):
        rng, h = np.random.default_rng(seed), HIDDEN
        self.langs = langs
        self.p = {}
        for d in "fb":
            self.p[f"wx{d}"] = rng.normal(0, 0.4, (256, 3 * h)).astype(np.float32)
            self.p[f"wh{d}"] = rng.normal(0, 0.4, (h, 3 * h)).astype(np.float32)
        self.p["wo"] = rng.normal(0, 0.4, (2 * h, len(langs))).astype(np.float32)
        self.p["bo"] = np.zeros(len(langs), np.float32)

    def run(self, x: np.ndarray, direction: str, keep: list | None = None) -> np.ndarray:
        """States (time, window, hidden) of x (window, time)."""
        wx, wh, n = self.p[f"wx{direction}"], self.p[f"wh{direction}"], HIDDEN
        h = np.zeros((len(x), n), np.float32)
        out = np.empty((x.shape[1], len(x), n), np.float32)
        steps = range(x.shape[1]) if direction == "f" else range(x.shape[1] - 1, -1, -1)
        for t in steps:
            from_x, from_h = wx[x[:, t]], h @ wh
            gates = _sigmoid(from_x[:, : 2 * n] + from_h[:, : 2 * n])
            z, r = gates[:, :n], gates[:, n:]
            raw = from_x[:, 2 * n :] + r * from_h[:, 2 * n :]
            c = np.clip(raw, -1, 1)
            if keep is not None:
                keep.append((t, h, gates, raw, from_h[:, 2 * n :]))
            h = c + z * (h - c)
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, window, language) for every byte of the windows."""
        n = HIDDEN
        logits = self.run(x, "f") @ self.p["wo"][:n] + self.run(x, "b") @ self.p["wo"][n:] + self.p["bo"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over bytes, and its gradients by backpropagation through time."""
        n, (b, steps) = HIDDEN, x.shape
        kept = {d: [] for d in "fb"}
        states = {d: self.run(x, d, kept[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        logits = both @ self.p["wo"] + self.p["bo"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        hit = p[:, np.arange(b), y]
        d_logits = p
        d_logits[:, np.arange(b), y] -= 1
        d_logits /= b * steps
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["wo"] = both.reshape(-1, 2 * n).T @ d_logits.reshape(-1, len(self.langs))
        g["bo"] = d_logits.sum(axis=(0, 1))
        d_both = d_logits @ self.p["wo"].T
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            wh, carry = self.p[f"wh{d}"], np.zeros((b, n), np.float32)
            for t, h, gates, raw, from_h in reversed(kept[d]):
                z, r = gates[:, :n], gates[:, n:]
                c = np.clip(raw, -1, 1)
                dh = carry + d_both[t][:, part]
                d_raw = dh * (1 - z) * (np.abs(raw) < 1)
                d_gates = np.concatenate([dh * (h - c), d_raw * from_h], axis=1) * np.float32(0.25) * ((gates > 0) & (gates < 1))
                d_from_h = np.concatenate([d_gates, d_raw * r], axis=1)
                np.add.at(g[f"wx{d}"], x[:, t], np.concatenate([d_gates, d_raw], axis=1))
                g[f"wh{d}"] += h.T @ d_from_h
                carry = dh * z + d_from_h @ wh.T
        return float(-np.log(np.maximum(hit, 1e-9)).mean()), g


def fit(windows: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 4) -> Net | None:
    """Trains on windows (rows of WINDOW bytes) with their languages, every language equally often."""
    langs = sorted(set(labels))
    if not langs:
        return None
    net, rng = Net(langs, seed), np.random.default_rng(seed)
    of = [np.flatnonzero(np.array(labels) == lang) for lang in langs]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, len(langs), BATCH)
        x = windows[[rng.choice(of[i]) for i in y]]
        _, g = net.gradients(x, y)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v / max(1.0, norm)
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            net.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _cut(text: bytes) -> np.ndarray:
    """The windows of a text; the last is filled up with spaces."""
    n = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(n * WINDOW), np.uint8).reshape(n, WINDOW)


def labelled_windows(documents: DataFrame, keep) -> tuple[np.ndarray, list[str]]:
    """A bounded sample: windows of labelled documents (keep is a condition on them), the same on every run. Of rows that
    repeat an id and a language, the smallest text is looked at."""
    rows = documents.where(keep & F.col("lang").isNotNull()).select("doc_id", "lang")
    n_langs = max(1, rows.select("lang").distinct().count())
    each = max(1, min(PER_LANGUAGE, SAMPLE // n_langs) // 8)
    by = W.partitionBy("lang", "salt").orderBy("h", "doc_id")
    rows = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("salt", F.pmod("h", F.lit(8))).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= each)
    ids = rows.select("doc_id", "lang").limit(SAMPLE + 8 * n_langs).distinct()
    texts = documents.select("doc_id", "lang", F.col("text").cast("binary").alias("text")).join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def pick(batches):
        for batch in batches:
            out = []
            for i, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), strict=True):
                if len(text) < 8:
                    continue
                cut = _cut(text)
                for j in np.random.default_rng(len(text)).choice(len(cut), min(WINDOWS, len(cut)), replace=False):
                    out.append((str(i), lang, cut[j].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.string(), pa.string(), pa.binary()))], names=["id", "lang", "x"])

    got = texts.mapInArrow(pick, "id string, lang string, x binary").toArrow().sort_by([("id", "ascending"), ("lang", "ascending"), ("x", "ascending")])
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return x, got["lang"].to_pylist()


def has_letter(text: bytes) -> bool:
    if _LETTER[np.frombuffer(text, np.uint8)].any():
        return True
    return not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def pooled(net: Net, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each text's bytes; every byte of every text is read."""
    total = np.zeros((len(texts), len(net.langs)))
    cuts, owner, size = [], [], 0

    def flush():
        x = np.concatenate(cuts)
        p = net.probabilities(x)
        own = np.concatenate(owner)
        real = np.arange(WINDOW)[:, None] < np.concatenate(left)[None, :]
        sums = (p * real[:, :, None]).sum(axis=0)
        for c in range(len(net.langs)):
            total[:, c] += np.bincount(own, weights=sums[:, c], minlength=len(texts))

    left: list[np.ndarray] = []
    for i, text in enumerate(texts):
        if not text:
            continue
        cut = _cut(text)
        for a in range(0, len(cut), TOGETHER):
            part = cut[a : a + TOGETHER]
            cuts.append(part), owner.append(np.full(len(part), i))
            left.append(np.minimum(WINDOW, len(text) - WINDOW * np.arange(a, a + len(part))))
            size += len(part)
            if size >= TOGETHER:
                flush()
                cuts.clear(), owner.clear(), left.clear()
                size = 0
    if size:
        flush()
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a network that never saw rows with crc32(doc_id) mod 3 = 1.

    lang_pred is a language of the labelled sample; `und` with score 0 where the text is null or has no letter (or no
    row is labelled). The score is the pooled probability of lang_pred. Only text and, in training, lang are read.
    Texts are read whole, in windows; rows that repeat are labelled each, of equal probabilities the first language by name
    wins. No documents give no rows.
    """
    x, labels = labelled_windows(documents, fold("doc_id", 3) != 1)
    net_var = send(documents.sparkSession, fit(x, labels))

    def run(batches):
        net = received(net_var)
        for batch in batches:
            texts = as_bytes(batch.column(1))
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            if net is not None:
                p = pooled(net, texts)
                for i, t in enumerate(texts):
                    if has_letter(t):
                        best = int(p[i].argmax())
                        lang[i], score[i] = net.langs[best], float(p[i, best])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out = documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
