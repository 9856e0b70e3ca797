"""Toxicity: a support vector machine on a gap-weighted subsequence kernel, with Nystroem landmarks.

Units of a sentence are its words; runs of single letters ("i d i o t") are one unit. The kernel compares two units by
the subsequences of three characters they share, each weighted by LAMBDA per character that it spans and with up to two
characters skipped between its members, so inserted letters and gaps leave most of it; signs and digits within a
word are skipped. Units carry
marks at both ends. Kernel values are divided by both units' norms to the power NORM, so longer units count a little more.

The machine works on the Nystroem features of a unit: its kernel with each landmark, times the inverse root of the
landmarks' kernel. A sentence is as toxic as its worst units are, and a text as its sentences, so training is by
witnesses: of a toxic text, the units that the current machine finds worst; of clean texts, all units, the hardest ones
found again in every round. The probability comes from a text's WORST largest values by logistic regression (by chance
some invented word of a clean text may look like an insult, two hardly do).

The kernel is a dot product over subsequences. All landmarks' weights therefore fold into one table with an entry for
each subsequence, exactly; scoring a text is a sum over table entries, whatever the number of landmarks.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fold, received, send
from .quality_classifier import labelled_sample

#: Characters are told apart by 6 bits; a subsequence is three of them.
ALPHABET = 64
LAMBDA = 0.8
GAPS = (1, 2, 3)
#: Labelled rows that are learned from, at most (toxic, clean), by hash of their ids; landmarks.
SAMPLE = (2000, 2500)
LANDMARKS = 400
ROUNDS = 4
#: Units of a toxic text that are learned as toxic; worst units that a text's probability looks at, and what their values are cut to.
WITNESSES, WORST = 4, 2
LOW, HIGH = -2.0, 2.0
#: Weight of a toxic unit with an inserted letter; clean ones have 1.
GAPPED = 0.1
#: Power of a unit's norm that its kernel values are divided by.
NORM = 0.5
#: Bytes that are scored together.
TOGETHER = 1 << 17

_MARK = 1
_JUNK = re.compile(r"[!-@\[-`{-~]+")


def _code(c: int) -> int:
    """A character's number: 0 space, 1 end mark, 2-27 letters, 28 digits, 29-31 other ASCII, 32-63 other letters by their lower case."""
    x = chr(c)
    if x in " \t\n\v\f\r":
        return 0
    if x.isascii():
        if x.isalpha():
            return ord(x.lower()) - 95
        return 28 if x.isdigit() else 29 + c % 3
    low = x.lower()
    return 32 + ord(low[0]) % 32


_CODES = np.array([_code(c) for c in range(0x250)], np.uint8)


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = (32 + points % 32).astype(np.uint8)
    low = points < len(_CODES)
    out[low] = _CODES[points[low]]
    return out


class Units:
    """Units of texts: their characters, one after another with a mark at both ends, and each unit's text."""

    def __init__(self, texts: list[str]):
        codes = encode("\n".join(texts) + "\n")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        ends = np.cumsum(lengths)
        # Other characters of a word than letters are left out, not taken for ends.
        at = np.flatnonzero((codes < 28) | (codes > 31))
        codes, ends = codes[at], np.searchsorted(at, ends)
        letter = codes != 0
        edge = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc = np.searchsorted(ends, start, "right")
        single = end - start == 1
        joined = np.zeros(len(start), bool)
        joined[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
        unit = np.cumsum(~joined) - 1
        self.n = int(unit[-1]) + 1 if len(unit) else 0
        self.doc = doc[~joined]
        size = np.bincount(unit, weights=end - start, minlength=self.n).astype(np.int64)
        self.first = np.cumsum(size + 2) - (size + 2)
        self.size = size + 2
        self.codes = np.full(int(self.size.sum()), _MARK, np.uint8)
        of_char = np.repeat(unit, end - start)
        self.codes[np.arange(len(of_char)) + 2 * of_char + 1] = codes[letter]
        self.unit = np.repeat(np.arange(self.n), self.size)

    def triples(self):
        """For each choice of gaps: (subsequence, weight, unit)."""
        c, u = self.codes.astype(np.int32), self.unit
        for g in GAPS:
            for h in GAPS:
                n = len(c) - g - h
                if n <= 0:
                    continue
                at = np.flatnonzero(u[g + h :] == u[:n])
                yield (c[at] * ALPHABET + c[at + g]) * ALPHABET + c[at + g + h], np.float32(LAMBDA ** (g + h)), u[at]

    def apply(self, table: np.ndarray) -> np.ndarray:
        """Sum over each unit's subsequences of weight times table entry, over the unit's norm."""
        total = np.zeros(self.n)
        for s, w, u in self.triples():
            total += w * np.bincount(u, weights=table[s], minlength=self.n)
        return total / self.norms()

    def norms(self) -> np.ndarray:
        """What kernel values are divided by: the unit's norm (of subsequences taken by place) to the power NORM."""
        total = np.zeros(self.n)
        for s, w, u in self.triples():
            total += float(w) ** 2 * np.bincount(u, minlength=self.n)
        return np.maximum(total, 1e-12) ** (NORM / 2)


def _kernel(units: Units, marks: np.ndarray, column: np.ndarray, block: int = 1000) -> np.ndarray:
    """Kernel of each unit with each landmark. marks: the landmarks' subsequences (rows) by column; column: of each subsequence, or -1."""
    norm, out = units.norms(), np.zeros((units.n, len(marks)))
    triples = [(column[s], w, u) for s, w, u in units.triples()]
    for a in range(0, units.n, block):
        dense = np.zeros((min(block, units.n - a), marks.shape[1]), np.float32)
        for c, w, u in triples:
            lo, hi = np.searchsorted(u, (a, a + block))
            known = c[lo:hi] >= 0
            np.add.at(dense, (u[lo:hi][known] - a, c[lo:hi][known]), w)
        out[a : a + len(dense)] = (dense @ marks.T) / norm[a : a + len(dense), None]
    return out


def _marks(units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised subsequences of landmarks (rows), the subsequences that columns stand for, and each one's column."""
    keys = np.unique(np.concatenate([s for s, _, _ in units.triples()]))
    column = np.full(ALPHABET**3, -1, np.int64)
    column[keys] = np.arange(len(keys))
    dense = np.zeros((units.n, len(keys)), np.float32)
    for s, w, u in units.triples():
        np.add.at(dense, (u, column[s]), w)
    return dense / units.norms()[:, None].astype(np.float32), keys, column


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton's method on the rows within the margin."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x1.shape[1]), np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        a = x1[inside]
        k = c * weight[inside]
        new = np.linalg.solve(ridge + (a * k[:, None]).T @ a, (a * (k * y[inside])[:, None]).sum(axis=0))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, the last for a column of ones, by Newton's method. share: what each row counts."""
    ridge, w = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6]), np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (share * (y - p)) - ridge @ w)
        w = w + step * min(1.0, 5 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """table: what each subsequence adds; bias; slope and offset: from the worst units' values to a probability."""

    def __init__(self):
        self.table, self.bias = np.zeros(ALPHABET**3, np.float32), -1.0
        self.slope, self.offset = np.zeros(WORST), -3.0

    def worst(self, texts: list[str]) -> np.ndarray:
        """The WORST largest values of each text's units, each within [LOW, HIGH]; LOW where there are fewer."""
        out = np.full((len(texts), WORST), LOW)
        u = Units(texts)
        if u.n:
            v = np.clip(u.apply(self.table) + self.bias, LOW, HIGH)
            order = np.lexsort((-v, u.doc))
            doc, v = u.doc[order], v[order]
            place = np.arange(len(doc)) - np.searchsorted(doc, doc)
            for k in range(WORST):
                at = place == k
                out[doc[at], k] = v[at]
        return out

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(worst @ self.slope + self.offset, -35, 35)))


def _words_of(text: str) -> list[str]:
    """Units of a text as strings, runs of single letters joined."""
    out, run = [], ""
    for w in _JUNK.sub("", text).split():
        if len(w) == 1:
            run += w
            continue
        if run:
            out.append(run)
            run = ""
        out.append(w)
    return [*out, run] if run else out


def train(texts: list[str], labels: list[int], clean_share: float = 1.0, seed: int = 1) -> Model:
    """Fits the machine on labelled texts; without both labels, one that scores everything alike. clean_share: how many
    clean texts stand behind each one here, for every toxic text behind each toxic one; it sets the probability's level."""
    model = Model()
    toxic = [i for i, y in enumerate(labels) if y == 1]
    clean = [i for i, y in enumerate(labels) if y == 0]
    if not toxic or not clean:
        return model
    rng = np.random.default_rng(seed)
    bags = [sorted({w.lower() for w in _words_of(t)}) for t in texts]
    in_toxic: dict[str, int] = {}
    in_clean: dict[str, int] = {}
    for i, bag in enumerate(bags):
        counts = in_toxic if labels[i] == 1 else in_clean
        for w in bag:
            counts[w] = counts.get(w, 0) + 1
    # First witnesses: words that toxic texts hold much more often.
    rate = len(clean) / len(toxic)
    odds = lambda w: (in_toxic.get(w, 0) * rate) / (in_clean.get(w, 0) + 1 + 0.5 * rate)
    clean_units = sorted(in_clean)
    everything = Units(clean_units)
    bag_units = {i: Units(bags[i]) for i in toxic if bags[i]}
    hard = [clean_units[i] for i in rng.choice(len(clean_units), min(3000, len(clean_units)), replace=False)]
    frequent = sorted(in_clean, key=lambda w: (-in_clean[w], w))[:500]
    witness = {i: [w for w in sorted(bags[i], key=lambda w: (-odds(w), w))[:WITNESSES] if odds(w) >= 5] for i in bag_units}
    worst_clean: list[str] = []
    for turn in range(ROUNDS):
        positive = sorted({w for ws in witness.values() for w in ws})
        if not positive:
            return model
        negative = sorted({*hard, *frequent} - set(positive))
        pick = lambda xs, n: [xs[i] for i in sorted(rng.choice(len(xs), min(len(xs), n), replace=False))]
        landmarks = pick(positive, LANDMARKS // 2) + pick([w for w in (worst_clean or negative) if w not in positive], LANDMARKS // 4) + pick(negative, LANDMARKS // 4)
        marks, keys, column = _marks(Units(landmarks))
        value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        root = vector * (1 / np.sqrt(np.maximum(value, 1e-3 * value.max())))[None, :] @ vector.T
        # Toxic units are learned as they are, and with a letter inserted.
        gapped = [w[:j] + chr(97 + int(rng.integers(26))) + w[j:] for w in positive if len(w) > 3 for j in [int(rng.integers(2, len(w) - 1))]]
        gapped = [w for w in gapped if w not in in_clean]
        x = _kernel(Units(positive + gapped + negative), marks, column) @ root
        y = np.array([1.0] * (len(positive) + len(gapped)) + [-1.0] * len(negative))
        share = np.concatenate([np.full(len(positive), len(negative) / (4 * len(positive))), np.full(len(gapped), GAPPED), np.ones(len(negative))])
        beta, bias = _svm(x, y, share)
        model.table = np.zeros(ALPHABET**3, np.float32)
        model.table[keys] = (root @ beta) @ marks  # each subsequence gets its sum over the landmarks
        model.bias = bias
        values = everything.apply(model.table) + bias
        worst_clean = [clean_units[i] for i in np.argsort(-values, kind="stable")[:1500]]
        hard = sorted({*hard, *worst_clean})
        bar = max(0.0, float(np.quantile(values, 0.999)))
        for i, u in bag_units.items():
            v = u.apply(model.table) + bias
            witness[i] = [bags[i][j] for j in np.argsort(-v, kind="stable")[:WITNESSES] if v[j] > bar]
    # Probability: logistic regression of the label on the worst units' values.
    x = np.concatenate([model.worst(texts[a : a + 100]) for a in range(0, len(texts), 100)])
    x, y = np.column_stack([x, np.ones(len(x))]), np.array(labels, float)
    used = np.ones(WORST + 1, bool)
    while True:  # a value that would count against toxicity is left out
        w = np.zeros(WORST + 1)
        w[used] = _logistic(x[:, used], y, np.where(y > 0, 1.0, clean_share))
        if (w[:-1] >= 0).all():
            break
        used[int(w[:-1].argmin())] = False
    model.slope, model.offset = w[:-1], float(w[-1])
    return model


def learn(documents: DataFrame, labels: DataFrame, keep, sample: tuple[int, int] = SAMPLE) -> Model:
    """Trains on a bounded sample of labelled rows."""
    there = {r["toxic"]: r["count"] for r in labels.where(keep & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    texts, ys = [], []
    for label in (1, 0):
        rows = labelled_sample(documents, labels.where(F.col("toxic") == label), "toxic", keep, sample[0 if label else 1]).toArrow().sort_by("doc_id")
        texts += [b"" if t is None else t for t in rows["text"].to_pylist()]
        ys += rows["label"].to_pylist()
    toxic, clean = sum(ys), len(ys) - sum(ys)
    share = (there.get(0, 0) / clean) / (there.get(1, 0) / toxic) if toxic and clean else 1.0
    return train([t.decode("utf-8", "replace") for t in texts], ys, share)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability that a text is toxic) of every document, over all units of its whole text."""
    var = send(documents.sparkSession, model)

    def run(batches):
        m = received(var)
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in as_bytes(batch.column(1))]
            worst, lo, size = [np.zeros((0, WORST))], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= TOGETHER or i + 1 == len(texts):
                    worst.append(m.worst(texts[lo : i + 1]))
                    lo, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.probability(np.concatenate(worst)))], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by a machine that never saw rows with crc32(doc_id) mod 3 = 1.

    Empty and null texts get the score of a text without any suspicious unit. Labels that are null or not 0/1 are not
    learned; of a repeated id the smaller label counts. Only text is scored; extra columns are not read. Texts are scored whole, some
    at a time; rows that repeat are scored each. Without labels of both kinds all texts score alike; no documents give no rows.
    """
    out = score(documents, learn(documents, labels, fold("doc_id", 3) != 1))
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
