"""Byte-level BPE encoding and decoding in numpy, many words at a time.

A text is split at special tokens and then into words; words that a task has met before are looked up. The symbols of all
new words of a slice lie in one flat array. A round gives every pair of neighbours its rank by binary search over the sorted keys of
all pairs, finds the lowest rank of each word and merges its places from the left; words without a pair are done. Very
long words take their pairs in order of rank instead, so that a round costs what it merges.

The vocabulary is a file of the tokenizers library: byte-level BPE without normaliser. The driver reads it and sends
sorted arrays, a few bytes an entry, to all tasks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Letters and numbers that the regex module knows and the tokenizers library, whose Unicode tables are older, takes for unassigned.
LATER = (
    "0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
UNKNOWN = re.compile("[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in LATER.split()) + "]")
FIRST_LATER = 0x558
#: A code point that is unassigned in all versions.
UNASSIGNED = "\u0378"

#: Words that are encoded together, and characters of a text above which its words are read in several turns.
TOGETHER = 1 << 17
#: Bytes of text that are looked at together.
TEXTS = 1 << 20
#: Bytes of a word above which pairs are merged in order of rank.
LONG = 2048
#: Bytes of distinct words that a task remembers.
KNOWN = 16 << 20
#: Ids that are decoded at once.
IDS = 1 << 19
NONE = np.iinfo(np.int32).max


@dataclass
class Vocabulary:
    """byte_id: the id of each byte. keys: left id * 2^32 + right id of all pairs, sorted; rank and merged: of these. at and
    pieces: the bytes of id i are pieces[at[i]:at[i + 1]]. specials: texts of special tokens, and their ids."""

    byte_id: np.ndarray
    keys: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    at: np.ndarray
    pieces: np.ndarray
    specials: list
    special_ids: list

    def plain(self) -> dict:
        """What can be sent to workers that have no copy of this class."""
        return {f.name: getattr(self, f.name) for f in fields(self)}


def byte_characters() -> dict[str, int]:
    """The character that vocabulary files write for each byte: itself where it is printable in Latin-1, else the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> Vocabulary:
    """Reads a tokenizer file. Settings beyond plain byte-level BPE raise ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type") != "BPE" or odd or spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    added = spec.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("special tokens have to be matched as they are")
    chars, ids = byte_characters(), model["vocab"]
    pieces = {i: bytes(chars[c] for c in s) for s, i in ids.items()} | {t["id"]: t["content"].encode() for t in added}
    lengths = np.zeros(max(pieces) + 1, np.int64)
    lengths[list(pieces)] = [len(p) for p in pieces.values()]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
    merged = np.array([ids[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    byte_id = np.zeros(256, np.int64)
    for c, b in chars.items():
        byte_id[b] = ids[c]
    specials = sorted(added, key=lambda t: (-len(t["content"]), t["content"]))
    return Vocabulary(byte_id, keys[order], order.astype(np.int32), merged[order], np.concatenate([[0], np.cumsum(lengths)]), np.frombuffer(b"".join(pieces[i] for i in sorted(pieces)), np.uint8), [t["content"] for t in specials], [t["id"] for t in specials])


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places start..start+length of each, in order."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


class _Numbers(dict):
    """Numbers new keys as they come."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Bpe:
    """Encodes and decodes with one vocabulary; remembers the words it has met, up to KNOWN bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.by_rank = np.zeros(len(vocabulary.keys), np.int64)
        self.by_rank[vocabulary.rank] = vocabulary.merged
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.specials))) if vocabulary.specials else None
        self.special_id = dict(zip(vocabulary.specials, vocabulary.special_ids, strict=True))
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.size, self.ids, self.start, self.length = 0, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    # -- merging

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search; NONE where it is no pair of the vocabulary."""
        if not len(self.v.keys):
            return np.full(len(left), NONE, np.int32)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.v.keys, key), len(self.v.keys) - 1)
        return np.where(self.v.keys[at] == key, self.v.rank[at], NONE).astype(np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.v.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        long = lengths > LONG
        parts, owner = [], []
        for w, at in zip(np.flatnonzero(long), (np.cumsum(lengths) - lengths)[long], strict=True):
            parts.append(self._by_rank(ids[at : at + lengths[w]]))
            owner.append(np.full(len(parts[-1]), w))
        some = ~long & (lengths > 0)
        for out, of in self._rounds(ids[np.repeat(some, lengths)], np.repeat(np.flatnonzero(some), lengths[some])):
            parts.append(out), owner.append(of)
        if not parts:
            return np.zeros(0, np.uint32), lengths
        owner = np.concatenate(owner)
        return np.concatenate(parts)[np.argsort(owner, kind="stable")].astype(np.uint32), np.bincount(owner, minlength=len(words))

    def _rounds(self, ids: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges the lowest-ranked pair of every word, round by round; yields the symbols of words that are done, and their words."""
        rank = np.full(len(ids), NONE, np.int32)  # of the pair that begins here
        rank[:-1] = np.where(word[:-1] == word[1:], self.ranks(ids[:-1], ids[1:]), NONE)
        while len(ids):
            starts = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.append(starts, len(ids))))
            open_ = lowest != NONE
            if not open_.all():
                yield ids[~open_], word[~open_]
                ids, word, rank, lowest = ids[open_], word[open_], rank[open_], lowest[open_]
                if not len(ids):
                    return
            at = np.flatnonzero(rank == lowest)
            at = at[self._apart(at)]
            ids[at] = self.by_rank[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, word, rank = ids[stay], word[stay], rank[stay]
            at = at - np.arange(len(at))
            new = np.concatenate([at, at[at > 0] - 1])
            last = new == len(ids) - 1
            next_ = np.where(last, new, new + 1)
            rank[new] = np.where(~last & (word[new] == word[next_]), self.ranks(ids[new], ids[next_]), NONE)

    @staticmethod
    def _apart(at: np.ndarray) -> np.ndarray:
        """Of ascending places, those that are merged: in a run of neighbours every other one, from its left end."""
        first = np.concatenate([[True], at[1:] != at[:-1] + 1])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        return (np.arange(len(at)) - begin) % 2 == 0

    def _by_rank(self, ids: np.ndarray) -> np.ndarray:
        """Merges one long word: pairs wait by rank, and a round takes all places of the lowest rank that is there."""
        ids, n = ids.copy(), len(ids)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        rank = np.full(n, NONE, np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(at: np.ndarray) -> None:
            at = at[(at >= 0)]
            at = np.unique(at[alive[at]])
            rank[at] = NONE
            at = at[after[at] < n]
            rank[at] = self.ranks(ids[at], ids[after[at]])
            at = at[rank[at] != NONE]
            if not len(at):
                return
            by = np.argsort(rank[at], kind="stable")
            at, r = at[by], rank[at[by]]
            cuts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            for a, b in zip(cuts, [*cuts[1:], len(r)], strict=True):
                if int(r[a]) not in waiting:
                    waiting[int(r[a])] = []
                    heapq.heappush(heap, int(r[a]))
                waiting[int(r[a])].append(at[a:b])

        put(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            # neighbours in the list of symbols, which need not be neighbours in the array
            first = np.concatenate([[True], after[at[:-1]] != at[1:]])
            begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            gone = after[at]
            ids[at] = self.by_rank[r]
            alive[gone] = False
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            put(np.concatenate([at, before[at]]))
        return ids[alive]

    # -- texts

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has; merges the words that are not known yet."""
        if self.size > KNOWN:
            self.forget()
        before = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > before:
            raw = [w.encode("utf-8", "surrogatepass") for w in islice(reversed(self.known), len(self.known) - before)][::-1]
            ids, length = self.merge(raw)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.ids = np.concatenate([self.ids, ids])
            self.size += sum(map(len, raw))
        length = self.length[at]
        return self.ids[_ragged(self.start[at], length)], length

    @staticmethod
    def split(text: str) -> Iterator[list[str]]:
        """The words of a text, without gaps, TOGETHER at most at a time."""
        if not text.isascii() and np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").max() >= FIRST_LATER and UNKNOWN.search(text):
            found = (text[m.start() : m.end()] for m in WORD.finditer(UNKNOWN.sub(UNASSIGNED, text)))
        elif len(text) <= TOGETHER:
            yield WORD.findall(text)
            return
        else:
            found = (m.group() for m in WORD.finditer(text))
        while some := list(islice(found, TOGETHER)):
            yield some

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special tokens (None), and special tokens with their ids."""
        at = 0
        for m in self.special.finditer(text) if self.special and any(s in text for s in self.special_id) else ():
            yield text[at : m.start()], None
            yield m.group(), self.special_id[m.group()]
            at = m.end()
        yield text[at:], None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        owner: list[tuple[int, int]] = []  # (text, words) in order

        def flush() -> None:
            if words:
                ids, length = self._words(words)
                ends = np.cumsum(length)
                place = 0
                for i, n in owner:
                    out[i].append(ids[ends[place] - length[place] : ends[place + n - 1]])
                    place += n
            words.clear(), owner.clear()

        for i, text in enumerate(texts):
            for part, special in self.parts(text):
                if special is not None:
                    flush()
                    out[i].append(np.array([special], np.uint32))
                    continue
                for some in self.split(part):
                    if some:
                        words += some
                        owner.append((i, len(some)))
                    if len(words) >= TOGETHER:
                        flush()
        flush()
        return [np.concatenate(o) if o else np.zeros(0, np.uint32) for o in out]

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; those that the vocabulary does not know have none."""
        parts = []
        for a in range(0, len(ids), IDS):
            x = ids[a : a + IDS].astype(np.int64)
            x = x[(x >= 0) & (x < len(self.v.at) - 1)]
            start = self.v.at[x]
            parts.append(self.v.pieces[_ragged(start, self.v.at[x + 1] - start)].tobytes())
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return self.raw(ids).decode("utf-8", "replace")


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, some at a time."""
    lo, size = [], 0
    for x in column:
        t = x.as_py() or ""
        lo.append(t)
        size += len(t)
        if size >= TEXTS:
            yield lo
            lo, size = [], 0
    if lo:
        yield lo


def encode(documents: DataFrame, path: str, back: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), ids_sha256 (of ids as little-endian 32-bit integers) of every row of documents, and with
    `back` also decoded: the text that these ids decode to.

    As the tokenizers library encodes with the vocabulary at path and add_special_tokens=False: special tokens in a text are
    their ids. A null text is empty: no ids. Texts are encoded whole; those beyond a megabyte by turns, so a task holds
    them, their ids and TOGETHER words. Rows that repeat are encoded each; no rows give none. Only doc_id and text are read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    sent = documents.sparkSession.sparkContext.broadcast(read_vocabulary(path).plain())
    names = ["doc_id", "n_tokens", "ids", "ids_sha256", *(["decoded"] if back else [])]

    def run(batches):
        bpe = Bpe(Vocabulary(**sent.value))
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(1)):
                ids = bpe.encode(texts)
                counts = [len(x) for x in ids]
                flat = np.concatenate(ids).astype(np.int32)
                arrays = [batch.column(0).slice(at, len(texts)), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat))]
                arrays.append(pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]))
                if back:
                    arrays.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>, ids_sha256 string" + (", decoded string" if back else ""))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """encoded with a column `text`: what its ids (array of int) decode to; null for null. Null ids and ids that the vocabulary does not
    know are left out, as the tokenizers library does. A column of that name is replaced."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path).plain())

    @F.pandas_udf("string")
    def of(column):
        import pandas as pd

        bpe = Bpe(Vocabulary(**sent.value))
        return pd.Series([None if x is None else bpe.decode(np.array([i for i in x if i is not None and i == i], np.int64)) for x in column], dtype=object)

    return encoded.withColumn(text, of(F.col(ids)))
