"""Self-join of documents by the Jaccard similarity of their word n-gram sets, over a token-group matrix.

Documents with the same set are one entity. Tokens (n-gram hashes) are ordered by frequency class and hash, and each
entity's first tokens, its prefix, are those of which two linked entities must share some (ELL, where the prefix has no
frequent token). The join runs in three steps:

1. Families. Every entity picks, of the most central holders of its prefix tokens, the one it shares most with; what
   picks connect is a family of similar documents, and the member that most others pick is its centre.
2. Token-group matrix, across families. A prefix token's column lists the groups (bounded parts of families) that hold
   it, not the entities. An entity that meets a group of another family in enough columns is bounded: its overlap with
   the union of the group's tokens has to reach what the threshold asks for. Only groups that qualify are opened.
3. Within families. Every member is compared with the centre. Members that it is linked with need no other comparison;
   the rest get a second order of tokens in which those that the centre lacks come first. Copies with different edits
   share nothing early in that order, so few of their pairs are met, and those are opened as in step 2.

Every pair that could link is met in step 2 or 3, or is linked through a centre, so no link between components is lost.
Sets are compared whole, as 64-bit hashes of their n-grams: exact but for collisions of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, LOWER, Slice, SpanHash, Tables, as_bytes, chained, freed, mixed, signed, slices, unused_prefix, words
from .graph import components
from .ranks import BROADCAST_ROWS

#: Shared prefix tokens that a pair must have, where both prefixes consist of infrequent tokens.
ELL = 3
#: log2 of the number of frequent cells that may be broadcast (8 bytes each). A cell is frequent if more than
#: tokens / 2^HOT_BITS documents hold it, so there cannot be more.
HOT_BITS = 21
LEAST_HOT = 16
#: Tokens that one range of hashes should have, and entries a mapper gathers before it sends them.
RANGE_TOKENS, FLUSH = 1 << 21, 1 << 19
#: Members of a group, about. What names a group: its kind (part of a family, the linked ones of a part, a member alone), family or member, and part.
GROUP = 16
GROUP_KEYS = ["kind", "root", "chunk"]
PART_OF_FAMILY, LINKED, ALONE = 0, 1, 2
#: Members of a family that meet a copy of the centre's set in one task, about.
PART = 2048
#: Entities whose sets are needed are named to the executors up to this number (8 bytes each); beyond, a join selects them.
NAMED = 2_000_000


# -- sets -------------------------------------------------------------------------------------------------------


def shingles(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document in the slice, hash), distinct and in order: k-word shingles in lower case (A-Z), or the whole sequence if it is shorter."""
    start, end, doc = words(s)
    h = SpanHash(LOWER[s.data])(start, end)
    count = np.bincount(doc, minlength=s.n)
    at = np.arange(len(h) - k + 1) if len(h) >= k else np.zeros(0, np.int64)
    at = at[doc[at + k - 1] == doc[at]]
    docs, tokens = [doc[at]], [chained(h, k)[at]]
    first = np.cumsum(count) - count
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        value = np.full(len(short), n, np.uint64)
        for i in range(n):
            value = mixed(value * np.uint64(BASE) + h[first[short] + i])
        docs.append(short), tokens.append(value)
    docs, tokens = np.concatenate(docs), np.concatenate(tokens)
    order = np.lexsort((tokens, docs))
    docs, tokens = docs[order], tokens[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (tokens[1:] != tokens[:-1])
    return docs[new], tokens[new]


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of values (uint64, wrapping) between cuts."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:], dtype=np.uint64)
    return total[cuts[1:]] - total[cuts[:-1]]


def sets_of(s: Slice, k: int):
    """tokens (ascending within a document), cuts, sizes, and entity of each document: a 64-bit hash of its set."""
    doc, tokens = shingles(s, k)
    cuts = np.searchsorted(doc, np.arange(s.n + 1))
    size = np.diff(cuts)
    entity = signed(mixed(_sums(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), cuts) + size.astype(np.uint64)))
    return tokens, cuts, size, entity


def _map(documents: DataFrame, function, schema: str) -> DataFrame:
    return documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(function, schema)


def summaries(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, entity of every document."""

    def run(batches):
        for batch in batches:
            n, e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s in slices(as_bytes(batch.column(1))):
                _, _, size, entity = sets_of(s, k)
                n.append(size), e.append(entity)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n)), pa.array(np.concatenate(e))], names=["doc_id", "n_shingles", "entity"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles bigint, entity bigint")


# -- frequencies ------------------------------------------------------------------------------------------------


def frequent_cells(documents: DataFrame, k: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (upper 32 bits of a token) that more than total / 2^HOT_BITS documents hold, ascending, and their counts.

    All tokens of all documents are counted: mappers send distinct cells with counts as packed arrays, by range of
    cells. Two tokens in one cell only steer the order of tokens; any order gives the same links.
    """
    most = max(LEAST_HOT, total >> HOT_BITS)
    bits = _range_bits(total, 1)

    def gather(batches):
        held, size = [], 0

        def send():
            cells, count = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(cells, (np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32 - bits)).astype(np.uint64))
            many = count > 1
            rows = [(r, cells[a:b][~many[a:b]].tobytes(), cells[a:b][many[a:b]].tobytes(), count[a:b][many[a:b]].astype(np.uint32).tobytes()) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["part", "once", "cells", "counts"])

        for batch in batches:
            for s in slices(as_bytes(batch.column(0))):
                held.append((sets_of(s, k)[0] >> np.uint64(32)).astype(np.uint32))
                size += len(held[-1])
                if size >= 4 * FLUSH:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    def count(table: pa.Table) -> pa.Table:
        unpack = lambda c: np.concatenate([np.frombuffer(x, np.uint32) for x in table[c].to_pylist()])
        once, cells = unpack("once"), unpack("cells")
        found, at = np.unique(np.concatenate([once, cells]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([np.ones(len(once)), unpack("counts")]), minlength=len(found)).astype(np.int64)
        hot = n > most
        return pa.table({"cell": found[hot].astype(np.int64), "n": n[hot]})

    with freed(documents.sparkSession):
        rows = _map(documents, gather, "part int, once binary, cells binary, counts binary").groupBy("part").applyInArrow(count, "cell bigint, n bigint").toArrow()
    cells, n = rows["cell"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(cells)
    return cells[order].astype(np.uint32), n[order].astype(np.int64)


# -- prefixes ---------------------------------------------------------------------------------------------------


def required(n, num: int, den: int):
    """The least overlap of a set of n tokens with one that it is linked with."""
    return -(-num * n // den)


KINDS = {"token": np.uint64, "entity": np.int64, "n": np.int32, "pos": np.int32, "ell": np.int8, "weight": np.int32, "root": np.int64, "chunk": np.int32, "linked": np.int8}
SQL_KINDS = {"u8": "bigint", "i8": "bigint", "i4": "int", "i1": "int"}


def _new(token: np.ndarray, entity: np.ndarray) -> np.ndarray:
    """Of rows in order: is a (token, entity) the first of its kind?"""
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (entity[1:] != entity[:-1])
    return new


#: Rows of a token whose partners are looked for pair by pair; of more, all are kept.
TRIED = 64


def _partnered(token: np.ndarray, n: np.ndarray, pos: np.ndarray, ell: np.ndarray | None, num: int, den: int) -> np.ndarray:
    """Of rows in the order of their tokens: is there another row of the token with which a link is possible? (See
    _sizes_fit and _places_fit.)"""
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    ell = np.ones(len(n), np.int64) if ell is None else ell.astype(np.int64)
    first, count = np.unique(token, return_index=True, return_counts=True)[1:]
    keep = np.repeat(count > TRIED, count)
    at = np.flatnonzero(~keep)
    left = np.repeat(first + count, count) - np.arange(len(token))  # rows of the token from here on
    for step in range(1, TRIED):
        at = at[left[at] > step]
        if not len(at):
            break
        a, b = at, at + step
        low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        both, shared = -(-num * (low + high) // (num + den)), np.minimum(ell[a], ell[b])
        fits = (den * low >= num * high) & (pos[a] < n[a] - both + shared) & (pos[b] < n[b] - both + shared)
        keep[a[fits]] = keep[b[fits]] = True
    return keep


class Sender:
    """Gathers rows of a mapper and packs them, distinct in (token, entity), into arrays by range of tokens. Rows of
    frequent tokens go to ranges of their own, dealt by entity, so that no range has to hold all rows of such a token."""

    def __init__(self, names: list[str], bits: int):
        self.names, self.bits, self.loose = names, bits, 1 << max(min(bits, 6), bits - 2)
        self.held, self.size = [], 0

    def add(self, frequent: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append([frequent, *[columns[n].astype(KINDS[n]) for n in self.names]])
        self.size += len(frequent)
        if self.size >= FLUSH:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        frequent, *columns = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        token, entity = columns[0], columns[1]
        order = np.lexsort((entity, token))
        order = order[_new(token[order], entity[order])]
        part = np.where(frequent, (1 << self.bits) + (entity.view(np.uint64) % np.uint64(self.loose)).astype(np.int64), (token >> np.uint64(64 - self.bits)).astype(np.int64))
        order = order[np.argsort(part[order], kind="stable")]
        part = part[order]
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
        packed = [pa.array([c[order[a:b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]], pa.int32()), *packed], names=["part", *self.names])

    def schema(self) -> str:
        return ", ".join(["part int", *[f"{n} binary" for n in self.names]])

    def shared(self, packed: DataFrame, num: int, den: int) -> DataFrame:
        """The rows of tokens that have a partner: another entity with this token that fits in size and place. Of frequent
        tokens, whose rows are in several ranges, all rows."""
        names, exact = self.names, 1 << self.bits

        def unpack(table: pa.Table) -> pa.Table:
            columns = [np.concatenate([np.frombuffer(x, KINDS[n]) for x in table[n].to_pylist()]) for n in names]
            order = np.lexsort((columns[1], columns[0]))
            order = order[_new(columns[0][order], columns[1][order])]
            if table["part"][0].as_py() < exact:  # all rows of these tokens are here
                c = {n: x[order] for n, x in zip(names, columns, strict=True)}
                order = order[_partnered(c["token"], c["n"], c["pos"], c.get("ell"), num, den)]
            out = {n: c[order] for n, c in zip(names, columns, strict=True)}
            return pa.table({n: signed(c) if c.dtype == np.uint64 else c.astype(np.int32) if c.dtype == np.int8 else c for n, c in out.items()})

        kinds = ", ".join(f"{n} {SQL_KINDS[np.dtype(KINDS[n]).str[1:]]}" for n in names)
        return packed.groupBy("part").applyInArrow(unpack, kinds)


def _range_bits(total: int, share: int = 4) -> int:
    """log2 of the number of ranges: of RANGE_TOKENS prefix tokens each, and 64 at least, but for very small corpora."""
    return max(1, min(6, (total >> 12).bit_length()), (total // share // RANGE_TOKENS).bit_length())


class Frequencies:
    """How often frequent cells occur, for looking up tokens."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray):
        self.cells, self.counts = cells, counts
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[cells >> np.uint32(12)] = True

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        cell = (tokens >> np.uint64(32)).astype(np.uint32)
        often = np.zeros(len(tokens), np.int64)
        if len(self.cells):
            look = np.flatnonzero(self.maybe[cell >> np.uint32(12)])
            at = np.minimum(np.searchsorted(self.cells, cell[look]), len(self.cells) - 1)
            often[look] = np.where(self.cells[at] == cell[look], self.counts[at], 0)
        return often


def prefixes(documents: DataFrame, k: int, num: int, den: int, hot, total: int) -> DataFrame:
    """(token, entity, n, pos, ell, weight): prefix tokens by which two entities may be linked. pos: the token's place in the
    entity's order. ell: how many prefix tokens a pair must share, as far as this entity goes. weight: how frequent the
    entity's tokens are in sum, for choosing central ones. hot: a broadcast of cells and counts."""
    sender = Sender(["token", "entity", "n", "pos", "ell", "weight"], _range_bits(total))

    def gather(batches):
        frequency = Frequencies(*hot.value)
        for batch in batches:
            for s in slices(as_bytes(batch.column(0))):
                tokens, cuts, size, entity = sets_of(s, k)
                doc = np.repeat(np.arange(s.n), size)
                often = frequency(tokens)
                order = np.lexsort((tokens, often, doc))
                tokens, often = tokens[order], often[order]  # documents stay where they are
                place = np.arange(len(tokens)) - cuts[doc]
                need = required(size, num, den)
                least = size - need + 1
                rare = np.bincount(doc, weights=often == 0, minlength=s.n).astype(np.int64)
                # The prefix grows by ell - 1 for ell shared tokens, but not into frequent tokens.
                ell = np.clip(np.minimum(np.minimum(need, ELL), rare - least + 1), 1, ELL)
                _, firsts = np.unique(entity, return_index=True)
                chosen = np.zeros(s.n, bool)
                chosen[firsts] = True
                keep = (place < (least + ell - 1)[doc]) & chosen[doc]
                weight = np.minimum(np.bincount(doc, weights=often, minlength=s.n), (1 << 31) - 1)
                d = doc[keep]
                yield from sender.add(often[keep] > 0, token=tokens[keep], entity=entity[d], n=size[d], pos=place[keep], ell=ell[d], weight=weight[d])
        yield from sender.end()

    return sender.shared(_map(documents, gather, sender.schema()), num, den)


# -- comparisons ------------------------------------------------------------------------------------------------


def needed_sets(documents: DataFrame, k: int, wanted: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, tokens): the packed sets of the wanted entities (a table with a distinct column `entity`), each from the
    document with the smallest id that has it (entities: entity, first of every entity)."""
    integral = documents.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    few = wanted.limit(NAMED + 1).count() <= NAMED
    named = None
    if few:
        rows = entities.join(wanted, "entity", "left_semi").select("entity", F.coalesce(F.col("first"), F.lit(-1)).cast("long") if integral else F.lit(-1).cast("long")).toArrow()
        ids, firsts = rows[0].to_numpy(), rows[1].to_numpy()
        order = np.argsort(ids)
        named = (ids[order], firsts[order])
    named_var = documents.sparkSession.sparkContext.broadcast(named)

    def run(batches):
        seen = set()
        for batch in batches:
            doc_ids = batch.column(1).to_numpy(zero_copy_only=False)
            for s in slices(as_bytes(batch.column(0))):
                tokens, cuts, size, entity = sets_of(s, k)
                wanted = size > 0
                if named_var.value is not None:
                    ids, firsts = named_var.value
                    if not len(ids):
                        continue
                    at = np.minimum(np.searchsorted(ids, entity), len(ids) - 1)
                    wanted &= (ids[at] == entity) & ((firsts[at] < 0) | (firsts[at] == doc_ids[s.lo : s.hi]))
                out = []
                for i in np.flatnonzero(wanted):
                    if (e := int(entity[i])) not in seen:
                        seen.add(e)
                        out.append((e, tokens[cuts[i] : cuts[i + 1]].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in out], pa.int64()), pa.array([t for _, t in out], pa.binary())], names=["entity", "tokens"])

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)) if integral else F.lit(-1)
    sets = documents.select(F.col("text").cast("binary").alias("text"), key.alias("id")).mapInArrow(run, "entity bigint, tokens binary")
    if few and integral:
        return sets  # a repeated id may give a set twice, which only repeats links
    return (sets if few else sets.join(wanted, "entity", "left_semi")).dropDuplicates(["entity"])


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = _overlap(a, b)
    return den * both >= num * (len(a) + len(b) - both)


def _small(df: DataFrame) -> DataFrame:
    """df, to be sent to all tasks if it has few rows (of some numbers each); else Spark moves both sides of its join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of the sets that are named, so that a join after it moves no others."""
    ids = ids.distinct()
    return sets.join(F.broadcast(ids) if ids.limit(NAMED + 1).count() <= NAMED else ids, "entity", "left_semi")


def stars(members: DataFrame, sets: DataFrame, hot, num: int, den: int) -> DataFrame:
    """(entity, root, centre, chunk, linked, n, base, prefix): is a member linked with its family's centre, and its prefix in
    the family's order, packed: rare tokens that the centre lacks (as many as `base`, or fewer), then the others by frequency.

    members: (entity, root, centre, chunk, part, least). The prefix is as long as a link with the family's smallest set (of
    `least` tokens) can need. A family's members are dealt over its parts, each of which has a copy of
    the centre's set, so no task has to hold a family.
    """
    copies = _small(members.select("root", "centre", "part").distinct())
    centres = _only(sets, members.select(F.col("centre").alias("entity"))).select(F.col("entity").alias("centre"), F.col("tokens").alias("core")).join(copies, "centre").drop("centre")

    def run(batches):
        frequency = Frequencies(*hot.value)
        for batch in batches:
            entity, root, centre, chunk = (batch.column(i) for i in range(4))
            linked, n, base, prefix = [], [], [], []
            for x, y, smallest in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)), strict=True):
                a, c = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(c, a), len(c) - 1)
                inside = c[at] == a
                both = int(inside.sum())
                linked.append(den * both >= num * (len(a) + len(c) - both))
                often = frequency(a)
                late = inside | (often > 0)
                other = max(smallest, int(required(len(a), num, den)))
                most = max(0, len(a) - -(-num * (len(a) + other) // (num + den)) + 1)
                order = np.lexsort((a, often, late))[:most]
                n.append(len(a)), base.append(min(most, int((~late).sum()))), prefix.append(a[order].tobytes())
            yield pa.RecordBatch.from_arrays([entity, root, centre, chunk, pa.array(linked, pa.bool_()), pa.array(n, pa.int32()), pa.array(base, pa.int32()), pa.array(prefix, pa.binary())], names=["entity", "root", "centre", "chunk", "linked", "n", "base", "prefix"])

    met = sets.join(_small(members), "entity").join(centres, ["root", "part"]).select("entity", "root", "centre", "chunk", "tokens", "core", "least")
    return met.mapInArrow(run, "entity bigint, root bigint, centre bigint, chunk int, linked boolean, n int, base int, prefix binary")


def family_rows(stars_: DataFrame, total: int, num: int, den: int) -> DataFrame:
    """(token, entity, n, pos, root, chunk, linked): prefix tokens in their family's order by which two members may be linked. A
    token's hash is mixed with its family's, so one column is one family's. What linked members share with the centre is
    left out where no other member of the family has such a token in its prefix."""
    sender = Sender(["token", "entity", "n", "pos", "root", "chunk", "linked"], _range_bits(total))
    near = stars_.where("not linked and octet_length(prefix) > 8 * base").select("root").distinct().withColumn("near", F.lit(True))
    near = F.broadcast(near) if near.limit(NAMED + 1).count() <= NAMED else near

    def gather(batches):
        for batch in batches:
            entity, root, chunk, linked, n, base, near = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            tokens = [np.frombuffer(x, np.uint64) for x in batch.column(7).to_pylist()]
            tokens = [t if y or not x else t[:b] for t, x, y, b in zip(tokens, linked, near, base, strict=True)]
            size = np.fromiter(map(len, tokens), np.int64, len(tokens))
            if not size.sum():
                continue
            row = np.repeat(np.arange(len(tokens)), size)
            pos = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            token = mixed(np.concatenate(tokens) ^ mixed(root.view(np.uint64))[row])
            yield from sender.add(pos >= base[row], token=token, entity=entity[row], n=n[row], pos=pos, root=root[row], chunk=chunk[row], linked=linked[row])
        yield from sender.end()

    flagged = stars_.join(near, "root", "left").select("entity", "root", "chunk", "linked", "n", "base", F.coalesce("near", F.lit(False)).alias("near"), "prefix")
    return sender.shared(flagged.mapInArrow(gather, sender.schema()), num, den)


def open_groups(candidates: DataFrame, sets: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) of entities (a) with members of groups that qualify. candidates: (a, *GROUP_KEYS); groups: (entity, *GROUP_KEYS)."""

    def build(table: pa.Table) -> pa.Table:
        members = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        union = np.unique(np.concatenate(members))
        return pa.table({**{c: table[c][:1] for c in GROUP_KEYS}, "members": pa.array([table["entity"].to_pylist()], pa.list_(pa.int64())), "sizes": pa.array([[len(m) for m in members]], pa.list_(pa.int64())), "packed": pa.array([np.concatenate(members).tobytes()], pa.binary()), "union": pa.array([union.tobytes() if len(members) > 1 else b""], pa.binary())})

    matrix = _only(sets, groups.select("entity")).join(_small(groups), "entity").groupBy(*GROUP_KEYS).applyInArrow(build, "kind int, root bigint, chunk int, members array<bigint>, sizes array<bigint>, packed binary, union binary")

    def run(batches):
        for batch in batches:
            out = []
            rows = [batch.column(i).to_pylist() for i in range(6)]
            for a, x, members, sizes, packed, union in zip(*rows, strict=True):
                q, all_ = np.frombuffer(x, np.uint64), np.frombuffer(packed, np.uint64)
                # Linked members hold at least this many of the query's tokens, and so does the union.
                if union and _overlap(q, np.frombuffer(union, np.uint64)) < required(len(q), num, den):
                    continue
                at = 0
                for e, n in zip(members, sizes, strict=True):
                    if e != a and _similar(q, all_[at : at + n], num, den):
                        out.append((a, e))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    queries = _only(sets, candidates.select(F.col("a").alias("entity"))).select(F.col("entity").alias("a"), F.col("tokens").alias("x"))
    met = queries.join(_small(candidates), "a").join(matrix, GROUP_KEYS)
    return met.select("a", "x", "members", "sizes", "packed", "union").mapInArrow(run, "a bigint, b bigint")


# -- the join ---------------------------------------------------------------------------------------------------


def _sizes_fit(n: str, low: str, high: str, num: int, den: int):
    """Can a set of n tokens be linked with one of low..high tokens?"""
    return F.expr(f"{den} * cast({high} as bigint) >= {num} * cast({n} as bigint) and {den} * cast({n} as bigint) >= {num} * cast({low} as bigint)")


def _places_fit(n: str, pos: str, other: str, ell: str, num: int, den: int):
    """Is a token early enough in a set of n tokens to count for a pair with a set of `other` tokens? Of linked sets, the
    first n - overlap + ell tokens of both share ell, and the overlap is at least num / (num + den) of both sizes."""
    overlap = f"(({num} * (cast({n} as bigint) + {other}) + {num + den - 1}) div {num + den})"
    return F.expr(f"{pos} < {n} - {overlap} + {ell}")


def families(found: DataFrame, entities: DataFrame, tables: Tables, num: int, den: int) -> DataFrame:
    """(entity, root, centre, chunk, part, least) of every member of a family. found: rows of prefixes(); least: the size of
    the family's smallest set."""
    # Of a family of copies, the one that shares most of its prefix is likely what the others were made from.
    shared = found.groupBy("entity").agg(F.count(F.lit(1)).cast("int").alias("shared"))
    central = found.join(shared, "entity").groupBy("token").agg(F.max(F.struct("weight", "shared", "entity", "n", "pos", "ell")).alias("c"), F.min("entity").alias("low"), F.max("entity").alias("high")).where("low < high").select("token", F.col("c.entity").alias("b"), F.col("c.n").alias("n_b"), F.col("c.pos").alias("pos_b"), F.col("c.ell").alias("ell_b"))
    met = found.select("token", F.col("entity").alias("a"), "n", "pos", "ell").join(central, "token").where("a <> b").where(_sizes_fit("n", "n_b", "n_b", num, den))
    met = met.where(_places_fit("n", "pos", "n_b", "least(ell, ell_b)", num, den)).where(_places_fit("n_b", "pos_b", "n", "least(ell, ell_b)", num, den))
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("ell", "ell_b")).alias("ell")).where("c >= ell")
    picks = tables.put(counted.groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b")), "picks")
    roots = components(picks, tables)
    picked = picks.groupBy("b").agg(F.count(F.lit(1)).alias("votes")).select(F.col("b").alias("node"), "votes")
    sized = roots.join(entities.select(F.col("entity").alias("node"), "n"), "node").join(picked, "node", "left")
    centres = sized.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max_by("node", F.struct(F.coalesce("votes", F.lit(0)), "node")).alias("centre"))
    centres = tables.put(centres, "centres")
    centres = _small(centres)
    dealt = lambda most: F.expr(f"cast(pmod(xxhash64(node, {most}), (members + {most - 1}) div {most}) as int)")
    return roots.join(centres, "root").select(F.col("node").alias("entity"), "root", "centre", dealt(GROUP).alias("chunk"), dealt(PART).alias("part"), "least")


def links(documents: DataFrame, entities: DataFrame, tables: Tables, k: int, num: int, den: int, total: int) -> DataFrame:
    """Links (a, b) between entities that connect all linked ones."""
    hot = documents.sparkSession.sparkContext.broadcast(frequent_cells(documents, k, total))
    found = tables.put(prefixes(documents, k, num, den, hot, total), "prefixes")
    members = tables.put(families(found, entities, tables, num, den), "families")

    # Across families. An entity without one is a group of its own.
    rooted = found.drop("weight").join(members.select("entity", "root", "chunk"), "entity", "left").withColumn("root", F.coalesce("root", "entity")).withColumn("chunk", F.coalesce("chunk", F.lit(0)))
    crossed = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
    rows = tables.put(rooted.join(crossed, "token"), "rows")
    columns = rows.groupBy("token", "root", "chunk").agg(F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("pos").alias("pos_g"), F.min("ell").alias("ell_g"), F.max("ell").alias("ell_high"))
    meets = rows.select("token", F.col("entity").alias("a"), F.col("root").alias("root_a"), "n", "pos", "ell").join(columns, "token").where("root_a < root").where(_sizes_fit("n", "n_low", "n_high", num, den))
    meets = meets.where(_places_fit("n", "pos", "n_low", "least(ell, ell_high)", num, den)).where(_places_fit("n_high", "pos_g", "n", "least(ell, ell_high)", num, den))
    across = meets.groupBy("a", "root", "chunk").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("ell", "ell_g")).alias("ell")).where("c >= ell").select("a", F.lit(PART_OF_FAMILY).alias("kind"), "root", "chunk")
    across = tables.put(across, "across")
    tables.drop(found, rows)
    met_groups = across.select("kind", "root", "chunk").distinct()
    of_families = met_groups.join(members, ["root", "chunk"]).select("entity", *GROUP_KEYS)
    of_one = met_groups.join(members.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("entity"), *GROUP_KEYS)
    opened = tables.put(of_families.unionByName(of_one), "opened")

    wanted = members.select("entity").union(across.select("a")).union(opened.select("entity")).distinct()
    sets = tables.put(needed_sets(documents, k, wanted, entities), "sets")

    # Within families: what is linked with the centre, and the pairs of others that the family's order lets meet.
    starred = tables.put(stars(members, sets, hot, num, den), "stars")
    inner = tables.put(family_rows(starred, total, num, den), "inner")
    linked = F.col("linked") == 1
    kind = F.when(linked, LINKED).otherwise(ALONE).alias("kind")
    columns = inner.select("token", "n", "pos", kind, F.when(linked, F.col("root")).otherwise(F.col("entity")).alias("root"), F.when(linked, F.col("chunk")).otherwise(F.lit(0)).alias("chunk")).groupBy("token", *GROUP_KEYS).agg(F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("pos").alias("pos_g"))
    meets = inner.where(~linked).select("token", F.col("entity").alias("a"), "n", "pos").join(columns, "token").where(f"kind = {LINKED} or a < root").where(_sizes_fit("n", "n_low", "n_high", num, den))
    within = meets.where(_places_fit("n", "pos", "n_low", "1", num, den)).where(_places_fit("n_high", "pos_g", "n", "1", num, den)).select("a", *GROUP_KEYS).distinct()
    within = tables.put(within, "within")
    tables.drop(inner)
    of_linked = starred.where("linked").select("entity", F.lit(LINKED).alias("kind"), "root", "chunk").join(within.select(*GROUP_KEYS).distinct(), GROUP_KEYS, "left_semi")
    alone = within.where(F.col("kind") == ALONE).select(F.col("root").alias("entity"), *GROUP_KEYS).distinct()
    opened = tables.put(opened.unionByName(of_linked).unionByName(alone), "groups")
    out = tables.put(open_groups(across.unionByName(within), sets, opened, num, den).union(starred.where("linked and entity <> centre").select("entity", "centre")), "linked")
    tables.drop(sets, starred)
    return out


def _rooted(documents: DataFrame, tables: Tables, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame | None]:
    """docs (doc_id, n_shingles, entity of every document), and (entity, first, root) of every entity: its smallest id, and
    what stands for its component. None where no text has words."""
    docs = tables.put(summaries(documents, k), "docs")
    total = docs.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    if not total:
        return docs, None
    entities = tables.put(docs.where("n_shingles > 0").groupBy("entity").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n")), "entities")
    roots = components(links(documents, entities, tables, k, num, den, total), tables)
    return docs, tables.put(entities.join(roots.withColumnRenamed("node", "entity"), "entity", "left").select("entity", "first", F.coalesce("root", "entity").alias("root")), "rooted")


def _labelled(docs: DataFrame, rooted: DataFrame | None, tables: Tables) -> DataFrame:
    blank = docs.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    if rooted is None:
        return blank
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = tables.put(rooted.join(least, "root").select("entity", "component_id"), "named")
    out = docs.where("n_shingles > 0").join(named, "entity").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(blank)


def ngram_components(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included) of every document.

    A document's set: its distinct k-word shingles, words being runs without ASCII whitespace, A-Z in lower case; with
    fewer words, the whole sequence as one. Two documents link when den * intersection >= num * union. Texts without
    words (null, empty, blank) are linked with nothing. Rows that repeat an id are compared like others; null ids are
    never the smallest. Extra columns are not read. Texts are taken whole, however long; no documents give no rows.
    """
    tables = Tables(documents.sparkSession, "ngrams")
    return _labelled(*_rooted(documents, tables, k, num, den), tables)


def _with_entities(documents: DataFrame, k: int, size: str, entity: str) -> DataFrame:
    """documents with the size and the entity of each row's set."""
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            n, e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s in slices(as_bytes(batch.column(at))):
                _, _, sizes, entities = sets_of(s, k)
                n.append(sizes), e.append(entities)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(n)), pa.array(np.concatenate(e))], names=[*batch.schema.names, size, entity])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField(size, T.LongType()), T.StructField(entity, T.LongType())]))


def keep_one_of_each(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """documents without near copies: of every component, one row with the smallest doc_id stays. Rows are told apart by
    their texts where ids are null or repeat. Texts without words are copies of nothing and stay. Texts are taken whole; of no
    documents none stay."""
    p = unused_prefix(documents)
    tables = Tables(documents.sparkSession, "ngrams")
    docs, rooted = _rooted(documents, tables, k, num, den)
    if rooted is None:
        return documents
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        kept = rooted.groupBy("root").agg(F.min("first").alias(f"{p}id")).select(f"{p}id").union(docs.where("n_shingles = 0").select("doc_id"))
        return documents.join(kept, F.col("doc_id") == F.col(f"{p}id"), "left_semi")
    least = rooted.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "entity")).alias("c"))
    kept = tables.put(least.select(F.col("c.first").alias(f"{p}id"), F.col("c.entity").alias(f"{p}of")), "kept")
    sized = _with_entities(documents, k, f"{p}n", f"{p}entity")
    full = sized.where(f"{p}n > 0").join(kept, (F.col(f"{p}entity") == F.col(f"{p}of")) & F.col("doc_id").eqNullSafe(F.col(f"{p}id")))
    blank = sized.where(f"{p}n = 0").select(*documents.columns)
    return full.dropDuplicates([f"{p}of"]).select(*documents.columns).unionByName(blank)
