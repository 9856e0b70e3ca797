"""Secret scans with one combined deterministic automaton.

Every rule is compiled by itself: pattern -> Thompson automaton -> scanner. A scanner is a deterministic machine that
restarts by itself, so that it finds leftmost, longest, non-overlapping matches in one pass: its states are ordered
lists of positions in the pattern (earlier starts first), cut behind the first accepting one. All scanners then run
in step: the subset construction of their product, followed by minimisation (partition refinement), gives one table
of 256 transitions a state. A text is scanned once, byte by byte, whatever the number of rules; only where some rule
accepts is anything noted. The start of a match is found backwards from its end with the rule's reversed automaton.

Patterns may use literals, classes, `?`, `*`, `+`, `{m}`, `{m,}`, `{m,n}`, groups and `|` over ASCII. Once a rule
accepts, it has to go on accepting until its match ends (it ends in a repeated class, or in a fixed text); compile()
raises ValueError otherwise.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes


@dataclass(frozen=True)
class Rule:
    """kind: its name in spans. The pattern is head + body; matches whose body has fewer than `least` bytes are dropped."""

    kind: str
    body: str
    least: int = 0
    head: str = ""

    @property
    def pattern(self) -> str:
        return self.head + self.body


# The base rules, then formats of widespread credentials.
BASE_RULES = (
    Rule("assign", "[A-Za-z0-9+/_.=-]+", 8, head=r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32}[0-9a-f]*"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


# -- pattern -> Thompson automaton ------------------------------------------------------------------------------


class _Parser:
    """Builds the automaton: edges[state] is a list of (set of bytes or None for an empty move, state)."""

    def __init__(self, pattern: str):
        self.p, self.at, self.edges = pattern, 0, []
        self.fold = False

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def build(self) -> tuple[int, int]:
        tree = self.alternation()
        if self.at != len(self.p):
            raise ValueError(f"unexpected {self.p[self.at]!r} in {self.p!r}")
        self.tree = tree
        return self.lay(tree)

    # syntax tree: ("set", bytes) | ("cat", [..]) | ("alt", [..]) | ("rep", node, least, most)
    def alternation(self):
        branches = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            branches.append(self.sequence())
        return branches[0] if len(branches) == 1 else ("alt", branches)

    def sequence(self):
        items = []
        while (c := self.peek()) and c not in "|)":
            items.append(self.repeated(self.atom()))
        return ("cat", items)

    def repeated(self, node):
        while (c := self.peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                to = self.p.index("}", self.at)
                low, comma, high = self.p[self.at : to].partition(",")
                self.at = to + 1
                node = ("rep", node, int(low), (int(high) if high else None) if comma else int(low))
            else:
                node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[c])
        return node

    def peek(self) -> str:
        return self.p[self.at : self.at + 1]

    def atom(self):
        c = self.p[self.at]
        self.at += 1
        if c == "(":
            before = self.fold
            if m := re.compile(r"\?(i?):").match(self.p, self.at):
                self.fold |= bool(m[1])
                self.at = m.end()
            node = self.alternation()
            if self.peek() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            self.at += 1
            self.fold = before
            return node
        if c == "[":
            return ("set", self.char_class())
        return ("set", self.folded({self.escape() if c == "\\" else ord(c)}))

    def escape(self) -> int:
        c = self.p[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.p[self.at - 2 : self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char_class(self) -> frozenset:
        negated, found = self.peek() == "^", set()
        self.at += negated
        while (c := self.p[self.at]) != "]" or not found:
            self.at += 1
            low = self.escape() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.at + 1] != "]":
                self.at += 1
                c = self.p[self.at]
                self.at += 1
                found |= set(range(low, (self.escape() if c == "\\" else ord(c)) + 1))
            else:
                found.add(low)
        self.at += 1
        return frozenset(range(256)) - self.folded(found) if negated else self.folded(found)

    def folded(self, found: set) -> frozenset:
        return frozenset(found | {x ^ 32 for x in found if self.fold and chr(x).isascii() and chr(x).isalpha()})

    def lay(self, node, backwards: bool = False) -> tuple[int, int]:
        kind = node[0]
        first, last = self.state(), self.state()
        if kind == "set":
            self.edges[first].append((node[1], last))
        elif kind == "alt":
            for x in node[1]:
                a, b = self.lay(x, backwards)
                self.edges[first].append((None, a))
                self.edges[b].append((None, last))
        elif kind == "cat":
            at = first
            for x in reversed(node[1]) if backwards else node[1]:
                a, b = self.lay(x, backwards)
                self.edges[at].append((None, a))
                at = b
            self.edges[at].append((None, last))
        else:
            _, x, least, most = node
            at = first
            for _ in range(least):
                a, b = self.lay(x, backwards)
                self.edges[at].append((None, a))
                at = b
            if most is None:
                a, b = self.lay(x, backwards)
                self.edges[at] += [(None, a), (None, last)]
                self.edges[b] += [(None, a), (None, last)]
            else:
                for _ in range(most - least):
                    a, b = self.lay(x, backwards)
                    self.edges[at] += [(None, a), (None, last)]
                    at = b
                self.edges[at].append((None, last))
        return first, last


def _closure(edges, states) -> tuple[int, ...]:
    """States reached by empty moves; the order of first discovery is the order of priority."""
    out, stack = {}, list(reversed(states))
    while stack:
        s = stack.pop()
        if s not in out:
            out[s] = None
            stack += [t for c, t in reversed(edges[s]) if c is None]
    return tuple(out)


class _Scanner:
    """One rule as a machine that restarts by itself. A state: (threads in order, locked). Each thread is one start's set of places."""

    def __init__(self, rule: Rule):
        parser = _Parser(rule.pattern)
        self.first, self.last = parser.build()
        self.edges = parser.edges
        self.fresh = frozenset(_closure(self.edges, [self.first]))
        if self.last in self.fresh:
            raise ValueError(f"{rule.kind}: the pattern matches the empty text")
        self.start = ((), False)

    def step(self, thread: frozenset, byte: int) -> frozenset:
        return frozenset(_closure(self.edges, [t for s in thread for c, t in self.edges[s] if c is not None and byte in c]))

    def move(self, state, byte: int):
        threads, locked = state
        if locked:
            if on := self.step(threads[0], byte):
                if self.last not in on:
                    raise ValueError("a rule stops accepting within its match: end it in a repeated class or a fixed text")
                return ((on,), True)
            threads = ()  # the match ended before this byte, which may begin the next
        out = []
        for t in (*threads, self.fresh):
            on = self.step(t, byte)
            if on and on not in out:  # of equal threads, the earlier start wins
                out.append(on)
                if self.last in on:
                    # An earlier start that is still undecided would have to be kept; none of the rules needs that.
                    if len(out) > 1:
                        raise ValueError("two starts of a rule are open when it accepts")
                    return ((on,), True)
        return (tuple(out), False)


class _Backward:
    """A rule's reversed automaton, determinised lazily: the leftmost start of a match whose end is known."""

    def __init__(self, rule: Rule):
        parser = _Parser(rule.pattern)
        parser.build()
        parser.edges = []
        first, self.last = parser.lay(parser.tree, backwards=True)
        self.edges = parser.edges
        self.begin = frozenset(_closure(self.edges, [first]))
        self.memo: dict = {}

    def __call__(self, data: bytes, end: int, floor: int) -> int:
        state, best, at = self.begin, end, end
        while at > floor:
            at -= 1
            key = (state, data[at])
            if key not in self.memo:
                self.memo[key] = frozenset(_closure(self.edges, [t for s in state for c, t in self.edges[s] if c is not None and data[at] in c]))
            state = self.memo[key]
            if not state:
                break
            if self.last in state:
                best = at
        return best


# -- product, minimisation, tables ------------------------------------------------------------------------------


@dataclass
class Automaton:
    """next: one list of 256 * states entries, each the next state times 256; accepts[state]: bits of the rules that accept."""

    rules: tuple[Rule, ...]
    next: list[int]
    accepts: list[int]
    built: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def _byte_classes(scanners) -> list[int]:
    """For each byte, the first byte that no pattern tells from it."""
    sets = {c for s in scanners for e in s.edges for c, _ in e if c is not None}
    seen: dict = {}
    return [seen.setdefault(tuple(b in c for c in sets), b) for b in range(256)]


def compile(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """Subset construction over all rules at once, then minimisation; about a second for the rules above."""
    scanners = [_Scanner(r) for r in rules]
    klass = _byte_classes(scanners)
    letters = sorted(set(klass))
    memos: list[dict] = [{} for _ in rules]
    start = tuple(s.start for s in scanners)
    ids, todo, table = {start: 0}, [start], []
    while len(table) < len(todo):
        row = []
        for b in letters:
            to = []
            for s, memo, x in zip(scanners, memos, todo[len(table)], strict=True):
                if (x, b) not in memo:
                    memo[x, b] = s.move(x, b)
                to.append(memo[x, b])
            to = tuple(to)
            if to not in ids:
                ids[to] = len(todo)
                todo.append(to)
            row.append(ids[to])
        table.append(row)
    out = [sum(1 << i for i, x in enumerate(s) if x[1]) for s in todo]
    # Partition refinement: states are equal while their outputs and the blocks they move to are.
    moves = np.array(table)
    block = np.unique(out, return_inverse=True)[1]
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # The start is numbered 0; others follow as they are met, silent states before accepting ones.
    firsts = {}
    for i, b in enumerate(block):
        firsts.setdefault(int(b), i)
    order = sorted(firsts, key=lambda b: (out[firsts[b]] != 0, firsts[b]))
    number = {b: i for i, b in enumerate(order)}
    column = [letters.index(k) for k in klass]
    flat = []
    for b in order:
        row = table[firsts[b]]
        flat += [number[int(block[row[c]])] * 256 for c in column]
    return Automaton(rules, flat, [out[firsts[b]] for b in order], len(todo))


def accepted(automaton: Automaton, data: bytes) -> list[tuple[int, int]]:
    """The one pass: (place behind the byte, bits of the rules whose match ends there). A rule accepts from the byte that
    makes its match long enough on; its end is where it no longer does, so one long match is one entry."""
    step, accepts = automaton.next, automaton.accepts
    loud = 256 * next((i for i, a in enumerate(accepts) if a), automaton.states)
    state, was, found, at = 0, 0, [], 0
    for byte in data:
        state = step[state + byte]
        if was or state >= loud:
            now = accepts[state >> 8]
            if was & ~now:
                found.append((at, was & ~now))
            was = now
        at += 1
    if was:
        found.append((at, was))
    return found


def spans_of(automaton: Automaton, backward: list[_Backward], heads: list, data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, rule) in bytes, of every match that its rule does not drop; by start, then rule."""
    out, floors = [], [0] * len(automaton.rules)
    for end, bits in accepted(automaton, data):
        for r, rule in enumerate(automaton.rules):
            if not bits >> r & 1:
                continue
            start, floors[r] = backward[r](data, end, floors[r]), end
            size = end - start
            if heads[r] is not None:
                size -= heads[r].match(data, start, end).end() - start
            if size >= rule.least:
                out.append((start, end, r))
    return sorted(out, key=lambda x: (x[0], x[2]))


def _heads(rules) -> list:
    return [re.compile(r.head.encode()) if r.head else None for r in rules]


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans, counted in code points."""
    if data.isascii():
        return spans
    at = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    before = lambda i: int(at[i - 1]) if i else 0
    return [(before(a), before(b), r) for a, b, r in spans]


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id, kinds/starts/ends (arrays of the spans in code points, end exclusive, by start and
    then by the rules' order). Null and empty texts have no spans. Ids may repeat; each row is scanned by itself; other columns are not read."""
    automaton = compile(rules)

    def scan(batches):
        backward, heads = [_Backward(r) for r in rules], _heads(rules)
        names = [r.kind for r in rules]
        for batch in batches:
            found = [code_points(t, spans_of(automaton, backward, heads, t)) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[names[r] for _, _, r in s] for s in found], pa.list_(pa.string())),
                    pa.array([[a for a, _, _ in s] for s in found], pa.list_(pa.int64())),
                    pa.array([[b for _, b, _ in s] for s in found], pa.list_(pa.int64())),
                ],
                names=["id", "kinds", "starts", "ends"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(scan, f"id {kind}, kinds array<string>, starts array<bigint>, ends array<bigint>").withColumnRenamed("id", id_col)


def digest(spans: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    item = lambda x: F.concat_ws(":", x["k"], x["a"].cast("string"), x["b"].cast("string"))
    zipped = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda x: F.struct(x["kinds"].alias("k"), x["starts"].alias("a"), x["ends"].alias("b")))
    is_base = lambda x: x["k"].isin([r.kind for r in base])
    s = spans.withColumn("z", zipped)
    return s.select(
        *[c for c in spans.columns if c not in ("kinds", "starts", "ends")],
        *[F.expr(f"cast(size(filter(kinds, k -> k = '{r.kind}')) as bigint)").alias(f"n_{r.kind}") for r in base],
        F.sha2(F.array_join(F.transform(F.filter("z", is_base), item), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("z", item), ",").alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text", mark: str = "[REDACTED]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """df with every span in the text replaced by the mark (overlapping spans by one); nulls stay null, all columns stay."""
    automaton = compile(rules)
    at = df.columns.index(text_col)

    def scan(batches):
        backward, heads, sign = [_Backward(r) for r in rules], _heads(rules), mark.encode()
        for batch in batches:
            column = batch.column(at)
            out = []
            for t in column.cast(pa.binary()).to_pylist():
                if t is None or not (spans := spans_of(automaton, backward, heads, t)):
                    out.append(t)
                    continue
                parts, done = [], 0
                for a, b, _ in spans:
                    if a >= done:
                        parts += [t[done:a], sign]
                    done = max(done, b)
                out.append(b"".join([*parts, t[done:]]))
            columns = batch.columns
            columns[at] = pa.array(out, pa.binary()).cast(column.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(scan, df.schema)
