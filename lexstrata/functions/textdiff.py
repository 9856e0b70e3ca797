"""Word-level differences of texts, in character offsets of the old one."""

from __future__ import annotations

import re

import numpy as np

_TOKEN = re.compile(r"!\[[^\]]*\]\([^)]*\)|\s+|(?:(?!!\[[^\]]*\]\()\S)+")


def words(text: str) -> list[str]:
    """Words and runs of whitespace; an image mark is one word. Joined they give the text."""
    return _TOKEN.findall(text)


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence.

    A row of the table of lengths is one whole number: bit i is 0 where the length grows at a[i]. A row comes from the one before by
    an addition, so a row costs the machine words of a. Rows are kept for the way back, BITS in all; larger tables are cut in
    two where the lengths from both sides add up to most, so memory grows with a and b and not with their product.
    """
    known = set(a) & set(b)  # what is on one side only is never common
    places_a, places_b = [i for i, x in enumerate(a) if x in known], [j for j, x in enumerate(b) if x in known]
    a, b = [a[i] for i in places_a], [b[j] for j in places_b]
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, low, high = todo.pop()
        if lo == hi or low == high:
            continue
        if (hi - lo) * (high - low) <= BITS or high - low == 1:
            out += [(places_a[lo + i], places_b[low + j]) for i, j in _traced(a[lo:hi], b[low:high])]
            continue
        middle = (low + high) // 2
        front = _lengths(_rows(a[lo:hi], b[low:middle])[-1], hi - lo)
        rear = _lengths(_rows(a[lo:hi][::-1], b[middle:high][::-1])[-1], hi - lo)
        at = lo + int((front + rear[::-1]).argmax())
        todo += [(lo, at, low, middle), (at, hi, middle, high)]
    return sorted(out)


#: Bits of the rows that are kept at once.
BITS = 1 << 28


def _rows(a: list, b: list, every: bool = False) -> list[int]:
    """The rows of the table of lengths: all, from that of no b on, or the last one only."""
    of: dict = {}
    for i, x in enumerate(a):
        of[x] = of.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    rows = [row]
    for x in b:
        met = row & of.get(x, 0)
        row = ((row + met) | (row - met)) & full
        if every:
            rows.append(row)
    return rows if every else [row]


def _lengths(row: int, n: int) -> np.ndarray:
    """Lengths at the first 0..n of a."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _traced(a: list, b: list) -> list[tuple[int, int]]:
    rows, i, j, out = _rows(a, b, True), len(a), len(b), []
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
            if rows[j] >> (i - 1) & 1:
                i -= 1
                out.append((i, j))
    return out


def opcodes(old: str, new: str) -> list:
    """('insert', offset, text), ('delete', start, end), or [delete, insert] where words are replaced.

    As few words as can be are deleted and inserted. Whitespace decides nothing: it is the same where it stands next to words
    that are, or where texts begin or end alike."""
    a, b = words(old), words(new)
    at = [0]
    for w in a:
        at.append(at[-1] + len(w))
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    end_a, end_b = len(a) - tail, len(b) - tail
    said_a, said_b = ([i for i in range(head, end) if not x[i].isspace()] for x, end in ((a, end_a), (b, end_b)))
    same = [(said_a[i], said_b[j]) for i, j in common([a[i] for i in said_a], [b[j] for j in said_b])]
    met: list[tuple[int, int]] = []
    i, j = head, head
    for k, m in [*same, (end_a, end_b)]:
        if k > i and m > j and (k < end_a or tail) and a[k - 1] == b[m - 1] and a[k - 1].isspace() and not (k - 1 == i - 1 or m - 1 == j - 1):
            met.append((k - 1, m - 1))
        if k < end_a:
            met.append((k, m))
            i, j = k + 1, m + 1
            if i < end_a and j < end_b and a[i] == b[j] and a[i].isspace():
                met.append((i, j))
                i, j = i + 1, j + 1
    out: list = []
    i, j = head, head
    for k, m in [*met, (end_a, end_b)]:
        gone, come = ("delete", at[i], at[k]), ("insert", at[i], "".join(b[j:m]))
        if k > i and m > j:
            out.append([gone, come])
        elif k > i:
            out.append(gone)
        elif m > j:
            out.append(come)
        i, j = k + 1, m + 1
    return out


def flat(ops: list) -> list[tuple]:
    return [x for op in ops for x in (op if isinstance(op, list) else [op])]


def apply(old: str, ops: list) -> str:
    """The new text, from the old one and its differences."""
    out, at = [], 0
    for op in sorted(flat(ops), key=lambda o: (o[1], o[0] == "insert" and 1 or 0)):
        if op[0] == "delete":
            out.append(old[at : op[1]])
            at = op[2]
        elif op[1] >= at:
            out += [old[at : op[1]], op[2]]
            at = op[1]
        else:  # inserted where something was just deleted
            out.append(op[2])
    return "".join(out) + old[at:]
