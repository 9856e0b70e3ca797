"""Depths of paragraph markers as a search over assignments of (type, index, depth).

A marker such as `i` may be a letter or a numeral; what it is follows from what stands around it. Assignments are
extended marker by marker and dropped as soon as a rule fails, so the search rarely branches.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from .markers import STARS, TYPES

MAX_DEPTH = 9
REGTEXT_ORDER = ("lower", "ints", "roman", "upper", "em_ints", "em_roman")
INTERP_ORDER = (("ints", "em_ints"), ("lower", "roman", "upper"), "upper", "em_ints", "em_roman")


@dataclass(frozen=True)
class Place:
    type: str
    index: int
    depth: int


def _path(places: Sequence[Place]) -> list[Place]:
    """The innermost place at each depth that is still open."""
    open_: list[Place] = []
    for p in places:
        open_ = [*open_[: p.depth], *[p] * max(0, p.depth - len(open_)), p]
    return open_


def _continues(places: Sequence[Place], new: Place) -> bool:
    """Does an open place at this depth come just before the new one?"""
    path = _path(places)
    return new.depth < len(path) and path[new.depth].depth == new.depth and path[new.depth].type == new.type and path[new.depth].index + 1 == new.index


def _follows(places: Sequence[Place], new: Place) -> bool:
    if not places:
        return new.depth == 0
    last = places[-1]
    if new.type == last.type == "stars":
        return new.depth < last.depth or (last.index == 1 and new.depth == last.depth + 1)
    if new.type == last.type:
        return _continues(places, new)
    if new.index == 0 and new.depth == last.depth + 1 and new.type != "stars":
        return True
    if new.type == "stars":
        return last.depth - new.depth >= -1
    if last.type == "stars" and new.depth == last.depth:
        return True
    return _continues(places, new)


def _siblings(places: Sequence[Place]) -> bool:
    """Within a run of siblings: one type besides stars, not the parent's, and indices that rise (a row of stars takes one up)."""
    stack: list[tuple[int, str | None, int, str | None]] = []  # depth, type, last index, parent's type
    for p in places:
        while stack and stack[-1][0] > p.depth:
            stack.pop()
        if not stack or stack[-1][0] < p.depth:
            parent = stack[-1][1] if stack else None
            stack.append((p.depth, None, -1, parent))
        depth, kind, index, parent = stack.pop()
        if p.type == "stars":
            index += p.index == 0
        else:
            if (kind is not None and kind != p.type) or p.type == parent or p.index <= index:
                return False
            kind, index = p.type, p.index
        stack.append((depth, kind, index, parent))
    return True


def _ordered(place: Place, order) -> bool:
    if order is None or place.type == "stars":
        return True
    if place.depth >= len(order):
        return False
    allowed = order[place.depth]
    return place.type == allowed if isinstance(allowed, str) else place.type in allowed


def solve(markers: Sequence[str], order=None) -> list[list[Place]]:
    """All assignments (there may be very many; depths() finds the best without listing them), in the order of their depths, then types and indices."""
    found: list[list[Place]] = []

    def extend(places: list[Place]) -> None:
        if len(places) == len(markers):
            found.append(places)
            return
        marker = markers[len(places)]
        deepest = min(MAX_DEPTH, places[-1].depth + 1) if places else 0
        for depth in range(deepest + 1):
            for name, alphabet in TYPES.items():
                for index in (i for i, m in enumerate(alphabet) if m == marker):
                    new = Place(name, index, depth)
                    if _ordered(new, order) and _follows(places, new) and _siblings([*places, new]):
                        extend([*places, new])

    if markers:
        extend([])
    return sorted(found, key=lambda s: ([p.depth for p in s], [(p.type, p.index) for p in s]))


def weight(places: Sequence[Place]) -> float:
    """Solutions in which many markers have a single child weigh less."""
    lone = 0
    for i, p in enumerate(places):
        children = 0
        for q in places[i + 1 :]:
            if q.depth <= p.depth:
                break
            children += q.depth == p.depth + 1
        lone += children == 1
    return 1 - 0.5 * lone / len(places) if places else 1.0


class Level(NamedTuple):
    """A depth that is open: its last place, the type and index its siblings have reached, and the last place's children (2: two or more)."""

    type: str
    place: int
    kind: str | None
    index: int
    children: int


def _extended(levels: tuple[Level, ...], name: str, place: int, at: int) -> tuple[tuple[Level, ...], int] | None:
    """The open levels after one more place, and how many places with a single child it closes; None where a rule fails.
    The rules are those of _follows and _siblings, which look at open levels only."""
    deepest = len(levels) - 1
    if levels:
        last = levels[-1]
        if name == last.type == "stars":
            fits = at < deepest or (last.place == 1 and at == deepest + 1)
        elif name == "stars" or (name != last.type and ((place == 0 and at == deepest + 1) or (last.type == "stars" and at == deepest))):
            fits = True
        else:
            fits = at <= deepest and levels[at].type == name and levels[at].place + 1 == place
        if not fits:
            return None
    kind, index = (levels[at].kind, levels[at].index) if at <= deepest else (None, -1)
    if name == "stars":
        index += place == 0
    else:
        if (kind is not None and kind != name) or (at and levels[at - 1].kind == name) or place <= index:
            return None
        kind, index = name, place
    above = levels[:at]
    if at:
        t, p, k, i, n = above[-1]
        above = (*above[:-1], Level(t, 0 if t == "stars" else p, k, i, min(2, n + 1)))  # which stars they are no longer matters
    return (*above, Level(name, place, kind, index, 0)), sum(x.children == 1 for x in levels[at:])


def depths(markers: Sequence[str], order=None) -> list[int] | None:
    """Depths of the best solution (of equals, the smallest vector); None without a solution. Trailing stars are level with what they follow.

    Exact for sequences of any length: what may follow depends on the open levels only, so of all assignments of the first
    markers that leave the same levels open, one is carried on: that with the fewest places with a single child and, of
    equals, the smallest vector.
    """
    if not markers:
        return None
    best: dict[tuple[Level, ...], tuple[int, tuple[int, ...]]] = {(): (0, ())}
    for marker in markers:
        read = [(name, i) for name, alphabet in TYPES.items() for i, m in enumerate(alphabet) if m == marker]
        longer: dict[tuple[Level, ...], tuple[int, tuple[int, ...]]] = {}
        for levels, (lone, vector) in best.items():
            for depth in range(min(MAX_DEPTH, len(levels)) + 1):
                for name, index in read:
                    if _ordered(Place(name, index, depth), order) and (step := _extended(levels, name, index, depth)):
                        found = (lone + step[1], (*vector, depth))
                        if step[0] not in longer or found < longer[step[0]]:
                            longer[step[0]] = found
        best = longer
    ends = [(lone + sum(x.children == 1 for x in levels), vector) for levels, (lone, vector) in best.items()]
    return list(min(ends)[1]) if ends else None


def depth_sets(markers: Sequence[str], order=None) -> set[tuple[int, ...]]:
    return {tuple(p.depth for p in s) for s in solve(markers, order)}


def is_stars(marker: str) -> bool:
    return marker in STARS


def without_trailing_stars(markers: Iterable[str]) -> list[str]:
    out = list(markers)
    while out and is_stars(out[-1]):
        out.pop()
    return out
