"""Paragraph markers: their alphabets, and how deep they can be."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from ..operators.tree import ROMAN

LOWER, UPPER = tuple(ascii_lowercase), tuple(ascii_uppercase)
INTS = tuple(str(i) for i in range(1, 51))
STARS = ("STARS", "* * *")


def emphasised(markers) -> tuple[str, ...]:
    return tuple(f'<E T="03">{m}</E>' for m in markers)


#: Plain-text levels of a section's paragraphs, outermost first.
LEVELS: tuple[tuple[str, ...], ...] = (LOWER, INTS, tuple(ROMAN), UPPER, emphasised(INTS), emphasised(ROMAN))

#: Types that the depth solver tells apart; letters may be doubled there.
TYPES: dict[str, tuple[str, ...]] = {
    "lower": LOWER + tuple(c * 2 for c in LOWER),
    "upper": UPPER + tuple(c * 2 for c in UPPER),
    "ints": tuple(str(i) for i in range(1, 51)),
    "roman": tuple(ROMAN),
    "em_ints": emphasised(INTS),
    "em_roman": emphasised(ROMAN),
    "stars": STARS,
}


def levels_of(marker: str) -> list[int]:
    """Levels (from 0) whose alphabet has the marker."""
    return [i for i, level in enumerate(LEVELS) if marker in level]


def marker_of(label: list[str], node_type: str, text: str) -> str:
    """How a node's own text would begin: `1.` in interpretations (and in appendices that write so), else `(a)`."""
    last = label[-1]
    if "Interp" in label or (node_type == "appendix" and text.strip().startswith(f"{last}.")):
        return f"{last}."
    return f"({last})"
