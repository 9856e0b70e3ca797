"""Definitions of terms in paragraphs, and where defined terms are used."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

#: Nouns whose plural is the same, and irregular plurals. Fixed values.
UNCOUNTABLE = {"equipment", "fish", "information", "money", "rice", "series", "sheep", "species"}
IRREGULAR = {"child": "children", "man": "men", "ox": "oxen", "mouse": "mice", "louse": "lice", "quiz": "quizzes", "matrix": "matrices", "vertex": "vertices", "index": "indices", "axis": "axes", "octopus": "octopi", "virus": "viri"}
#: Words in -o that take -es. Fixed values.
O_WITH_E = {"buffalo", "tomato", "potato"}
_VOWELS = "aeiou"


def _plural_word(word: str) -> str:
    """By the end of the word: -sis, -y after a consonant, -fe and -lf/-rf, hissing sounds, -tum/-ium, -o with e; else -s."""
    low = word.lower()
    if low in UNCOUNTABLE:
        return word
    for whole, many in IRREGULAR.items():
        if low.endswith(whole) and low not in ("human", "german", "roman") and (low == whole or whole in ("man", "child", "mouse")):
            kept = len(word) - len(whole)
            return word[:kept] + (many if low[kept:] == word[kept:] else word[kept] + many[1:])
    if low.endswith("sis"):
        return word[:-2] + "es"
    if low.endswith("y") and low[-2:-1] not in _VOWELS or low.endswith("quy"):
        return word[:-1] + "ies"
    if low.endswith("fe") and low[-3:-2] != "f":
        return word[:-2] + "ves"
    if low.endswith(("lf", "rf")):
        return word[:-1] + "ves"
    if low.endswith(("x", "ch", "ss", "sh", "bus", "alias", "status")) or low in O_WITH_E:
        return word + "es"
    if low.endswith(("tum", "ium")):
        return word[:-2] + "a"
    return word if low.endswith("s") else word + "s"


def plural(term: str) -> str:
    """The plural of a term's last word; `person` stays regular."""
    if not term.strip():
        return term
    at = term.rstrip().rfind(" ") + 1
    return term[:at] + _plural_word(term[at:].rstrip()) + term[len(term.rstrip()) :]


@dataclass(frozen=True)
class Ref:
    term: str
    label: str
    start: int
    end: int


def uses(text: str, terms: Iterable[tuple[str, str]], excluded: Iterable[tuple[int, int]] = ()) -> list[tuple[str, str, int, int]]:
    """(term as matched, label, start, end) of every use: plurals count, longer terms go first, and nothing may begin or end
    within what was matched before or is excluded (ends count as within)."""
    text = text.lower()
    taken = list(excluded)
    every: dict[str, str] = {}
    for term, label in terms:
        every[term] = label
        every.setdefault(plural(term), label)
    out = []
    for term in sorted(every, key=lambda t: (-len(t), t)):
        if not term:
            continue
        found = []
        for m in re.finditer(rf"\b{re.escape(term.lower())}\b", text):
            if not any(a <= m.start() <= b or a <= m.end() <= b for a, b in taken):
                found.append(m.span())
        taken += found
        out += [(term, every[term], a, b) for a, b in found]
    return sorted(out, key=lambda x: (x[2], x[3]))


_PIECE = re.compile(r"\w+|\W")


class Scanner:
    """All terms of a scope as one automaton over words: a trie of the words of terms and plurals, with links from each state to the
    longest other beginning that ends there. One pass over a text finds every place of every term, however many there are."""

    def __init__(self, terms: Iterable[tuple[str, str]]):
        # of each phrase: the definition of the term that it is, if it is one, and of the terms whose plural it is
        known: dict[str, tuple[list[str], list[str]]] = {}
        for term, label in terms:
            for phrase, i in ((term, 0), (plural(term), 1)):
                if phrase:
                    known.setdefault(phrase, ([], []))[i].append(label)
        self.phrases = sorted(known, key=lambda t: (-len(t), t))
        self.labels = [known[p] for p in self.phrases]
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        for i, phrase in enumerate(self.phrases):
            state = 0
            for piece in _PIECE.findall(phrase.lower()):
                if piece not in self.next[state]:
                    self.next[state][piece] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                state = self.next[state][piece]
            self.ends[state].append(i)
        self.back = [0] * len(self.next)
        queue = list(self.next[0].values())
        for state in queue:  # breadth first: links lead to shorter beginnings, which are done
            for piece, target in self.next[state].items():
                self.back[target] = self._step(self.back[state], piece)
                self.ends[target] = self.ends[target] + self.ends[self.back[target]]
                queue.append(target)

    def _step(self, state: int, piece: str) -> int:
        while piece not in self.next[state]:
            if not state:
                return 0
            state = self.back[state]
        return self.next[state][piece]

    def places(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Start and end of every place of each phrase (by its number), in order; text is in lower case."""
        out: dict[int, list[tuple[int, int]]] = {}
        word = lambda at: 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")
        state = 0
        for m in _PIECE.finditer(text):
            state = self._step(state, m[0])
            for i in self.ends[state]:
                a, b = m.end() - len(self.phrases[i].lower()), m.end()
                if word(a) != word(a - 1) and word(b) != word(b - 1):
                    out.setdefault(i, []).append((a, b))
        return out

    def uses(self, text: str, excluded: Iterable[tuple[int, int]] = (), without: str | None = None) -> list[tuple[str, str, int, int]]:
        """What uses() gives for the terms whose definition is not `without`."""
        text = text.lower()
        within = bytearray(len(text) + 1)  # places at which no term may begin or end any more

        def take(a: int, b: int) -> None:
            within[max(a, 0) : b + 1] = b"\x01" * max(0, min(b, len(text)) + 1 - max(a, 0))

        for a, b in excluded:
            take(a, b)
        out = []
        for i, spans in sorted(self.places(text).items()):
            own, of_plural = ([x for x in labels if x != without] for labels in self.labels[i])
            label = own[-1] if own else of_plural[0] if of_plural else None
            if label is None:
                continue
            last, found = 0, []
            for a, b in spans:
                if a >= last:
                    last = b
                    if not (within[a] or within[b]):
                        found.append((a, b))
            for a, b in found:
                take(a, b)
            out += [(self.phrases[i], label, a, b) for a, b in found]
        return sorted(out, key=lambda x: (x[2], x[3]))


_QUOTED = re.compile("[“”]([^“”]+)[“”]")
_MEANS = re.compile(r"(?i)\b(?:means|refers?\s+to|has\s+the\s+(?:same\s+)?meaning)\b")
_E = re.compile(r"<E[^>]*>\s*(.+?)\s*</E>", re.S)
_E_LIST = re.compile(r"(?is)((?:<E[^>]*>[^<]*</E>(?:\s*(?:,|or|and)\s*)*(?:\([^)]*\)\s*)?)+)\s*(?:means\b|refers?\s+to\b|has\s+the\s+(?:same\s+)?meaning\b)")
_PURPOSE = re.compile(r"(?i)for\s+(?:the\s+)?purposes?\s+of\s+[^,]*,\s*(?:the\s+term\s+)?([^,“”]*?)\s+means\b")
_EXCLUDES = re.compile("(?i)the\\s+term\\s+[“”]?([^“”]+?)[“”]?\\s+(?:does\\s+not\\s+include|shall\\s+not\\s+include)")


def has_indicator(texts: Iterable[str]) -> bool:
    """Does a paragraph or one above it speak of definitions?"""
    return any("Definition" in t or "definition" in t or re.search(r"(?is)the term .* means", t) for t in texts)


def definitions(text: str, label: str, above: Iterable[str] = (), tagged: str = "", known: Iterable[str] = ()) -> tuple[list[Ref], list[Ref]]:
    """Terms that a paragraph defines and terms that it excludes (`the term X does not include`, for an X that applies already).

    Quoted terms count where the paragraph or one above it is about definitions; emphasised terms where `means` follows.
    """
    included: list[Ref] = []
    excluded: list[Ref] = []
    known = {k.lower() for k in known}

    def add(term: str, start: int) -> None:
        term = term.lower().strip().strip(",.;:")
        if term and all(r.term != term for r in included + excluded):
            gone = any(m[1].lower().strip() == term for m in _EXCLUDES.finditer(text)) and term in known
            (excluded if gone else included).append(Ref(term, label, start, start + len(term)))

    if has_indicator([*above, text]):
        for m in _QUOTED.finditer(text):
            lead = len(m[1]) - len(m[1].lstrip())
            add(m[1], m.start(1) + lead)
    for m in _PURPOSE.finditer(text):
        add(m[1], m.start(1))
    for m in _E_LIST.finditer(tagged):
        for e in _E.finditer(m[1]):
            at = text.lower().find(e[1].strip().lower())
            if at >= 0:
                add(e[1], at)
    return included, excluded


def scopes(text: str, label: list[str], subpart: list[list[str]] = ()) -> list[list[str]]:
    """Labels that a definition in this text holds for, as `purposes of this section` and the like say; each for the
    interpretations too. Empty: the text does not say."""
    out: list[list[str]] = []
    for m in re.finditer(r"(?i)(?:purposes\s+of\s+|as\s+used\s+in\s+)(?:this\s+(part|subpart|section|paragraph)|§+\s*(\d+)\.(\d+)((?:\([a-zA-Z0-9]+\))*)|paragraphs?\s+((?:\([a-zA-Z0-9]+\))+))", text):
        kind = (m[1] or "").lower()
        if kind == "part":
            out.append(label[:1])
        elif kind == "subpart":
            out += [list(s) for s in subpart]
        elif kind == "section":
            out.append(label[:2])
        elif kind == "paragraph":
            out.append(list(label))
        elif m[2]:
            out.append([m[2], m[3], *re.findall(r"\(([^)]+)\)", m[4])])
        else:
            out.append([*label[:2], *re.findall(r"\(([^)]+)\)", m[5])])
    return out + [[*s, "Interp"] for s in out]
