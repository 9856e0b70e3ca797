"""Label trees in memory, for what works on one document at a time."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

KINDS = ("appendix", "interp", "regtext", "subpart", "emptypart")
INTERP = "Interp"


@dataclass
class Node:
    text: str = ""
    label: list[str] = field(default_factory=list)
    node_type: str = "regtext"
    title: str | None = None
    tagged_text: str = ""
    marker: str | None = None
    children: list[Node] = field(default_factory=list)
    child_labels: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.label = [x for x in self.label if x]
        self.title = self.title or None

    @property
    def label_id(self) -> str:
        return "-".join(self.label)

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += reversed(n.children)

    def find(self, label_id: str) -> Node | None:
        return next((n for n in self.walk() if n.label_id == label_id), None)

    def map(self, f: Callable[[Node], object]) -> list:
        return [v for n in self.walk() if (v := f(n)) is not None]

    @property
    def reserved(self) -> bool:
        return "[Reserved]" in self.text or "[Reserved]" in (self.title or "")

    @property
    def placeholder(self) -> bool:
        """An interpretation that only holds others together."""
        return INTERP in self.label and not self.text and not self.title

    def digest(self) -> str:
        """Hash of the subtree: own fields and the children's hashes, in order."""
        done: dict[int, str] = {}
        for n in reversed(list(self.walk())):
            own = "\x1f".join((n.text, n.tagged_text, n.title or "", n.label_id, n.node_type))
            done[id(n)] = hashlib.sha256((own + "".join(done[id(c)] for c in n.children)).encode()).hexdigest()
        return done[id(self)]


def to_dict(n: Node) -> dict:
    """For JSON: title and marker only where there are any; tagged text and child labels stay out."""
    out = {"text": n.text, "label": n.label, "node_type": n.node_type, "children": [to_dict(c) for c in n.children]}
    return out | ({"title": n.title} if n.title else {}) | ({"marker": n.marker} if n.marker else {})


def from_dict(d: dict) -> Node:
    return Node(d["text"], list(d["label"]), d["node_type"], d.get("title"), d.get("tagged_text", ""), d.get("marker"), [from_dict(c) for c in d.get("children", [])], list(d.get("child_labels", [])))


def to_json(n: Node) -> str:
    return json.dumps(to_dict(n), sort_keys=True, indent=4)


#: Columns of a node table for one tree.
ROW_SCHEMA = "path array<int>, label array<string>, label_id string, node_type string, title string, text string, tagged_text string"


def to_rows(root: Node) -> list[tuple]:
    out, stack = [], [(root, [0])]
    while stack:
        n, path = stack.pop()
        out.append((path, n.label, n.label_id, n.node_type, n.title, n.text, n.tagged_text))
        stack += [(c, [*path, i]) for i, c in reversed(list(enumerate(n.children)))]
    return out


def from_rows(rows) -> Node | None:
    """rows: (path, label, label_id, node_type, title, text, tagged_text), in any order."""
    made: dict[tuple, Node] = {}
    root = None
    for path, label, _, kind, title, text, tagged in sorted(rows, key=lambda r: list(r[0])):
        n = made[tuple(path)] = Node(text or "", list(label), kind, title, tagged or "")
        above = made.get(tuple(path)[:-1])
        if above is None:
            root = root or n
        else:
            above.children.append(n)
    return root


def treeify(nodes: list[Node]) -> list[Node]:
    """A forest of flat nodes: each goes under the one whose label is the longest beginning of its own."""
    by_label = {}
    for n in nodes:
        by_label.setdefault(tuple(x for x in n.label if x != INTERP), n)
    roots = []
    for n in nodes:
        key = tuple(x for x in n.label if x != INTERP)
        above = next((by_label[key[:k]] for k in range(len(key) - 1, 0, -1) if key[:k] in by_label and by_label[key[:k]] is not n), None)
        (above.children if above else roots).append(n)
    return roots


def merge_duplicates(nodes: list[Node]) -> list[Node]:
    """Siblings with one label become the first of them, with the children of all."""
    first: dict[str, Node] = {}
    for n in nodes:
        if n.label_id in first:
            first[n.label_id].children += n.children
        else:
            first[n.label_id] = n
    return list(first.values())


def flatten(root: Node) -> list[Node]:
    """Every node without its children, those below before those above."""
    out: list[Node] = []
    for n in reversed(list(root.walk())):
        out.append(Node(n.text, list(n.label), n.node_type, n.title, n.tagged_text, n.marker, [], [c.label_id for c in n.children]))
    return out


def prepend_label(root: Node, prefix: list[str]) -> Node:
    """The whole tree with its labels under a prefix."""
    for n in root.walk():
        n.label = [*prefix, *n.label]
    return root


def is_empty(n: Node) -> bool:
    """Nothing to show: no text, no title, nothing below."""
    return not n.text.strip() and not n.title and not n.children
