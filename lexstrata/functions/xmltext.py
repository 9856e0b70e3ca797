"""Mending of published XML: missing spaces around tags, emphasis, page breaks, stray characters."""

from __future__ import annotations

import copy
import re
import xml.etree.ElementTree as ET

#: Characters that a space is not put behind, and not put before.
NO_SPACE_BEHIND, NO_SPACE_BEFORE = "@#$(-'\" \t\n", "%):?!,. \t\n"


def _wants_gap(before: str, after: str) -> bool:
    return bool(before and after) and before[-1] not in NO_SPACE_BEHIND and after[0] not in NO_SPACE_BEFORE


def spaced(root: ET.Element, tag: str) -> ET.Element:
    """Every element of the tag with spaces around it where its neighbours would run into it."""
    root = copy.deepcopy(root)
    for above in root.iter():
        previous = None
        for e in above:
            lead = (previous.tail if previous is not None else above.text) or ""
            inner, tail = "".join(e.itertext()), e.tail or ""
            if e.tag == tag:
                filled = bool(inner)
                if filled and tail and tail[0] not in NO_SPACE_BEFORE:
                    e.tail = " " + tail
                if (filled and lead and lead[-1] not in NO_SPACE_BEHIND) or (not filled and _wants_gap(lead, tail)):
                    if previous is not None:
                        previous.tail = lead + " "
                    else:
                        above.text = lead + " "
            previous = e
    return root


def without_tag(root: ET.Element, tag: str) -> ET.Element:
    """The elements of a tag taken out with their content, spaces set first; what follows them stays."""
    root = spaced(root, tag)
    for above in root.iter():
        previous = None
        for e in list(above):
            if e.tag != tag:
                previous = e
                continue
            if previous is not None:
                previous.tail = (previous.tail or "") + (e.tail or "")
            else:
                above.text = (above.text or "") + (e.tail or "")
            above.remove(e)
    return root


def unwrapped(root: ET.Element, tag: str, mark: str | None = None) -> ET.Element:
    """The elements of a tag renamed to `mark` (emphasis for the web), attributes gone."""
    root = copy.deepcopy(root)
    for e in root.iter(tag):
        e.tag = mark or e.tag
        e.attrib.clear()
    return root


def body_text(root: ET.Element) -> str:
    """Inner text with emphasis as EM elements and page breaks gone."""
    e = unwrapped(without_tag(root, "PRTPAGE"), "E", "EM")
    return (e.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in e)


def clear_between(root: ET.Element, start: str, end: str) -> ET.Element:
    """Without what stands from one character to another, in any text or markup (brackets around page numbers and the like)."""
    return ET.fromstring(re.sub(re.escape(start) + "[^" + re.escape(end) + "]*" + re.escape(end), "", ET.tostring(root, encoding="unicode")))


def without_char(root: ET.Element, char: str) -> ET.Element:
    """Without a character in any text."""
    root = copy.deepcopy(root)
    for e in root.iter():
        e.text, e.tail = (x.replace(char, "") if x else x for x in (e.text, e.tail))
        for k, v in list(e.attrib.items()):
            e.set(k, v.replace(char, ""))
    return root
