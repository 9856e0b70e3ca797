"""Settings in layers: defaults of the library, then files or tables in order; what comes later wins, key by key."""

from __future__ import annotations

import json
from pathlib import Path

#: What a build reads where nothing else says so.
DEFAULTS: dict[str, object] = {
    "title": None,
    "act": None,
    "graphics_template": "https://images.invalid/%s.gif",
    "meta": {},
    "macros": [],
    "image_overrides": {},
    "patches": {},
    "include_terms": {},
    "ignore_terms": {},
}


def merged(below: dict, above: dict) -> dict:
    """above over below; tables within are merged, lists follow one another, anything else is replaced."""
    out = dict(below)
    for k, v in above.items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = merged(out[k], v)
        elif isinstance(v, list) and isinstance(out.get(k), list):
            out[k] = [*out[k], *v]
        else:
            out[k] = v
    return out


def layered(*sources: str | dict) -> dict:
    """Settings of JSON files (those that are missing are left out, as local settings may be) and tables, over the defaults."""
    out = dict(DEFAULTS)
    for s in sources:
        if isinstance(s, str):
            path = Path(s)
            if not path.exists():
                continue
            s = json.loads(path.read_text())
        out = merged(out, s)
    return out


def first_holding(key: str, *sources: dict, default=None):
    """The value of the first source that has the key."""
    return next((s[key] for s in sources if key in s), default)


def apply_macros(text: str, macros: list) -> str:
    """Replacements (old, new) in a source, in order."""
    for old, new in macros:
        text = text.replace(old, new)
    return text
