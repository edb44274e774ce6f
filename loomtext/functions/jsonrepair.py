"""Pairs out of a model's raw answer: find the array, then three ever more tolerant ways to read it."""

from __future__ import annotations

import json
import re

_FENCE = re.compile(r"```[A-Za-z0-9_-]*")
_TRAILING = re.compile(r",(?=\s*[}\]])")
_FLAT = re.compile(r"\{[^{}]+\}")


def array_text(raw: str) -> str:
    """From the first [ to the ] that balances it, brackets in strings counted too; without [ all of it."""
    text = _FENCE.sub("", raw).strip()
    begin = text.find("[")
    if begin < 0:
        return text
    depth = 0
    for m in re.finditer(r"[\[\]]", text[begin:]):
        depth += 1 if m[0] == "[" else -1
        if not depth:
            return text[begin : begin + m.end()]
    return text[begin:]


def _dicts(text: str) -> list[dict] | None:
    try:
        data = json.loads(text)
    except ValueError:
        return None
    return [x for x in data if isinstance(x, dict)] if isinstance(data, list) else None


def pairs(raw: str | None) -> list[dict]:
    """The objects of the answer: as it is, without trailing commas, or each flat object by itself."""
    text = array_text(raw or "")
    found = _dicts(text)
    if found is None:
        found = _dicts(_TRAILING.sub("", text))
    if found is None:
        found = []
        for m in _FLAT.finditer(text):
            found += _dicts(f"[{m[0]}]") or []
    return found
