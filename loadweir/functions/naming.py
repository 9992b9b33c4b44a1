"""Identifier case. Plan-time only: no row is looked at."""

from __future__ import annotations

import re

from loadweir.spec import NAMING_CASES

# A word is a run of capitals before a capitalised word, a capitalised or lower word, or digits.
_WORD = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+[0-9]*|[A-Z]+[0-9]*|[0-9]+")


def to_case(name: str, case: str) -> str:
    """``name`` in snake_case, camel_case or pascal_case; leading underscores are kept."""
    if case not in NAMING_CASES:
        raise ValueError(f"Unknown naming case '{case}'. Known cases: {list(NAMING_CASES)}")
    lead = name[: len(name) - len(name.lstrip("_"))]
    words = [w.lower() for w in _WORD.findall(name)]
    if not words:
        raise ValueError(f"'{name}' holds no letter or digit to name a column by")
    if case == "snake_case":
        body = "_".join(words)
    else:
        body = "".join(w.capitalize() for w in words)
        if case == "camel_case":
            body = body[0].lower() + body[1:]
    return lead + body if lead or not body[0].isdigit() else "_" + body


def table_name(base: str, prefix: str = "", suffix: str = "", case: str = "snake_case") -> str:
    """The table a resource is written to; prefix and suffix are added as they stand."""
    return f"{prefix}{to_case(base, case)}{suffix}"
