"""SQL equivalents of the registered queries, for a second engine.

Each text is one SELECT over the driver tables. The tables it shares with others are
prepended as common table expressions, only those it needs.
"""

from __future__ import annotations

import re

from oracle.base import CTES
from oracle.bodies import BODIES


def _needed(sql: str) -> list[str]:
    """Names of the CTEs a text uses, directly or through others, in definition order."""
    names = list(CTES)
    found: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in names:
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                todo.append(CTES[name])
    return [n for n in names if n in found]


def with_ctes(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in _needed(body))
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def all_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
