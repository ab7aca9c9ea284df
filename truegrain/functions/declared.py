"""Type declarations as text: CHAR(n), DECIMAL(p,s), SMALLINT, INTEGER."""

from __future__ import annotations

import re
from dataclasses import dataclass

from truegrain.errors import RuleError

_CHAR = re.compile(r"CHAR\(\s*(\d+)\s*\)")
_DECIMAL = re.compile(r"DECIMAL\(\s*(\d+)\s*,\s*(\d+)\s*\)")


@dataclass(frozen=True)
class Declared:
    kind: str
    size: int = 0
    scale: int = 0


def parse_declared(text: str) -> Declared:
    """Read a declaration; anything else is an error rather than a silent pass."""
    stripped = (text or "").strip()
    if match := _CHAR.fullmatch(stripped):
        return Declared("CHAR", int(match[1]))
    if match := _DECIMAL.fullmatch(stripped):
        size, scale = int(match[1]), int(match[2])
        if not 1 <= size <= 38 or scale > size:
            raise RuleError(f"DECIMAL({size},{scale}) is out of bounds")
        return Declared("DECIMAL", size, scale)
    if stripped in ("SMALLINT", "INTEGER"):
        return Declared(stripped)
    raise RuleError(f"unknown type '{text}'")
