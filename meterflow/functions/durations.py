"""Duration text used as an operator parameter, e.g. ``90``, ``"1h:30m"`` or ``"500ms"``."""

from __future__ import annotations

import re
from decimal import Decimal

# Microseconds per unit.
UNIT_MICROS = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}

_PART = re.compile(r"\s*(\d+(?:\.\d+)?)\s*([a-z]+)\s*")


def micros(duration: str | int | float) -> int:
    """Length of a duration in whole microseconds; bare numbers are seconds."""
    text = str(duration).strip().lower()
    sign, text = (-1, text[1:]) if text.startswith("-") else (1, text)
    if re.fullmatch(r"\d+(\.\d*)?|\.\d+|\d+(\.\d+)?e[+-]?\d+", text):
        return sign * int(Decimal(text) * UNIT_MICROS["s"])
    total = Decimal(0)
    for part in filter(str.strip, text.split(":")):
        found = _PART.fullmatch(part)
        if not found or found[2] not in UNIT_MICROS:
            raise ValueError(f"not a duration: {duration!r}")
        total += Decimal(found[1]) * UNIT_MICROS[found[2]]
    return sign * int(total)
