"""Dictionaries the driver queries apply to the given tables (built from rules)."""

from __future__ import annotations

# Adjective "regions" in lookup order. "old" comes first and is a substring of
# "cold": a text with "cold" also hits "old", and only falls through to "cold" when
# none of the cities of "old" is in it. "e" is last and catches what is left.
GAZ_REGIONS = ("old", "cold", "red", "hot", "blue", "small", "new", "large", "e")
GAZ_CITIES = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
GAZ_SHORT = {"old": GAZ_CITIES[:3], "e": ("widget", "plate")}
GAZ_NULL_PAIR = ("new", "rod")  # a pair without coordinates


def part_gazetteer() -> list[tuple]:
    """``(ord, wide, narrow, lat, lng)`` rows, coordinates from the position."""
    rows, o = [], 0
    for w in GAZ_REGIONS:
        for n in GAZ_SHORT.get(w, GAZ_CITIES):
            if (w, n) == GAZ_NULL_PAIR:
                rows.append((o, w, n, None, None))
            else:
                rows.append((o, w, n, round(30.0 + 0.25 * o, 4), round(120.0 + 0.5 * o, 4)))
            o += 1
    return rows
