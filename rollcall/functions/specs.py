"""Small text settings: size bins, value ranges and category maps.

They are a handful of items typed by a user, so they are read on the driver and
enter the plans as literals.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bin(NamedTuple):
    """One inclusive interval; ``hi`` is None when the interval is open."""

    pos: int
    label: str
    lo: int
    hi: int | None


def parse_bins(spec: str) -> list[Bin]:
    """``"1,2,4-6,11-end"`` → single values, closed ranges and open ranges.

    Bins may overlap and may leave gaps; each one is counted on its own.
    """
    return [_interval(pos, item, spec) for pos, item in enumerate(spec.split(","))]


def parse_ranges(spec: str) -> list[Bin]:
    """``"1901-1950,1951-1980"`` → closed ranges only."""
    ranges = parse_bins(spec)
    for item in ranges:
        if item.hi is None or "-" not in item.label:
            raise ValueError(f"not a closed range: {item.label!r} in {spec!r}")
    return ranges


def parse_categories(spec: str) -> dict[str, str]:
    """``"article:journal;book:book"`` → mapping from kind to category."""
    mapping = {}
    for item in spec.split(";"):
        kind, found, category = item.partition(":")
        if not found or not kind.strip() or not category.strip():
            raise ValueError(f"not a kind:category pair: {item!r} in {spec!r}")
        mapping[kind.strip()] = category.strip()
    return mapping


def category_of(kind: Column | str, mapping: Mapping[str, str]) -> Column:
    """Category of a kind, null when the kind is not in the mapping."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), kind)


def _interval(pos: int, item: str, spec: str) -> Bin:
    low, dash, high = (part.strip() for part in item.partition("-"))
    try:
        if not dash:
            return Bin(pos, low, int(low), int(low))
        hi = None if high == "end" else int(high)
        return Bin(pos, f"{low}-{high}", int(low), hi)
    except ValueError:
        raise ValueError(f"not a value or range: {item!r} in {spec!r}") from None
