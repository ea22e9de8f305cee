"""Fixed-width binning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unit_edges(bins: int) -> list[float]:
    """Edges of equal-width probability bins, as multiples of one step."""
    if bins < 1:
        raise ValueError("at least one bin is required")
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def bin_of(value: Column, edges: list[float]) -> Column:
    """Bin whose lower edge is included; the last bin also includes its upper edge.

    Comparing with the edges themselves (rather than flooring ``value * bins``)
    keeps values that sit exactly on an edge in the bin the edge opens.
    """
    passed = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= value))
    return F.greatest(F.lit(0), F.least(passed - 1, F.lit(len(edges) - 2)))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin between two bounds; a single-valued column falls into bin 0."""
    position = F.when(high > low, F.floor((value - low) / (high - low) * bins)).otherwise(0)
    return F.least(position.cast("int"), F.lit(bins - 1))
