"""Right-closed bins ``(a, b]`` as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def grid_slot(value: Column, start: float, step: float) -> Column:
    """Number k with ``start + (k-1)*step < value <= start + k*step``.

    The quotient gives a first guess, then the guess is compared with the two
    edges it lies between, so a value that sits on an edge lands in the bin
    that the edge closes whatever the rounding of the division.
    """
    low, width = F.lit(float(start)), F.lit(float(step))
    guess = F.ceil((value - low) / width)
    return (
        F.when(value > guess * width + low, guess + 1)
        .when(value <= (guess - 1) * width + low, guess - 1)
        .otherwise(guess)
    )


def spread_bounds(low: float, high: float) -> tuple[float, float]:
    """Bounds to cut between; a constant column is widened by a thousandth on each side."""
    if low != high:
        return low, high
    margin = abs(low) * 0.001 if low else 0.001
    return low - margin, high + margin


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin 1..``bins`` of equal width; the lowest value falls in bin 1."""
    low, high = spread_bounds(low, high)
    slot = grid_slot(value.cast("double"), low, (high - low) / bins)
    return F.when(value.isNotNull(), F.least(F.greatest(slot, F.lit(1)), F.lit(bins))).cast("int")


def edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """Bin 1..len(edges)-1 between explicit edges; NULL outside them."""
    result = F.when(value <= F.lit(edges[0]), F.lit(None).cast("int"))
    for number, edge in enumerate(edges[1:], start=1):
        result = result.when(value <= F.lit(edge), F.lit(number))
    return result.otherwise(F.lit(None).cast("int"))


def edge_label(number: Column, edges: Sequence[float]) -> Column:
    """``(a, b]`` text of a bin from :func:`edge_bin`."""
    labels = F.array(*[F.lit(f"({a}, {b}]") for a, b in zip(edges, edges[1:])])
    return F.get(labels, number - 1)
