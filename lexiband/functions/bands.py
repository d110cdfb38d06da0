"""Band thresholds and labels over ranks 1..n."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bands as shares of the vocabulary.
POPULAR_END = 0.05
COMMON_START = 0.475
COMMON_END = 0.525
RARE_START = 0.95


def thresholds(n: Column) -> dict[str, Column]:
    """First and last ranks of the bands: upper ends round up, lower ends round down."""
    return {
        "popular": F.ceil(F.lit(POPULAR_END) * n),
        "common_lo": F.floor(F.lit(COMMON_START) * n),
        "common_hi": F.ceil(F.lit(COMMON_END) * n),
        "rare": F.floor(F.lit(RARE_START) * n),
    }


def category(rank: Column, n: Column) -> Column:
    """Band of a rank, null between bands. Bands overlap for n <= 4; the first match wins."""
    limit = thresholds(n)
    return (
        F.when(rank <= limit["popular"], "popular")
        .when(rank >= limit["rare"], "rare")
        .when(rank.between(limit["common_lo"], limit["common_hi"]), "common")
    )
