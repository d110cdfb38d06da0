"""Repeated measurements: one column per repetition, one row per setting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = {"mean": F.avg, "sd": F.stddev_samp}
# The columns of the long table.
NAME, VALUE = "Execution #", "Time taken"


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str = NAME,
    value: str = VALUE,
) -> DataFrame:
    """One row per measurement, with the name of the column it came from."""
    return df.unpivot(list(ids), list(values), name, value)


def mean_and_deviation_of(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "measure"
) -> DataFrame:
    """`mean` and sample deviation `sd` of each column of `values` in each setting.

    The columns are summed up side by side and stacked afterwards, so that no row of the
    input is multiplied.
    """
    sums = [f(value).alias(f"_{what}{i}") for i, value in enumerate(values) for what, f in STATISTICS.items()]
    rows = [
        F.struct(F.lit(value).alias(name), *(F.col(f"_{what}{i}").alias(what) for what in STATISTICS))
        for i, value in enumerate(values)
    ]
    return df.groupBy(*ids).agg(*sums).select(*ids, F.inline(F.array(*rows)))


def mean_and_deviation(df: DataFrame, ids: Sequence[str], value: str = VALUE) -> DataFrame:
    """`mean` and sample deviation `sd` of the measurements of each setting."""
    return df.groupBy(*ids).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
