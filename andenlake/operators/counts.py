"""Row counts of several frames as one frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(frames: dict[str, DataFrame], label: str, value: str = "filas") -> DataFrame:
    """One row per frame: its name and its number of rows."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias(value)).select(F.lit(name).alias(label), value)
        for name, df in frames.items()])
