"""Join helpers: lookups with a default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from andenlake.session import written


def lookup(facts: DataFrame, dim: DataFrame, fact_key: str, natural_key: str,
           surrogate_key: str, carry: dict[str, str] | None = None,
           unique: bool = False) -> DataFrame:
    """Left join natural key → surrogate key (plus carried attributes).

    A natural key that occurs twice in the dimension resolves to its last
    surrogate key, so a fact row never multiplies. That key table is written
    first; ``unique=True`` skips this where the natural key is known to be one.
    Either way nothing stands between the join and its shuffles: only then can
    AQE split the partition of a hot fact key (an aggregate on the dimension
    side would prevent it). Small dimensions are broadcast by their file size.
    Columns of a missed lookup are null; the caller fills its defaults.
    """
    names = {surrogate_key: surrogate_key, **(carry or {})}
    known = dim.filter(F.col(natural_key).isNotNull())
    if unique:
        keyed = known.select(F.col(natural_key).alias("__key"),
                             *[F.col(src).alias(out) for src, out in names.items()])
    else:
        last = known.groupBy(F.col(natural_key).alias("__key")).agg(
            F.max(F.struct(*names)).alias("found"))
        keyed = written(last.select("__key", *[F.col(f"found.{src}").alias(out)
                                               for src, out in names.items()]), "lookup")
    return facts.join(keyed, F.col(fact_key) == F.col("__key"), "left").drop("__key")


def scalar(df: DataFrame) -> Column:
    """One-row, one-column frame as an uncorrelated scalar subquery."""
    return df.scalar()
