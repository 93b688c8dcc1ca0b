"""Dense surrogate keys 1..n without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from andenlake.operators.joins import scalar
from andenlake.session import written

# monotonically_increasing_id() keeps the partition number above this bit.
_ROW_BITS = 33


def dense_numbers(df: DataFrame, out: str, order_by: list[str]) -> DataFrame:
    """Add ``out`` = 1..n in ``order_by`` order; nulls sort first.

    Rows are range-partitioned on the whole ordering key (a hot leading column
    is split by the later ones), sorted inside each partition and tagged with
    partition and position. The tagged rows are written once, which fixes the
    partition boundaries; the number is position + rows in earlier partitions.
    Only one row per partition takes part in the running total.
    ``order_by`` has to identify a row for the numbers to be reproducible.
    """
    tagged = written(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("__tag", F.monotonically_increasing_id()), "numbered", compression="zstd")
    part = F.shiftright("__tag", _ROW_BITS)
    position = F.col("__tag").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = tagged.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("__part"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return (tagged.withColumn("__part", part)
            .join(F.broadcast(starts), "__part")  # one row per shuffle partition
            .withColumn(out, F.col("__start") + position + 1)
            .select(out, *df.columns))


def sparse_numbers(df: DataFrame, out: str, order_by: list[str]) -> DataFrame:
    """Order-preserving keys from a unique integer id: 1 for the smallest id,
    with gaps where the ids have gaps. Needs no shuffle, so views computed on
    the fly use it; stored tables get ``dense_numbers``."""
    first = scalar(df.agg(F.min(order_by[0])))
    return df.select((F.col(order_by[0]) - first + 1).alias(out), *df.columns)
