"""Exact median without holding a column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from andenlake.operators.joins import scalar

#: Rank error of the first bracket is one part in so many; the bracket is cut in so many buckets.
ACCURACY = 10_000
BUCKETS = 1024


def exact_median(df: DataFrame, name: str) -> Column:
    """The median of a numeric column (mean of the two middle values) as a scalar subquery.

    1. A mergeable sketch brackets the middle ranks by two values of the column; its rank
       error is bounded, so they surely lie inside.
    2. The bracket is cut into buckets of equal width, which are counted.
    3. Only values of the bucket that holds the middle ranks (or of the two) are counted one
       by one.

    Every step combines before it shuffles. The cumulative sums run over the buckets, and
    over the distinct values of the last bucket, of which it holds one part in millions of
    the rows unless they repeat. Nulls and NaNs are left out; null if nothing is left."""
    values = df.select(F.col(name).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    near = 2 / ACCURACY
    sketch = values.agg(
        F.percentile_approx("v", F.array(F.lit(0.5 - near), F.lit(0.5 + near)), ACCURACY)
        .alias("at"), F.count("*").alias("n"))
    bracket = scalar(sketch.select(F.struct(
        F.col("at")[0].alias("low"), F.col("at")[1].alias("high"), "n")))
    low, high, n = bracket["low"], bracket["high"], bracket["n"]
    first, second = F.floor((n - 1) / 2), F.floor(n / 2)

    share = F.when(high > low, (F.col("v") - low) / (high - low)).otherwise(0.0)
    bucket = F.when(F.col("v") < low, -1).otherwise(
        F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)))
    placed = values.filter(F.col("v") <= high).withColumn("bucket", bucket)
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.groupBy("bucket").agg(F.count("*").alias("m")).withColumn(
        "upto", F.sum("m").over(upto))  # at most BUCKETS + 1 rows
    middle = scalar(counted.filter(F.col("upto") > first).agg(F.struct(
        F.min("bucket").alias("from"), F.min(F.col("upto") - F.col("m")).alias("before"),
        F.min(F.when(F.col("upto") > second, F.col("bucket"))).alias("to"))))

    inside = placed.filter(F.col("bucket").between(middle["from"], middle["to"]))
    so_far = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.groupBy("v").agg(F.count("*").alias("m")).withColumn(
        "upto", middle["before"] + F.sum("m").over(so_far))
    return scalar(ranked.agg((F.min(F.when(F.col("upto") > first, F.col("v")))
                              + F.min(F.when(F.col("upto") > second, F.col("v")))) / 2))
