"""Relational source and sink over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 500


def read_options(url: str, table: str, column: str | None = None, lower: object = None,
                 upper: object = None, partitions: int | None = None) -> dict[str, str]:
    """Options of a full-table scan, split by ranges of ``column`` if given."""
    options = {"url": url, "dbtable": table}
    if column is not None:
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_table(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **split)).load()


def write_options(url: str, table: str, batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    """Options of a batched insert; ``truncate`` keeps the table definition
    when the write mode is overwrite."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), "truncate": "true"}


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                batch_rows: int = BATCH_ROWS) -> None:
    df.write.format("jdbc").options(**write_options(url, table, batch_rows)).mode(mode).save()
