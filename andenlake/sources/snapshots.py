"""Dated snapshots: land a table as it is, read the newest one back."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from andenlake.operators.counts import row_counts

DATE_COLUMN = "ingest_date"

# The operational tables, parents before children.
SOURCE_TABLES = ["geografia", "empresas", "rutas", "pasajeros", "unidades_flota",
                 "itinerarios", "ventas_pasajes"]


class SnapshotNotFound(FileNotFoundError):
    """No snapshot of the table has been landed."""


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, one directory level: names only, no data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(path) or [])


def partition_values(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of a partition column, from the folder names."""
    return [p.rpartition("=")[2] for p in _matches(spark, f"{folder}/{column}=*")]


#: A row group is the smallest piece that a task can read of a landed file.
ROW_GROUP_BYTES = 8 << 20


def land(df: DataFrame, root: str, table: str, ingest_date: dt.date) -> str:
    """Write the unmodified rows as the snapshot of a date. Landing a date again
    replaces that date only. An empty table is a snapshot too: its folder holds
    a file with the schema, and it is the newest one until the next. Row groups are
    small, so that one file is read by several tasks."""
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{root}/{table}/{DATE_COLUMN}={ingest_date:%Y-%m-%d}")
    return f"{root}/{table}"


def move(spark: SparkSession, source: str, root: str, table: str, ingest_date: dt.date) -> None:
    """Make the snapshot of a date under ``source`` the one under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    day = f"{table}/{DATE_COLUMN}={ingest_date:%Y-%m-%d}"
    target = path(f"{root}/{day}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(path(f"{source}/{day}"), target):
        raise OSError(f"{source}/{day} could not be moved to {root}")


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the table files of a folder: changes when one is replaced."""
    found = []
    for pattern in (f"{folder}/*.parquet", f"{folder}/*.parquet/*"):
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime())
                  for s in files.globStatus(path) or []]
    return tuple(sorted(found))


def snapshot_dates(spark: SparkSession, root: str, table: str) -> list[str]:
    """Landed dates from the folders of finished writes, oldest first; folders
    without a date in their name are no snapshots."""
    found = _matches(spark, f"{root}/{table}/{DATE_COLUMN}=*/_SUCCESS")
    dates = [p.split("/")[-2].partition("=")[2] for p in found]
    return [d for d in dates if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d)]


def latest(spark: SparkSession, root: str, table: str,
           schema: T.StructType | None = None) -> DataFrame:
    """Newest snapshot. Only its partition folder is listed and read."""
    dates = snapshot_dates(spark, root, table)
    if not dates:
        raise SnapshotNotFound(f"no snapshot of {table!r} under {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{table}/{DATE_COLUMN}={dates[-1]}")


def newest_rows(df: DataFrame, date_column: str = DATE_COLUMN) -> DataFrame:
    """Newest snapshot of a frame that holds several; on a partitioned table the
    subquery prunes partitions."""
    return df.filter(F.col(date_column) == df.agg(F.max(date_column)).scalar())


BAD_ROW = "_fila_mala"
CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": True}
#: Stands for a missing value where an empty text has to be told from it.
MISSING = "\0missing\0"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """archivo, registro (from 1 in each file), texto: the records of CSV files, line breaks
    inside quotes included, with a file read in as many pieces as it has splits.

    Quotes stand around values and are doubled inside them, so a line begins a record if an
    even number of quotes comes before it. That number is counted by split, summed over the
    splits before (one row for each split), and by line inside a split. Only the last record
    of a split can reach into the next; those and their rests alone meet again."""
    lines = (spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("trozo"),
        F.monotonically_increasing_id().alias("orden"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("comillas")))
    split = Window.partitionBy("archivo", "trozo").orderBy("orden")
    before = F.sum("comillas").over(split.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("impar", F.coalesce(before % 2, F.lit(0)))

    splits = lines.groupBy("archivo", "trozo").agg(
        F.sum("comillas").alias("comillas"), F.count_if(F.col("impar") == 0).alias("pares"),
        F.count_if(F.col("impar") == 1).alias("impares"))
    earlier = Window.partitionBy("archivo").orderBy("trozo").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.withColumn(
        "entra", F.coalesce(F.sum("comillas").over(earlier) % 2, F.lit(0))
    ).withColumn("inicios", F.when(F.col("entra") == 0, F.col("pares")).otherwise(F.col("impares"))
                 ).select("archivo", "trozo", "entra", "inicios", F.coalesce(
                     F.sum("inicios").over(earlier), F.lit(0)).alias("previos"))

    starts = (F.col("impar") == F.col("entra")).cast("long")
    placed = lines.join(splits, ["archivo", "trozo"]).select(
        "archivo", "trozo", "orden", "value", "previos", "inicios",
        (F.col("previos") + F.sum(starts).over(split)).alias("registro"))
    parts = placed.groupBy("archivo", "trozo", "registro").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("orden", "value"))),
                                 lambda x: x.value), "\n").alias("texto"),
        F.any_value("previos").alias("previos"), F.any_value("inicios").alias("inicios"))
    first = F.col("registro") == F.col("previos")  # the rest of a record begun before
    last = F.col("registro") == F.col("previos") + F.col("inicios")
    inner = parts.filter(~first & ~last).select("archivo", "registro", "texto")
    edges = parts.filter(first | last).groupBy("archivo", "registro").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("trozo", "texto"))), lambda x: x.texto), "\n")
        .alias("texto"))
    return inner.unionByName(edges).withColumn("texto", F.regexp_replace("texto", r"\r\z", ""))


def _torn(text: str) -> Column:
    """Whether quotes stand elsewhere than around values in a record of several lines, or a
    quote is never closed: such a record may be two."""
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    marked = F.regexp_replace(F.regexp_replace(text, '"[^"]*+"', "\x01"), "\x01+", "\x01")
    return (quotes % 2 == 1) | F.contains(text, F.lit("\n")) & marked.rlike("[^,]\x01|\x01[^,]")


def _csv(spark: SparkSession, path: str, schema: T.StructType,
         keep_empty: bool = False) -> DataFrame:
    """Declared columns, found by their names in the header, and the raw text of
    rows that do not fit. Quotes are doubled inside quotes; a quoted value may
    hold line breaks; a byte-order mark is accepted. Empty lines are no rows. A value of
    two quotes is missing, or with ``keep_empty`` an empty text."""
    header = spark.read.option("header", True).options(**CSV_OPTIONS).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    if missing := [name for name in declared if name not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    given = T.StructType([declared.get(name, T.StructField(name, T.StringType()))
                          for name in header]).add(BAD_ROW, T.StringType())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given)
    records = csv_records(spark, path).filter((F.col("registro") > 1) & (F.col("texto") != ""))
    row = F.from_csv("texto", fields, {
        **{k: str(v) for k, v in CSV_OPTIONS.items()}, "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_ROW, "nullValue": MISSING if keep_empty else ""})
    return records.select("texto", row.alias("fila")).select(
        *[F.col(f"fila.{name}") for name in declared],
        F.when(_torn("texto"), F.col("texto")).otherwise(F.col(f"fila.{BAD_ROW}")).alias(BAD_ROW))


def write_csv(df: DataFrame, folder: str) -> str:
    """Files with a header that ``read_csv`` with ``keep_empty`` reads back as they were:
    blanks at either end of a value stay, and an empty text is not a missing one."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(folder)
    return folder


def bad_csv_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows with too many or too few values, or values not of the declared type: what could
    be read of them, and their text."""
    return _csv(spark, path, schema).filter(F.col(BAD_ROW).isNotNull())


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             keep_empty: bool = False) -> DataFrame:
    """CSV with a header and declared types. A row that does not fit fails the read;
    ``bad_csv_rows`` shows which. ``keep_empty`` is for files by ``write_csv``."""
    rows = _csv(spark, path, schema, keep_empty)
    broken = F.raise_error(F.concat(F.lit("bad row in a CSV file: "), BAD_ROW))
    first = schema.fields[0]
    checked = F.when(F.col(BAD_ROW).isNotNull(), broken.cast(first.dataType)).otherwise(
        F.col(first.name))
    return rows.withColumn(first.name, checked).drop(BAD_ROW)


def latest_csv(spark: SparkSession, folder: str, table: str, schema: T.StructType) -> DataFrame:
    """Newest ``<table>_<YYYYMMDD>.csv`` of a folder."""
    name = re.compile(rf"{re.escape(table)}_\d{{8}}\.csv$")
    found = [p for p in _matches(spark, f"{folder}/{table}_*.csv") if name.search(p)]
    if not found:
        raise SnapshotNotFound(f"no file {table}_*.csv in {folder}")
    return read_csv(spark, found[-1], schema)


def land_tables(read_table: Callable[[str], DataFrame], root: str, ingest_date: dt.date,
                tables: list[str] | None = None) -> dict[str, str]:
    """Land every source table through one ``read_table(name)`` contract."""
    return {name: land(read_table(name), root, name, ingest_date)
            for name in tables or SOURCE_TABLES}


def manifest(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per landed table and a total line over all of them."""
    counts = row_counts(frames, "tabla", "registros")
    return (counts.rollup("tabla").agg(F.sum("registros").alias("registros"),
                                       F.count("*").alias("tablas"))
            .select(F.coalesce("tabla", F.lit("TOTAL")).alias("tabla"), "registros", "tablas"))
