"""The three layers as batch jobs: land, clean and integrate, build the star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from andenlake import schemas
from andenlake.functions import calendar as cal
from andenlake.operators import profiling, quality, star
from andenlake.operators.cleaning import CLEANERS
from andenlake.operators.counts import row_counts
from andenlake.operators.enrich import integrate
from andenlake.plans import kpis
from andenlake.plans.kpis import Gold
from andenlake.sources import indicator, snapshots, versions

SERIES = "cepal_transporte_pasajeros"
INTEGRATED = quality.INTEGRATED


def land_bronze(spark: SparkSession, read_table: Callable[[str], DataFrame], bronze: str,
                ingest_date: dt.date) -> DataFrame:
    """Land all operational tables; returns the manifest over what was landed."""
    paths = snapshots.land_tables(read_table, bronze, ingest_date)
    landed = {name: snapshots.latest(spark, bronze, name) for name in paths}
    return snapshots.manifest(landed)


def land_indicator(spark: SparkSession, documents: str, bronze: str,
                   ingest_date: dt.date) -> DataFrame:
    """Check, land raw and flatten the indicator documents. A rejected document
    stops the run before anything is written."""
    raw = indicator.read_documents(spark, documents)
    checked = indicator.check_envelopes(indicator.parse(raw))
    indicator.require_accepted(checked)
    indicator.land_documents(raw, bronze, f"{SERIES}_json", ingest_date)
    series = indicator.as_bronze(indicator.flatten_series(checked, ingest_date))
    snapshots.land(series, bronze, SERIES, ingest_date)
    return snapshots.latest(spark, bronze, SERIES)


def read_bronze(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    return {name: snapshots.latest(spark, bronze, name, schemas.BRONZE[name])
            for name in CLEANERS}


def profile_bronze(tables: dict[str, DataFrame], out: str) -> None:
    """Write the profile report of all sources."""
    profiling.profile_tables(tables).write.mode("overwrite").parquet(f"{out}/columnas")
    ventas = tables["ventas_pasajes"]
    profiling.sales_detail(ventas).write.mode("overwrite").parquet(f"{out}/ventas_detalle")
    (profiling.frequencies(ventas, ["estado_pasaje", "canal_venta"])
     .write.mode("overwrite").parquet(f"{out}/frecuencias"))


def build_silver(spark: SparkSession, bronze: str, silver: str, ingest_date: dt.date,
                 strict: bool = True) -> DataFrame:
    """Clean and integrate every table. Each is written once, beside the layer, and what
    passes is observed in that write. In strict mode a failed rule raises and nothing of the
    run appears; else the written tables become the snapshots of the date. Returns the
    report."""
    aside = versions.new(f"{silver}_staged")
    watch, clean = quality.Watch(), {}
    for name, df in read_bronze(spark, bronze).items():
        cleaned = watch.clean(name, CLEANERS[name](watch.raw(name, df)))
        snapshots.land(cleaned, aside, name, ingest_date)
        clean[name] = snapshots.latest(spark, aside, name)
    integrated = watch.clean(INTEGRATED, integrate(clean["ventas_pasajes"], clean[SERIES]))
    snapshots.land(integrated, aside, INTEGRATED, ingest_date)
    report = quality.settled(quality.silver_report(watch, clean[SERIES]))
    try:
        if strict:
            quality.enforce(report)
        for name in [*clean, INTEGRATED]:
            snapshots.move(spark, aside, silver, name, ingest_date)
    finally:
        versions.discard(spark, aside)
    return report


def gold_dimensions(spark: SparkSession, silver: str) -> dict[str, DataFrame]:
    """The six dimensions over the newest silver snapshots."""
    def table(name: str) -> DataFrame:
        return snapshots.latest(spark, silver, name)

    geo = table("geografia")
    return {
        "dim_tiempo": star.dim_tiempo(table("ventas_pasajes")),
        "dim_ruta": star.dim_ruta(table("rutas"), geo),
        "dim_empresa": star.dim_empresa(table("empresas")),
        "dim_pasajero": star.dim_pasajero(table("pasajeros"), geo),
        "dim_unidad": star.dim_unidad(table("unidades_flota")),
        "dim_canal": star.dim_canal(spark),
    }


def gold_tickets(spark: SparkSession, silver: str, use_itineraries: bool = False) -> DataFrame:
    """Integrated tickets; with ``use_itineraries`` each gets its itinerary's bus."""
    tickets = snapshots.latest(spark, silver, INTEGRATED)
    if not use_itineraries:
        return tickets
    itineraries = snapshots.latest(spark, silver, "itinerarios")
    return star.units_from_itineraries(tickets.drop("id_unidad"), itineraries)


CELLS, COMPANY_CELLS = "celdas_rutas", "celdas_empresas"


def _write_by_year(df: DataFrame, path: str, key: str = "sk_ruta") -> None:
    """By year, ordered by route or another key inside each file, without another shuffle: a
    task writes a file for each year it holds."""
    (df.sortWithinPartitions("anio", key)
     .write.option("compression", "zstd").partitionBy("anio").parquet(path))


def _gold_schema(name: str) -> T.StructType:
    declared = T.StructType(list(schemas.GOLD[name].fields))
    return declared.add("anio", T.IntegerType()) if name == "fact_ventas" else declared


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Gold tables with their declared types. Dimension sizes are known from
    the files, so Spark itself decides what to broadcast."""
    return {name: spark.read.schema(_gold_schema(name)).parquet(f"{folder}/{name}")
            for name in names}


def write_dimensions(spark: SparkSession, folder: str, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write the dimensions; returns them as read back."""
    for name, df in dims.items():
        df.write.parquet(f"{folder}/{name}")
    return read_tables(spark, folder, list(dims))


def write_fact(folder: str, dims: dict[str, DataFrame], tickets: DataFrame,
               unique: bool = False) -> None:
    """Write the fact looked up against the written dimensions."""
    fact = star.fact_ventas(tickets, dims["dim_tiempo"], dims, unique=unique)
    _write_by_year(fact.withColumn("anio", cal.key_year("sk_tiempo")), f"{folder}/fact_ventas")


def write_cells(folder: str, fact: DataFrame, tiempo: DataFrame) -> None:
    """Write the cells of the views by route."""
    _write_by_year(kpis.cells(fact, tiempo), f"{folder}/{CELLS}")


def write_company_cells(folder: str, fact: DataFrame, tiempo: DataFrame) -> None:
    """Write the cells of the views by company."""
    _write_by_year(kpis.company_cells(fact, tiempo), f"{folder}/{COMPANY_CELLS}", "sk_empresa")


def write_star(spark: SparkSession, folder: str, dims: dict[str, DataFrame], tickets: DataFrame,
               unique: bool = False) -> None:
    """Write a whole star: dimensions first, then the fact looked up against the written
    dimensions, then the cells of the views. ``unique``: no source id occurs twice."""
    known = write_dimensions(spark, folder, dims)
    write_fact(folder, known, tickets, unique)
    written = read_tables(spark, folder, ["fact_ventas"])["fact_ventas"]
    write_cells(folder, written, known["dim_tiempo"])
    write_company_cells(folder, written, known["dim_tiempo"])


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return read_tables(spark, folder, list(schemas.GOLD))


def with_cells(spark: SparkSession, t: dict[str, DataFrame], routes: str,
               companies: str | None = None) -> Gold:
    """The tables with the cells in the given folders; the years are those of their partitions."""
    years = snapshots.partition_values(spark, f"{routes}/{CELLS}", "anio")

    def read(path: str) -> DataFrame | None:
        return spark.read.parquet(path) if snapshots.partition_values(spark, path, "anio") else None

    return Gold(t["fact_ventas"], t["dim_ruta"], t["dim_empresa"], t["dim_tiempo"],
                read(f"{routes}/{CELLS}"),
                None if companies is None else read(f"{companies}/{COMPANY_CELLS}"),
                tuple(map(int, years)) or None)


def open_star(spark: SparkSession, folder: str) -> Gold:
    """The star as the views read it."""
    return with_cells(spark, read_star(spark, folder), folder, folder)


def read_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """Tables of the current version."""
    return read_star(spark, versions.current(spark, gold))


def open_gold(spark: SparkSession, gold: str) -> Gold:
    return open_star(spark, versions.current(spark, gold))


def build_gold(spark: SparkSession, silver: str, gold: str, strict: bool = True,
               use_itineraries: bool = False) -> DataFrame:
    """Full refresh: a new version is written beside the current one, checked, and published
    only then. In strict mode a failed rule raises and deletes it; readers keep the version
    before. Returns the constraint report."""
    version = versions.new(gold)
    write_star(spark, version, gold_dimensions(spark, silver),
               gold_tickets(spark, silver, use_itineraries))
    report = quality.settled(quality.gold_report(read_star(spark, version)))
    if strict:
        try:
            quality.enforce(report)
        except quality.QualityError:
            versions.discard(spark, version)
            raise
    versions.publish(spark, gold, version)
    return report


def gold_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return row_counts(tables, "tabla", "registros")
