"""Tickets enriched with the yearly external benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME_COUNTRY = "BOL"


def country_series(benchmark: DataFrame, iso3: str = HOME_COUNTRY) -> DataFrame:
    return (benchmark.filter(F.col("iso3") == iso3)
            .select("anio",
                    F.col("modo_transporte").alias("cepal_modo_transporte"),
                    F.col("valor").alias("cepal_volumen_pasajeros_km"),
                    F.col("unidad").alias("cepal_unidad")))


def join_benchmark(ventas: DataFrame, benchmark: DataFrame, iso3: str = HOME_COUNTRY) -> DataFrame:
    """Left join on the year of sale; unmatched columns stay null.

    The series of a country has one row per year; that is its contract, which the
    quality rule on row counts watches. So it is a few dozen rows whatever the
    number of tickets, and is broadcast for that reason: a year holds a large
    share of all tickets, which must not be shuffled on it.
    """
    series = country_series(benchmark, iso3)
    return ventas.join(F.broadcast(series), F.col("anio_venta") == F.col("anio"), "left").drop("anio")


def integrate(ventas: DataFrame, benchmark: DataFrame, iso3: str = HOME_COUNTRY) -> DataFrame:
    return (join_benchmark(ventas, benchmark, iso3)
            .fillna(0.0, subset=["cepal_volumen_pasajeros_km"])
            .fillna({"cepal_unidad": "Sin dato CEPALSTAT", "cepal_modo_transporte": "Sin dato"}))


def match_rate(ventas: DataFrame, benchmark: DataFrame, iso3: str = HOME_COUNTRY) -> DataFrame:
    """Tickets with and without benchmark context, from one pass over the years."""
    years = ventas.groupBy("anio_venta").agg(F.count("*").alias("filas"))
    joined = join_benchmark(years, benchmark, iso3)
    hit = F.col("cepal_volumen_pasajeros_km").isNotNull()
    counts = joined.agg(
        F.coalesce(F.sum(F.when(hit, F.col("filas"))), F.lit(0)).alias("con_match"),
        F.coalesce(F.sum(F.when(~hit, F.col("filas"))), F.lit(0)).alias("sin_match"))
    total = F.col("con_match") + F.col("sin_match")
    return counts.select("con_match", "sin_match", total.alias("total"),
                         F.try_divide(F.col("con_match") * 100.0, total).alias("pct_match"))
