"""Silver cleaning, one lazy function per source table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.functions import calendar as cal
from andenlake.functions import measures as m
from andenlake.functions import text as t
from andenlake.operators.order_statistics import exact_median

# Accepted ranges.
FIRST_BUILD_YEAR, LAST_BUILD_YEAR = 1990, 2025


def clean_geografia(raw: DataFrame) -> DataFrame:
    return (raw.withColumns({"ciudad": t.title_case("ciudad"),
                             "departamento": t.title_case("departamento")})
            .fillna(0.0, subset=["latitud", "longitud"]))


def fill_with_median(df: DataFrame, name: str) -> DataFrame:
    """Replace nulls by the exact median of the column, a scalar subquery of the plan."""
    return df.withColumn(name, F.coalesce(name, exact_median(df, name)))


def clean_empresas(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns({
        "nombre_empresa": t.title_case("nombre_empresa"),
        "estado": t.capitalized("estado"),
        "tipo": t.capitalized("tipo"),
        "telefono": t.phone("telefono"),
        "fecha_registro": cal.parse_date("fecha_registro"),
    })
    return fill_with_median(cleaned, "capacidad_flota_total")


def clean_rutas(raw: DataFrame) -> DataFrame:
    positive = [F.col(c) > 0 for c in ("distancia_km", "duracion_horas", "tarifa_base")]
    return (raw.filter(positive[0] & positive[1] & positive[2])
            .withColumn("tipo_corredor", t.title_case("tipo_corredor")))


def clean_pasajeros(raw: DataFrame) -> DataFrame:
    return (raw.withColumns({
        "nombre": t.title_case("nombre"),
        "apellido": t.title_case("apellido"),
        "email": t.lower_case("email"),
        "nacionalidad": t.capitalized("nacionalidad"),
        "fecha_nacimiento": cal.parse_date("fecha_nacimiento"),
    }).fillna("", subset=["email", "telefono"]))


def clean_unidades(raw: DataFrame) -> DataFrame:
    return (raw.filter(F.col("anio_fabricacion").between(FIRST_BUILD_YEAR, LAST_BUILD_YEAR))
            .withColumns({
                "placa": t.upper_case("placa"),
                "marca": t.title_case("marca"),
                "modelo": t.upper_case("modelo"),
                "tipo_servicio": t.title_case("tipo_servicio"),
                "estado_unidad": t.title_case("estado_unidad"),
            }))


def clean_itinerarios(raw: DataFrame) -> DataFrame:
    return raw


def clean_ventas(raw: DataFrame) -> DataFrame:
    """Drops tickets without two valid dates or without a positive amount."""
    return (raw.withColumns({"fecha_venta": cal.parse_date("fecha_venta"),
                             "fecha_viaje": cal.parse_date("fecha_viaje")})
            .dropna(subset=["fecha_venta", "fecha_viaje"])
            .filter(F.col("monto_pagado") > 0)
            .withColumns({
                "monto_pagado": F.round("monto_pagado", 2),
                "nombre_pasajero_registrado": t.passenger_name("nombre_pasajero_registrado"),
                "canal_venta": t.capitalized("canal_venta"),
                "estado_pasaje": t.capitalized("estado_pasaje"),
                "observaciones": F.coalesce("observaciones", F.lit("Sin observaciones")),
                "descuento_aplicado": m.valid_discount("descuento_aplicado"),
                "anio_venta": F.year("fecha_venta"),
                "mes_venta": F.month("fecha_venta"),
            }))


def clean_benchmark(raw: DataFrame) -> DataFrame:
    return (raw.withColumn("valor", F.col("valor").try_cast("double"))
            .dropna(subset=["valor"])
            .withColumns({
                "pais_nombre": t.title_case("pais_nombre"),
                "modo_transporte": t.title_case("modo_transporte"),
                "anio": F.col("anio").try_cast("int"),
            }))


CLEANERS = {
    "geografia": clean_geografia,
    "empresas": clean_empresas,
    "rutas": clean_rutas,
    "pasajeros": clean_pasajeros,
    "unidades_flota": clean_unidades,
    "itinerarios": clean_itinerarios,
    "ventas_pasajes": clean_ventas,
    "cepal_transporte_pasajeros": clean_benchmark,
}
