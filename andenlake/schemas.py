"""Declared schemas of every layer. Nothing is inferred: inference would turn
phone numbers into integers and clock times into timestamps."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
          "boolean": T.BooleanType(), "double": T.DoubleType(), "date": T.DateType()}


def _schema(columns: str) -> T.StructType:
    """``"a bigint, b decimal(8,2)"`` as a type. Unlike ``fromDDL`` this needs no
    running session, so schemas can be module constants."""
    fields = []
    for name, kind in re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", columns):
        size = re.search(r"\((\d+),(\d+)\)", kind)
        data_type = T.DecimalType(*map(int, size.groups())) if size else _TYPES[kind]
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


BRONZE = {
    "geografia": _schema("id_ciudad bigint, ciudad string, departamento string, "
                         "es_fronteriza boolean, latitud double, longitud double"),
    "empresas": _schema("id_empresa bigint, nombre_empresa string, nit string, telefono string, "
                        "estado string, tipo string, ciudad_origen_id bigint, "
                        "capacidad_flota_total double, fecha_registro string"),
    "rutas": _schema("id_ruta bigint, ciudad_origen_id bigint, ciudad_destino_id bigint, "
                     "distancia_km int, duracion_horas decimal(4,1), tipo_corredor string, "
                     "tarifa_base decimal(8,2), activa boolean"),
    "pasajeros": _schema("id_pasajero bigint, nombre string, apellido string, ci string, "
                         "telefono string, email string, ciudad_id bigint, nacionalidad string, "
                         "fecha_nacimiento string"),
    "unidades_flota": _schema("id_unidad bigint, id_empresa bigint, placa string, marca string, "
                              "modelo string, anio_fabricacion int, capacidad_asientos int, "
                              "tipo_servicio string, estado_unidad string"),
    "itinerarios": _schema("id_itinerario bigint, id_ruta bigint, id_empresa bigint, "
                           "id_unidad bigint, hora_salida string, dias_operacion string, "
                           "frecuencia string, activo boolean"),
    "ventas_pasajes": _schema("id_venta bigint, id_itinerario bigint, id_pasajero bigint, "
                              "id_ruta bigint, id_empresa bigint, fecha_venta string, "
                              "fecha_viaje string, numero_asiento int, monto_pagado decimal(18,4), "
                              "canal_venta string, estado_pasaje string, "
                              "descuento_aplicado decimal(5,2), "
                              "nombre_pasajero_registrado string, observaciones string"),
    "cepal_transporte_pasajeros": _schema(
        "indicador_id int, indicador_nombre string, pais_id int, pais_nombre string, iso3 string, "
        "anio_id int, anio string, modo_id int, modo_transporte string, valor string, "
        "unidad string, fuente_id int, fecha_extraccion date"),
}

# DDL text, parsed by from_json.
PAYLOAD = (
    "header struct<name: string, version: string, success: boolean, machine: string, "
    "context: string, code: int, message: string, timestamp: bigint>, "
    "body struct<metadata: struct<indicator_id: int, indicator_name: string, theme: string, "
    "area: string, note: string, unit: string, decimals: int, last_update: string>, "
    "data: array<struct<value: string, source_id: int, notes_ids: string, iso3: string, "
    "dim_74754: int, dim_208: int, dim_29117: int, dim_74389: int>>, "
    "dimensions: array<struct<name: string, id: int, `order`: int, position: int, "
    "members: array<struct<name: string, id: int, `in`: int, `order`: int, parent: int, "
    "selected: int>>>>, "
    "sources: array<struct<id: int, description: string, organization_acronym: string, "
    "organization_name: string, organization_url: string>>, "
    "credits: array<struct<id: int, description: string>>>, "
    "footer struct<records: int, elapsed_time: string, ip: string, query: string>")

# Gold columns are all NOT NULL but those named in GOLD_NULLABLE.
GOLD = {
    "dim_tiempo": _schema("sk_tiempo int, fecha date, anio int, trimestre int, mes int, "
                          "nombre_mes string, semana_anio int, dia_semana int, nombre_dia string, "
                          "es_fin_semana int, temporada string, es_semana_santa int, "
                          "es_feria_tarija int, es_fin_anio int"),
    "dim_ruta": _schema("sk_ruta bigint, id_ruta_origen bigint, ciudad_origen string, "
                        "departamento_origen string, ciudad_destino string, "
                        "departamento_destino string, distancia_km int, "
                        "duracion_horas decimal(4,1), tipo_corredor string, "
                        "tarifa_base decimal(8,2), ingreso_por_km decimal(19,13)"),
    "dim_empresa": _schema("sk_empresa bigint, id_empresa_origen bigint, nombre_empresa string, "
                           "tipo_empresa string, estado_empresa string, "
                           "capacidad_flota_total int"),
    "dim_pasajero": _schema("sk_pasajero bigint, id_pasajero_origen bigint, ciudad_origen string, "
                            "departamento_origen string, nacionalidad string"),
    "dim_unidad": _schema("sk_unidad bigint, id_unidad_origen bigint, placa string, marca string, "
                          "modelo string, anio_fabricacion int, capacidad_asientos int, "
                          "tipo_servicio string"),
    "dim_canal": _schema("sk_canal int, canal_venta string, es_digital int"),
    "fact_ventas": _schema("sk_venta bigint, sk_tiempo int, sk_ruta bigint, sk_empresa bigint, "
                           "sk_pasajero bigint, sk_unidad bigint, sk_canal int, "
                           "id_venta_origen bigint, monto_pagado decimal(18,2), "
                           "tarifa_base decimal(8,2), descuento_aplicado decimal(5,2), "
                           "numero_asiento int, capacidad_unidad int, distancia_km int, "
                           "es_cancelado int, ingreso_por_km decimal(31,15), "
                           "cepal_volumen_pasajeros_km decimal(18,3), "
                           "cepal_modo_transporte string"),
}

GOLD_NULLABLE = {
    "dim_ruta": {"ingreso_por_km"},
    "fact_ventas": {"ingreso_por_km", "cepal_volumen_pasajeros_km", "cepal_modo_transporte"},
}

PRIMARY_KEYS = {
    "dim_tiempo": "sk_tiempo", "dim_ruta": "sk_ruta", "dim_empresa": "sk_empresa",
    "dim_pasajero": "sk_pasajero", "dim_unidad": "sk_unidad", "dim_canal": "sk_canal",
    "fact_ventas": "sk_venta",
}

FOREIGN_KEYS = {f"sk_{d}": f"dim_{d}"
                for d in ("tiempo", "ruta", "empresa", "pasajero", "unidad", "canal")}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the declared columns, in declared order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform_known(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``conform`` to those of the declared columns that the frame has."""
    return conform(df, T.StructType([f for f in schema.fields if f.name in df.columns]))


def with_double_decimals(df: DataFrame) -> DataFrame:
    """Report view of a frame: exact decimals handed over as doubles."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name) for f in df.schema.fields])
