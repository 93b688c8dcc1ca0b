"""External indicator payloads: nested JSON documents to flat series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from andenlake.operators.quality import QualityError
from andenlake.schemas import BRONZE, PAYLOAD, conform
from andenlake.sources import snapshots

# Dimension members requested from the indicator service.
COUNTRIES = {221: "Bolivia (Estado Plurinacional de)", 216: "Argentina", 244: "Peru",
             224: "Chile", 222: "Brasil", 242: "Paraguay"}
YEARS = {29185: "2015", 29187: "2017", 29188: "2018", 29189: "2019", 29190: "2020",
         29191: "2021", 29192: "2022"}
MODES = {74755: "Transporte aereo", 74756: "Transporte ferroviario", 74757: "Transporte vial"}
INDICATOR_ID = 3906
INDICATOR_NAME = "Volumen transporte pasajeros"
UNKNOWN = "Desconocido"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw documents, one row per file, text unmodified."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("archivo"), F.col("value").alias("documento")))


def land_documents(documents: DataFrame, root: str, name: str, ingest_date: dt.date) -> str:
    return snapshots.land(documents, root, name, ingest_date)


def parse(documents: DataFrame, text: str = "documento") -> DataFrame:
    """Add the parsed envelope as ``payload``; broken text gives null fields.

    The one-element explode keeps later filters above the parser; pushed below
    it they would parse the text again for every field they look at.
    """
    parsed = F.array(F.from_json(F.col(text), PAYLOAD))
    return documents.select("*", F.explode(parsed).alias("payload"))


def envelope_status() -> Column:
    """``rechazado`` unless success is true and the code 200, ``vacio`` where the
    service answered without records, else ``ok``."""
    header, records = F.col("payload.header"), F.col("payload.footer.records")
    accepted = header.success & (header.code == 200)
    return (F.when(~F.coalesce(accepted, F.lit(False)), "rechazado")
            .when(F.coalesce(records, F.lit(0)) == 0, "vacio")
            .otherwise("ok"))


def check_envelopes(parsed: DataFrame) -> DataFrame:
    """Parsed documents with their ``estado`` and the reason of a rejection."""
    header = F.col("payload.header")
    reason = (F.when(~F.coalesce(header.success, F.lit(False)),
                     F.concat(F.lit("success=False: "),
                              F.coalesce(F.nullif(header.message, F.lit("")),
                                         F.lit("Sin mensaje"))))
              .when(~F.coalesce(header.code == 200, F.lit(False)),
                    F.concat(F.lit("codigo "), F.coalesce(header.code.cast("string"),
                                                          F.lit("ausente")))))
    return parsed.withColumns({"estado": envelope_status(), "motivo": reason})


def require_accepted(checked: DataFrame) -> None:
    """Raise on the first rejected document."""
    bad = checked.filter(F.col("estado") == "rechazado").select("motivo").head(1)
    if bad:
        raise QualityError(bad[0].motivo)


def _decode(code: Column, members: dict[int, str]) -> Column:
    pairs = [F.lit(x) for pair in members.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(UNKNOWN))


def flatten_series(parsed: DataFrame, run_date: dt.date,
                   indicator_id: int = INDICATOR_ID) -> DataFrame:
    """One row per data point, codes decoded by the requested members."""
    meta, point = F.col("payload.body.metadata"), F.col("punto")
    points = parsed.select("*", F.explode("payload.body.data").alias("punto"))
    rows = points.select(
        F.lit(indicator_id).alias("indicador_id"),
        F.coalesce(meta.indicator_name, F.lit(INDICATOR_NAME)).alias("indicador_nombre"),
        point.dim_208.alias("pais_id"), _decode(point.dim_208, COUNTRIES).alias("pais_nombre"),
        F.coalesce(point.iso3, F.lit("")).alias("iso3"),
        point.dim_29117.alias("anio_id"), _decode(point.dim_29117, YEARS).alias("anio"),
        point.dim_74754.alias("modo_id"), _decode(point.dim_74754, MODES).alias("modo_transporte"),
        point.value.try_cast("double").alias("valor"),
        F.coalesce(meta.unit, F.lit("")).alias("unidad"),
        point.source_id.alias("fuente_id"),
        F.lit(run_date).alias("fecha_extraccion"))
    return rows


def as_bronze(series: DataFrame) -> DataFrame:
    return conform(series, BRONZE["cepal_transporte_pasajeros"])


def dimension_members(parsed: DataFrame) -> DataFrame:
    """Catalogue of dimensions and members."""
    dims = parsed.select(F.explode("payload.body.dimensions").alias("d"))
    members = dims.select("d", F.explode("d.members").alias("x"))
    d, x = F.col("d"), F.col("x")
    return members.select(
        d.id.alias("dim_id"), d["name"].alias("dim_nombre"), x.id.alias("miembro_id"),
        x["name"].alias("miembro_nombre"), x.parent.alias("padre"), x["order"].alias("orden"))
