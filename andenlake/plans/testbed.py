"""Driver tables seen as the operational tables of the terminal.

The mapping is plain SQL that Spark and the checking database both run; only
the few words in ``SPARK`` differ between them. It plants the defects that the
cleaning rules exist for: padded and mixed-case text, invalid dates, amounts of
zero, discounts out of range, missing routes, buses and cities.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from andenlake.operators import cleaning, quality, star
from andenlake.operators.enrich import integrate
from andenlake.operators.numbering import sparse_numbers
from andenlake.plans import pipeline
from andenlake.plans.kpis import Gold
from andenlake.schemas import GOLD, conform_known
from andenlake.session import release, scratch, shared_folder
from andenlake.sources import snapshots, versions

DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
DRIVER_TABLES = list(DRIVER_SCHEMAS)
RUN_DATE = dt.date(2026, 4, 7)

SPARK = {
    "hash60": "cast(conv(substr(md5(%s), 1, 15), 16, 10) AS bigint)",
    "upto": "explode(sequence(0, %s))",
}

_TICKET_ID = ("concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
              "cast(l_quantity AS int), cast(l_shipdate AS date))")

# The route of a ticket is the pair of the company's and the passenger's city.
_ROUTE = "cast(s_nationkey * 25 + c_nationkey AS bigint)"
_COMPANY_JOIN = "LEFT JOIN {supplier} ON l_suppkey = s_suppkey"
_ROUTE_JOINS = f"""LEFT JOIN {{customer}} ON o_custkey = c_custkey
{_COMPANY_JOIN}"""

RAW_SQL = {
    "geografia": """
SELECT cast(n_nationkey AS bigint) AS id_ciudad,
       CASE n_nationkey % 3 WHEN 0 THEN '  ' || lower(n_name) WHEN 1 THEN n_name || ' '
            ELSE n_name END AS ciudad,
       lower(r_name) AS departamento,
       n_nationkey % 5 = 0 AS es_fronteriza,
       CASE WHEN n_nationkey % 4 <> 0 THEN cast(-10 - n_nationkey * 0.25 AS double) END AS latitud,
       CASE WHEN n_nationkey % 6 <> 0 THEN cast(-60 - n_nationkey * 0.5 AS double) END AS longitud
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "empresas": """
SELECT s_suppkey AS id_empresa,
       CASE WHEN s_suppkey % 2 = 0 THEN ' ' || lower(s_name) ELSE s_name || '  ' END
           AS nombre_empresa,
       concat('10', s_suppkey) AS nit,
       CASE WHEN s_suppkey % 10 <> 0 THEN concat('0 46 ', s_suppkey, ' 0') END AS telefono,
       CASE s_suppkey % 3 WHEN 0 THEN 'activa' WHEN 1 THEN ' SUSPENDIDA'
            ELSE 'Inhabilitada ' END AS estado,
       CASE s_suppkey % 4 WHEN 0 THEN 'FLOTA' WHEN 1 THEN 'trufi' WHEN 2 THEN ' Microbus'
            ELSE 'mixta' END AS tipo,
       cast(s_nationkey AS bigint) AS ciudad_origen_id,
       CASE WHEN s_acctbal > 0 THEN cast(floor(s_acctbal / 50) + 20 AS double) END
           AS capacidad_flota_total,
       CASE WHEN s_suppkey % 17 = 0 THEN 'sin fecha'
            ELSE concat('20', lpad(cast(s_suppkey % 20 AS string), 2, '0'), '-0',
                        1 + s_suppkey % 9, '-15') END AS fecha_registro
FROM {supplier}""",
    "rutas": """
SELECT cast(s.n_nationkey * 25 + d.n_nationkey AS bigint) AS id_ruta,
       cast(s.n_nationkey AS bigint) AS ciudad_origen_id,
       cast(d.n_nationkey AS bigint) AS ciudad_destino_id,
       CASE WHEN s.n_nationkey = 7 AND d.n_nationkey = 7 THEN 0
            ELSE 25 + 37 * abs(s.n_nationkey - d.n_nationkey) END AS distancia_km,
       cast(0.5 + 0.5 * abs(s.n_nationkey - d.n_nationkey) AS decimal(4,1)) AS duracion_horas,
       CASE WHEN s.n_nationkey = d.n_nationkey THEN ' interprovincial'
            WHEN s.n_regionkey = d.n_regionkey THEN 'INTERDEPARTAMENTAL'
            ELSE 'Fronterizo ' END AS tipo_corredor,
       cast(1000 + 60 * (25 + 37 * abs(s.n_nationkey - d.n_nationkey)) AS decimal(8,2))
           AS tarifa_base,
       (s.n_nationkey + d.n_nationkey) % 7 <> 0 AS activa
FROM (SELECT *, {all_nations} AS other FROM {nation}) s
JOIN {nation} d ON d.n_nationkey = s.other""",
    "pasajeros": """
SELECT c_custkey AS id_pasajero,
       lower(c_name) AS nombre,
       CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE ' ' || lower(c_mktsegment) || ' ' END
           AS apellido,
       concat('CI', c_custkey) AS ci,
       CASE WHEN c_custkey % 5 <> 0 THEN concat('7', c_custkey) END AS telefono,
       CASE WHEN c_custkey % 4 <> 0 THEN concat(' User', c_custkey, '@Mail.COM ') END AS email,
       CASE WHEN c_custkey % 50 = 0 THEN cast(99 AS bigint) ELSE cast(c_nationkey AS bigint) END
           AS ciudad_id,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' argentina' ELSE 'BOLIVIANA' END
           AS nacionalidad,
       CASE WHEN c_custkey % 13 = 0 THEN '1990-02-30'
            ELSE concat('19', 50 + c_custkey % 50, '-06-', 10 + c_custkey % 18) END
           AS fecha_nacimiento
FROM {customer}""",
    "unidades_flota": """
SELECT p_partkey AS id_unidad,
       p_partkey % 100 AS id_empresa,
       concat(' abc-', p_partkey) AS placa,
       lower(p_brand) AS marca,
       concat(p_name, ' ') AS modelo,
       CASE WHEN p_partkey % 25 = 0 THEN 1975 ELSE 1990 + p_size % 36 END AS anio_fabricacion,
       p_size AS capacidad_asientos,
       lower(p_type) AS tipo_servicio,
       CASE p_partkey % 3 WHEN 0 THEN 'operativa' WHEN 1 THEN ' en mantenimiento'
            ELSE 'BAJA' END AS estado_unidad
FROM {part}""",
    "itinerarios": """
SELECT p_partkey AS id_itinerario,
       p_partkey % 625 AS id_ruta,
       p_partkey % 100 AS id_empresa,
       p_partkey AS id_unidad,
       concat(lpad(cast(p_partkey % 24 AS string), 2, '0'), ':30:00') AS hora_salida,
       'Lunes,Miercoles,Viernes' AS dias_operacion,
       'Semanal' AS frecuencia,
       p_partkey % 9 <> 0 AS activo
FROM {part}""",
    "ventas_pasajes": """
SELECT {ticket_id} AS id_venta,
       l_partkey AS id_itinerario,
       o_custkey AS id_pasajero,
       {route} AS id_ruta,
       l_suppkey AS id_empresa,
       CASE WHEN l_orderkey % 97 = 13 THEN 'sin fecha'
            ELSE cast(cast(o_orderdate AS date) AS string) END AS fecha_venta,
       CASE WHEN l_orderkey % 89 = 7 AND l_linenumber = 2 THEN '2000-02-30'
            ELSE cast(cast(l_shipdate AS date) AS string) END AS fecha_viaje,
       CASE WHEN l_linenumber <> 5 THEN l_linenumber END AS numero_asiento,
       CASE WHEN l_partkey % 101 = 3 THEN cast(0 AS decimal(18,4))
            ELSE cast(cast(l_extendedprice AS decimal(12,2))
                      * (cast(1 AS decimal(4,2)) - cast(l_discount AS decimal(4,2)))
                      AS decimal(18,4)) END AS monto_pagado,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN ' web' WHEN '2' THEN 'TELEFONO'
            WHEN '3' THEN 'ventanilla ' WHEN '5' THEN 'Agente' ELSE 'otro' END AS canal_venta,
       CASE l_returnflag WHEN 'R' THEN 'cancelado' WHEN 'A' THEN ' Viajado'
            ELSE 'CONFIRMADO' END AS estado_pasaje,
       CASE WHEN l_suppkey % 50 = 7 THEN cast(101 AS decimal(5,2))
            WHEN l_linenumber <> 7
            THEN cast(100 * cast(l_discount AS decimal(4,2)) AS decimal(5,2)) END
           AS descuento_aplicado,
       CASE l_linenumber WHEN 1 THEN NULL
            WHEN 2 THEN concat('  Ana  Maria ', o_custkey, ' ')
            WHEN 3 THEN concat('JOSE', chr(9), ' PEREZ ', o_custkey)
            ELSE concat('Pasajero ', o_custkey) END AS nombre_pasajero_registrado,
       CASE WHEN l_linenumber % 3 <> 0 THEN concat('Obs ', l_linestatus) END AS observaciones,
       l_partkey AS id_unidad
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
{route_joins}""",
    "cepal_transporte_pasajeros": """
SELECT 3906 AS indicador_id,
       'Volumen de transporte' AS indicador_nombre,
       CASE pais WHEN 0 THEN 221 ELSE 216 END AS pais_id,
       CASE pais WHEN 0 THEN ' bolivia (estado plurinacional de)' ELSE 'ARGENTINA ' END
           AS pais_nombre,
       CASE pais WHEN 0 THEN 'BOL' ELSE 'ARG' END AS iso3,
       29000 + anio AS anio_id,
       cast(anio AS string) AS anio,
       74755 AS modo_id,
       'transporte aereo ' AS modo_transporte,
       CASE WHEN pais = 1 AND anio = 1997 THEN 'n/d'
            ELSE cast(cast(total * cast(0.001 AS decimal(4,3)) AS decimal(18,3)) AS string) END
           AS valor,
       'pasajeros-km' AS unidad,
       3760 AS fuente_id,
       date '2026-04-07' AS fecha_extraccion
FROM (SELECT anio, total, {two} AS pais
      FROM (SELECT year(cast(o_orderdate AS date)) AS anio,
                   sum(cast(o_totalprice AS decimal(18,2))) AS total
            FROM {orders}
            WHERE o_orderstatus = 'F' AND cast(o_orderdate AS date) < date '2000-01-01'
            GROUP BY year(cast(o_orderdate AS date))) y) x""",
}


def mapping_sql(table: str, words: dict[str, str], names: dict[str, str],
                route_joins: str = _ROUTE_JOINS) -> str:
    """The mapping of a table with the words of an engine and its table names."""
    return RAW_SQL[table].format(
        ticket_id=words["hash60"] % _TICKET_ID, route=_ROUTE,
        route_joins=route_joins.format(**names),
        all_nations=words["upto"] % f"(SELECT max(n_nationkey) FROM {names['nation']})",
        two=words["upto"] % "1", **names)


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


#: Folders of what was derived from the given files, by application, scratch folder and files.
_LAKES: dict[tuple, str] = {}


def lake(spark: SparkSession, folder: str) -> str:
    """Where the tables derived from the given files are landed. They are landed once: the
    files of a folder are told by name, size and time, so replaced ones get a new lake."""
    key = (spark.sparkContext.applicationId, shared_folder(spark),
           snapshots.fingerprint(spark, folder))
    if key not in _LAKES:
        _LAKES[key] = scratch(spark, "lake")
    return _LAKES[key]


def source_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """An operational table as the mapping gives it. Passengers are joined to the orders and
    not to the rows of ``lineitem``, which so are shuffled for one join only."""
    text = mapping_sql(table, SPARK, {n: f"{{{n}}}" for n in DRIVER_TABLES}, _COMPANY_JOIN)
    used = {n: driver_table(spark, folder, n) for n in DRIVER_TABLES if f"{{{n}}}" in text}
    if table == "ventas_pasajes":
        cities = driver_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        used["orders"] = used["orders"].join(
            cities, F.col("o_custkey") == F.col("c_custkey"), "left")
    return spark.sql(text, **used)


def raw_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The landed snapshot of an operational table, landed where there is none yet."""
    bronze, source = f"{lake(spark, folder)}/bronze", source_table(spark, folder, table)
    if not snapshots.snapshot_dates(spark, bronze, table):
        snapshots.land(source, bronze, table, RUN_DATE)
        release(spark)
    return snapshots.latest(spark, bronze, table, source.schema)


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, folder, name) for name in RAW_SQL}


def clean_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return cleaning.CLEANERS[table](raw_table(spark, folder, table))


def clean_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: clean_table(spark, folder, name) for name in RAW_SQL}


def integrated(spark: SparkSession, folder: str) -> DataFrame:
    return integrate(clean_table(spark, folder, "ventas_pasajes"),
                     clean_table(spark, folder, "cepal_transporte_pasajeros"))


def dimension(spark: SparkSession, folder: str, name: str, **numbering) -> DataFrame:
    """One dimension over cleaned tables."""
    def clean(table: str) -> DataFrame:
        return clean_table(spark, folder, table)

    if name == "dim_ruta":
        return star.dim_ruta(clean("rutas"), clean("geografia"), **numbering)
    if name == "dim_empresa":
        return star.dim_empresa(clean("empresas"), **numbering)
    if name == "dim_pasajero":
        return star.dim_pasajero(clean("pasajeros"), clean("geografia"), **numbering)
    return star.dim_unidad(clean("unidades_flota"), **numbering)


LOOKED_UP = ["dim_ruta", "dim_empresa", "dim_pasajero", "dim_unidad"]


def live_gold(spark: SparkSession, folder: str, dims: str = "",
              with_benchmark: bool = False) -> Gold:
    """The part of the star a view needs, as one lazy plan over the raw
    tables with nothing written. ``dims`` names the dimensions looked up."""
    used = {f"dim_{d}": dimension(spark, folder, f"dim_{d}", number=sparse_numbers)
            for d in dims.split()}
    tickets = (integrated(spark, folder) if with_benchmark
               else clean_table(spark, folder, "ventas_pasajes"))
    return Gold(star.fact_rows(tickets, used, unique=True), used.get("dim_ruta"),
                used.get("dim_empresa"))


def _built(spark: SparkSession, folder: str, part: str, write: Callable[[str], None]) -> str:
    """A published part of the star over the given tables, built where there is none yet."""
    root = f"{lake(spark, folder)}/{part}"
    try:
        return versions.current(spark, root)
    except versions.NoVersion:
        version = versions.new(root)
        write(version)
        release(spark)
        versions.publish(spark, root, version)
        return version


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six written dimensions."""
    def write(version: str) -> None:
        tiempo = star.dim_tiempo(clean_table(spark, folder, "ventas_pasajes"))
        pipeline.write_dimensions(spark, version, {
            "dim_tiempo": tiempo, **{n: dimension(spark, folder, n) for n in LOOKED_UP},
            "dim_canal": star.dim_canal(spark)})

    return pipeline.read_tables(spark, _built(spark, folder, "dimensions", write),
                                ["dim_tiempo", *LOOKED_UP, "dim_canal"])


def _repeats(dim: DataFrame, key: str) -> bool:
    """Whether an id occurs twice in a dimension."""
    ids = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return not ids.filter(F.col("n") > 1).isEmpty()


def _cell_rows(dims: dict[str, DataFrame], tickets: DataFrame, unread: dict[str, str]) -> DataFrame:
    """The tickets that cells are made from. Of ``unread``, dimensions (with their ids) that
    give the cells no column, those with an id only once are not looked up: that neither adds
    nor drops a ticket. With an id twice its tickets count twice, as in the fact."""
    used = {n: dims[n] for n in LOOKED_UP if n not in unread or _repeats(dims[n], unread[n])}
    return conform_known(star.fact_rows(tickets, used, dims["dim_tiempo"], unique=True),
                         GOLD["fact_ventas"])


def gold(spark: SparkSession, folder: str, companies: bool = True) -> Gold:
    """The star as the views read it: dimensions and cells; those by company only where a view
    reads them. Cells hold no numbers of tickets, so they are made from the looked-up tickets
    before these are numbered."""
    dims, tickets = dimensions(spark, folder), integrated(spark, folder)
    passengers, buses = ({f"dim_{n}": f"id_{n}_origen"} for n in ("pasajero", "unidad"))
    by_route = _built(spark, folder, "cells", lambda path: pipeline.write_cells(
        path, _cell_rows(dims, tickets, passengers), dims["dim_tiempo"]))
    by_company = _built(spark, folder, "company_cells", lambda path: pipeline.write_company_cells(
        path, _cell_rows(dims, tickets, passengers | buses),
        dims["dim_tiempo"])) if companies else None
    rows = star.fact_rows(tickets, dims, dims["dim_tiempo"], unique=True)
    return pipeline.with_cells(spark, {**dims, "fact_ventas": rows}, by_route, by_company)


def gold_frames(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven gold tables."""
    dims = dimensions(spark, folder)
    version = _built(spark, folder, "fact", lambda path: pipeline.write_fact(
        path, dims, integrated(spark, folder), unique=True))
    return {**dims, **pipeline.read_tables(spark, version, ["fact_ventas"])}


def fact(spark: SparkSession, folder: str, use_itineraries: bool = False) -> DataFrame:
    """The complete fact over the star's dimensions, built anew. With ``use_itineraries`` a
    ticket has no bus of its own and gets its itinerary's."""
    frames, tickets = dimensions(spark, folder), integrated(spark, folder)
    trips = clean_table(spark, folder, "itinerarios") if use_itineraries else None
    dims = {name: frames[name] for name in LOOKED_UP}
    return star.fact_ventas(tickets, frames["dim_tiempo"], dims, unique=True, itinerarios=trips)


def watched_silver(spark: SparkSession, folder: str) -> quality.Watch:
    """What is observed while every table is cleaned and the tickets are integrated: one scan
    of each raw table, and nothing written."""
    watch = quality.Watch()
    clean = {name: watch.clean(name, cleaning.CLEANERS[name](watch.raw(name, df)))
             for name, df in raw_tables(spark, folder).items()}
    clean["ventas_pasajes"] = watch.clean(quality.INTEGRATED, integrate(
        clean["ventas_pasajes"], clean_table(spark, folder, "cepal_transporte_pasajeros")))
    for df in clean.values():
        df.write.format("noop").mode("overwrite").save()
    return watch


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Indicator documents, one per event, with rejected, empty and odd ones."""
    k = F.get_json_object("props", "$.k").cast("int")
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")

    def point(shift: int):
        return F.struct(
            F.when((k + shift) % 10 == 3, "n/d").otherwise((k + shift).cast("string"))
            .alias("value"),
            F.lit(3760).alias("source_id"), F.lit("").alias("notes_ids"),
            F.when(user % 4 == 0, "BOL").when(user % 4 == 1, "ARG").alias("iso3"),
            (F.lit(74755) + (user + shift) % 4).cast("int").alias("dim_74754"),
            F.when(user % 4 == 0, 221).when(user % 4 == 1, 216).when(user % 4 == 2, 244)
            .otherwise(999).alias("dim_208"),
            (F.lit(29185) + event % 8).cast("int").alias("dim_29117"),
            F.lit(74391).alias("dim_74389"))

    def member(code: int, name: str, order):
        return F.struct(F.lit(name).alias("name"), F.lit(code).alias("id"), F.lit(1).alias("in"),
                        order.alias("order"), F.lit(208).alias("parent"),
                        F.lit(0).alias("selected"))

    points = F.array(point(0), point(1))
    catalogue = F.array(F.struct(
        F.lit("Pais").alias("name"), F.lit(208).alias("id"), F.lit(1).alias("order"),
        F.lit(1).alias("position"),
        F.array(member(221, "Bolivia", k), member(216, "Argentina", k + 1)).alias("members")))
    document = F.to_json(F.struct(
        F.struct((k % 20 != 0).alias("success"),
                 F.when(k % 20 == 1, 500).otherwise(200).alias("code"),
                 F.when(k % 20 == 0, "sin servicio").otherwise("").alias("message"))
        .alias("header"),
        F.struct(F.struct(F.lit("Volumen").alias("indicator_name"),
                          F.when(k % 2 == 0, "pasajeros-km").alias("unit")).alias("metadata"),
                 F.when(kind != "error", points).alias("data"),
                 F.when(kind == "view", catalogue).alias("dimensions")).alias("body"),
        F.struct(F.when(kind == "error", 0).otherwise(2).alias("records")).alias("footer")))
    return driver_table(spark, folder, "events").select("event_id", document.alias("documento"))
