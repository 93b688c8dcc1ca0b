"""Star schema: six dimensions and the ticket-grain fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from andenlake.functions import calendar as cal
from andenlake.functions import measures as m
from andenlake.operators.joins import lookup, scalar
from andenlake.operators.numbering import dense_numbers
from andenlake.schemas import GOLD, conform
from andenlake.session import release

# What the fact takes from a ticket, its id first.
TICKET_COLUMNS = ["id_venta", "id_ruta", "id_empresa", "id_pasajero", "id_unidad", "fecha_viaje",
                  "canal_venta", "estado_pasaje", "monto_pagado", "descuento_aplicado",
                  "numero_asiento", "cepal_volumen_pasajeros_km", "cepal_modo_transporte"]

NATURAL_KEYS = ["id_ruta", "id_empresa", "id_pasajero", "id_unidad"]

# Of these, the ids of what grows with the tickets, and where a bus may come from.
FAR_KEYS = ["id_pasajero", "id_unidad", "id_itinerario"]

Numbering = Callable[[DataFrame, str, list[str]], DataFrame]

# What a fact row gets where a lookup finds nothing.
UNKNOWN = "Desconocido"
DEFAULT_TIME_KEY = 20220101
DEFAULT_KEY = 1
DEFAULT_SEATS = 44

# Places of decimal(8,2) / int and of decimal(10,4) / int in the gold database.
ROUTE_FARE_PLACES = 13
TICKET_FARE_PLACES = 15


def dim_tiempo(ventas: DataFrame) -> DataFrame:
    """One row per date of sale or travel. Both dates come from one scan, and
    duplicates are dropped map-side before the shuffle."""
    both = F.array(cal.parse_date("fecha_venta"), cal.parse_date("fecha_viaje"))
    days = ventas.select(F.explode(both).alias("fecha")).dropna().distinct()
    columns = [c.alias(name) for name, c in cal.attributes("fecha").items()]
    return conform(days.select(*columns), GOLD["dim_tiempo"])


def _with_city(df: DataFrame, geo: DataFrame, key: str, city: str, department: str) -> DataFrame:
    places = geo.select(F.col("id_ciudad").alias(key), F.col("ciudad").alias(city),
                        F.col("departamento").alias(department))
    return df.join(places, key, "left").fillna(UNKNOWN, subset=[city, department])


def dim_ruta(rutas: DataFrame, geo: DataFrame, number: Numbering = dense_numbers) -> DataFrame:
    """Routes with the names of both end points (the city table in two roles)."""
    ends = _with_city(rutas, geo, "ciudad_origen_id", "ciudad_origen", "departamento_origen")
    ends = _with_city(ends, geo, "ciudad_destino_id", "ciudad_destino", "departamento_destino")
    rows = ends.select(F.col("id_ruta").alias("id_ruta_origen"), "ciudad_origen",
                       "departamento_origen", "ciudad_destino", "departamento_destino",
                       "distancia_km", "duracion_horas", "tipo_corredor", "tarifa_base",
                       m.decimal_ratio(F.col("tarifa_base"), F.col("distancia_km"), ROUTE_FARE_PLACES)
                       .alias("ingreso_por_km"))
    return conform(number(rows, "sk_ruta", rows.columns), GOLD["dim_ruta"])


def dim_empresa(empresas: DataFrame, number: Numbering = dense_numbers) -> DataFrame:
    rows = empresas.select(
        F.col("id_empresa").alias("id_empresa_origen"), "nombre_empresa",
        F.col("tipo").alias("tipo_empresa"), F.col("estado").alias("estado_empresa"),
        F.coalesce(F.col("capacidad_flota_total").cast("int"), F.lit(0))
        .alias("capacidad_flota_total"))
    return conform(number(rows, "sk_empresa", rows.columns), GOLD["dim_empresa"])


def dim_pasajero(pasajeros: DataFrame, geo: DataFrame,
                 number: Numbering = dense_numbers) -> DataFrame:
    placed = _with_city(pasajeros, geo, "ciudad_id", "ciudad_origen", "departamento_origen")
    rows = placed.select(
        F.col("id_pasajero").alias("id_pasajero_origen"), "ciudad_origen", "departamento_origen",
        F.coalesce("nacionalidad", F.lit("Boliviana")).alias("nacionalidad"))
    return conform(number(rows, "sk_pasajero", rows.columns), GOLD["dim_pasajero"])


def dim_unidad(unidades: DataFrame, number: Numbering = dense_numbers) -> DataFrame:
    rows = unidades.select(F.col("id_unidad").alias("id_unidad_origen"), "placa", "marca",
                           "modelo", "anio_fabricacion", "capacidad_asientos", "tipo_servicio")
    return conform(number(rows, "sk_unidad", rows.columns), GOLD["dim_unidad"])


def dim_canal(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(m.CHANNELS, GOLD["dim_canal"])


def units_from_itineraries(ventas: DataFrame, itinerarios: DataFrame) -> DataFrame:
    """Give tickets the bus of their itinerary. Tickets carry none of their own;
    without this step every fact row falls back to the first bus."""
    return lookup(ventas, itinerarios, "id_itinerario", "id_itinerario", "id_unidad")


def _or_literal(df: DataFrame, name: str, default: object) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def fact_rows(tickets: DataFrame, dims: dict[str, DataFrame],
              tiempo: DataFrame | None = None, unique: bool = False,
              keys: DataFrame | None = None) -> DataFrame:
    """Ticket-grain fact with the keys and copied measures of the given
    dimensions; a view that needs no buses leaves ``dim_unidad`` out.
    ``unique`` says that no source id occurs twice in a dimension.

    ``keys`` may hold ``id_venta``, ``sk_venta`` and the ids of passengers and buses by
    themselves, where no ``id_venta`` is null or occurs twice. These are then looked up for
    such short rows, and the tickets themselves are shuffled once, to meet what was found.

    The time key is spelled by the date itself; ``tiempo`` is only needed to
    send dates outside the dimension to the default key, and may be omitted
    when the dimension was built from these same tickets.
    """
    own = {
        "__day": cal.date_key(cal.parse_date("fecha_viaje")),
        "sk_canal": F.coalesce(m.channel_key("canal_venta"), F.lit(DEFAULT_KEY)),
        "id_venta_origen": F.col("id_venta"),
        "monto_pagado": F.col("monto_pagado"),
        "descuento_aplicado": F.coalesce("descuento_aplicado", F.lit(0)),
        "numero_asiento": F.coalesce("numero_asiento", F.lit(1)),
        "es_cancelado": m.is_cancelled("estado_pasaje"),
        "cepal_volumen_pasajeros_km": F.coalesce(
            _or_literal(tickets, "cepal_volumen_pasajeros_km", 0), F.lit(0))
        .cast("decimal(18,3)"),
        "cepal_modo_transporte": F.coalesce(
            _or_literal(tickets, "cepal_modo_transporte", "Sin dato"), F.lit("Sin dato")),
    }
    if "sk_venta" in tickets.columns:
        own["sk_venta"] = F.col("sk_venta")
    # Passengers and buses grow with the tickets, so these are shuffled for them: before the
    # other lookups add columns, and without the texts that the own columns come from.
    ids = [c for c in NATURAL_KEYS if c in tickets.columns and c not in own
           and (keys is None or c not in FAR_KEYS)]
    df = tickets.select(*[c.alias(name) for name, c in own.items()], *ids)
    columns = {name: F.col(name) for name in own if name != "__day"}
    far = df if keys is None else keys
    if "dim_unidad" in dims:
        far, columns["sk_unidad"], columns["capacidad_unidad"] = _bus(
            far, dims["dim_unidad"], unique)
    if "dim_pasajero" in dims:
        far, columns["sk_pasajero"] = _key_of(far, dims, "pasajero", unique)
    if keys is None:
        df = far
    else:
        found = far.drop(*FAR_KEYS).withColumnRenamed("id_venta", "__id_venta")
        df = df.join(found, F.col("id_venta_origen") == F.col("__id_venta"))
        columns["sk_venta"] = F.col("sk_venta")
    if "dim_empresa" in dims:
        df, columns["sk_empresa"] = _key_of(df, dims, "empresa", unique)
    if "dim_ruta" in dims:
        km = F.coalesce("__km", F.lit(0))
        df = lookup(df, dims["dim_ruta"], "id_ruta", "id_ruta_origen", "sk_ruta",
                    {"distancia_km": "__km", "tarifa_base": "__fare"}, unique)
        columns |= {"sk_ruta": F.coalesce("sk_ruta", F.lit(DEFAULT_KEY)),
                    "tarifa_base": F.coalesce("__fare", F.lit(0)),
                    "distancia_km": km,
                    "ingreso_por_km": m.decimal_ratio(F.col("monto_pagado"), km,
                                                      TICKET_FARE_PLACES)}
    columns["sk_tiempo"] = F.coalesce("__day", F.lit(DEFAULT_TIME_KEY))
    if tiempo is not None:
        known = tiempo.select(F.col("sk_tiempo").alias("__id"),
                              F.col("sk_tiempo").alias("__known"))
        df = lookup(df, known, "__day", "__id", "__known", unique=True)
        columns["sk_tiempo"] = F.coalesce("__known", F.lit(DEFAULT_TIME_KEY))
    return df.select(*[c.alias(name) for name, c in columns.items()])


def _key_of(df: DataFrame, dims: dict[str, DataFrame], name: str,
            unique: bool) -> tuple[DataFrame, Column]:
    found = lookup(df, dims[f"dim_{name}"], f"id_{name}", f"id_{name}_origen", f"sk_{name}",
                   unique=unique)
    return found, F.coalesce(f"sk_{name}", F.lit(DEFAULT_KEY))


def _bus(tickets: DataFrame, unidad: DataFrame, unique: bool) -> tuple[DataFrame, Column, Column]:
    """Bus key and seats. A missed bus is counted as bus 1, with its seats."""
    first = scalar(unidad.filter(F.col("sk_unidad") == DEFAULT_KEY)
                   .agg(F.max("capacidad_asientos")))
    if "id_unidad" not in tickets.columns:
        return tickets, F.lit(DEFAULT_KEY), F.coalesce(first, F.lit(DEFAULT_SEATS))
    df = lookup(tickets, unidad, "id_unidad", "id_unidad_origen", "sk_unidad",
                {"capacidad_asientos": "__seats"}, unique)
    seats = F.when(F.col("sk_unidad").isNull(), first).otherwise(F.col("__seats"))
    return (df, F.coalesce("sk_unidad", F.lit(DEFAULT_KEY)),
            F.coalesce(seats, F.lit(DEFAULT_SEATS)))


def _is_key(ids: DataFrame, name: str) -> bool:
    """Whether no value is null or occurs twice."""
    groups = ids.groupBy(name).agg(F.count("*").alias("n"))
    return groups.filter(F.col(name).isNull() | (F.col("n") > 1)).isEmpty()


def fact_ventas(tickets: DataFrame, tiempo: DataFrame | None, dims: dict[str, DataFrame],
                number: Numbering = dense_numbers, unique: bool = False, *,
                itinerarios: DataFrame | None = None) -> DataFrame:
    """The complete fact; with ``itinerarios`` a ticket gets the bus of its itinerary.

    Tickets are numbered before the lookups, so that the sampling pass of the range
    partitioning repeats a scan and not the joins. Where no ticket id is null or occurs twice
    it alone decides the order, and only it and the ids of passengers and buses are sorted,
    written and shuffled for the lookups; the tickets meet them by their id. Else whole tickets
    are numbered, with the columns of the fact alone, as the numbered rows are written. Ties
    of the id are broken by those columns."""
    if itinerarios is not None:
        tickets = tickets.drop("id_unidad")

    def bused(df: DataFrame) -> DataFrame:
        return df if itinerarios is None else units_from_itineraries(df, itinerarios)

    far = [c for c in FAR_KEYS if c in tickets.columns
           and (c != "id_itinerario" or itinerarios is not None)]
    keys = number(tickets.select("id_venta", *far), "sk_venta", ["id_venta"])
    alone = _is_key(keys, "id_venta")
    release(tickets.sparkSession)  # the shuffles of the numbering are not read again
    if alone:
        lean = tickets.select(*[c for c in TICKET_COLUMNS if c in tickets.columns])
        rows = fact_rows(lean, dims, tiempo, unique, bused(keys))
    else:
        whole = bused(tickets)
        lean = whole.select(*[c for c in TICKET_COLUMNS if c in whole.columns])
        rows = fact_rows(number(lean, "sk_venta", lean.columns), dims, tiempo, unique)
    return conform(rows, GOLD["fact_ventas"])
