"""Datasets behind the report pages: rankings, shares, trends, risk lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from andenlake.functions import calendar as cal
from andenlake.functions import measures as m
from andenlake.functions import text as t
from andenlake.operators.counts import row_counts
from andenlake.operators.joins import scalar
from andenlake.plans import kpis
from andenlake.plans.kpis import Gold

TOP_ROWS = 15
TOP_ROUTES = 10


# ---- sales page ----------------------------------------------------------

def sales_filtered(ventas: DataFrame, channels: list[str] | None = None,
                   states: list[str] | None = None) -> DataFrame:
    """Tickets of the chosen channels and states, with their month of travel."""
    df = ventas.select("fecha_viaje", "monto_pagado", "canal_venta", "estado_pasaje",
                       cal.month_bucket(cal.parse_date("fecha_viaje")).alias("mes"))
    if channels is not None:
        df = df.filter(F.col("canal_venta").isin(channels))
    if states is not None:
        df = df.filter(F.col("estado_pasaje").isin(states))
    return df


def sales_totals(sales: DataFrame) -> DataFrame:
    cancelled = F.col("estado_pasaje") == m.CANCELLED
    return (sales.agg(F.coalesce(F.sum("monto_pagado"), F.lit(0)).alias("ingresos_totales"),
                      F.count("*").alias("pasajes_vendidos"),
                      F.count_if(cancelled).alias("cancelados"),
                      F.count("monto_pagado").alias("__paid"))
            .withColumn("ticket_promedio", m.ratio(F.col("ingresos_totales"), F.col("__paid")))
            .drop("__paid"))


def sales_by_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy("mes").agg(F.sum("monto_pagado").alias("monto_pagado"))


def sales_by_channel(sales: DataFrame) -> DataFrame:
    return sales.groupBy("canal_venta").agg(F.count("*").alias("cantidad"))


def sales_by_state(sales: DataFrame) -> DataFrame:
    return (sales.groupBy(F.col("estado_pasaje").alias("estado"))
            .agg(F.count("*").alias("cantidad")))


def filter_options(ventas: DataFrame) -> DataFrame:
    """Distinct channels and states, from one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("filtro"), F.col(c).alias("opcion"))
                      for c in ("canal_venta", "estado_pasaje")])
    return ventas.select(F.explode(pairs).alias("p")).select("p.*").distinct()


# ---- route and company pages -----------------------------------------------

def route_ranking(ventas: DataFrame, rutas: DataFrame, geo: DataFrame) -> DataFrame:
    """Trips and revenue per pair of cities. Tickets are reduced to one row per
    route before the three joins."""
    per_route = ventas.groupBy("id_ruta").agg(F.count("*").alias("n"),
                                              F.sum("monto_pagado").alias("paid"))
    origin = geo.select(F.col("id_ciudad").alias("ciudad_origen_id"),
                        F.col("ciudad").alias("origen"))
    target = geo.select(F.col("id_ciudad").alias("ciudad_destino_id"),
                        F.col("ciudad").alias("destino"))
    ends = rutas.select("id_ruta", "ciudad_origen_id", "ciudad_destino_id")
    return (per_route.join(ends, "id_ruta").join(origin, "ciudad_origen_id")
            .join(target, "ciudad_destino_id")
            .groupBy("origen", "destino")
            .agg(F.sum("n").alias("total_viajes"), F.sum("paid").alias("ingresos")))


def top_routes(ranking: DataFrame, k: int = TOP_ROUTES) -> DataFrame:
    return ranking.orderBy(F.desc("total_viajes"), "origen", "destino").limit(k)


def company_share(ventas: DataFrame, empresas: DataFrame) -> DataFrame:
    """Tickets, revenue and market share per company name.

    The grand total is a one-row subquery: a window over all companies would
    pull them into a single task. It sums the same two columns as the ranking,
    so both read one shuffle of the per-company rows.
    """
    per_company = ventas.groupBy("id_empresa").agg(F.count("*").alias("n"),
                                                   F.sum("monto_pagado").alias("paid"))
    named = per_company.join(empresas.select("id_empresa", "nombre_empresa"), "id_empresa")
    ranking = named.groupBy("nombre_empresa").agg(F.sum("n").alias("total_pasajes"),
                                                  F.sum("paid").alias("ingresos"))
    total = scalar(named.agg(F.struct(F.sum("paid").alias("paid"), F.sum("n").alias("n"))))
    return ranking.withColumn("porcentaje", m.percentage(F.col("ingresos"), total["paid"]))


def top_company(share: DataFrame) -> DataFrame:
    return share.orderBy(F.desc("ingresos"), "nombre_empresa").limit(1)


# ---- the same pages over the operational tables ---------------------------------

def raw_sales(ventas: DataFrame) -> DataFrame:
    """Cells of raw tickets: channel, state, month, n, paid, n_paid.

    Tickets are grouped by the spellings that occur; each distinct spelling is normalised
    once, after that. Amounts below zero and dates that are none count as they stand."""
    cells = ventas.groupBy("canal_venta", "estado_pasaje", "fecha_viaje").agg(
        F.count("*").alias("n"), F.sum("monto_pagado").alias("paid"),
        F.count("monto_pagado").alias("n_paid"))
    return cells.select(
        t.capitalized("canal_venta").alias("canal_venta"),
        t.capitalized("estado_pasaje").alias("estado_pasaje"),
        cal.month_bucket(cal.parse_date("fecha_viaje")).alias("mes"), "n", "paid", "n_paid")


def raw_sales_totals(cells: DataFrame) -> DataFrame:
    lost = F.col("estado_pasaje") == m.CANCELLED
    return (cells.agg(F.coalesce(F.sum("paid"), F.lit(0)).alias("ingresos_totales"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("pasajes_vendidos"),
                      F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("cancelados"),
                      F.sum("n_paid").alias("__paid"))
            .withColumn("ticket_promedio", m.ratio(F.col("ingresos_totales"), F.col("__paid")))
            .drop("__paid"))


def raw_sales_by(cells: DataFrame, key: str) -> DataFrame:
    return cells.groupBy(key).agg(F.sum("n").alias("cantidad"), F.sum("paid").alias("ingresos"))


def raw_route_ranking(ventas: DataFrame, rutas: DataFrame, geo: DataFrame) -> DataFrame:
    """Ranking by the spellings of the city table, normalised once per pair of cities."""
    pairs = route_ranking(ventas, rutas, geo)
    return pairs.groupBy(t.title_case("origen").alias("origen"),
                         t.title_case("destino").alias("destino")).agg(
        F.sum("total_viajes").alias("total_viajes"), F.sum("ingresos").alias("ingresos"))


# ---- KPI page --------------------------------------------------------------

def top_occupancy(gold: Gold, k: int = TOP_ROWS) -> DataFrame:
    return (kpis.occupancy(gold.latest_year())
            .orderBy(F.desc("tasa_ocupacion_pct"), "origen", "destino", "num_mes",
                     "distancia_km", "tarifa_base", "tipo_corredor")
            .limit(k)
            .select("origen", "destino", "tasa_ocupacion_pct", "nivel_ocupacion", "ingresos_bs",
                    "distancia_km", "tarifa_base"))


def occupancy_alerts(top: DataFrame) -> DataFrame:
    """How many of the listed routes are crowded or empty."""
    level = F.col("nivel_ocupacion")
    return top.agg(F.count_if(level == "Alta").alias("rutas_alta"),
                   F.count_if(level == "Baja").alias("rutas_baja"))


def top_revenue_per_km(gold: Gold, k: int = TOP_ROWS) -> DataFrame:
    """Best routes of the latest year, labelled against the benchmark average of
    the listed rows. The two figures have different units, as in the report."""
    best = (kpis.revenue_per_km(gold.latest_year())
            .orderBy(F.desc("ingreso_por_pasajero_km"), "ciudad_origen", "ciudad_destino",
                     "trimestre", "distancia_km", "tipo_corredor")
            .limit(k))
    # At most k rows are left, so they fit one group.
    names = ["ciudad_origen", "ciudad_destino", "distancia_km", "ingreso_por_pasajero_km",
             "ingreso_total_bs", "total_pasajes", "tarifa_promedio_real",
             "tarifa_base_referencia", "diferencia_tarifa_bs", "cepal_vol_pasajeros_km_bolivia"]
    listed = best.agg(F.collect_list(F.struct(*names)).alias("filas"),
                      F.avg("cepal_vol_pasajeros_km_bolivia").alias("referencia"))
    return (listed.select(F.inline("filas"), "referencia")
            .withColumn("comparacion_cepal",
                        m.reference_label(F.col("ingreso_por_pasajero_km"), F.col("referencia")))
            .drop("referencia"))


def latest_season(gold: Gold) -> DataFrame:
    """Periods of the latest year in calendar order."""
    return (kpis.seasonal_index(gold.latest_year())
            .drop("promedio_mensual_anio", "mes_pico_pasajes", "mes_valle_pasajes")
            .orderBy("mes", "es_semana_santa", "es_feria_tarija", "es_fin_anio"))


def season_peak_valley(season: DataFrame) -> DataFrame:
    """Peak and valley period, their distance in %, and event periods. The
    first period in calendar order wins a tie."""
    index = F.col("indice_estacional")
    early = (-F.col("mes"), -F.col("es_semana_santa"), -F.col("es_feria_tarija"),
             -F.col("es_fin_anio"))
    found = season.agg(
        F.max_by("nombre_mes", F.struct(index, *early)).alias("pico_mes"),
        F.max(index).alias("pico_valor"),
        F.max_by("nombre_mes", F.struct(-index, *early)).alias("valle_mes"),
        F.min(index).alias("valle_valor"),
        F.count_if(F.col("es_semana_santa") == 1).alias("filas_semana_santa"),
        F.count_if(F.col("es_feria_tarija") == 1).alias("filas_feria"),
        F.count_if(F.col("es_fin_anio") == 1).alias("filas_fin_anio"))
    spread = m.percentage(F.col("pico_valor") - F.col("valle_valor"), F.col("valle_valor"))
    return found.withColumn("variacion_pct", m.half_up(spread, 4))


def _top_cancellation_rows(gold: Gold, k: int) -> DataFrame:
    # Ties are listed in calendar order.
    return (kpis.cancellations(gold.latest_year())
            .withColumn("num_mes", cal.month_number("nombre_mes"))
            .orderBy(F.desc("tasa_cancelacion_pct"), "nombre_empresa", "num_mes",
                     "tipo_empresa", "estado_empresa")
            .limit(k))


def top_cancellations(gold: Gold, k: int = TOP_ROWS) -> DataFrame:
    return _top_cancellation_rows(gold, k).drop("anio", "nombre_mes", "num_mes")


def risk_lists(gold: Gold, k: int = TOP_ROWS) -> DataFrame:
    """Names at high and medium risk among the listed rows, in listed order."""
    rows = _top_cancellation_rows(gold, k)

    def names(level: str) -> Column:
        key = F.struct((-F.col("tasa_cancelacion_pct")).alias("r"), F.col("nombre_empresa"),
                       F.col("num_mes"))
        found = F.collect_list(F.when(F.col("nivel_riesgo") == level, key))
        return F.array_join(F.transform(F.array_sort(found), lambda x: x.nombre_empresa), ", ")

    return rows.agg(names("Riesgo Alto").alias("riesgo_alto"),
                    names("Riesgo Medio").alias("riesgo_medio"))


def lost_revenue(gold: Gold, k: int = TOP_ROWS) -> DataFrame:
    """Lost revenue of the listed rows only."""
    return _top_cancellation_rows(gold, k).agg(
        F.sum("ingreso_perdido_bs").alias("total_perdido"))


def growth_history(gold: Gold) -> DataFrame:
    return kpis.yearly_growth(gold).orderBy("anio")


def growth_evaluation(growth: DataFrame) -> DataFrame:
    """Years with a growth figure, and whether they met the goal."""
    return (growth.filter(F.col("crecimiento_pct").isNotNull())
            .select("anio", "crecimiento_pct", "estado_okr",
                    (F.col("crecimiento_pct") >= m.GROWTH_GOAL_PCT).alias("cumple_objetivo")))


def tier_counts(gold: Gold) -> DataFrame:
    """Rows per tier of the four rated views."""
    rated = [("nivel_ocupacion", kpis.occupancy(gold)), ("tipo_periodo", kpis.seasonal_index(gold)),
             ("nivel_riesgo", kpis.cancellations(gold)), ("estado_okr", kpis.yearly_growth(gold))]
    return reduce(DataFrame.unionByName, [
        view.groupBy(F.col(c).alias("nivel")).agg(F.count("*").alias("filas"))
        .select(F.lit(c).alias("clasificacion"), "nivel", "filas") for c, view in rated])


def view_row_counts(gold: Gold) -> DataFrame:
    return row_counts({name: view(gold) for name, view in kpis.VIEWS.items()}, "vista")
