"""The six business views over the star schema.

All measures are additive, so the views roll up from cells: one row for each route and
period with counts and sums, and one for each company and month. Grouped by both, with the
day, nearly every ticket would keep a row of its own. A stored star holds the cells as two
tables of their own, written once from the fact; the views then never read a ticket. Without
them a view reduces the fact to its own groups first, where a hot route or company collapses
map-side. Either way dimensions are joined to groups and never to the fact.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from andenlake.functions import calendar as cal
from andenlake.functions import measures as m
from andenlake.operators.joins import scalar


@dataclass(frozen=True)
class Gold:
    """The star. Without ``dim_tiempo`` the period columns are computed from the
    time key, which spells the date; with it they come from an inner join. ``cells``
    are the additive measures by route and period, ``company_cells`` those by company and
    month; ``years`` the years of cells and fact, where a stored star is partitioned by
    them. What is grouped by cells that are not there is grouped by the fact."""

    fact_ventas: DataFrame
    dim_ruta: DataFrame | None = None
    dim_empresa: DataFrame | None = None
    dim_tiempo: DataFrame | None = None
    cells: DataFrame | None = None
    company_cells: DataFrame | None = None
    years: tuple[int, ...] | None = None

    def timed(self, *columns: str) -> DataFrame:
        """The fact with the named calendar columns."""
        if self.dim_tiempo is None:
            return self.fact_ventas.withColumns(cal.key_attributes("sk_tiempo", columns))
        # A table written by year already carries that column.
        return self.fact_ventas.drop(*columns).join(
            self.dim_tiempo.select("sk_tiempo", *columns), "sk_tiempo")

    def latest_year(self) -> Gold:
        """Only the tickets of the last year present. In a stored star that is the last
        partition; else a scalar subquery over the key column, which prunes before any
        aggregation."""
        if self.years is not None:
            last = F.lit(max(self.years, default=None)).cast("int")
        elif self.dim_tiempo is None:
            last = scalar(self.fact_ventas.agg(cal.key_year(F.max("sk_tiempo"))))
        else:
            used = self.fact_ventas.select("sk_tiempo").distinct()
            last = scalar(used.join(self.dim_tiempo, "sk_tiempo").agg(F.max("anio")))

        def in_year(rows: DataFrame) -> DataFrame:
            if "anio" in rows.columns:
                return rows.filter(F.col("anio") == last)
            return rows.filter(F.col("sk_tiempo").between(last * 10000, last * 10000 + 9999))

        return replace(self, fact_ventas=in_year(self.fact_ventas), **{
            name: None if rows is None else in_year(rows)
            for name, rows in (("cells", self.cells), ("company_cells", self.company_cells))})


def _measure(name: str) -> Column:
    sold, lost = F.col("es_cancelado") == 0, F.col("es_cancelado") == 1
    if name == "n":
        return F.count("*")
    if name == "n_sold":
        return F.count_if(sold)
    if name == "n_lost":
        return F.count_if(lost)
    if name == "paid":
        return m.sum_when(sold, F.col("monto_pagado"))
    if name == "seats":
        return m.sum_when(sold, F.col("capacidad_unidad").cast("bigint"))
    if name == "km":
        return m.sum_when(sold, F.col("distancia_km").cast("bigint"))
    if name == "lost_fare":
        return m.sum_when(lost, F.col("tarifa_base"))
    if name == "list_fare":
        return F.sum("tarifa_base")
    return F.sum("cepal_volumen_pasajeros_km")  # "volume"


MEASURES = "n n_sold n_lost paid seats km lost_fare list_fare volume"
COMPANY_MEASURES = "n n_lost n_sold lost_fare paid"

# The columns of the time dimension that routes are grouped by, and companies.
PERIOD = ["anio", "trimestre", "mes", "es_semana_santa", "es_feria_tarija", "es_fin_anio"]
MONTH = ["anio", "mes"]


def cells(fact: DataFrame, tiempo: DataFrame) -> DataFrame:
    """All measures by route and period, for the days of the time dimension, and the last day.
    Their number does not grow with the tickets, which combine before the shuffle."""
    days = fact.drop("anio").join(tiempo.select("sk_tiempo", "fecha", *PERIOD), "sk_tiempo")
    return days.groupBy("sk_ruta", *PERIOD).agg(
        *[_measure(n).alias(n) for n in MEASURES.split()], F.max("fecha").alias("fecha"))


def company_cells(fact: DataFrame, tiempo: DataFrame) -> DataFrame:
    """The measures of companies by company and month, for the days of the time dimension."""
    days = fact.drop("anio").join(tiempo.select("sk_tiempo", *MONTH), "sk_tiempo")
    return days.groupBy("sk_empresa", *MONTH).agg(
        *[_measure(n).alias(n) for n in COMPANY_MEASURES.split()])


def _cells(gold: Gold, times: list[str], keys: list[str], measures: str) -> DataFrame:
    """Additive measures per key, the first and only pass over cells or fact. A sum of sums
    has the type of the sum, so both ways give the same columns."""
    rows, names = gold.company_cells if "sk_empresa" in keys else gold.cells, measures.split()
    if rows is None:
        return gold.timed(*times).groupBy(*keys).agg(*[_measure(n).alias(n) for n in names])
    return rows.groupBy(*keys).agg(*[F.sum(n).cast(rows.schema[n].dataType).alias(n)
                                     for n in names])


def _sum(name: str, out: str | None = None) -> Column:
    return F.sum(name).alias(out or name)


def occupancy(gold: Gold) -> DataFrame:
    """KPI 1: tickets sold against seats offered, per route and month.

    Seats are counted once per ticket, as the view is defined; the rate is
    therefore about 100 / seats per bus and not a load factor.
    """
    cells = _cells(gold, ["anio", "mes"], ["sk_ruta", "anio", "mes"], "n_sold seats paid")
    route = gold.dim_ruta.select(
        "sk_ruta", F.col("ciudad_origen").alias("origen"), F.col("ciudad_destino").alias("destino"),
        "tipo_corredor", "distancia_km", "tarifa_base")
    groups = (cells.join(route, "sk_ruta")
              .groupBy("origen", "destino", "tipo_corredor", "anio", "mes",
                       "distancia_km", "tarifa_base")
              .agg(_sum("n_sold", "pasajes_vendidos"), _sum("seats", "asientos_ofertados"),
                   _sum("paid", "ingresos_bs")))
    seats = F.col("asientos_ofertados")
    rate = m.half_up(m.percentage(F.col("pasajes_vendidos"), seats), 2)
    return groups.select(
        "origen", "destino", "tipo_corredor", "anio", cal.month_name("mes").alias("mes"),
        F.col("mes").alias("num_mes"), cal.season("mes").alias("temporada"),
        "pasajes_vendidos", "asientos_ofertados",
        m.zero_safe(seats, rate).alias("tasa_ocupacion_pct"),
        m.occupancy_tier(rate).alias("nivel_ocupacion"),
        "ingresos_bs", "distancia_km", "tarifa_base")


def revenue_per_km(gold: Gold) -> DataFrame:
    """KPI 2: revenue per passenger-kilometre, per route and quarter."""
    cells = _cells(gold, ["anio", "trimestre"], ["sk_ruta", "anio", "trimestre"],
                   "n n_sold paid km volume list_fare")
    route = gold.dim_ruta.select("sk_ruta", "ciudad_origen", "ciudad_destino", "tipo_corredor",
                                 "distancia_km")
    groups = (cells.join(route, "sk_ruta")
              .groupBy("ciudad_origen", "ciudad_destino", "tipo_corredor", "distancia_km",
                       "anio", "trimestre")
              .agg(*[_sum(c) for c in ("n", "n_sold", "paid", "km", "volume", "list_fare")]))
    km = F.col("km")
    real, listed = m.ratio(F.col("paid"), F.col("n_sold")), m.ratio(F.col("list_fare"), F.col("n"))
    return groups.select(
        "ciudad_origen", "ciudad_destino", "tipo_corredor", "distancia_km", "anio", "trimestre",
        F.col("n_sold").alias("total_pasajes"),
        F.col("paid").alias("ingreso_total_bs"),
        km.alias("pasajeros_km_terminal"),
        m.zero_safe(km, m.half_up(m.ratio(F.col("paid"), km), 4)).alias("ingreso_por_pasajero_km"),
        m.ratio(F.col("volume"), F.col("n")).alias("cepal_vol_pasajeros_km_bolivia"),
        real.alias("tarifa_promedio_real"),
        listed.alias("tarifa_base_referencia"),
        m.half_up(real - listed, 2).alias("diferencia_tarifa_bs"))


def seasonal_index(gold: Gold, by_month: bool = False) -> DataFrame:
    """KPI 3: demand of a period against the average period of its year.

    The view splits months by holiday flags, so its average is over 15 to 17
    periods a year. ``by_month=True`` gives plain calendar months instead.
    """
    flags = [] if by_month else ["es_semana_santa", "es_feria_tarija", "es_fin_anio"]
    keys = ["anio", "mes", *flags]
    periods = _cells(gold, keys, keys, "n_sold n_lost paid")
    year = Window.partitionBy("anio")  # at most a few dozen rows a year
    tickets = F.col("n_sold")
    rated = periods.withColumns({
        "promedio_mensual_anio": m.ratio(F.sum(tickets).over(year), F.count("*").over(year)),
        "mes_pico_pasajes": F.max(tickets).over(year),
        "mes_valle_pasajes": F.min(tickets).over(year),
    })
    average = F.col("promedio_mensual_anio")
    index = m.percentage(tickets, average)
    return rated.select(
        "anio", "mes", cal.month_name("mes").alias("nombre_mes"),
        cal.season("mes").alias("temporada"), *flags,
        tickets.alias("pasajes_mes"), F.col("paid").alias("ingreso_mes"),
        F.col("n_lost").alias("cancelaciones_mes"),
        average, "mes_pico_pasajes", "mes_valle_pasajes",
        m.zero_safe(average, m.half_up(index, 1)).alias("indice_estacional"),
        m.season_tier(index).alias("tipo_periodo"),
        (F.col("mes_pico_pasajes") - F.col("mes_valle_pasajes")).alias("brecha_pico_valle"))


def cancellations(gold: Gold) -> DataFrame:
    """KPI 4: cancelled tickets and lost revenue, per company and month."""
    cells = _cells(gold, ["anio", "mes"], ["sk_empresa", "anio", "mes"],
                   "n n_lost n_sold lost_fare paid")
    company = gold.dim_empresa.select("sk_empresa", "nombre_empresa", "tipo_empresa",
                                      "estado_empresa")
    groups = (cells.join(company, "sk_empresa")
              .groupBy("nombre_empresa", "tipo_empresa", "estado_empresa", "anio", "mes")
              .agg(*[_sum(c) for c in ("n", "n_lost", "n_sold", "lost_fare", "paid")]))
    rate = m.half_up(m.percentage(F.col("n_lost"), F.col("n")), 2)
    return groups.select(
        "nombre_empresa", "tipo_empresa", "estado_empresa", "anio",
        cal.month_name("mes").alias("nombre_mes"),
        F.col("n").alias("total_pasajes"), F.col("n_lost").alias("total_cancelados"),
        F.col("n_sold").alias("total_efectivos"),
        rate.alias("tasa_cancelacion_pct"),
        F.col("lost_fare").alias("ingreso_perdido_bs"),
        F.col("paid").alias("ingreso_efectivo_bs"),
        m.risk_tier(rate).alias("nivel_riesgo"))


def growth_from_years(years: DataFrame) -> DataFrame:
    """Growth against the year before, and its state against the goal."""
    # One row per year: the unpartitioned window holds a handful of rows.
    previous = F.lag("ingreso_total_bs").over(Window.orderBy("anio"))
    rated = years.withColumn("ingreso_anio_anterior", previous)
    before = F.col("ingreso_anio_anterior")
    growth = m.half_up(m.percentage(F.col("ingreso_total_bs") - before, before), 2)
    return rated.select("anio", "total_pasajes", "ingreso_total_bs", "total_cancelados", before,
                        growth.alias("crecimiento_pct"),
                        m.growth_tier(growth, before).alias("estado_okr"))


def yearly_growth(gold: Gold) -> DataFrame:
    """OKR: revenue growth per year against the 15 % goal."""
    years = _cells(gold, ["anio"], ["anio"], "n_sold n_lost paid").select(
        "anio", F.col("n_sold").alias("total_pasajes"),
        F.col("paid").alias("ingreso_total_bs"), F.col("n_lost").alias("total_cancelados"))
    return growth_from_years(years)


def _used_keys(gold: Gold) -> DataFrame:
    """kind, key, n, n_sold, paid, fecha: a row or more for each route and company in use; the
    amounts and the day go with the route."""
    names = ["n", "n_sold", "paid", "fecha"]
    if gold.cells is not None and gold.company_cells is not None:
        routes = gold.cells.select(F.lit("ruta").alias("kind"), F.col("sk_ruta").alias("key"), *names)
        return routes.unionByName(gold.company_cells.select(
            F.lit("empresa").alias("kind"), F.col("sk_empresa").alias("key")),
            allowMissingColumns=True)
    sold = F.col("es_cancelado") == 0
    rows = gold.timed("fecha").withColumns({
        "n": F.lit(1).cast("long"), "n_sold": sold.cast("long"),
        "paid": F.when(sold, F.col("monto_pagado")).otherwise(0)})

    def part(label: str, key: str, used: bool) -> Column:
        amounts = [F.when(F.lit(used), F.col(c)).alias(c) for c in names]
        return F.struct(F.lit(label).alias("kind"), F.col(key).alias("key"), *amounts)

    both = F.array(part("ruta", "sk_ruta", True), part("empresa", "sk_empresa", False))
    return rows.select(F.explode(both).alias("p")).select("p.*")


def executive_summary(gold: Gold) -> DataFrame:
    """One row of global figures.

    Each row is counted for its route and for its company, in groups that combine before the
    shuffle. Counting two columns distinct would send every row on once for each of them, and
    grouping by both would keep nearly every row."""
    kind = _cells(gold, ["fecha"], [], "paid").schema["paid"].dataType
    used = _used_keys(gold).groupBy("kind", "key").agg(
        _sum("n"), _sum("n_sold"), _sum("paid"), F.max("fecha").alias("fecha"))

    def keys(label: str) -> Column:
        return F.count_if((F.col("kind") == label) & F.col("key").isNotNull())

    counted = used.agg(
        _sum("n"), F.coalesce(F.sum("n_sold"), F.lit(0)).alias("total_pasajes_vendidos"),
        F.sum("paid").cast(kind).alias("ingreso_total_bs"),
        keys("ruta").alias("rutas_activas"), keys("empresa").alias("empresas_activas"),
        F.max("fecha").alias("ultimo_registro"))
    tickets, paid = F.col("total_pasajes_vendidos"), F.col("ingreso_total_bs")
    return counted.select(
        tickets, paid,
        m.half_up(m.percentage(F.col("n") - tickets, F.col("n")), 2)
        .alias("tasa_cancelacion_global_pct"),
        m.half_up(m.ratio(paid, tickets), 2).alias("ticket_promedio_bs"),
        "rutas_activas", "empresas_activas", "ultimo_registro")


VIEWS = {
    "vw_kpi1_tasa_ocupacion": occupancy,
    "vw_kpi2_ingreso_por_km": revenue_per_km,
    "vw_kpi3_demanda_estacional": seasonal_index,
    "vw_kpi4_cancelaciones_empresa": cancellations,
    "vw_okr_crecimiento_ingresos": yearly_growth,
    "vw_resumen_ejecutivo": executive_summary,
}


def register_views(gold: Gold) -> None:
    """Make the views available to ``spark.sql``."""
    for name, view in VIEWS.items():
        view(gold).createOrReplaceTempView(name)
