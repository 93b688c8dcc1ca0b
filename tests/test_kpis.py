import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from andenlake.operators import star
from andenlake.plans import kpis, reports, testbed
from andenlake.plans.kpis import Gold


@pytest.fixture(scope="module")
def live(spark, smoke):
    return testbed.live_gold(spark, smoke, "ruta empresa unidad", with_benchmark=True)


@pytest.fixture(scope="module")
def joined(live, spark, smoke):
    """The same star with a stored time dimension."""
    ventas = testbed.clean_table(spark, smoke, "ventas_pasajes")
    return Gold(live.fact_ventas, live.dim_ruta, live.dim_empresa, star.dim_tiempo(ventas))


@pytest.mark.parametrize("name", list(kpis.VIEWS))
def test_joined_and_derived_calendar_agree(live, joined, name):
    view = kpis.VIEWS[name]
    assert rows(view(live)) == rows(view(joined))


def test_latest_year_agrees(live, joined):
    assert rows(reports.latest_season(live)) == rows(reports.latest_season(joined))
    assert rows(reports.top_occupancy(live)) == rows(reports.top_occupancy(joined))


def test_sums_agree_across_views(live):
    total = kpis.executive_summary(live).first()
    months = kpis.seasonal_index(live).agg(F.sum("pasajes_mes"), F.sum("ingreso_mes")).first()
    years = kpis.yearly_growth(live).agg(F.sum("total_pasajes"), F.sum("ingreso_total_bs")).first()
    routes = kpis.occupancy(live).agg(F.sum("pasajes_vendidos"), F.sum("ingresos_bs")).first()
    assert tuple(months) == tuple(years) == tuple(routes) == (
        total.total_pasajes_vendidos, total.ingreso_total_bs)


def test_tiers_cover_all_rows(live):
    counted = {r.clasificacion: r.filas for r in reports.tier_counts(live).groupBy("clasificacion")
               .agg(F.sum("filas").alias("filas")).collect()}
    views = {r.vista: r.filas for r in reports.view_row_counts(live).collect()}
    assert counted == {"nivel_ocupacion": views["vw_kpi1_tasa_ocupacion"],
                       "tipo_periodo": views["vw_kpi3_demanda_estacional"],
                       "nivel_riesgo": views["vw_kpi4_cancelaciones_empresa"],
                       "estado_okr": views["vw_okr_crecimiento_ingresos"]}


def fact(spark, *records):
    base = {"sk_tiempo": 20220110, "sk_ruta": 1, "sk_empresa": 1, "monto_pagado": Decimal("10.00"),
            "tarifa_base": Decimal("12.00"), "capacidad_unidad": 2, "distancia_km": 10,
            "es_cancelado": 0, "cepal_volumen_pasajeros_km": Decimal("1.000")}
    data = [tuple({**base, **r}.values()) for r in records]
    return spark.createDataFrame(
        data, "sk_tiempo int, sk_ruta bigint, sk_empresa bigint, monto_pagado decimal(18,2), "
        "tarifa_base decimal(8,2), capacidad_unidad int, distancia_km int, es_cancelado int, "
        "cepal_volumen_pasajeros_km decimal(18,3)")


@pytest.fixture(scope="module")
def dims(spark):
    ruta = spark.createDataFrame(
        [(1, "A", "B", "x", 10, Decimal("12.00")), (2, "A", "B", "x", 10, Decimal("12.00")),
         (3, "A", "C", "x", 0, Decimal("5.00"))],
        "sk_ruta bigint, ciudad_origen string, ciudad_destino string, tipo_corredor string, "
        "distancia_km int, tarifa_base decimal(8,2)")
    empresa = spark.createDataFrame(
        [(1, "Uno", "Flota", "Activa"), (2, "Dos", "Flota", "Activa")],
        "sk_empresa bigint, nombre_empresa string, tipo_empresa string, estado_empresa string")
    return ruta, empresa


def test_routes_with_equal_attributes_share_a_group(spark, dims):
    gold = Gold(fact(spark, {}, {"sk_ruta": 2}, {"sk_ruta": 2, "es_cancelado": 1}), *dims)
    row = kpis.occupancy(gold).collect()
    assert len(row) == 1
    assert (row[0].pasajes_vendidos, row[0].asientos_ofertados, row[0].tasa_ocupacion_pct) == (
        2, 4, 50.0)
    assert (row[0].nivel_ocupacion, row[0].mes, row[0].temporada) == ("Media", "Enero", "Baja")


def test_no_seats_offered(spark, dims):
    gold = Gold(fact(spark, {"es_cancelado": 1}), *dims)
    row = kpis.occupancy(gold).first()
    assert (row.tasa_ocupacion_pct, row.nivel_ocupacion, row.asientos_ofertados) == (0.0, "Baja", 0)


def test_revenue_per_km(spark, dims):
    gold = Gold(fact(spark, {}, {"monto_pagado": Decimal("15.00")}, {"es_cancelado": 1},
                     {"sk_ruta": 3, "distancia_km": 0}), *dims)
    got = {r.ciudad_destino: r for r in kpis.revenue_per_km(gold).collect()}
    assert (got["B"].total_pasajes, got["B"].pasajeros_km_terminal) == (2, 20)
    assert got["B"].ingreso_por_pasajero_km == 1.25
    assert got["B"].tarifa_promedio_real == 12.5 and got["B"].diferencia_tarifa_bs == 0.5
    assert got["B"].cepal_vol_pasajeros_km_bolivia == 1.0
    assert got["C"].ingreso_por_pasajero_km == 0.0


def growth(spark, *amounts):
    return kpis.growth_from_years(spark.createDataFrame(
        [(2018 + i, 1, None if a is None else Decimal(a), 0) for i, a in enumerate(amounts)],
        "anio int, total_pasajes bigint, ingreso_total_bs decimal(18,2), total_cancelados bigint"))


def test_growth_states(spark):
    got = growth(spark, "100", "115", "115", "114", "131.10", "0", "5").orderBy("anio").collect()
    assert [r.crecimiento_pct for r in got] == [None, 15.0, 0.0, -0.87, 15.0, -100.0, None]
    assert [r.estado_okr for r in got] == [
        None, "OKR Cumplido ✓", "OKR En progreso", "OKR No cumplido ✗", "OKR Cumplido ✓",
        "OKR No cumplido ✗", "OKR No cumplido ✗"]
    evaluated = reports.growth_evaluation(growth(spark, "100", "115", "114"))
    assert rows(evaluated.select("anio", "cumple_objetivo")) == [(2019, True), (2020, False)]


def test_seasonal_index_splits_months_by_holiday(spark, dims):
    gold = Gold(fact(spark, {"sk_tiempo": 20220402}, {"sk_tiempo": 20220420},
                     {"sk_tiempo": 20220421}, {"sk_tiempo": 20220601}), *dims)
    assert kpis.seasonal_index(gold).count() == 3
    by_month = {r.mes: r for r in kpis.seasonal_index(gold, by_month=True).collect()}
    assert by_month[4].indice_estacional == 150.0 and by_month[4].tipo_periodo == "Pico alto"
    assert by_month[6].indice_estacional == 50.0 and by_month[6].tipo_periodo == "Valle"
    assert by_month[4].brecha_pico_valle == 2


def test_peak_and_valley_ties_go_to_the_first_month(spark, dims):
    gold = Gold(fact(spark, {"sk_tiempo": 20220301}, {"sk_tiempo": 20220501}), *dims)
    got = reports.season_peak_valley(reports.latest_season(gold)).first()
    assert (got.pico_mes, got.valle_mes, got.variacion_pct) == ("Marzo", "Marzo", 0.0)


def test_risk_lists_and_lost_revenue_of_listed_rows(spark, dims):
    lost = {"es_cancelado": 1}
    gold = Gold(fact(
        spark, {**lost}, {"sk_empresa": 2, **lost}, {"sk_empresa": 2, "sk_tiempo": 20220201},
        *[{"sk_empresa": 1, "sk_tiempo": 20220301}] * 6,
        {"sk_empresa": 1, "sk_tiempo": 20220301, **lost},
        {"sk_tiempo": 20210301, **lost}), *dims)  # an older year is not listed
    got = reports.risk_lists(gold).first()
    assert (got.riesgo_alto, got.riesgo_medio) == ("Dos, Uno", "Uno")
    assert reports.lost_revenue(gold).first().total_perdido == Decimal("36.00")
    assert reports.lost_revenue(gold, 1).first().total_perdido == Decimal("12.00")


def test_inner_join_drops_tickets_outside_the_time_dimension(spark, dims):
    tiempo = spark.createDataFrame([(20220110, dt.date(2022, 1, 10), 2022, 1, 1)],
                                   "sk_tiempo int, fecha date, anio int, trimestre int, mes int")
    gold = Gold(fact(spark, {}, {"sk_tiempo": 20250101}), *dims, tiempo)
    assert kpis.executive_summary(gold).first().total_pasajes_vendidos == 1
    assert gold.latest_year().fact_ventas.count() == 1


def test_one_company_holding_most_tickets(spark, dims):
    hot = spark.range(60000).select(F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("e"))
    tickets = fact(spark, {}).crossJoin(hot).withColumn("sk_empresa", F.col("e").cast("bigint"))
    got = {r.nombre_empresa: r.total_pasajes
           for r in kpis.cancellations(Gold(tickets, *dims)).collect()}
    assert got == {"Uno": 54000, "Dos": 6000}


def test_sales_filters(spark):
    ventas = spark.createDataFrame(
        [("2022-01-31", Decimal("5.00"), "Web", "Viajado"),
         ("2022-02-01", Decimal("7.00"), "Agente", "Cancelado"), ("2022-02-01", None, "Web", "X")],
        "fecha_viaje string, monto_pagado decimal(18,2), canal_venta string, estado_pasaje string")
    everything = reports.sales_totals(reports.sales_filtered(ventas)).first()
    assert tuple(everything) == (Decimal("12.00"), 3, 1, 6.0)
    web = reports.sales_filtered(ventas, ["Web"], ["Viajado", "Cancelado"])
    assert rows(reports.sales_by_month(web)) == [("2022-01", Decimal("5.00"))]
    nothing = reports.sales_totals(reports.sales_filtered(ventas, [])).first()
    assert (nothing.ingresos_totales, nothing.pasajes_vendidos, nothing.ticket_promedio) == (
        0, 0, None)


def test_rankings_break_ties_by_name(spark):
    ranking = spark.createDataFrame([("B", "C", 5), ("A", "D", 5), ("A", "C", 5), ("Z", "Z", 9)],
                                    "origen string, destino string, total_viajes bigint")
    top = [tuple(r) for r in reports.top_routes(ranking, 3).collect()]
    assert top == [("Z", "Z", 9), ("A", "C", 5), ("A", "D", 5)]
