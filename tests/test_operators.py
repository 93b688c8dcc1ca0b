import datetime as dt
import statistics
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from andenlake import schemas
from andenlake.operators import cleaning, enrich, joins, profiling, quality, star
from andenlake.operators.numbering import dense_numbers, sparse_numbers
from andenlake.operators.order_statistics import exact_median


def frame(spark, table, *records):
    """Raw rows of a source table; fields not given are null."""
    schema = schemas.BRONZE[table]
    return spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in records], schema)


# ---- numbering and joins ---------------------------------------------------

def test_dense_numbers_equal_global_row_number(spark):
    """A third of the rows share the leading key; nulls come first."""
    df = (spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None)
        .otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("u"))
        .repartition(7))
    got = dense_numbers(df, "n", ["k", "u"])
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k", "u")))
    assert got.columns == ["n", "k", "u"]
    assert rows(got.select("k", "u", "n")) == rows(want.select("k", "u", "n"))


def test_dense_numbers_use_many_partitions(spark):
    got = dense_numbers(spark.range(0, 1_000_000, 1, 8).toDF("k"), "n", ["k"])
    assert got.filter(F.col("n") != F.col("k") + 1).count() == 0


def test_dense_numbers_of_nothing(spark):
    assert dense_numbers(spark.range(0).toDF("k"), "n", ["k"]).count() == 0


def test_sparse_numbers(spark):
    df = spark.createDataFrame([(5, "a"), (9, "b")], "id bigint, x string")
    assert rows(sparse_numbers(df, "n", ["id"])) == [(1, 5, "a"), (5, 9, "b")]


def test_lookup_takes_last_duplicate_and_never_multiplies(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(10, 1, "a"), (11, 1, "b"), (12, 3, "c"), (13, None, "d")],
                                "sk int, id int, name string")
    got = joins.lookup(facts, dim, "k", "id", "sk", {"name": "label"})
    assert rows(got) == [(1, 11, "b"), (1, 11, "b"), (2, None, None), (None, None, None)]


def test_no_job_runs_while_the_benchmark_join_is_planned(spark):
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    ventas = spark.createDataFrame([(1, 2020), (2, 2021)], "id_venta long, anio_venta int")
    series = spark.createDataFrame([("BOL", 2020, "aereo", 7.0, "km"), ("ARG", 2020, "x", 1.0, "km")],
                                   "iso3 string, anio int, modo_transporte string, valor double,"
                                   " unidad string")
    before = jobs()
    joined = enrich.join_benchmark(ventas, series)
    assert jobs() == before
    assert {(r.id_venta, r.cepal_volumen_pasajeros_km) for r in joined.collect()} == {
        (1, 7.0), (2, None)}


# ---- cleaning ----------------------------------------------------------------

def test_clean_geografia(spark):
    raw = frame(spark, "geografia", {"id_ciudad": 1, "ciudad": " santa cruz de la sierra ",
                                     "departamento": "SANTA CRUZ"})
    got = cleaning.clean_geografia(raw).first()
    assert (got.ciudad, got.departamento, got.latitud, got.longitud) == (
        "Santa Cruz De La Sierra", "Santa Cruz", 0.0, 0.0)


def test_clean_empresas_imputes_exact_median(spark):
    raw = frame(spark, "empresas",
                {"id_empresa": 1, "capacidad_flota_total": 10.0, "telefono": "046 643 210"},
                {"id_empresa": 2, "capacidad_flota_total": 25.0, "fecha_registro": "2010-03-15"},
                {"id_empresa": 3, "estado": "SUSPENDIDA ", "fecha_registro": "ayer"},
                {"id_empresa": 4, "capacidad_flota_total": 90.0},
                {"id_empresa": 5, "capacidad_flota_total": 30.0, "nombre_empresa": "flota SCZ"})
    got = {r.id_empresa: r for r in cleaning.clean_empresas(raw).collect()}
    assert got[3].capacidad_flota_total == 27.5
    assert got[1].telefono == "046643210" and got[2].telefono == ""
    assert got[2].fecha_registro == dt.date(2010, 3, 15) and got[3].fecha_registro is None
    assert got[3].estado == "Suspendida" and got[5].nombre_empresa == "Flota Scz"


def test_clean_rutas_drops_non_positive(spark):
    good = {"distancia_km": 1, "duracion_horas": Decimal(1), "tarifa_base": Decimal(1)}
    raw = frame(spark, "rutas", {"id_ruta": 1, **good}, {"id_ruta": 2, **good, "distancia_km": 0},
                {"id_ruta": 3, **good, "duracion_horas": Decimal(-1)},
                {"id_ruta": 4, **good, "tarifa_base": None})
    assert [r.id_ruta for r in cleaning.clean_rutas(raw).collect()] == [1]


def test_clean_pasajeros(spark):
    raw = frame(spark, "pasajeros", {"id_pasajero": 1, "nombre": " ana maría", "apellido": "O'NEIL",
                                     "email": " A@B.Com ", "nacionalidad": "BOLIVIANA",
                                     "fecha_nacimiento": "1990-02-30"},
                {"id_pasajero": 2, "telefono": "7"})
    got = {r.id_pasajero: r for r in cleaning.clean_pasajeros(raw).collect()}
    assert (got[1].nombre, got[1].apellido, got[1].email, got[1].nacionalidad) == (
        "Ana María", "O'Neil", "a@b.com", "Boliviana")
    assert got[1].fecha_nacimiento is None and got[1].telefono == "" and got[2].email == ""


def test_clean_unidades_keeps_closed_year_range(spark):
    raw = frame(spark, "unidades_flota", *[
        {"id_unidad": y, "anio_fabricacion": y, "placa": " tar-1", "tipo_servicio": "semi-cama"}
        for y in (1989, 1990, 2025, 2026)], {"id_unidad": 1})
    got = cleaning.clean_unidades(raw).collect()
    assert sorted(r.id_unidad for r in got) == [1990, 2025]
    assert {r.placa for r in got} == {"TAR-1"} and {r.tipo_servicio for r in got} == {"Semi-Cama"}


def ticket(i, **changes):
    base = {"id_venta": i, "id_ruta": 1, "id_empresa": 1, "id_pasajero": 1, "id_itinerario": 1,
            "fecha_venta": "2021-03-01", "fecha_viaje": "2021-03-05", "numero_asiento": 4,
            "monto_pagado": Decimal("50.0000"), "canal_venta": "Web", "estado_pasaje": "Viajado",
            "descuento_aplicado": Decimal("10.00")}
    return {**base, **changes}


def test_clean_ventas(spark):
    raw = frame(spark, "ventas_pasajes",
                ticket(1, nombre_pasajero_registrado="  ana \t maría ", canal_venta=" WEB ",
                       monto_pagado=Decimal("10.0050")),
                ticket(2, fecha_venta="x"), ticket(3, fecha_viaje=None),
                ticket(4, monto_pagado=Decimal(0)), ticket(5, monto_pagado=None),
                ticket(6, descuento_aplicado=Decimal(101), estado_pasaje="cancelado"),
                ticket(7, descuento_aplicado=None))
    got = {r.id_venta: r for r in cleaning.clean_ventas(raw).collect()}
    assert sorted(got) == [1, 6, 7]
    assert got[1].nombre_pasajero_registrado == "ANA MARÍA" and got[1].canal_venta == "Web"
    assert got[1].monto_pagado == Decimal("10.01") and got[1].observaciones == "Sin observaciones"
    assert got[6].descuento_aplicado == 0 and got[7].descuento_aplicado == 0
    assert got[6].nombre_pasajero_registrado == "SIN REGISTRO"
    assert (got[1].anio_venta, got[1].mes_venta, got[6].estado_pasaje) == (2021, 3, "Cancelado")


def series(year, value="10", iso3="BOL", mode="transporte aereo"):
    return {"anio": year, "valor": value, "iso3": iso3, "modo_transporte": mode,
            "pais_nombre": "bolivia (estado plurinacional de)", "unidad": "km"}


def test_clean_benchmark(spark):
    raw = frame(spark, "cepal_transporte_pasajeros", series("2021"), series("2020", "n/d"),
                series("dos mil"))
    got = {r.anio: r for r in cleaning.clean_benchmark(raw).collect()}
    assert set(got) == {2021, None} and got[2021].valor == 10.0
    assert got[2021].pais_nombre == "Bolivia (Estado Plurinacional De)"


def test_integrate_and_match_rate(spark):
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", ticket(1), ticket(2),
                                         ticket(3, fecha_venta="2019-01-01")))
    bench = cleaning.clean_benchmark(frame(spark, "cepal_transporte_pasajeros", series("2021"),
                                           series("2019", iso3="CHL")))
    got = {r.id_venta: r for r in enrich.integrate(ventas, bench).collect()}
    assert got[1].cepal_volumen_pasajeros_km == 10.0 and got[1].cepal_unidad == "km"
    assert got[3].cepal_volumen_pasajeros_km == 0.0
    assert got[3].cepal_modo_transporte == "Sin dato"
    assert got[3].cepal_unidad == "Sin dato CEPALSTAT"
    rate = enrich.match_rate(ventas, bench).first()
    assert (rate.con_match, rate.sin_match, rate.total) == (2, 1, 3)
    assert abs(rate.pct_match - 66.6666666) < 1e-5


# ---- quality -----------------------------------------------------------------

def test_there_are_37_reference_checks(spark):
    row_level = sum(len(r) for r in quality.row_rules().values())
    cardinality = 1  # tickets kept by the benchmark join
    assert row_level + len(quality.KEPT_SHARE) + cardinality == 37


def test_two_modes_in_a_year_are_caught(spark):
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", ticket(1)))
    bench = cleaning.clean_benchmark(frame(spark, "cepal_transporte_pasajeros", series("2021"),
                                           series("2021", mode="vial")))
    watch = quality.Watch()
    for name in quality.row_rules():  # tables without a part in this
        if name not in ("ventas_pasajes", quality.INTEGRATED):
            watch.clean(name, watch.raw(name, spark.createDataFrame(
                [], schemas.BRONZE[name]))).count()
    ventas = watch.clean("ventas_pasajes", watch.raw("ventas_pasajes", ventas))
    watch.clean(quality.INTEGRATED, enrich.integrate(ventas, bench)).write.format(
        "noop").mode("overwrite").save()
    report = quality.silver_report(watch, bench)
    assert watch.count("clean", "ventas_pasajes") == 1
    failed = {r.regla for r in report.collect() if not r.ok}
    assert failed == {"registros conservados", "anio unico"}
    with pytest.raises(quality.QualityError, match="anio unico"):
        quality.enforce(report)


def test_null_counts_as_violation(spark):
    df = spark.createDataFrame([(1.0, "Web"), (None, None), (-1.0, "x")], "a double, c string")
    rules = {**quality.positive("a"), **quality.in_domain("c", ["Web"]), **quality.not_null("a"),
             **quality.in_range("a", 0, 5)}
    got = {r.regla: (r.violaciones, r.total, r.ok)
           for r in quality.check_rows(df, "t", rules).collect()}
    assert got == {"a positivo": (2, 3, False), "c en dominio": (2, 3, False),
                   "a no nulo": (1, 3, False), "a en rango": (2, 3, False)}


def test_retention_threshold(spark):
    for kept, ok in ((10, True), (9, True), (8, False)):
        watch = quality.Watch()
        df = watch.raw("rutas", spark.range(10).selectExpr(
            "id as id_ruta", "1 as distancia_km", "1 as tarifa_base"))
        watch.clean("rutas", df.filter(F.col("id_ruta") < kept)).write.format("noop").mode(
            "overwrite").save()
        line = watch.kept_line("rutas", quality.KEPT_SHARE["rutas"])
        assert line == ("rutas", "registros conservados", 10 - kept, 10, ok)
        assert watch.kept_line("rutas", 1.0)[4] == (kept == 10)
        assert not watch.kept_line("rutas", 1.0, before=kept - 1)[4]
        assert watch.row_lines("rutas") == [
            ("rutas", rule, 0, kept, True) for rule in
            ("id_ruta no nulo", "distancia_km positivo", "tarifa_base positivo")]


def test_unique_counts_extra_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    assert quality.check_unique(df, "t", "k").first()[2:] == (3, 5, False)


def test_foreign_keys_on_a_hot_key(spark):
    fact = spark.range(9000).select(
        *[F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 10).alias(k)
          for k in schemas.FOREIGN_KEYS])
    tables = {"fact_ventas": fact}
    for key, dim in schemas.FOREIGN_KEYS.items():
        tables[dim] = spark.range(0 if key != "sk_canal" else 1, 10).select(F.col("id").alias(key))
    got = {r.regla: r.violaciones for r in quality.foreign_key_report(tables).collect()}
    assert got.pop("sk_canal existe") == 600
    assert set(got.values()) == {0} and len(got) == 5


# ---- profiling -----------------------------------------------------------------

def test_profile_table(spark):
    df = spark.createDataFrame(
        [(1, "Semi-cama", 1.5), (2, " Cama", None), (3, None, 2.5), (4, "CAMA", 3.0)],
        "id bigint, t string, v double")
    got = {r.columna: r for r in profiling.profile_table(df, "x").collect()}
    assert (got["id"].filas, got["id"].columnas, got["id"].tipo) == (4, 3, "bigint")
    assert (got["id"].minimo, got["id"].maximo, got["id"].media) == (1.0, 4.0, 2.5)
    assert (got["t"].nulos, got["t"].pct_nulos) == (1, 25.0)
    assert (got["t"].espacios_extra, got["t"].mayusculas_mixtas) == (1, 1)
    assert got["v"].media == 2.33 and got["v"].espacios_extra is None


def test_sales_detail_counts_a_name_twice(spark):
    raw = frame(spark, "ventas_pasajes", ticket(1, nombre_pasajero_registrado="Ana  Paz"),
                ticket(2, nombre_pasajero_registrado="ANA"), ticket(3))
    got = profiling.sales_detail(raw).first()
    assert (got.nombre_nulo, got.nombre_doble_espacio, got.nombre_mayusculas_mixtas) == (1, 1, 1)
    assert (got.total_sucios, got.pct_sucios) == (3, 100.0)
    assert (got.monto_minimo, got.monto_maximo, got.montos_no_positivos) == (50.0, 50.0, 0)


def test_frequencies_keep_nulls_in_the_denominator(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert rows(profiling.frequencies(df, ["c", "missing"])) == [
        ("c", "a", 2, 50.0), ("c", "b", 1, 25.0)]


# ---- star --------------------------------------------------------------------------

@pytest.fixture()
def small_star(spark):
    geo = cleaning.clean_geografia(frame(spark, "geografia", {"id_ciudad": 1, "ciudad": "tarija",
                                                              "departamento": "tarija"}))
    route = {"duracion_horas": Decimal(1), "tipo_corredor": "fronterizo", "activa": True}
    rutas = cleaning.clean_rutas(frame(
        spark, "rutas",
        {"id_ruta": 7, "ciudad_origen_id": 1, "ciudad_destino_id": 9, "distancia_km": 100,
         "tarifa_base": Decimal(40), **route},
        {"id_ruta": 8, "ciudad_origen_id": 9, "ciudad_destino_id": 1, "distancia_km": 10,
         "tarifa_base": Decimal(20), **route}))
    empresas = cleaning.clean_empresas(frame(spark, "empresas", {
        "id_empresa": 1, "nombre_empresa": "uno", "estado": "activa", "tipo": "flota",
        "capacidad_flota_total": 12.9}))
    pasajeros = cleaning.clean_pasajeros(frame(spark, "pasajeros",
                                               {"id_pasajero": 1, "ciudad_id": 5}))
    unidades = cleaning.clean_unidades(frame(
        spark, "unidades_flota",
        {"id_unidad": 3, "anio_fabricacion": 2000, "capacidad_asientos": 30, "placa": "a"},
        {"id_unidad": 4, "anio_fabricacion": 2000, "capacidad_asientos": 40, "placa": "b"}))
    return {"dim_ruta": star.dim_ruta(rutas, geo), "dim_empresa": star.dim_empresa(empresas),
            "dim_pasajero": star.dim_pasajero(pasajeros, geo),
            "dim_unidad": star.dim_unidad(unidades)}


def test_dimension_defaults(small_star):
    first = small_star["dim_ruta"].orderBy("sk_ruta").first()
    assert (first.sk_ruta, first.id_ruta_origen, first.ciudad_origen, first.ciudad_destino) == (
        1, 7, "Tarija", "Desconocido")
    assert first.ingreso_por_km == Decimal("0.4")
    passenger = small_star["dim_pasajero"].first()
    assert (passenger.ciudad_origen, passenger.nacionalidad) == ("Desconocido", "Boliviana")
    assert small_star["dim_empresa"].first().capacidad_flota_total == 12


def test_fact_defaults(spark, small_star):
    ventas = cleaning.clean_ventas(frame(
        spark, "ventas_pasajes", ticket(1, id_ruta=7, canal_venta="agente"),
        ticket(2, id_ruta=99, id_empresa=99, id_pasajero=99, canal_venta="otro",
               numero_asiento=None, estado_pasaje="cancelado", fecha_viaje="2030-01-01")))
    bused = ventas.withColumn("id_unidad", F.when(F.col("id_venta") == 1, 4).otherwise(99))
    tiempo = star.dim_tiempo(ventas.filter("id_venta = 1"))
    fact = {r.id_venta_origen: r for r in star.fact_ventas(bused, tiempo, small_star).collect()}
    hit, miss = fact[1], fact[2]
    assert (hit.sk_venta, miss.sk_venta) == (1, 2)
    assert (hit.sk_tiempo, hit.sk_ruta, hit.sk_canal, hit.sk_unidad) == (20210305, 1, 4, 2)
    assert (hit.distancia_km, hit.tarifa_base, hit.capacidad_unidad) == (100, 40, 40)
    assert hit.ingreso_por_km == Decimal("0.5") and hit.cepal_modo_transporte == "Sin dato"
    assert (miss.sk_tiempo, miss.sk_ruta, miss.sk_empresa, miss.sk_pasajero) == (20220101, 1, 1, 1)
    assert (miss.sk_unidad, miss.sk_canal, miss.numero_asiento, miss.es_cancelado) == (1, 1, 1, 1)
    assert (miss.distancia_km, miss.tarifa_base, miss.ingreso_por_km) == (0, 0, None)
    assert miss.capacidad_unidad == 30  # seats of bus 1
    orphans = quality.foreign_key_report({
        **small_star, "dim_tiempo": tiempo, "dim_canal": star.dim_canal(spark),
        "fact_ventas": star.fact_ventas(bused, tiempo, small_star)})
    assert {r.regla for r in orphans.collect() if not r.ok} == {"sk_tiempo existe"}


def test_fact_without_buses_uses_bus_one(spark, small_star):
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", ticket(1)))
    row = star.fact_ventas(ventas, None, small_star).first()
    assert (row.sk_unidad, row.capacidad_unidad) == (1, 30)
    empty = {**small_star, "dim_unidad": small_star["dim_unidad"].limit(0)}
    assert star.fact_ventas(ventas, None, empty).first().capacidad_unidad == 44


def test_buses_from_itineraries(spark, small_star):
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", ticket(1, id_itinerario=5)))
    trips = frame(spark, "itinerarios", {"id_itinerario": 5, "id_unidad": 4})
    bused = star.units_from_itineraries(ventas, trips)
    assert star.fact_ventas(bused, None, small_star).first().capacidad_unidad == 40


@pytest.mark.parametrize("ids", [[5, 3, 9], [5, 3, 5], [None, 3, 5], [None, None, 3], [4, 4, 4]])
@pytest.mark.parametrize("by_itinerary", [False, True])
def test_fact_with_and_without_ids_that_are_a_key(spark, small_star, ids, by_itinerary):
    """numbers by id, ties by the other columns, and the lookups of each ticket."""
    raw = [ticket(i, id_ruta=7, id_pasajero=p, id_itinerario=t, id_unidad=u, numero_asiento=k)
           for k, (i, p, t, u) in enumerate(zip(ids, [1, 99, None], [6, 5, 8], [3, None, 4]))]
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", *raw)).drop("id_unidad").join(
        spark.createDataFrame([(r["numero_asiento"], r["id_unidad"]) for r in raw],
                              "numero_asiento int, id_unidad bigint"), "numero_asiento")
    trips = frame(spark, "itinerarios", {"id_itinerario": 5, "id_unidad": 4},
                  {"id_itinerario": 5, "id_unidad": 4}, {"id_itinerario": 6, "id_unidad": 77})
    whole = star.units_from_itineraries(ventas.drop("id_unidad"), trips) if by_itinerary else ventas
    lean = whole.select(*[c for c in star.TICKET_COLUMNS if c in whole.columns])
    numbered = lean.withColumn("sk_venta", F.row_number().over(
        Window.orderBy(*lean.columns)).cast("bigint"))
    want = schemas.conform(star.fact_rows(numbered, small_star), schemas.GOLD["fact_ventas"])
    got = star.fact_ventas(ventas, None, small_star, itinerarios=trips if by_itinerary else None)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert got.count() == 3


def test_dim_tiempo_takes_both_dates_once(spark):
    ventas = cleaning.clean_ventas(frame(spark, "ventas_pasajes", ticket(1), ticket(2),
                                         ticket(3, fecha_viaje="2021-03-01")))
    assert [r.sk_tiempo for r in star.dim_tiempo(ventas).orderBy("sk_tiempo").collect()] == [
        20210301, 20210305]


@pytest.mark.parametrize("values", [
    [], [None, None], [3.0], [1.0, 2.0], [5.0, None, 1.0, 9.0], [2.0] * 9 + [7.0],
    [float(x * x % 977) for x in range(5001)], [float(x) ** 9 for x in range(4000)],
    [-1e300, 1e300, 0.0, 5.5], [float("nan"), 1.0, 2.0, 3.0], [0.1 * (x % 3) for x in range(3000)]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = spark.range(1).select(exact_median(df, "x").alias("m")).first().m
    real = [v for v in values if v is not None and v == v]
    want = statistics.median(real) if real else None
    assert got == (want if want is None else pytest.approx(want, rel=1e-15, abs=0))
