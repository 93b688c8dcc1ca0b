import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from andenlake.functions import calendar as cal
from andenlake.functions import measures as m
from andenlake.functions import text as t

TEXTS = ["semi-cama", "Bolivia (Estado Plurinacional de)", "3rd o'neil", "ñandú ÁRBOL", "", " ",
         "  Flota  SCZ ", "\tWEB\n", " nbsp ", "a1b2", "ÉCOLE d'été", "x", "日本a語b",
         " ancho　", "santa cruz de la sierra", "(abc) [DEF]", "\x1fcontrol\x1c"]


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


@pytest.mark.parametrize("ours, python", [
    (t.strip, str.strip),
    (t.title_case, lambda x: x.strip().title()),
    (t.capitalized, lambda x: x.strip().capitalize()),
    (t.upper_case, lambda x: x.strip().upper()),
    (t.lower_case, lambda x: x.strip().lower()),
    (t.passenger_name, lambda x: " ".join(x.split()).upper()),
    (t.has_outer_space, lambda x: x != x.strip()),
    (t.is_irregular_case, lambda x: x not in (x.upper(), x.lower(), x.title())),
    (t.is_mixed_case, lambda x: x not in (x.upper(), x.lower())),
])
def test_text_equals_python(spark, ours, python):
    assert column(spark, TEXTS, "string", ours) == [python(x) for x in TEXTS]


NAMES = ["ana maria", "  ana  maria ", " ana", "ana ", "ana\tmaria", "josé  pérez", "josé pérez ", "",
         " ", "  ", "x\x1cy", "a\u2003b", "\xa0a", "o'neil-smith 3b", "user 12", "12 user", "a1", "ab#c",
         "CUSTOMER#0001", "semi cama", "MED POLISHED TIN", "dž ǆ x", "ﬁ x", "straße i̇"]


def test_names_that_need_no_pattern(spark):
    """Plain names take a way without a pattern, with the same outcome."""
    assert column(spark, NAMES, "string", t.passenger_name) == [
        " ".join(x.split()).upper() for x in NAMES]
    df = spark.createDataFrame([("x",)], "x string")
    plan = df.select(t.passenger_name("x"))._jdf.queryExecution().analyzed().toString().lower()
    assert "case when" in plan and plan.index("case when") < plan.index("regexp_replace")


def test_missing_text(spark):
    assert column(spark, [None], "string", t.title_case) == [None]
    assert column(spark, [None], "string", t.passenger_name) == ["SIN REGISTRO"]
    assert column(spark, [None, "0 46 1", "nan", " 7 "], "string", t.phone) == ["", "0461", "", "7"]


def test_parse_date(spark):
    values = ["2020-02-29", "2021-02-29", "sin fecha", "", None, "2024-1-5"]
    assert column(spark, values, "string", cal.parse_date) == [
        dt.date(2020, 2, 29), None, None, None, None, dt.date(2024, 1, 5)]


DAYS = [dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2021, 1, 4),
        dt.date(2022, 12, 23), dt.date(2022, 12, 24), dt.date(2022, 12, 31),
        *[dt.date(2022, 4, d) for d in range(1, 31)], dt.date(2024, 2, 29), dt.date(2023, 6, 15)]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    got = df.select("d", *[c.alias(k) for k, c in cal.attributes("d").items()]).collect()
    for r in got:
        d, week = r.d, r.d.isocalendar()
        assert r.sk_tiempo == int(d.strftime("%Y%m%d")) and r.fecha == d
        assert (r.anio, r.mes, r.trimestre) == (d.year, d.month, (d.month + 2) // 3)
        assert (r.semana_anio, r.dia_semana) == (week[1], week[2])
        assert r.nombre_mes == cal.MONTHS[d.month - 1]
        assert r.nombre_dia == cal.WEEKDAYS[d.weekday()]
        assert r.es_fin_semana == int(d.weekday() >= 5)
        assert r.es_semana_santa == int(d.month == 4 and week[1] in (14, 15, 16))
        assert r.es_feria_tarija == int(d.month == 4 and d.day <= 7)
        assert r.es_fin_anio == int((d.month, d.day) >= (12, 24) or (d.month, d.day) == (1, 1))


def test_key_attributes_equal_date_attributes(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date").withColumn("k", cal.date_key("d"))
    by_date = cal.attributes("d")
    assert list(cal.key_attributes("k", ("mes", "anio"))) == ["mes", "anio"]
    for name, expression in cal.key_attributes("k", tuple(by_date)).items():
        pairs = df.select(by_date[name].alias("a"), expression.alias("b")).collect()
        assert all(r.a == r.b for r in pairs), name


def test_seasons(spark):
    assert column(spark, list(range(1, 13)), "int", cal.season) == [
        "Baja", "Alta", "Media", "Alta", "Media", "Baja", "Alta", "Media", "Baja", "Baja",
        "Media", "Alta"]


@pytest.mark.parametrize("tier, values, labels", [
    (m.occupancy_tier, [75.0, 74.99, 40.0, 39.99, None],
     ["Alta", "Media", "Media", "Baja", "Baja"]),
    (m.season_tier, [130.0, 129.9, 100.0, 99.9, 70.0, 69.9, None],
     ["Pico alto", "Normal alto", "Normal alto", "Normal bajo", "Normal bajo", "Valle", "Valle"]),
    (m.risk_tier, [20.0, 19.99, 10.0, 9.99],
     ["Riesgo Alto", "Riesgo Medio", "Riesgo Medio", "Riesgo Bajo"]),
])
def test_tiers(spark, tier, values, labels):
    assert column(spark, values, "double", tier) == labels


def test_ratios(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (0, 5), (None, 2)], "a int, b int")
    got = [tuple(r) for r in df.select(
        m.percentage(F.col("a"), F.col("b")),
        m.zero_safe(F.col("b"), m.ratio(F.col("a"), F.col("b")))).collect()]
    assert got == [(12.5, 0.125), (None, 0.0), (0.0, 0.0), (None, None)]


def test_half_up(spark):
    values = [0.125, 2.675, -0.125, 1e18, None]
    assert column(spark, values, "double", lambda c: m.half_up(c, 2)) == [
        0.13, 2.68, -0.13, 1e18, None]


def test_discount_and_channel(spark):
    assert column(spark, [-1.0, 0.0, 100.0, 100.01, None], "double", m.valid_discount) == [
        0.0, 0.0, 100.0, 0.0, 0.0]
    assert column(spark, ["web", "AGENTE", "otro", None], "string", m.channel_key) == [
        3, 4, None, None]
    assert column(spark, ["CANCELADO ", "viajado", None], "string", m.is_cancelled) == [1, 0, 0]


def test_reference_label(spark):
    assert column(spark, [2.0, 1.0, None], "double",
                  lambda c: m.reference_label(c, F.lit(1.0))) == [
        "Supera referencia", "Debajo referencia", "Debajo referencia"]


def test_decimal_ratio_cuts_digits(spark):
    """Against whole-number division, at the largest divisors too."""
    rng = random.Random(1)
    pairs = [(2, 3), (-2, 3), (100, 0), (1, 7), (1, None), (None, 7), (99, 100)]
    pairs += [(rng.randint(1, 10**9), rng.choice([3, 7, 997, 2**31 - 1, rng.randint(1, 2**31 - 1)]))
              for _ in range(300)]
    pairs += [(k * (2**31 - 1) - 1, 2**31 - 1) for k in (1, 5, 40)]
    df = spark.createDataFrame([(i, None if c is None else Decimal(c) / 100, d)
                                for i, (c, d) in enumerate(pairs)],
                               "i int, amount decimal(18,2), km int")
    for places in (13, 15):
        got = df.select("i", m.decimal_ratio(F.col("amount"), F.col("km"), places)).orderBy("i")
        for (c, d), (_, q) in zip(pairs, got.collect()):
            want = None
            if c is not None and d:
                whole = abs(c) * 10 ** (places - 2) // d
                want = Decimal(whole if c > 0 else -whole).scaleb(-places)
            assert q == want
    huge = spark.sql("SELECT cast('9999999999999999.99' AS decimal(18,2)) AS amount, 3 AS km")
    assert huge.select(m.decimal_ratio(F.col("amount"), F.col("km"), 15)).first()[0] is None
