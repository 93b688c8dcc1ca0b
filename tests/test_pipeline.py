"""The three layers end to end on written files."""

import datetime as dt
import json
import os
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from andenlake.operators import quality, star
from andenlake.plans import kpis, pipeline, testbed
from andenlake.sources import snapshots, versions

DAY = dt.date(2026, 4, 7)


@pytest.fixture(scope="module")
def source(spark, smoke):
    """Operational tables that pass every rule: amounts inside the expected
    range, known channels, and no more defects than cleaning may drop."""
    tables = testbed.raw_tables(spark, smoke)
    ventas = tables["ventas_pasajes"]
    amount = F.when(F.col("monto_pagado") > 0, (F.col("monto_pagado") % 400) + 5)
    tables["ventas_pasajes"] = (
        ventas.withColumn("monto_pagado", amount.cast("decimal(18,4)"))
        .withColumn("canal_venta", F.regexp_replace("canal_venta", "otro", "web"))
        .drop("id_unidad"))
    return tables


@pytest.fixture(scope="module")
def document():
    points = [{"value": str(1000 + year), "source_id": 3760, "iso3": "BOL", "dim_74754": 74755,
               "dim_208": 221, "dim_29117": code, "dim_74389": 74391}
              for code, year in ((29185, 2015), (29187, 2017), (29188, 2018))]
    return {"header": {"success": True, "code": 200, "message": ""},
            "body": {"metadata": {"indicator_name": "Volumen", "unit": "km"}, "data": points},
            "footer": {"records": 3}}


@pytest.fixture(scope="module")
def layers(spark, source, document, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    paths = {n: str(base / n) for n in ("bronze", "silver", "gold", "docs")}
    (base / "docs").mkdir()
    (base / "docs" / "a.json").write_text(json.dumps(document), encoding="utf-8")
    manifest = rows(pipeline.land_bronze(spark, source.__getitem__, paths["bronze"], DAY))
    series = pipeline.land_indicator(spark, paths["docs"], paths["bronze"], DAY)
    silver = rows(pipeline.build_silver(spark, paths["bronze"], paths["silver"], DAY))
    gold = rows(pipeline.build_gold(spark, paths["silver"], paths["gold"], use_itineraries=True))
    return {**paths, "manifest": manifest, "series": series, "silver_report": silver,
            "gold_report": gold}


def test_manifest(layers, source):
    lines = {r[0]: r[1] for r in layers["manifest"]}
    assert len(lines) == 8 and lines["ventas_pasajes"] == 6000
    assert lines["TOTAL"] == sum(n for t, n in lines.items() if t != "TOTAL")


def test_series(layers):
    assert [r.anio for r in layers["series"].orderBy("anio").collect()] == ["2015", "2017", "2018"]


def test_reports_pass(layers):
    assert len(layers["silver_report"]) == 38 and all(r[4] for r in layers["silver_report"])
    assert len(layers["gold_report"]) == 7 + 6 + 61 and all(r[4] for r in layers["gold_report"])


def test_gold_counts_and_numbers(spark, layers):
    tables = pipeline.read_gold(spark, layers["gold"])
    counts = {r.tabla: r.registros for r in pipeline.gold_row_counts(tables).collect()}
    assert counts["dim_canal"] == 4
    fact = tables["fact_ventas"]
    bounds = fact.agg(F.min("sk_venta"), F.max("sk_venta"), F.countDistinct("sk_venta")).first()
    assert tuple(bounds) == (1, counts["fact_ventas"], counts["fact_ventas"])
    assert fact.select("sk_unidad").distinct().count() > 1


def test_views_over_stored_gold(spark, layers):
    gold = pipeline.open_gold(spark, layers["gold"])
    kpis.register_views(gold)
    total = spark.sql("SELECT total_pasajes_vendidos FROM vw_resumen_ejecutivo").first()[0]
    years = spark.sql("SELECT sum(total_pasajes) FROM vw_okr_crecimiento_ingresos").first()[0]
    assert total == years
    top = spark.sql("SELECT * FROM vw_kpi1_tasa_ocupacion "
                    "WHERE anio = (SELECT max(anio) FROM vw_kpi1_tasa_ocupacion) "
                    "ORDER BY tasa_ocupacion_pct DESC LIMIT 15")
    assert top.count() == 15


def test_stored_plan_prunes_and_broadcasts(spark, layers):
    gold = pipeline.open_gold(spark, layers["gold"])
    latest = kpis.occupancy(gold.latest_year())
    latest.collect()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


def test_second_run_gives_the_same_gold(spark, layers, tmp_path):
    pipeline.build_gold(spark, layers["silver"], str(tmp_path), use_itineraries=True)
    first = pipeline.read_gold(spark, layers["gold"])
    second = pipeline.read_gold(spark, str(tmp_path))
    for name in first:
        assert first[name].exceptAll(second[name]).count() == 0, name
        assert first[name].count() == second[name].count()


def test_rebuild_in_place_replaces(spark, layers):
    before = {n: df.count() for n, df in pipeline.read_gold(spark, layers["gold"]).items()}
    pipeline.build_gold(spark, layers["silver"], layers["gold"], use_itineraries=True)
    after = {n: df.count() for n, df in pipeline.read_gold(spark, layers["gold"]).items()}
    assert before == after


def test_failed_rule_leaves_the_old_gold_readable(spark, layers, tmp_path, monkeypatch):
    gold = str(tmp_path / "gold")
    with pytest.raises(versions.NoVersion):
        pipeline.read_gold(spark, gold)
    pipeline.build_gold(spark, layers["silver"], gold)
    first = versions.current(spark, gold)
    before = rows(pipeline.gold_row_counts(pipeline.read_gold(spark, gold)))
    reader = pipeline.read_gold(spark, gold)["fact_ventas"]
    write = pipeline.write_star

    def spoiled(spark, folder, dims, tickets, **options):
        write(spark, folder, dims, tickets.unionByName(tickets.limit(3).withColumn(
            "id_venta", F.lit(None).cast("bigint"))), **options)

    monkeypatch.setattr(pipeline, "write_star", spoiled)
    with pytest.raises(quality.QualityError, match="id_venta_origen no nulo"):
        pipeline.build_gold(spark, layers["silver"], gold)
    assert versions.current(spark, gold) == first and versions.others(spark, gold) == []
    assert rows(pipeline.gold_row_counts(pipeline.read_gold(spark, gold))) == before
    pipeline.build_gold(spark, layers["silver"], gold, strict=False)
    assert versions.others(spark, gold) == [first]
    assert pipeline.read_gold(spark, gold)["fact_ventas"].count() == reader.count() + 3
    versions.discard(spark, first)
    assert versions.others(spark, gold) == []


def test_views_read_cells_and_not_tickets(spark, layers):
    gold = pipeline.open_gold(spark, layers["gold"])
    assert len(gold.years) > 1
    for name, view in kpis.VIEWS.items():
        plan = view(gold)._jdf.queryExecution().optimizedPlan().toString()
        assert "monto_pagado" not in plan and "sk_venta" not in plan, name
    summary = kpis.executive_summary(gold)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in summary


def test_views_over_cells_equal_views_over_tickets(spark, layers):
    gold = pipeline.open_gold(spark, layers["gold"])
    tickets = kpis.Gold(gold.fact_ventas, gold.dim_ruta, gold.dim_empresa, gold.dim_tiempo)
    for name, view in kpis.VIEWS.items():
        kinds = [[(f.name, f.dataType) for f in view(g).schema] for g in (gold, tickets)]
        assert kinds[0] == kinds[1], name
        assert rows(view(gold)) == rows(view(tickets)), name
    assert rows(kpis.occupancy(gold.latest_year())) == rows(kpis.occupancy(tickets.latest_year()))


def test_silver_report_takes_one_scan_of_the_tickets(spark, smoke):
    watch = testbed.watched_silver(spark, smoke)
    raw = testbed.raw_table(spark, smoke, "ventas_pasajes")
    clean = testbed.clean_table(spark, smoke, "ventas_pasajes")
    assert watch.count("raw", "ventas_pasajes") == raw.count()
    assert watch.count("clean", "ventas_pasajes") == clean.count()
    assert watch.count("clean", quality.INTEGRATED) == clean.count()
    lost = {r.tabla: r.pct_perdido for r in quality.retention_report(spark, watch).collect()}
    assert lost["ventas_pasajes"] == round(
        100 * (raw.count() - clean.count()) / raw.count() + 1e-9, 1)


def test_strict_failure_leaves_no_silver(spark, layers, source, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    bad = dict(source)
    bad["ventas_pasajes"] = source["ventas_pasajes"].withColumn(
        "monto_pagado", F.lit(Decimal("900.0000")))
    pipeline.land_bronze(spark, bad.__getitem__, bronze, DAY)
    pipeline.land_indicator(spark, layers["docs"], bronze, DAY)
    with pytest.raises(quality.QualityError, match="monto_pagado en rango"):
        pipeline.build_silver(spark, bronze, silver, DAY)
    assert not os.path.exists(silver)
    report = pipeline.build_silver(spark, bronze, silver, DAY, strict=False)
    assert [r.regla for r in report.collect() if not r.ok] == ["monto_pagado en rango"]


def test_rejected_document_leaves_no_series(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text('{"header": {"success": false}}')
    with pytest.raises(quality.QualityError):
        pipeline.land_indicator(spark, str(tmp_path / "docs"), str(tmp_path / "bronze"), DAY)
    assert not os.path.exists(tmp_path / "bronze")


def test_profile_report(spark, layers, tmp_path):
    tables = pipeline.read_bronze(spark, layers["bronze"])
    pipeline.profile_bronze(tables, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/columnas").select("tabla").distinct().count() == 8
    assert spark.read.parquet(f"{tmp_path}/frecuencias").count() > 0
    assert spark.read.parquet(f"{tmp_path}/ventas_detalle").count() == 1


def test_snapshots_of_silver(spark, layers):
    assert snapshots.snapshot_dates(spark, layers["silver"], "dataset_integrado") == ["2026-04-07"]


def _depth(plan, join):
    return next(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if join in line)


def test_passengers_are_joined_to_orders_and_not_to_tickets(spark, smoke):
    """otherwise every ticket is shuffled for that join as well."""
    df = testbed.source_table(spark, smoke, "ventas_pasajes")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert _depth(plan, "LeftOuter, (o_custkey#") > _depth(plan, "Inner, (l_orderkey#")


def test_views_number_no_ticket(spark, tmp_path, smoke, monkeypatch):
    """F3, F6, F8: the views read dimensions and cells, for which no ticket is numbered."""
    for name in os.listdir(smoke):
        os.symlink(f"{smoke}/{name}", tmp_path / name)
    number, numbered = star.dense_numbers, []

    def watched(df, out, order_by):
        numbered.append(out)
        return number(df, out, order_by)

    monkeypatch.setattr(star.fact_ventas, "__defaults__", (watched, False))
    assert testbed.gold(spark, str(tmp_path)).cells.count() > 0
    assert numbered == []
    testbed.fact(spark, str(tmp_path))
    assert numbered == ["sk_venta"]  # the fact is built once for itself


def test_fact_is_written_without_another_shuffle(spark, tmp_path, monkeypatch):
    """files by year come from the partitions the rows are in."""
    seen = []
    frame = spark.range(100).selectExpr("cast(id % 3 as int) as anio", "id as sk_ruta")
    monkeypatch.setattr(type(frame.write), "parquet", lambda self, path, **_: seen.append(
        self._df._jdf.queryExecution().executedPlan().toString()))
    pipeline._write_by_year(frame, str(tmp_path))
    assert len(seen) == 1 and "Exchange" not in seen[0]


def test_summary_groups_combine_before_the_shuffle(spark, layers):
    """no sort of every row, no groups of route, company and day."""
    gold = pipeline.open_gold(spark, layers["gold"])
    plan = kpis.executive_summary(gold)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "keys=[sk_ruta" not in plan and "partial_sum" in plan


def test_cells_do_not_grow_with_companies_and_days(spark, layers):
    """F3, F6, F7, F8: by route, company and day nearly every ticket was a cell of its own."""
    gold = pipeline.open_gold(spark, layers["gold"])
    keys = ["sk_ruta", *kpis.PERIOD]
    assert gold.cells.count() == gold.cells.select(*keys).distinct().count()
    assert "sk_empresa" not in gold.cells.columns and "sk_tiempo" not in gold.cells.columns
    assert gold.company_cells.count() == gold.company_cells.select(
        "sk_empresa", *kpis.MONTH).distinct().count()
    tickets = gold.fact_ventas.count()
    for cells in (gold.cells, gold.company_cells):
        assert cells.agg(F.sum("n")).first()[0] == tickets


def test_views_by_company_without_their_cells(spark, layers):
    """What is grouped by cells that are not there is grouped by the fact."""
    gold = pipeline.open_gold(spark, layers["gold"])
    bare = replace(gold, company_cells=None)
    for view in (kpis.cancellations, kpis.executive_summary):
        assert rows(view(gold)) == rows(view(bare))
    assert rows(kpis.cancellations(gold.latest_year())) == rows(
        kpis.cancellations(bare.latest_year()))


def test_cells_look_up_what_their_columns_come_from(spark, tmp_path, smoke, monkeypatch):
    """F3, F6, F8: a lookup of passengers shuffles every ticket, and no cell holds them."""
    for name in os.listdir(smoke):
        os.symlink(f"{smoke}/{name}", tmp_path / name)
    plans = []
    write = pipeline._write_by_year
    monkeypatch.setattr(pipeline, "_write_by_year", lambda df, *a: (plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a)))
    testbed.gold(spark, str(tmp_path), companies=False)
    assert len(plans) == 1 and "id_unidad_origen" in plans[0]
    testbed.gold(spark, str(tmp_path))
    assert len(plans) == 2
    assert not any("id_pasajero_origen" in plan for plan in plans)


def test_lookups_that_shuffle_come_first_and_carry_no_text(spark, smoke):
    """tickets are shuffled for passengers and buses once these are many."""
    dims = testbed.dimensions(spark, smoke)
    rows_of_fact = star.fact_rows(testbed.integrated(spark, smoke), dims, dims["dim_tiempo"], unique=True)
    plan = rows_of_fact._jdf.queryExecution().optimizedPlan().toString()
    for large in ("id_pasajero", "id_unidad"):
        for small in ("id_ruta", "id_empresa", "__day"):
            assert _depth(plan, f"LeftOuter, ({large}#") > _depth(plan, f"LeftOuter, ({small}#")
    joined = plan[:plan.index("LeftOuter, (id_unidad#")]
    assert "estado_pasaje#" not in joined and "canal_venta#" not in joined


def _under(plan, join):
    """The lines of a plan that a join stands on."""
    lines = plan.splitlines()
    deep = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if join in line)
    end = next((i for i in range(at + 1, len(lines)) if deep[i] <= deep[at]), len(lines))
    return "\n".join(lines[at + 1:end])


def test_short_rows_are_looked_up_where_the_id_is_a_key(spark, smoke):
    """whole tickets were sorted, written and shuffled for passengers and for buses."""
    dims = testbed.dimensions(spark, smoke)
    fact = star.fact_ventas(testbed.integrated(spark, smoke), dims["dim_tiempo"], dims, unique=True)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    for key in ("id_pasajero", "id_unidad"):
        assert "monto_pagado" not in _under(plan, f"LeftOuter, ({key}#")
    assert plan.count("Inner, (id_venta") == 1


def test_itineraries_are_looked_up_for_short_rows(spark, smoke):
    """whole tickets were shuffled for the bus of their itinerary as well."""
    plan = testbed.fact(spark, smoke, use_itineraries=True)._jdf.queryExecution() \
        .optimizedPlan().toString()
    for key in ("id_itinerario", "id_pasajero", "id_unidad"):
        assert "monto_pagado" not in _under(plan, f"LeftOuter, ({key}#")


def test_tables_by_year_are_compressed_further(spark, tmp_path):
    """the written fact counts against the disk."""
    frame = spark.range(100).selectExpr("cast(id % 3 as int) as anio", "id as sk_ruta")
    pipeline._write_by_year(frame, str(tmp_path / "years"))
    files = [p.name for p in tmp_path.rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)


def test_a_repeated_passenger_counts_in_the_cells_as_in_the_fact(spark, tmp_path, smoke):
    """F3, F6, F7, F8: a lookup is left out only where it changes no count."""
    for name in os.listdir(smoke):
        if name != "customer.parquet":
            os.symlink(f"{smoke}/{name}", tmp_path / name)
    customers = spark.read.parquet(f"{smoke}/customer.parquet")
    customers.unionByName(customers.filter("c_custkey % 3 = 0")).write.parquet(
        str(tmp_path / "customer.parquet"))
    gold = testbed.gold(spark, str(tmp_path))
    tickets = gold.fact_ventas.count()
    assert tickets > testbed.clean_table(spark, str(tmp_path), "ventas_pasajes").count()
    for cells in (gold.cells, gold.company_cells):
        assert cells.agg(F.sum("n")).first()[0] == tickets
