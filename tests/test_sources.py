import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import types as T

from andenlake import schemas
from andenlake.operators.quality import QualityError
from andenlake.sources import indicator, jdbc, snapshots

DAY1, DAY2 = dt.date(2026, 4, 6), dt.date(2026, 4, 7)


# ---- snapshots ---------------------------------------------------------------

def test_newest_snapshot_wins_and_a_date_is_replaced(spark, tmp_path):
    root = str(tmp_path)
    for day, n in ((DAY2, 3), (DAY1, 5), (DAY2, 4)):
        snapshots.land(spark.range(n), root, "t", day)
    assert snapshots.snapshot_dates(spark, root, "t") == ["2026-04-06", "2026-04-07"]
    assert rows(snapshots.latest(spark, root, "t")) == [(0,), (1,), (2,), (3,)]
    everything = spark.read.parquet(f"{root}/t")
    assert everything.count() == 9
    assert snapshots.newest_rows(everything).count() == 4


def test_missing_snapshot(spark, tmp_path):
    with pytest.raises(snapshots.SnapshotNotFound):
        snapshots.latest(spark, str(tmp_path), "nada")
    with pytest.raises(snapshots.SnapshotNotFound):
        snapshots.latest_csv(spark, str(tmp_path), "nada", schemas.BRONZE["rutas"])


def write(path, text, encoding="utf-8-sig"):
    path.write_text(text, encoding=encoding)


def test_csv_keeps_phone_numbers_and_clock_times(spark, tmp_path):
    head = ",".join(f.name for f in schemas.BRONZE["empresas"].fields)
    write(tmp_path / "empresas_20260101.csv", f"{head}\n9,Vieja,1,1,Activa,Flota,1,1,2010-01-01\n")
    write(tmp_path / "empresas_20260407.csv",
          f"{head}\n1,\"Uno, S.A.\",10,045551234,Activa,Flota,1,77,2014-09-02\n")
    write(tmp_path / "empresas_extra_20270101.csv", "otra\n1\n")
    got = snapshots.latest_csv(spark, str(tmp_path), "empresas", schemas.BRONZE["empresas"])
    row = got.first()
    assert (row.id_empresa, row.nombre_empresa, row.telefono) == (1, "Uno, S.A.", "045551234")
    head = ",".join(f.name for f in schemas.BRONZE["itinerarios"].fields)
    write(tmp_path / "itinerarios_20260407.csv",
          f"{head}\n1,1,1,1,08:00:00,\"Lunes,Viernes\",Diario,True\n")
    row = snapshots.latest_csv(spark, str(tmp_path), "itinerarios",
                               schemas.BRONZE["itinerarios"]).first()
    assert (row.hora_salida, row.dias_operacion, row.activo) == ("08:00:00", "Lunes,Viernes", True)


@pytest.mark.parametrize("days", [(DAY1, DAY2), (DAY2, DAY2)])
def test_an_empty_snapshot_is_the_newest(spark, tmp_path, days):
    for day, n in zip(days, (3, 0)):
        snapshots.land(spark.range(n), str(tmp_path), "t", day)
    newest = snapshots.latest(spark, str(tmp_path), "t")
    assert newest.columns == ["id"] and newest.count() == 0


def test_unfinished_and_odd_folders_are_no_snapshots(spark, tmp_path):
    snapshots.land(spark.range(2), str(tmp_path), "t", DAY1)
    for name in ("2027-01-01", "__HIVE_DEFAULT_PARTITION__"):
        (tmp_path / "t" / f"ingest_date={name}").mkdir()
    (tmp_path / "t" / "ingest_date=__HIVE_DEFAULT_PARTITION__" / "_SUCCESS").touch()
    assert snapshots.snapshot_dates(spark, str(tmp_path), "t") == [str(DAY1)]


CITIES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("de", T.StringType()),
                       T.StructField("a", T.StringType())])


def test_csv_quotes_line_breaks_and_columns_by_name(spark, tmp_path):
    write(tmp_path / "t.csv", 'a,id,de,x\n"dijo ""hola"", y salio",1,Sur,9\n"dos\nlineas",2,Este,9\n')
    got = snapshots.read_csv(spark, str(tmp_path / "t.csv"), CITIES)
    assert got.columns == ["id", "de", "a"]
    assert rows(got) == [(1, "Sur", 'dijo "hola", y salio'), (2, "Este", "dos\nlineas")]
    with pytest.raises(ValueError):
        snapshots.read_csv(spark, str(tmp_path / "t.csv"), schemas.BRONZE["rutas"])


TEXTS = [None, "", " a ", 'say ""hi""', '"', '""', "a,b", "one\ntwo\n\nthree", "win\r\ndows", "\n",
         "long\n" * 400, "x" * 3000, '"\n"' * 50, "áé🙂\nñ", "end\r", "-"]


def test_csv_with_line_breaks_is_read_in_pieces(spark, tmp_path):
    """Splits far smaller than a record give the rows that were written."""
    rows = [(i, TEXTS[i % len(TEXTS)], f"t{i}") for i in range(400)]
    schema = "id long, texto string, otra string"
    df = spark.createDataFrame(rows, schema).coalesce(2)
    path = snapshots.write_csv(df, str(tmp_path / "t"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    try:
        for size in ("700b", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            if size == "700b":
                assert spark.read.text(path).rdd.getNumPartitions() > 50
            got = snapshots.read_csv(spark, path, df.schema, keep_empty=True).collect()
            assert sorted(map(tuple, got)) == rows
            assert snapshots.bad_csv_rows(spark, path, df.schema).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_quotes_out_of_place_do_not_swallow_rows(spark, tmp_path):
    """A quote inside a plain value may hide where rows end: the read fails and says so."""
    for body in ('1,x"y,z\n2,x,y\n3,x"y,z\n', '1,"x,y\n2,x,y\n'):
        write(tmp_path / "t.csv", "id,de,a\n" + body)
        path = str(tmp_path / "t.csv")
        assert snapshots.bad_csv_rows(spark, path, CITIES).count() == 1
        with pytest.raises(Exception, match="bad row in a CSV file"):
            snapshots.read_csv(spark, path, CITIES).collect()
    write(tmp_path / "t.csv", "id,de,a\n")
    assert snapshots.read_csv(spark, str(tmp_path / "t.csv"), CITIES).collect() == []


def test_bad_csv_rows_are_reported_and_fail_the_read(spark, tmp_path):
    write(tmp_path / "t.csv", "id,de,a\n1,x,y\nuno,x,y\n3,x,y,z\n")
    path = str(tmp_path / "t.csv")
    bad = snapshots.bad_csv_rows(spark, path, CITIES).collect()
    assert {r[snapshots.BAD_ROW] for r in bad} == {"3,x,y,z", "uno,x,y"}
    with pytest.raises(Exception, match="bad row in a CSV file"):
        snapshots.read_csv(spark, path, CITIES).collect()
    write(tmp_path / "good.csv", "id,de,a\n1,x,y\n,,\n")
    good = snapshots.read_csv(spark, str(tmp_path / "good.csv"), CITIES)
    assert rows(good) == [(1, "x", "y"), (None, None, None)]


def test_manifest_totals(spark):
    frames = {"a": spark.range(3), "b": spark.range(5), "c": spark.range(0)}
    assert rows(snapshots.manifest(frames)) == [
        ("TOTAL", 8, 3), ("a", 3, 1), ("b", 5, 1), ("c", 0, 1)]


# ---- JDBC options ----------------------------------------------------------------

def test_jdbc_options():
    assert jdbc.read_options("jdbc:x", "rutas") == {"url": "jdbc:x", "dbtable": "rutas"}
    split = jdbc.read_options("jdbc:x", "ventas", "id_venta", 1, 1200, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("id_venta", "1", "1200", "8")
    assert jdbc.write_options("jdbc:x", "fact")["batchsize"] == "500"
    assert jdbc.write_options("jdbc:x", "fact")["truncate"] == "true"


# ---- indicator documents -------------------------------------------------------------

def payload(success=True, code=200, records=2, message="", data=None, **body):
    points = data if data is not None else [
        {"value": "12345678", "source_id": 3760, "notes_ids": "", "iso3": "PER",
         "dim_74754": 74755, "dim_208": 244, "dim_29117": 29188, "dim_74389": 74391},
        {"value": "n/d", "source_id": 3760, "iso3": "XXX", "dim_74754": 1, "dim_208": 2,
         "dim_29117": 3, "dim_74389": 74391}]
    return {"header": {"success": success, "code": code, "message": message},
            "body": {"metadata": {"indicator_id": 3906, "indicator_name": "Volumen",
                                  "unit": "km"}, "data": points, **body},
            "footer": {"records": records}}


def land(folder, **documents):
    for name, doc in documents.items():
        text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False, indent=2)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def test_envelope_routing(spark, tmp_path):
    folder = land(tmp_path, good=payload(), failed=payload(success=False, message="sin cupo"),
                  code=payload(code=500), empty=payload(records=0, data=[]), broken="{no json")
    checked = indicator.check_envelopes(indicator.parse(indicator.read_documents(spark, folder)))
    got = {os.path.basename(r.archivo): (r.estado, r.motivo) for r in checked.collect()}
    assert got == {"good.json": ("ok", None), "empty.json": ("vacio", None),
                   "failed.json": ("rechazado", "success=False: sin cupo"),
                   "code.json": ("rechazado", "codigo 500"),
                   "broken.json": ("rechazado", "success=False: Sin mensaje")}
    with pytest.raises(QualityError):
        indicator.require_accepted(checked)


def test_flatten(spark, tmp_path):
    docs = indicator.read_documents(spark, land(tmp_path, a=payload()))
    got = {r.iso3: r for r in indicator.flatten_series(indicator.parse(docs), DAY2).collect()}
    row = got["PER"]
    assert (row.pais_nombre, row.anio, row.modo_transporte) == ("Peru", "2018", "Transporte aereo")
    assert (row.valor, row.unidad, row.fuente_id, row.fecha_extraccion) == (
        12345678.0, "km", 3760, DAY2)
    odd = got["XXX"]
    assert (odd.pais_nombre, odd.anio, odd.modo_transporte, odd.valor) == (
        "Desconocido", "Desconocido", "Desconocido", None)
    empty = indicator.read_documents(spark, land(tmp_path, a=payload(data=[], records=0)))
    assert indicator.flatten_series(indicator.parse(empty), DAY2).count() == 0


def test_dimension_members(spark, tmp_path):
    dims = [{"name": "Pais", "id": 208, "order": 1, "position": 1, "members": [
        {"name": "Chile", "id": 224, "in": 1, "order": 4, "parent": 208, "selected": 0},
        {"name": "Peru", "id": 244, "in": 1, "order": 5, "parent": 208, "selected": 0}]},
        {"name": "Vacia", "id": 1, "order": 2, "position": 2, "members": []}]
    docs = indicator.read_documents(spark, land(tmp_path, a=payload(dimensions=dims)))
    assert rows(indicator.dimension_members(indicator.parse(docs))) == [
        (208, "Pais", 224, "Chile", 208, 4), (208, "Pais", 244, "Peru", 208, 5)]


def test_documents_land_unmodified(spark, tmp_path):
    text = '{\n  "header": {"success": true},\n  "ñ": "x"\n}\n'
    (tmp_path / "in").mkdir()
    docs = indicator.read_documents(spark, land(tmp_path / "in", a=text))
    indicator.land_documents(docs, str(tmp_path / "out"), "d", DAY2)
    back = snapshots.latest(spark, str(tmp_path / "out"), "d")
    assert back.first().documento == text
