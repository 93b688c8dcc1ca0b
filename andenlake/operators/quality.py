"""Data-quality rules. A report has the rows ``(tabla, regla, violaciones, total, ok)``.
Silver tables are checked by what is observed while they are written; gold tables by one
aggregation pass each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from andenlake import schemas
from andenlake.functions import measures as m
from andenlake.functions.measures import CHANNELS
from andenlake.operators.enrich import country_series

# Accepted domains and limits.
COMPANY_STATES = ["Activa", "Suspendida", "Inhabilitada"]
AMOUNT_RANGE = (5, 500)
MIN_KEPT_SHARE = 0.90


class QualityError(RuntimeError):
    """At least one rule of a report failed."""


def not_null(*names: str) -> dict[str, Column]:
    return {f"{n} no nulo": F.col(n).isNotNull() for n in names}


def positive(*names: str) -> dict[str, Column]:
    return {f"{n} positivo": F.col(n) > 0 for n in names}


def non_negative(name: str) -> dict[str, Column]:
    return {f"{name} no negativo": F.col(name) >= 0}


def in_domain(name: str, values: list[str]) -> dict[str, Column]:
    return {f"{name} en dominio": F.col(name).isin(values)}


def in_range(name: str, low: float, high: float) -> dict[str, Column]:
    return {f"{name} en rango": F.col(name).between(low, high)}


def row_rules() -> dict[str, dict[str, Column]]:
    """Row-level rules of each cleaned table."""
    channels = [name for _, name, _ in CHANNELS]
    return {
        "geografia": {**not_null("id_ciudad", "ciudad", "departamento")},
        "empresas": {**not_null("id_empresa", "nombre_empresa"),
                     **in_domain("estado", COMPANY_STATES)},
        "rutas": {**not_null("id_ruta"), **positive("distancia_km", "tarifa_base")},
        "pasajeros": {**not_null("id_pasajero", "nombre", "apellido", "ci")},
        "unidades_flota": {**not_null("id_unidad", "placa"), **positive("capacidad_asientos")},
        "ventas_pasajes": {
            **not_null("id_venta", "id_empresa", "id_ruta", "fecha_venta", "fecha_viaje"),
            **positive("monto_pagado"),
            **in_domain("canal_venta", channels),
            **in_range("monto_pagado", *AMOUNT_RANGE)},
        "cepal_transporte_pasajeros": {**not_null("valor", "pais_nombre", "anio"),
                                       **non_negative("valor")},
        "dataset_integrado": {**not_null("id_venta", "monto_pagado")},
    }


# Share of the raw rows that has to survive cleaning.
KEPT_SHARE = {
    "geografia": 1.0, "empresas": 1.0, "pasajeros": 1.0,
    "rutas": MIN_KEPT_SHARE, "unidades_flota": MIN_KEPT_SHARE, "ventas_pasajes": MIN_KEPT_SHARE,
}


def check_rows(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Count the rows that break each rule; a null outcome breaks it too."""
    counters = {f"v{i}": F.count_if(~F.coalesce(rule, F.lit(False)))
                for i, rule in enumerate(rules.values())}
    counted = df.agg(F.count("*").alias("total"), *[c.alias(k) for k, c in counters.items()])
    lines = F.array(*[F.struct(F.lit(name).alias("regla"), F.col(k).alias("violaciones"))
                      for k, name in zip(counters, rules)])
    return (counted.select("total", F.explode(lines).alias("linea"))
            .select(F.lit(table).alias("tabla"), "linea.regla", "linea.violaciones", "total",
                    (F.col("linea.violaciones") == 0).alias("ok")))


def check_unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of each key, and rows without a key."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    extra = F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    counted = groups.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("violaciones"),
                         F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return counted.select(F.lit(table).alias("tabla"), F.lit(f"{key} unico").alias("regla"),
                          "violaciones", "total", (F.col("violaciones") == 0).alias("ok"))


def union_reports(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


REPORT = "tabla string, regla string, violaciones bigint, total bigint, ok boolean"
INTEGRATED = "dataset_integrado"


class Watch:
    """Metrics of tables, taken while one job reads and writes them.

    ``raw`` and ``clean`` pass a frame on and note how many rows go through it and how many
    break each rule. Once a job has consumed the frames, the reports know the raw, the kept
    and the rule-breaking rows of every table without another scan. Each job counts for
    itself: the frames are to be consumed once."""

    def __init__(self) -> None:
        self.seen: dict[tuple[str, str], Observation] = {}
        self.rules: dict[str, list[str]] = {}

    def raw(self, name: str, df: DataFrame) -> DataFrame:
        self.seen["raw", name] = Observation()
        return df.observe(self.seen["raw", name], F.count(F.lit(1)).alias("total"))

    def clean(self, name: str, df: DataFrame) -> DataFrame:
        rules = row_rules().get(name, {})
        self.rules[name], self.seen["clean", name] = list(rules), Observation()
        broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"v{i}")
                  for i, rule in enumerate(rules.values())]
        return df.observe(self.seen["clean", name], F.count(F.lit(1)).alias("total"), *broken)

    def count(self, state: str, name: str, metric: str = "total") -> int:
        return self.seen[state, name].get.get(metric) or 0

    def row_lines(self, name: str) -> list[tuple]:
        total = self.count("clean", name)
        found = [(rule, self.count("clean", name, f"v{i}"))
                 for i, rule in enumerate(self.rules[name])]
        return [(name, rule, n, total, n == 0) for rule, n in found]

    def kept_line(self, name: str, min_share: float, before: int | None = None) -> tuple:
        """Rows lost; passes if at least ``min_share`` is left."""
        total = self.count("raw", name) if before is None else before
        lost = total - self.count("clean", name)
        ok = lost == 0 if min_share == 1.0 else total - lost >= total * min_share
        return name, "registros conservados", lost, total, ok

    def retention_lines(self) -> list[tuple]:
        return [self.kept_line(name, share) for name, share in KEPT_SHARE.items()]

    def silver_lines(self) -> list[tuple]:
        """All checks but the one that needs a grouping."""
        joined = self.kept_line(INTEGRATED, 1.0, before=self.count("clean", "ventas_pasajes"))
        return [*[line for name in self.rules for line in self.row_lines(name)],
                *self.retention_lines(), joined]


def silver_report(watch: Watch, benchmark: DataFrame) -> DataFrame:
    """All checks of the silver layer, from a watch whose frames have been consumed."""
    lines = benchmark.sparkSession.createDataFrame(watch.silver_lines(), REPORT)
    return lines.unionByName(check_unique(country_series(benchmark),
                                          "cepal_transporte_pasajeros", "anio"))


def retention_report(spark: SparkSession, watch: Watch) -> DataFrame:
    """Raw and lost rows per cleaned table, and the share lost in percent."""
    return spark.createDataFrame(watch.retention_lines(), REPORT).withColumn(
        "pct_perdido", m.half_up(m.percentage(F.col("violaciones"), F.col("total")), 1))


def primary_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    return union_reports([check_unique(tables[name], name, key)
                          for name, key in schemas.PRIMARY_KEYS.items() if name in tables])


def foreign_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is missing from its dimension.

    One scan counts the rows per distinct key of all foreign keys (map-side, so
    hot keys cost nothing), then the distinct keys are anti-joined.
    """
    keys = {fk: dim for fk, dim in schemas.FOREIGN_KEYS.items() if dim in tables}
    pairs = F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("k"))
                      for fk in keys])
    used = (tables["fact_ventas"].select(F.explode(pairs).alias("p"))
            .groupBy(F.col("p.fk").alias("fk"), F.col("p.k").alias("k"))
            .agg(F.count("*").alias("n")))
    known = reduce(DataFrame.unionByName, [
        tables[dim].select(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("k"))
        for fk, dim in keys.items()])
    marked = used.join(known.distinct().withColumn("hit", F.lit(True)), ["fk", "k"], "left")
    return (marked.groupBy(F.concat(F.col("fk"), F.lit(" existe")).alias("regla"))
            .agg(F.sum(F.when(F.col("hit"), 0).otherwise(F.col("n"))).alias("violaciones"),
                 F.sum("n").alias("total"))
            .select(F.lit("fact_ventas").alias("tabla"), "regla", "violaciones", "total",
                    (F.col("violaciones") == 0).alias("ok")))


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL contract of the declared gold schema."""
    reports = []
    for name, schema in schemas.GOLD.items():
        if name in tables:
            required = [f.name for f in schema.fields
                        if f.name not in schemas.GOLD_NULLABLE.get(name, set())]
            reports.append(check_rows(tables[name], name, not_null(*required)))
    return union_reports(reports)


def null_key_report(fact: DataFrame) -> DataFrame:
    return check_rows(fact, "fact_ventas", not_null("sk_tiempo", "sk_ruta", "sk_empresa"))


def gold_report(tables: dict[str, DataFrame]) -> DataFrame:
    return union_reports([primary_key_report(tables), foreign_key_report(tables),
                          not_null_report(tables)])


def settled(report: DataFrame) -> DataFrame:
    """The report's rows worked out once: one for each rule, so they fit the driver."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def enforce(report: DataFrame) -> None:
    """Raise if a rule failed. At most one row per rule reaches the driver."""
    failed = report.filter(~F.col("ok")).collect()
    if failed:
        lines = [f"{r.tabla}: {r.regla} ({r.violaciones} de {r.total})" for r in failed]
        raise QualityError("; ".join(lines))
