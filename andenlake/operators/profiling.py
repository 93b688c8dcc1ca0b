"""Column profiles of raw tables, each table in one aggregation pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from andenlake.functions import measures as m
from andenlake.functions import text as t
from andenlake.operators.joins import scalar
from andenlake.session import written


def _mean(c: Column, kind: T.DataType) -> Column:
    """Mean from an exact sum where the type allows one: a sum of doubles would
    depend on the order of the rows."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.avg(c)
    exact = c if isinstance(kind, T.DecimalType) else c.cast("decimal(20,0)")
    return m.ratio(F.sum(exact), F.count(c))


def _column_metrics(field: T.StructField) -> dict[str, Column]:
    """Aggregates of one column; those that do not apply to its type are null."""
    c = F.col(field.name)
    is_text = isinstance(field.dataType, T.StringType)
    is_number = isinstance(field.dataType, T.NumericType)
    no_count, no_value = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    return {
        "nulos": F.count_if(c.isNull()),
        "espacios_extra": F.count_if(t.has_outer_space(c)) if is_text else no_count,
        "mayusculas_mixtas": F.count_if(t.is_irregular_case(c)) if is_text else no_count,
        "minimo": F.min(c).cast("double") if is_number else no_value,
        "maximo": F.max(c).cast("double") if is_number else no_value,
        "media": _mean(c, field.dataType) if is_number else no_value,
    }


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, nulls, text format problems, numeric range."""
    fields = df.schema.fields
    metrics = {f.name: _column_metrics(f) for f in fields}
    counted = df.agg(F.count("*").alias("filas"), *[
        value.alias(f"{i}_{key}") for i, f in enumerate(fields)
        for key, value in metrics[f.name].items()])
    lines = F.array(*[
        F.struct(F.lit(f.name).alias("columna"),
                 F.lit(f.dataType.simpleString()).alias("tipo"),
                 *[F.col(f"{i}_{key}").alias(key) for key in metrics[f.name]])
        for i, f in enumerate(fields)])
    line = F.col("linea")
    return (counted.select("filas", F.explode(lines).alias("linea"))
            .select(F.lit(table).alias("tabla"), line.columna.alias("columna"),
                    line.tipo.alias("tipo"), "filas", F.lit(len(fields)).alias("columnas"),
                    line.nulos.alias("nulos"),
                    m.half_up(m.percentage(line.nulos, F.col("filas")), 1).alias("pct_nulos"),
                    line.espacios_extra.alias("espacios_extra"),
                    line.mayusculas_mixtas.alias("mayusculas_mixtas"),
                    *[m.half_up(line[k], 2).alias(k) for k in ("minimo", "maximo", "media")]))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [profile_table(df, name) for name, df in tables.items()])


def sales_detail(ventas: DataFrame) -> DataFrame:
    """Dirty-data evidence of the ticket table. A name may count twice in the
    total: once for its spaces and once for its case."""
    amount, name = F.col("monto_pagado"), F.col("nombre_pasajero_registrado")
    counted = ventas.agg(
        F.count("*").alias("filas"),
        F.count_if(amount <= 0).alias("montos_no_positivos"),
        F.min(amount).cast("double").alias("monto_minimo"),
        F.max(amount).cast("double").alias("monto_maximo"),
        F.count_if(name.isNull()).alias("nombre_nulo"),
        F.count_if(F.contains(name, F.lit("  "))).alias("nombre_doble_espacio"),
        F.count_if(t.is_mixed_case(name)).alias("nombre_mayusculas_mixtas"))
    dirty = (F.col("nombre_nulo") + F.col("nombre_doble_espacio")
             + F.col("nombre_mayusculas_mixtas"))
    return counted.withColumns({
        "total_sucios": dirty,
        "pct_sucios": m.half_up(m.percentage(dirty, F.col("filas")), 1)})


def frequencies(df: DataFrame, names: list[str]) -> DataFrame:
    """Value counts of several columns from one scan. Missing values are not
    listed but stay in the denominator."""
    present = [n for n in names if n in df.columns]
    pairs = F.array(*[F.struct(F.lit(n).alias("columna"), F.col(n).cast("string").alias("valor"))
                      for n in present])
    # Counted once and kept: the total is the sum over one column's values, nulls included.
    counted = written(df.select(F.explode(pairs).alias("p")).select("p.*")
                      .groupBy("columna", "valor").agg(F.count("*").alias("cantidad")),
                      "frequencies")
    total = scalar(counted.filter(F.col("columna") == present[0]).agg(F.sum("cantidad")))
    return counted.filter(F.col("valor").isNotNull()).withColumn(
        "pct", m.half_up(m.percentage(F.col("cantidad"), total), 1))
