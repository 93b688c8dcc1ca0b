"""Calendar attributes. Every one is a function of the date alone, so the same
expressions fill the time dimension and label rows that carry its key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column

# Labels and calendar rules of the time dimension.
MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
          "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAYS = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]
HIGH_SEASON = [2, 4, 7, 12]
MID_SEASON = [3, 5, 8, 11]
HOLY_WEEK_ISO_WEEKS = (14, 16)
FAIR_LAST_DAY = 7
YEAR_END_FIRST_DAY = 24


def parse_date(c: Column | str) -> Column:
    """Date, or null where the text is not one."""
    return column(c).try_cast("date")


def date_key(date: Column | str) -> Column:
    """Integer key YYYYMMDD."""
    d = column(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def key_date(key: Column | str) -> Column:
    k = column(key)
    return F.make_date((k / 10000).cast("int"), key_month(k), k % 100)


def key_year(key: Column | str) -> Column:
    return (column(key) / 10000).cast("int")


def key_month(key: Column | str) -> Column:
    return (column(key) / 100).cast("int") % 100


def quarter_of(month: Column | str) -> Column:
    return ((column(month) + 2) / 3).cast("int")


def month_bucket(date: Column | str) -> Column:
    return F.date_format(column(date), "yyyy-MM")


def _label(labels: list[str], number: Column | str) -> Column:
    """The n-th label; the split of a literal is folded into a constant array."""
    return F.element_at(F.split(F.lit(",".join(labels)), ","), column(number))


def month_name(month: Column | str) -> Column:
    return _label(MONTHS, month)


def month_number(name: Column | str) -> Column:
    return F.array_position(F.split(F.lit(",".join(MONTHS)), ","), column(name)).cast("int")


def weekday_name(weekday: Column | str) -> Column:
    return _label(WEEKDAYS, weekday)


def season(month: Column | str) -> Column:
    m = column(month)
    return (F.when(m.isin(HIGH_SEASON), "Alta")
            .when(m.isin(MID_SEASON), "Media")
            .otherwise("Baja"))


def holiday_flags(date: Column | str) -> dict[str, Column]:
    d = column(date)
    month, day = F.month(d), F.dayofmonth(d)
    april = month == 4
    year_end = ((month == 12) & (day >= YEAR_END_FIRST_DAY)) | ((month == 1) & (day == 1))
    return {
        "es_semana_santa": (april & F.weekofyear(d).between(*HOLY_WEEK_ISO_WEEKS)).cast("int"),
        "es_feria_tarija": (april & (day <= FAIR_LAST_DAY)).cast("int"),
        "es_fin_anio": year_end.cast("int"),
    }


def attributes(date: Column | str) -> dict[str, Column]:
    """All columns of the time dimension for a date, in table order."""
    d = column(date)
    month = F.month(d)
    weekday = F.weekday(d) + 1  # 1 = Monday
    return {
        "sk_tiempo": date_key(d),
        "fecha": d,
        "anio": F.year(d),
        "trimestre": F.quarter(d),
        "mes": month,
        "nombre_mes": month_name(month),
        "semana_anio": F.weekofyear(d),
        "dia_semana": weekday,
        "nombre_dia": weekday_name(weekday),
        "es_fin_semana": (weekday >= 6).cast("int"),
        "temporada": season(month),
        **holiday_flags(d),
    }


def key_attributes(key: Column | str, names: tuple[str, ...]) -> dict[str, Column]:
    """The named attributes for rows that carry only the key. Year, quarter and
    month, which most groupings need, stay integer arithmetic."""
    month = key_month(key)
    simple = {"anio": key_year(key), "mes": month, "trimestre": quarter_of(month)}
    if set(names) <= set(simple):
        return {n: simple[n] for n in names}
    derived = {**attributes(key_date(key)), **simple}
    return {n: derived[n] for n in names}
