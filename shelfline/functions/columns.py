"""Column expressions shared by the operators.  All stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfline import schemas

_NUMERIC = (T.NumericType,)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def normalized_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the inputs; Spark would sort and sum it as a number."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def round_half_up(col: Column, digits: int) -> Column:
    """Decimal rounding as on exact numerics; the result is a double again."""
    return F.round(col.cast("decimal(28,10)"), digits).cast("double")


def round_half_even(col: Column, digits: int) -> Column:
    return F.bround(col.cast("decimal(28,10)"), digits).cast("double")


def parsed_date(col: Column) -> Column:
    """Text to date; unparseable text becomes NULL instead of failing under ANSI mode."""
    text = col.cast("string")
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_timestamp(text).cast("date"))


def calendar_columns(date: Column) -> dict[str, Column]:
    """Monday-based weekday, day, ISO week, month, quarter, year and weekend flag."""
    return {
        "day_of_week": F.weekday(date),
        "day_of_month": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
    }


def fourier_columns(date: Column) -> dict[str, Column]:
    """Sine and cosine of the annual, weekly and monthly cycle."""
    cycles = {
        "annual": F.dayofyear(date) / F.lit(365.25),
        "weekly": F.weekday(date) / F.lit(7.0),
        "monthly": F.month(date) / F.lit(12.0),
    }
    out: dict[str, Column] = {}
    for name, share in cycles.items():
        angle = F.lit(2 * math.pi) * share
        out[f"sin_{name}"] = F.sin(angle)
        out[f"cos_{name}"] = F.cos(angle)
    return out


def demand_band(units: Column) -> Column:
    """Low, Medium, High or Surge; a NULL demand fails every test and lands in the top band."""
    band = None
    for name, upper in schemas.DEMAND_EDGES:
        band = F.when(units < upper, name) if band is None else band.when(units < upper, name)
    return band.otherwise(schemas.DEMAND_TOP)


def volatility_band(volatility: Column) -> Column:
    """Right-closed bands; an undefined volatility has a band of its own."""
    band = F.when(volatility.isNull(), schemas.VOLATILITY_UNDEFINED)
    for name, upper in schemas.VOLATILITY_EDGES:
        band = band.when(volatility <= upper, name)
    return band.otherwise(schemas.VOLATILITY_TOP)


def python_number_text(col: Column) -> Column:
    """A double as Python prints it.

    Spark changes to an exponent at 1e7 and below 1e-3, Python at 1e16 and below
    1e-4, so the ranges between go through a decimal.
    """
    text = col.cast("string")
    size = F.abs(col)
    whole = F.concat(text.cast("decimal(38,0)").cast("string"), F.lit(".0"))
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), "0+$", "")
    large = F.when(col == F.floor(col), whole).otherwise(plain)
    python_exponent = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E(-?)([0-9])$", "E$10$2"), "E([0-9])", "E+$1"
    )
    return (
        F.when((size >= 1e7) & (size < 1e16), large)
        .when((size >= 1e-4) & (size < 1e-3), plain)
        .when((size >= 1e16) | ((size > 0) & (size < 1e-4)), F.lower(python_exponent))
        .otherwise(text)
    )
