"""One column list per query, applied to the Spark result and to its SQL counterpart.

A column is ``name`` or ``name:kind``: ``i`` is a 64-bit integer, ``n`` a 32-bit
one, ``d`` a double rounded to six digits (sums and means may differ in the last
bits with the order of addition), ``a`` one rounded to nine (means of small values
that often lie half way between two six-digit numbers), ``t`` a date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


_DIGITS = {"d": 6, "a": 9}


def _parts(columns: str) -> list[tuple[str, str]]:
    return [tuple((c + ":").split(":")[:2]) for c in columns.split()]


def _spark(name: str, kind: str) -> Column:
    col = F.col(name)
    if kind == "i":
        col = col.cast("long")
    elif kind == "n":
        col = col.cast("int")
    elif kind in _DIGITS:
        # adding zero turns -0.0 into 0.0
        col = F.round(col.cast("double"), _DIGITS[kind]) + F.lit(0.0)
    elif kind == "t":
        col = col.cast("date")
    return col.alias(name)


def _sql(name: str, kind: str) -> str:
    quoted = f'"{name}"'
    text = {
        "": quoted, "i": f"CAST({quoted} AS BIGINT)", "n": f"CAST({quoted} AS INTEGER)",
        **{k: f"ROUND(CAST({quoted} AS DOUBLE), {n}) + 0.0" for k, n in _DIGITS.items()}, "t": f"CAST({quoted} AS DATE)",
    }[kind]
    return f"{text} AS {quoted}"


def shaped(df: DataFrame, columns: str) -> DataFrame:
    return df.select(*[_spark(n, k) for n, k in _parts(columns)])


def select_list(columns: str) -> str:
    return ", ".join(_sql(n, k) for n, k in _parts(columns))
