"""Periods: ``yyyyMMdd`` integers and the dates they stand for, as SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import literal_rows

# Comparatives a period refers to: name -> months back.
OFFSETS = {"lm1": 1, "lm2": 2, "lysm": 12}


def key_to_date(key: str = "time_key") -> str:
    return f"to_date(CAST({key} AS STRING), 'yyyyMMdd')"


def date_to_key(date: str) -> str:
    return f"CAST(date_format({date}, 'yyyyMMdd') AS INT)"


def month_end_back(date: str, months: int) -> str:
    """Last day of the month that lies ``months`` before the month of ``date``."""
    return f"last_day(add_months({date}, -{months}))"


def is_month_end(date: str) -> str:
    return f"{date} = last_day({date})"


def with_offsets(periods: DataFrame, key: str = "time_key") -> DataFrame:
    """Adds the month-end keys of the prior periods each period compares with."""
    return periods.selectExpr(
        f"CAST({key} AS INT) AS {key}",
        *[f"{date_to_key(month_end_back(key_to_date(key), m))} AS {key}_{n}" for n, m in OFFSETS.items()],
    )


def month_series(spans: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month end from the month of ``start`` to the month of ``end``."""
    months = f"sequence(trunc({start}, 'month'), trunc({end}, 'month'), INTERVAL 1 MONTH)"
    return spans.selectExpr("*", f"explode(transform({months}, m -> last_day(m))) AS period_end")


def periods_frame(spark: SparkSession, keys: Iterable[int]) -> DataFrame:
    return literal_rows(spark, [(int(k),) for k in keys], ["time_key"], "int")


def list_periods(fact: DataFrame, key: str = "time_key") -> list[int]:
    """The periods present. An 8-digit day key bounds them to 366 per year."""
    return sorted(r[0] for r in fact.selectExpr(f"CAST({key} AS INT)").distinct().collect())
