"""Projections from dictionaries of SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_exprs(df: DataFrame, added: dict[str, str]) -> DataFrame:
    """``df`` with columns added or replaced, in one projection."""
    present = df.columns
    return df.selectExpr(
        *[f"{added[c]} AS {c}" if c in added else c for c in present],
        *[f"{e} AS {n}" for n, e in added.items() if n not in present],
    )


def aggregates(exprs: dict[str, str]) -> list[Column]:
    return [F.expr(f"{e} AS {n}") for n, e in exprs.items()]


def select_as(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()])


def quoted(value: object) -> str:
    """A SQL string literal, or NULL."""
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def in_list(values: Iterable[object]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def case_of(column: str, mapping: dict[object, object]) -> str:
    """Simple CASE over a fixed mapping."""
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} END"
