"""Control totals: of stages side by side, and of rows while they are written."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.money import AMOUNT_DIGITS, exact_sum, scale
from ..functions.sql import quoted


def control_totals(stages: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and amount total of each stage; a stage is (rows, amount column).

    Amounts of one frame are added up together: it is computed once for all its stages.
    """
    frames: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
    for name, (df, amount) in stages.items():
        frames.setdefault(id(df), (df, []))[1].append((name, amount))
    parts = []
    for df, held in frames.values():
        totals = df.agg(F.expr("count(1) AS total_count"), *[F.expr(f"{exact_sum(a)} AS amount_{i}") for i, (_, a) in enumerate(held)])
        rows = ", ".join(f"struct({quoted(name)} AS stage, total_count, amount_{i} AS total_amount)" for i, (name, _) in enumerate(held))
        parts.append(totals.selectExpr(f"inline(array({rows}))"))
    return reduce(DataFrame.unionByName, parts)


class Disagreement(RuntimeError):
    """Two stages of a job that must hold the same amounts do not."""


def observed(df: DataFrame, amounts: dict[str, str]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` that counts its rows and adds up amounts as it is written, and what gives the totals then.

    Amounts are whole numbers of 1e-6, exact; ``|name`` has the sum of absolute amounts.
    No scan is added. The frame must be written or collected by the stage it ends in: only
    there is a task counted once, however often executors are lost.
    """
    seen = Observation()
    parts = {"rows": "count(1)"}
    for name, amount in amounts.items():
        for label, x in ((name, amount), (f"|{name}", f"abs({amount})")):
            parts[f"{label} whole"] = f"sum(CAST(floor({x}) AS BIGINT))"
            parts[f"{label} units"] = f"sum(CAST(rint((({x}) - floor({x})) * {scale(AMOUNT_DIGITS)}) AS BIGINT))"

    def totals() -> dict[str, int]:
        got = seen.get
        held = {"rows": got["rows"]}
        for label in [x for n in amounts for x in (n, f"|{n}")]:
            held[label] = (got[f"{label} whole"] or 0) * 10 ** AMOUNT_DIGITS + (got[f"{label} units"] or 0)
        return held

    return df.observe(seen, *[F.expr(e).alias(n) for n, e in parts.items()]), totals


def must_agree(what: str, before: tuple[int, int], after: tuple[int, int]) -> None:
    """Raises if two (sum, sum of absolute amounts) differ by more than doubles can lose.

    An aggregate is a double again, so each is off by up to half its last binary digit.
    """
    if abs(before[0] - after[0]) > max(before[1], after[1]) >> 50:
        raise Disagreement(f"{what}: {before[0]} before and {after[0]} after, in units of 1e-{AMOUNT_DIGITS}")
