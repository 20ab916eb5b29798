"""Dimension lookups. No side is hinted for broadcast: Spark broadcasts a side
whose size is under the session's threshold and otherwise shuffles, with AQE
splitting skewed partitions. A collapsed dimension is written first, for its size
is then known when the join is planned."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sql import aggregates
from ..session import stage


def collapse(dim: DataFrame, key: str | list[str], attributes: Iterable[str] | None = None) -> DataFrame:
    """One row per key holding the maximum of every attribute."""
    keys = [key] if isinstance(key, str) else list(key)
    names = list(attributes) if attributes is not None else [c for c in dim.columns if c not in keys]
    if not names:
        return dim.select(*keys).distinct()
    return dim.groupBy(*keys).agg(*aggregates({n: f"max({n})" for n in names}))


def collapsed(dim: DataFrame, key: str | list[str], attributes: Iterable[str] | None = None) -> DataFrame:
    """The same, written once if the dimension is read from files.

    The estimate for an aggregate is the size of what it reads. A join with a few
    accounts out of a large table was therefore planned as a shuffle, and by the time
    their size was measured the fact had moved, all rows of an account to one task.
    """
    side = collapse(dim, key, attributes)
    return stage(side, "dimension") if dim.inputFiles() else side


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    how: str = "left",
    unique: bool = False,
) -> DataFrame:
    """Adds dimension columns to the fact and never multiplies fact rows.

    ``on`` maps fact key to dimension key, ``take`` maps the new column to the
    dimension column. The dimension is collapsed on its key first, unless the
    caller states that it is unique.
    """
    keys = list(on.values())
    if not unique:
        dim = collapsed(dim, keys, sorted({c for c in take.values() if c not in keys}))
    side = dim.selectExpr(
        *[f"{d} AS __on_{i}" for i, d in enumerate(keys)],
        *[f"{source} AS {new}" for new, source in take.items()],
    )
    match = " AND ".join(f"{left} = __on_{i}" for i, left in enumerate(on))
    return fact.join(side, F.expr(match), how).drop(*[f"__on_{i}" for i in range(len(keys))])


def in_scope(fact: DataFrame, dim: DataFrame, on: dict[str, str], condition: str) -> DataFrame:
    """Fact rows whose dimension member satisfies ``condition`` (left semi join)."""
    side = dim.where(condition).selectExpr(*[f"{d} AS __on_{i}" for i, d in enumerate(on.values())])
    match = " AND ".join(f"{left} = __on_{i}" for i, left in enumerate(on))
    return fact.join(side, F.expr(match), "left_semi")


def star(fact: DataFrame, branches: Iterable[tuple]) -> DataFrame:
    """Inner joins with several dimensions; each branch is (dim, on, take)."""
    for dim, on, take in branches:
        fact = lookup(fact, dim, on, take, how="inner")
    return fact


def salted_left_join(
    fact: DataFrame,
    side: DataFrame,
    on: dict[str, str],
    hot: str,
    hot_side: str,
    spread_by: Iterable[str],
    salts: int = 64,
) -> DataFrame:
    """Left join in which the rows marked ``hot`` are spread over ``salts`` tasks.

    ``side`` must be unique on its keys. Its rows marked ``hot_side`` are
    repeated once per salt, so every fact row still meets exactly its match.
    The salt is a hash of row content: a recomputed task gives the same one.
    """
    salt = f"CASE WHEN {hot} THEN CAST(pmod(xxhash64({', '.join(spread_by)}), {salts}) AS INT) ELSE 0 END"
    copies = f"explode(CASE WHEN {hot_side} THEN sequence(0, {salts - 1}) ELSE array(0) END)"
    fact = fact.selectExpr("*", f"{salt} AS __salt")
    side = side.selectExpr("*", f"{copies} AS __copy")
    match = " AND ".join([f"{left} = {right}" for left, right in on.items()] + ["__salt = __copy"])
    return fact.join(side, F.expr(match), "left").drop("__salt", "__copy", *on.values())
