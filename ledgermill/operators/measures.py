"""Profit-and-loss measures, balances, scenarios, risk weights and margins.

Column formulas are SQL text by column name, ready for one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import chart
from ..functions.money import exact_sum, rounded
from ..functions.sql import aggregates, in_list, with_exprs
from ..schemas import selective_first
from .lookup import collapsed


def measure_name(name: str, basis: str) -> str:
    return name + (basis or chart.SUFFIXED.get(name, ""))


def base_measures(measures=chart.MEASURES, bases=chart.BASES) -> list[str]:
    return [measure_name(m, b) for b in bases for m, _ in measures]


def derived_measures(derived=chart.DERIVED, bases=chart.BASES) -> list[str]:
    return [measure_name(m, b) for b in bases for m, _ in derived]


def all_measures() -> list[str]:
    return base_measures() + derived_measures()


def select_balances(flag: str = "bs_pl_flag") -> dict[str, str]:
    """Month balance: the year balance for balance-sheet rows, else the month's own."""
    return {
        f"outstanding_balance_mtd_{c}": f"CASE WHEN {flag} = 'BS' THEN outstanding_balance_ytd_{c} "
                                        f"ELSE outstanding_balance_mtd_{c} END"
        for c in ("acy", "lcy", "aed")
    }


def account_flags(accounts: DataFrame, key: str = "gl_account_id", measures=chart.MEASURES) -> DataFrame:
    """One row per account with a boolean per measure, decided once per account."""
    return collapsed(accounts, key, chart.LEVELS).selectExpr(
        key, *[f"({c}) AS is_{m}" for m, c in measures])


def pivot_columns(measures=chart.MEASURES, bases=chart.BASES) -> dict[str, str]:
    return {
        measure_name(m, b): f"CASE WHEN is_{m} THEN {amount} ELSE 0D END"
        for b, amount in bases.items() for m, _ in measures
    }


def pivot_measures(pl: DataFrame, flags: DataFrame, key: str = "gl_account_id") -> DataFrame:
    """Adds measure x basis columns: the amount where the account's rule holds, else 0."""
    return with_exprs(pl.join(flags, key), pivot_columns())


def derivation(name: str, basis: str, derived=chart.DERIVED) -> list[str]:
    """Base measures a derived one adds up, with earlier derivations spelled out."""
    known, terms = dict(derived), []
    for t in known[name]:
        terms += derivation(t, basis, derived) if t in known else [measure_name(t, basis)]
    return terms


def derive_measures(df: DataFrame, derived=chart.DERIVED, bases=chart.BASES) -> DataFrame:
    """Adds the additive derivations; a later one may use an earlier one."""
    return with_exprs(df, {
        measure_name(n, b): rounded(" + ".join(derivation(n, b, derived)))
        for b in bases for n, _ in derived
    })


def pl_rollup(pl: DataFrame, flags: DataFrame, keys: list[str]) -> DataFrame:
    """Measures summed per deal.

    Derivations are linear, so they are taken from the sums after the one
    shuffle instead of being carried through it.
    """
    joined = pl.join(flags, "gl_account_id")
    sums = {n: exact_sum(e) for n, e in pivot_columns().items()}
    added = joined.groupBy(*selective_first(keys)).agg(*aggregates(sums))
    return derive_measures(added.select(*keys, *sums))


def scenario_columns(level1: str = "dom_l1") -> dict[str, str]:
    """Actual, budget and current-year budget amounts over the four bases."""
    added = {}
    for basis in ("mtd_aed", "mtd_lcy", "ytd_aed", "ytd_lcy"):
        for name, code in chart.SCENARIOS.items():
            column = f"{name}_{basis}" if name == "cy_ed_budget" else f"{basis}_{name}"
            added[column] = f"CASE WHEN {level1} = '{code}' THEN outstanding_balance_{basis} ELSE 0D END"
    return added


def rwa_columns(level4: str = "dom_l4", domain: str = "dom_id", account: str = "acc_id") -> dict[str, str]:
    """Risk-weighted balance by class; ``domain`` and ``account`` are null when unknown."""
    return {
        name: f"CASE WHEN {level4} = '{code}' OR ({domain} IN {in_list(chart.RWA_DOMAINS)} AND "
              f"{account} = '{gl}') THEN outstanding_balance_mtd_aed ELSE 0D END"
        for name, (code, gl) in chart.RWA_CLASSES.items()
    }


RWA_TOTAL = "rwa_credit_risk + rwa_market_risk + rwa_operational_risk"


def annualised_margin(income: str, average: str, date: str, horizon: str) -> str:
    """Income over average balance, scaled to 365 days; a zero balance counts as 1."""
    days = f"dayofmonth(last_day({date}))" if horizon == "mtd" else f"dayofyear({date})"
    divisor = f"CASE WHEN {average} = 0 THEN 1D ELSE {average} END"
    return f"coalesce(({income} / {divisor}) * (365D / {days}), 0D)"


def margin_columns(date: str) -> dict[str, str]:
    added = {}
    for basis in chart.BASES:
        name = basis or "_mtd_aed"
        added[f"net_int_margin{basis}"] = annualised_margin(
            f"net_interest_income{basis}", f"avg_book_bal{name}", date, name[1:4])
    return added
