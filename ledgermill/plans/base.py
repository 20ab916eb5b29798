"""Base fact: ledger rows with deal totals attached to their anchor row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import chart, schemas
from ..functions import calendar
from ..functions.codes import null_defaults
from ..functions.sql import with_exprs
from ..operators import anchor, measures
from ..operators.lookup import in_scope, lookup
from ..operators.reconcile import observed
from ..session import stage

BASE_KEYS = [*schemas.DEAL_KEYS, "time_key"]
ATTRIBUTES = ["gl_account_id", "common_key", "bs_pl_flag", "balance_sheet_type", "is_internal_account"]
BASE_COLUMNS = [*BASE_KEYS, *ATTRIBUTES, *schemas.BALANCES, *measures.all_measures(), *schemas.MARGINS]


def classify(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Ledger rows with their account's flags and the balance chosen by them."""
    rows = lookup(
        ledger, accounts, {"gl_account_id": "gl_account_id"},
        {"balance_sheet_type": "gl_account_levl2_desc", "bs_pl_flag": "gl_pl_flag",
         "is_internal_account": "is_internal_account"},
    )
    raw = {f"mtd_{c}": f"outstanding_balance_mtd_{c}" for c in schemas.CURRENCIES}
    return with_exprs(rows, {**raw, **measures.select_balances()})


def stage_classified(ledger: DataFrame, accounts: DataFrame, label: str = "classified",
                     columns: list[str] | None = None) -> DataFrame:
    """Classified rows written once, each with a number of its own (``line_no``); of all columns or those named.

    A generated number is fixed once it is written, whatever is read again later.
    """
    if columns is None:
        return stage_observed(ledger, accounts, label)[0]
    return stage(classify(ledger, accounts).select(*columns).withColumn("line_no", F.monotonically_increasing_id()), label)


# Amounts that every stage must keep, and what they are called in each.
KNOWN_HALF = "bs_pl_flag IN ('BS', 'PL')"
CONTROLS = {"month balance": "mtd_aed", "outstanding": "outstanding_balance_mtd_aed"}


def stage_observed(ledger: DataFrame, accounts: DataFrame, label: str = "classified") -> tuple[DataFrame, dict[str, int]]:
    """The same, and the control totals of the rows whose account is known."""
    rows = classify(ledger, accounts).withColumn("line_no", F.monotonically_increasing_id())
    rows, totals = observed(rows, {n: f"IF({KNOWN_HALF}, {a}, 0D)" for n, a in CONTROLS.items()})
    return stage(rows, label), totals()


BALANCE_HALF = "bs_pl_flag = 'BS'"


def balance_rows(classified: DataFrame) -> DataFrame:
    return classified.where(BALANCE_HALF)


def pl_rows(classified: DataFrame) -> DataFrame:
    return classified.where("bs_pl_flag = 'PL'")


def unclassified(classified: DataFrame) -> DataFrame:
    """Rows in neither half: their account is unknown or carries no flag."""
    return classified.where("bs_pl_flag IS NULL OR bs_pl_flag NOT IN ('BS', 'PL')")


def deal_totals(classified: DataFrame, accounts: DataFrame, domains: DataFrame,
                keys: list[str] = BASE_KEYS) -> DataFrame:
    """Measures per deal, over the rows of the domains in scope."""
    scoped = in_scope(pl_rows(classified), domains, {"domain_id": "domain_id"}, chart.MEASURE_SCOPE)
    return measures.pl_rollup(scoped, measures.account_flags(accounts), keys)


def merged_rows(classified: DataFrame, totals: DataFrame, keys: list[str] = BASE_KEYS) -> DataFrame:
    """Balance-sheet rows plus one synthetic row per deal that has none."""
    names = measures.all_measures()
    rows = balance_rows(classified).select("line_no", "row_id", *keys, *ATTRIBUTES, *schemas.BALANCES)
    merged = anchor.anchor_merge(rows, totals, keys, names)
    # Margins come before the defaults: they need the income and balance of one row.
    merged = with_exprs(merged, measures.margin_columns(calendar.key_to_date()))
    merged = with_exprs(merged, {
        **null_defaults({
            **{c: 0.0 for c in [*schemas.BALANCES, *names]},
            "balance_sheet_type": chart.SYNTHETIC_TYPE,
            "common_key": chart.SYNTHETIC_COMMON_KEY,
            "gl_account_id": chart.SYNTHETIC_ACCOUNT,
            "is_internal_account": chart.SYNTHETIC_ACCOUNT,
        }),
        "bs_pl_flag": "'BS'",
    })
    return merged.select(*BASE_COLUMNS)


def base_from(classified: DataFrame, accounts: DataFrame, domains: DataFrame) -> DataFrame:
    """Merged rows and the raw profit-and-loss rows of classified ledger rows.

    The raw rows are not limited to the domains in scope, the measures are.
    """
    merged = merged_rows(classified, deal_totals(classified, accounts, domains))
    raw = pl_rows(classified).select(*BASE_KEYS, *ATTRIBUTES, *schemas.BALANCES)
    return merged.unionByName(raw, allowMissingColumns=True)


def base_fact(ledger: DataFrame, accounts: DataFrame, domains: DataFrame, read: list[str] | None = None) -> DataFrame:
    """The base fact, for every period in the ledger.

    The classified rows are staged once: the fact needs them in four parts
    (anchors, balance rows, totals, raw rows), and each part then reads only
    its own columns and rows instead of building the ledger again. Callers that name
    the balances they ``read`` (margins read averages) have the others not written.
    """
    if read is None:
        return base_from(stage_classified(ledger, accounts), accounts, domains)
    left = [c for c in schemas.BALANCES if c not in read and c not in chart.BASES.values()]
    kept = [c for c in schemas.BALANCES if c not in left]
    rows = stage_classified(ledger, accounts, columns=["row_id", *BASE_KEYS, *ATTRIBUTES, *kept])
    # Whoever reads one of the others after all is told, by a failure.
    absent = {c: f"CAST(raise_error('not written: {c}') AS DOUBLE)" for c in left}
    return base_from(with_exprs(rows, absent), accounts, domains)
