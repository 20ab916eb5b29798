"""Sums that give the same answer whatever the order of the rows.

Doubles do not add associatively, so a distributed ``sum`` of doubles depends on
how rows fall into partitions. An amount is therefore added as two whole numbers:
its integer part, and its fraction in units of 10^-AMOUNT_DIGITS. The buffers stay
primitive longs inside generated code (a DECIMAL buffer would allocate per addition).

Error: each row is off by at most half a unit; amounts with no more decimals than
that are added exactly. Range: the integer parts of a group must stay below 9.2e18
and its rows below 9e12; in ANSI mode anything beyond raises.

The functions return SQL text: wide aggregates hold a hundred of them, and one
parsed expression is built far faster than a chain of Column calls.
"""

from __future__ import annotations

AMOUNT_DIGITS = 6
RATIO_SCALE = "1e9D"


def scale(digits: int) -> str:
    return f"1e{digits}D"


def exact_sum(amount: str, digits: int = AMOUNT_DIGITS) -> str:
    """Order-independent sum of amounts; null only if all are null."""
    return exact_total([amount], digits)


def exact_total(amounts: list[str], digits: int = AMOUNT_DIGITS) -> str:
    """The same of several amounts that are null together.

    Beside the sums of the amounts themselves it needs no buffers of its own.
    """
    units = " + ".join(f"sum(CAST(rint((({x}) - floor({x})) * {scale(digits)}) AS BIGINT))" for x in amounts)
    whole = " + ".join(f"sum(CAST(floor({x}) AS BIGINT))" for x in amounts)
    return joined(whole, units, digits)


def joined(whole: str, units: str, digits: int = AMOUNT_DIGITS) -> str:
    """The amount of an integer part and units, both longs; null if one of them is.

    Together they are one whole number of units, which is then made a double. A decimal
    holds it always, but allocates several objects per column and group; so it is taken
    as a long wherever it fits one.
    """
    fits = f"try_add(try_multiply({whole}, {10 ** digits}L), {units})"
    wide = f"CAST(({whole}) AS DECIMAL(20, 0)) * {10 ** digits} + ({units})"
    return f"coalesce(CAST({fits} AS DOUBLE), CAST({wide} AS DOUBLE)) / {scale(digits)}"


def ratio_sum(ratio: str) -> str:
    """Order-independent sum of ratios, exact to 1e-9 per row.

    The integer part and the fraction are added apart, so neither precision
    nor range is given up: x - floor(x) is exact in binary floating point.
    """
    return (
        f"CAST(sum(CAST(floor({ratio}) AS BIGINT)) AS DOUBLE) + "
        f"sum(CAST(rint((({ratio}) - floor({ratio})) * {RATIO_SCALE}) AS BIGINT)) / {RATIO_SCALE}"
    )


def rounded(amount: str, digits: int = AMOUNT_DIGITS) -> str:
    """A double rounded to the unit in which amounts are added."""
    return f"rint(({amount}) * {scale(digits)}) / {scale(digits)}"
