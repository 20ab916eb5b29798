"""Composite codes, derived business keys and null defaults, as SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from .sql import quoted

NO_TYPE = "NA"


def code_type(code: str, mark: str = "#") -> str:
    """Trimmed text before the first mark, or ``NA`` when there is no mark."""
    at = f"instr({code}, '{mark}')"
    return f"trim(CASE WHEN {at} > 0 THEN substr({code}, 1, {at} - 1) ELSE '{NO_TYPE}' END)"


def code_id(code: str, mark: str = "#") -> str:
    """Text after the first mark; the whole text when there is none."""
    return f"substr({code}, instr({code}, '{mark}') + 1)"


def joined_key(parts: Iterable[str]) -> str:
    """Concatenation that is null as soon as one part is null."""
    return "concat(" + ", ".join(f"CAST({p} AS STRING)" for p in parts) + ")"


def null_defaults(defaults: dict[str, object]) -> dict[str, str]:
    """Nulls replaced by a same-typed default: a number or a text."""
    return {
        name: f"coalesce({name}, {f'{value}D' if isinstance(value, float) else quoted(value)})"
        for name, value in defaults.items()
    }
