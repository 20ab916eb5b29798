"""Delimited ledger extract to typed ledger rows, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes
from ..session import shuffles_dropped

SEPARATOR = "~"


def header_line(spark: SparkSession, path: str) -> str | None:
    """First line of the first file by name."""
    files = spark.read.text(path).inputFiles()
    first = spark.read.text(min(files)).first() if files else None
    return first[0] if first else None


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Data lines as an array column; every line equal to the header is dropped.

    The array comes out of a generator, which no later filter is moved below: the test
    of a line looks at twenty fields, and below it each would split the line again.
    """
    header = header if header is not None else header_line(spark, path)
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.where(F.col("value") != header)
    return lines.select("value", F.explode(F.array(F.split("value", SEPARATOR, -1))).alias("field"))


def period_key(year: str, month: str, date_text: str) -> str:
    """Year, two-digit month and the second space-separated token of the date text."""
    padded = f"CASE WHEN length({month}) > 1 THEN {month} ELSE concat('0', {month}) END"
    return f"concat({year}, {padded}, get(split({date_text}, ' '), 1))"


def amount(text: str) -> str:
    """Empty text is 0; text that is no finite number is null."""
    number = f"try_cast({text} AS DOUBLE)"
    return f"CASE WHEN {text} = '' THEN 0D WHEN abs({number}) < double('Infinity') THEN {number} END"


def _field(position: int) -> str:
    return f"get(field, {position})"


def parse(lines: DataFrame) -> DataFrame:
    """All fields of every line, with the reason a line must be rejected (or null)."""
    parsed = lines.selectExpr(
        "value", "size(field) AS width",
        *[f"{_field(p)} AS {n}" for n, p in schemas.EXTRACT_KEYS.items()],
        f"{period_key(*[_field(p) for p in schemas.EXTRACT_PERIOD.values()])} AS period_text",
        *[f"{amount(_field(p))} AS {n}" for n, p in schemas.EXTRACT_AMOUNTS.items()],
    )
    bad_amount = " OR ".join(f"{n} IS NULL" for n in schemas.EXTRACT_AMOUNTS)
    return parsed.selectExpr(
        "*",
        f"CASE WHEN width < {schemas.EXTRACT_WIDTH} THEN 'too few fields' "
        "WHEN try_cast(period_text AS INT) IS NULL THEN 'bad period' "
        f"WHEN {bad_amount} THEN 'bad amount' END AS reject_reason")


def accepted(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Lines to load. ``strict`` fails the job on the first bad line."""
    row_id = "row_id"
    if strict:
        row_id = ("CASE WHEN reject_reason IS NULL THEN row_id ELSE "
                  "CAST(raise_error(concat(reject_reason, ': ', value)) AS STRING) END AS row_id")
    else:
        parsed = parsed.where("reject_reason IS NULL")
    return parsed.selectExpr(
        row_id, *[n for n in schemas.EXTRACT_KEYS if n != "row_id"],
        "try_cast(period_text AS INT) AS time_key", *schemas.EXTRACT_AMOUNTS)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason IS NOT NULL").select("value", "reject_reason")


def row_ids(rows: DataFrame) -> DataFrame:
    """How many rows have each row id."""
    return rows.groupBy("row_id").agg(F.expr("count(1) AS n_rows"))


def duplicate_row_ids(rows: DataFrame) -> DataFrame:
    """Row ids that occur more than once, for a look at an extract; loads number rows themselves."""
    return row_ids(rows).where("n_rows > 1")


def to_ledger(rows: DataFrame) -> DataFrame:
    """Ledger rows under the names of the fact: codes split, bases renamed.

    The year-to-date amounts are the rebased ones.
    """
    amounts = {}
    for raw, name in {"ccy": "acy", "lcl": "lcy", "rpt": "aed"}.items():
        amounts[f"outstanding_balance_mtd_{name}"] = f"mtd_{raw}_amount"
        amounts[f"outstanding_balance_ytd_{name}"] = f"ytd_{raw}_amount_rebased"
        for horizon in ("mtd", "ytd", "ltd"):
            amounts[f"avg_book_bal_{horizon}_{name}"] = f"{horizon}ab_{raw}"
    return rows.selectExpr(
        "row_id", "time_key", "common_key", "amount_class", "entity AS legal_entity",
        f"{codes.code_type('customer_nr')} AS banking_type_customer",
        f"{codes.code_id('customer_nr')} AS customer_number",
        "account_code AS gl_account_id",
        f"{codes.code_type('deal_id')} AS banking_type",
        f"{codes.code_id('deal_id')} AS contract_id",
        "profit_centre", "element1 AS category_code", "element3 AS source_system_id",
        "element4 AS final_segment", "element7 AS customer_segment_code",
        "currency AS currency_code", "domain_id",
        *[f"coalesce({c}, 0D) AS {n}" for n, c in amounts.items()],
    )


def read_ledger(spark: SparkSession, path: str, header: str | None = None,
                strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ledger rows and rejected lines of an extract."""
    parsed = parse(read_lines(spark, path, header))
    return to_ledger(accepted(parsed, strict)), rejected(parsed)


def write_extract(rows: DataFrame, path: str) -> None:
    """Writes raw rows in the extract's layout, one header line per file, compressed.

    A line is mostly separators and zeros; ``read_lines`` reads the files as it does plain ones.
    """
    by_position = {p: n for n, p in {**schemas.EXTRACT_KEYS, **schemas.EXTRACT_PERIOD,
                                     **schemas.EXTRACT_AMOUNTS}.items()}
    fields = [
        f"coalesce(CAST({by_position[p]} AS STRING), '') AS {by_position[p]}"
        if p in by_position else f"'' AS f{p}"
        for p in range(schemas.EXTRACT_WIDTH)
    ]
    options = {"sep": SEPARATOR, "header": True, "quote": "\u0000", "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
               "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    with shuffles_dropped(rows.sparkSession):
        rows.selectExpr(*fields).write.options(**options).csv(path)
