"""Column names and types of every dataset, as lists that code is generated from."""

from __future__ import annotations

from pyspark.sql import types as T

# --- ledger extract: zero-based position of each field -----------------------
# The layout of the delimited extract.
EXTRACT_KEYS = {
    "row_id": 49, "common_key": 3, "entity": 5, "amount_class": 6, "customer_nr": 7,
    "account_code": 8, "deal_id": 9, "profit_centre": 10, "element1": 11, "element3": 13,
    "element4": 14, "element7": 17, "currency": 20, "domain_id": 21,
}
EXTRACT_PERIOD = {"year": 0, "month": 1, "date_text": 50}
EXTRACT_AMOUNTS = {
    "mtd_ccy_amount": 22, "mtd_lcl_amount": 23, "mtd_rpt_amount": 24,
    "ytd_ccy_amount": 25, "ytd_lcl_amount": 26, "ytd_rpt_amount": 27,
    "ytd_ccy_amount_rebased": 28, "ytd_lcl_amount_rebased": 29, "ytd_rpt_amount_rebased": 30,
    "mtdab_ccy": 31, "mtdab_lcl": 32, "mtdab_rpt": 33,
    "ytdab_ccy": 34, "ytdab_lcl": 35, "ytdab_rpt": 36,
    "ltdab_ccy": 37, "ltdab_lcl": 38, "ltdab_rpt": 39,
}
EXTRACT_WIDTH = 51

# --- keys ---------------------------------------------------------------------
DEAL_KEYS = [
    "amount_class", "banking_type", "banking_type_customer", "category_code", "contract_id",
    "currency_code", "customer_number", "customer_segment_code", "domain_id", "final_segment",
    "legal_entity", "profit_centre", "source_system_id",
]
GL_KEYS = [
    "amount_class", "banking_type", "banking_type_customer", "category_code", "currency_code",
    "customer_segment_code", "domain_id", "final_segment", "gl_account_id",
    "is_internal_account", "legal_entity", "profit_centre", "source_system_id",
]
LINE_KEYS = [
    "amount_class", "banking_type", "category_code", "customer_segment_code", "domain_id",
    "final_segment", "is_internal_account", "legal_entity", "profit_centre", "time_key",
]
CUSTOMER_KEYS = [
    "amount_class", "banking_type", "banking_type_customer", "bs_pl_flag", "currency_code",
    "customer_number", "customer_segment_code", "department_id", "domain_id", "final_segment",
    "gl_account_id", "legal_entity", "product_code", "profit_centre_cd", "source_system_id",
    "time_key",
]
# Keys with many values. Rows sorted by them first are told apart by their first bytes.
SELECTIVE = ["contract_id", "customer_number", "time_key"]
TAG_KEYS = [k for k in GL_KEYS if k != "is_internal_account"]
TAGS = ["gm_stmt_derivatives", "gm_other"]

# --- amounts: horizon x currency ----------------------------------------------
CURRENCIES = ["acy", "lcy", "aed"]
RAW_MTD = [f"mtd_{c}" for c in CURRENCIES]
OUTSTANDING = [f"outstanding_balance_{h}_{c}" for h in ("mtd", "ytd") for c in CURRENCIES]
AVERAGES = [f"avg_book_bal_{h}_{c}" for h in ("ltd", "mtd", "ytd") for c in CURRENCIES]
BALANCES = RAW_MTD + OUTSTANDING + AVERAGES

MARGINS = [f"net_int_margin{s}" for s in ("", "_mtd_lcy", "_ytd_aed", "_ytd_lcy")]
COMPARATIVES = {
    "prev_yr_curr_mth_ytd_aed": ("lysm", "ytd_aed_actual"),
    "prev_yr_curr_mth_ytd_lcy": ("lysm", "ytd_lcy_actual"),
    "prev_mth1_mtd_aed": ("lm1", "mtd_aed_actual"),
    "prev_mth1_mtd_lcy": ("lm1", "mtd_lcy_actual"),
    "prev_mth2_mtd_aed": ("lm2", "mtd_aed_actual"),
    "prev_mth2_mtd_lcy": ("lm2", "mtd_lcy_actual"),
}

# --- storage --------------------------------------------------------------------
FACT_PARTITIONS = ["time_key", "version_id", "amount_class", "domain_id"]
TRIAL_BALANCE_PARTITIONS = FACT_PARTITIONS


def selective_first(keys: list[str]) -> list[str]:
    """The same keys in the order in which rows are best grouped and sorted by them."""
    return sorted(keys, key=lambda k: SELECTIVE.index(k) if k in SELECTIVE else len(SELECTIVE))


def struct(strings: list[str] = (), doubles: list[str] = (), ints: list[str] = ()) -> T.StructType:
    """A nullable schema from lists of names by type."""
    fields = [T.StructField(n, T.StringType()) for n in strings]
    fields += [T.StructField(n, T.DoubleType()) for n in doubles]
    fields += [T.StructField(n, T.IntegerType()) for n in ints]
    return T.StructType(fields)
