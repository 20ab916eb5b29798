"""The standard chart: measure, tag, scope and statement-line rules as data.

Conditions are SQL texts over the account dimension and the fact. Comparisons
keep SQL null logic: a plain ``<>`` or ``NOT IN`` rejects a null, and a rule that
lets a null pass says so. Pass other lists of the same shape to use another chart.
"""

from __future__ import annotations

# ---- fixed values: sentinels -------------------------------------------------
NO_CONTRACT = "0000000"
NO_CATEGORY = "00000"
SYNTHETIC_ACCOUNT = "999999"
SYNTHETIC_TYPE = "BS-PL INSERT"
RISK_DOMAINS = "domain_id IN ('19', '20', '21')"
RISK_ACCOUNTS = "gl_account_id IN ('913716', '813714', '813715')"
SYNTHETIC_COMMON_KEY = "0"
BUDGET_CLASS = "MGTBGT"
AMOUNT_CLASSES = ["MGTBGT", "MGTACT", "FINACT"]

# ---- fixed values: profit-and-loss measures -----------------------------------
L1, L2, L3, L4, L5, L6 = (f"gl_account_levl{n}_code" for n in range(1, 7))
LEVELS = [L1, L2, L3, L4, L5, L6]
MEASURES = [
    ("gross_interest_income", f"{L3} = '60110000'"),
    ("gross_interest_expense", f"{L3} = '60120000'"),
    ("asset_cof", f"{L5} = '60141100'"),
    ("lp_charge", f"{L5} = '60141200'"),
    ("lp_credit", f"{L5} = '60131200'"),
    ("liability_cof", f"{L5} = '60131300'"),
    ("derivatives_income", f"{L3} = '60150000'"),
    ("fee_income", f"{L3} = '60210000'"),
    ("fx_income", f"{L3} = '60230000'"),
    ("net_investment_income", f"{L3} = '60240000'"),
    ("oth_income", f"{L3} IN ('60161000', '60250000', '60260000')"),
    ("interbranch_income", f"{L4} = '60132000' OR {L5} = '60131100'"),
    ("interbranch_expense", f"{L4} = '60142000' OR {L5} = '60141300'"),
]
# Amount bases: name suffix -> amount column of the ledger row.
BASES = {
    "": "outstanding_balance_mtd_aed",
    "_mtd_lcy": "outstanding_balance_mtd_lcy",
    "_ytd_aed": "outstanding_balance_ytd_aed",
    "_ytd_lcy": "outstanding_balance_ytd_lcy",
}
# Derived measures, in order: later ones may use earlier ones.
DERIVED = [
    ("net_interest_income", ["gross_interest_income", "asset_cof", "lp_charge",
                             "gross_interest_expense", "liability_cof", "lp_credit"]),
    ("total_ftp_amt", ["asset_cof", "lp_charge", "liability_cof", "lp_credit"]),
    ("net_pl", ["net_interest_income", "derivatives_income", "fee_income", "fx_income",
                "net_investment_income", "oth_income", "interbranch_income",
                "interbranch_expense"]),
]
# Measures whose first basis carries a suffix too.
SUFFIXED = {"total_ftp_amt": "_mtd_aed"}
# Domains whose rows feed the measures.
MEASURE_SCOPE = "l1_code IN ('100000', '200000', '400000')"

# ---- fixed values: scenarios and risk-weighted assets --------------------------
SCENARIOS = {"actual": "100000", "budget": "200000", "cy_ed_budget": "400000"}
RWA_DOMAINS = ["50", "51", "52"]
RWA_CLASSES = {
    "rwa_credit_risk": ("511100", "913716"),
    "rwa_market_risk": ("511200", "813714"),
    "rwa_operational_risk": ("511300", "813715"),
}

# ---- fixed values: statement lines ---------------------------------------------
# Line -> (label, joins it needs, condition). Joins: "account", "centre"
# (profit centre known), "centre_entity" (known together with the entity).
_COST = "70314100"
_COST_RULE = f"({L5} <> '{_COST}' OR {L5} IS NULL OR profit_centre = '21010')"
STATEMENT_LINES = {
    "13000": ("Investments", ["account"], f"{L2} = '10300000'"),
    "13001": ("Net loans", ["account"], f"{L4} IN ('10511000', '10512000', '10521000')"),
    "13002": ("Total assets", ["account"], f"{L1} = '10000000'"),
    "13003": ("Total liabilities", ["account"], f"{L1} IN ('30000000', '35000000')"),
    "13004": ("Performing loans", ["account"], f"{L4} = '10511000'"),
    "13005": ("Customer deposits", ["account"], f"{L2} = '30300000'"),
    "13008": ("Investments and bank borrowings", ["account"],
              f"{L2} = '10300000' OR ({L2} = '30100000' AND {L3} = '30130000')"),
    "13010": ("Earning assets", ["account"],
              f"{L1} = '10000000' AND {L2} NOT IN ('10600000', '10700000', '10800000', "
              "'10900000', '10100000', '11000000')"),
    "13011": ("Interest-bearing liabilities", ["account"],
              f"{L1} IN ('30000000', '35000000') AND {L2} NOT IN ('30400000', '30500000', "
              "'30600000', '35000000')"),
    "67001": ("Net interest income", ["account"], f"{L2} = '60100000'"),
    "67002": ("Fee income", ["account"], f"{L3} = '60210000'"),
    "67003": ("Non-fund income", ["account"], f"{L2} = '60200000'"),
    "67004": ("Operating income", ["account"], f"{L1} = '60000000'"),
    "67005": ("Business direct cost", ["account"],
              f"{L1} = '70000000' AND {L3} = '70310000' AND {L5} <> '{_COST}'"),
    "67006": ("Operating expenses", ["account", "centre"], f"{L1} = '70000000' AND {_COST_RULE}"),
    "67007": ("Operating profit", ["account"],
              f"({L1} IN ('70000000', '60000000') AND {L5} <> '{_COST}') OR ({L1} = '70000000' "
              f"AND {L5} = '{_COST}' AND source_system_id IN ('T24', 'TI', 'OGL', 'MM'))"),
    "67008": ("Impairment", ["account"], f"{L1} = '77000000'"),
    "67009": ("Tax", ["account"], f"{L1} = '78000000'"),
    "67010": ("Impairment by known centre", ["account", "centre_entity"], f"{L1} = '77000000'"),
    "67011": ("Net profit", ["account", "centre_entity"],
              f"{L1} IN ('60000000', '70000000', '77000000', '78000000') AND {_COST_RULE}"),
    "67013": ("Net profit after equity charge", ["account", "centre_entity"],
              f"{L1} IN ('60000000', '70000000', '77000000', '78000000', '79000000') "
              f"AND {_COST_RULE}"),
    "67016": ("Risk-weighted assets", [],
              f"gl_account_id NOT LIKE '-%' AND ({RISK_DOMAINS} OR (domain_id "
              f"IN ('50', '51', '52') AND {RISK_ACCOUNTS}))"),
    "67017": ("Net profit after amortisation", ["account"],
              f"{L1} IN ('60000000', '70000000', '77000000', '78000000', '79000000')"),
}

# ---- fixed values: tag rules -----------------------------------------------------
# Columns: acc_* account, prod_* product, dept_* department, dom_* domain,
# seg_* customer segment, geo_* coverage geography; bare names are the fact's.
_MARKET_PRODUCTS = (
    "('00050', '00055', '00060', '00070', '00075', '00080', '00085', '00090', '00095', "
    "'00130', '01000', '02000', '20000', '21000', '30000', '35000', '36000', '37000')"
)
_CMC_ACCOUNTS = (
    "('642507', '728717', '728718', '728719', '728720', '728721', '728722', '728723', "
    "'728724', '728725', '728726', '728727', '728728', '728729', '728730', '728731', "
    "'728732', '728733', '728734')"
)
_TRADING = "dept_l4_code = '103070' AND acc_l3_code = '60260000'"
_NIM = (
    "legal_entity <> '620' AND acc_l2_code = '60100000' AND dept_l3_code = '100030' "
    "AND dom_l2_code = '120000' AND seg_l1_code IN ('5000', '7000') "
    "AND acc_l6_code NOT IN ('619021', '713071', '713072') "
    "AND prod_code IN ('21020', '21024', '21029', '9591', '9593', '9611') "
    "AND source_system_id NOT IN ('AEI', 'AEIFMD')"
)
# Tag -> ordered (condition, label); the first true condition wins.
TAG_RULES = {
    "gm_other": [
        (f"{_TRADING} AND prod_l2_code IN {_MARKET_PRODUCTS} AND acc_l6_code IN {_CMC_ACCOUNTS}", "CMC"),
        (f"{_TRADING} AND prod_l2_code IN {_MARKET_PRODUCTS} AND acc_l6_code = '642508'", "PC Sales"),
        (f"{_TRADING} AND prod_l2_code IN {_MARKET_PRODUCTS} AND acc_l6_code = '642509'", "PC Non Sales"),
        (f"{_TRADING} AND prod_l2_code IN {_MARKET_PRODUCTS}", "GM Sales Others"),
        (f"{_TRADING} AND prod_l2_code NOT IN {_MARKET_PRODUCTS}", "Others"),
        (_NIM, "NIM"),
        ("true", "GM Others"),
    ],
    "gm_stmt_derivatives": [
        (f"{_TRADING} AND prod_l2_code = '00075'", "FX"),
        (f"{_TRADING} AND prod_l2_code IN ('00055', '01000', '02000', '20000', '21000', '30000', "
         "'35000', '36000', '37000')", "MM"),
        (f"{_TRADING} AND prod_l2_code IN ('00050', '00085', '00095', '00130')", "Securities"),
        (_TRADING, "Derivatives"),
        (_NIM, "MM"),
        ("true", "GM Others"),
    ],
}
# Rows a tag may be given to. The segment grouping of the second level has an
# "others" group, so it admits every row and needs no condition.
TAG_ELIGIBLE = (
    "dept_l1_code = '100000' AND dept_l2_code = '100003' AND acc_l1_code = '60000000' "
    "AND (dom_l2_code = '120000' OR domain_id IN ('26', '37', '7')) "
    "AND geo_l2_code IN ('10105', '10107', '20100', '20300') "
    "AND seg_l1_code IN ('5000', '0009', '0001', '6000', 'UnClass') "
    "AND gl_account_id NOT LIKE '-%'"
)
