"""Ledger, dimensions and extract derived from an order-entry star schema.

Maps the public test tables to the datasets of this package, so that every
operator can be run and checked on them. All choices are plain arithmetic on
the tables' columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.money import rounded
from .functions.sql import case_of
from .session import literal_rows
from .sources import ingest
from .sources.dims import DIMENSION_COLUMNS, Dimensions

GROUP = "GROUP"
# The one year that the budget is reloaded for where later years are not.
RELOADED_YEAR = 1997
# Reloads of the deals whose id ends in a digit, one after the other: the digit, and their factor then.
RELOADS = [("3", 2), ("5", 3), ("3", 1)]
# Sums that the reloads are shown by.
RELOADED = ["outstanding_balance_mtd", "outstanding_balance_ytd_lcy", "avg_book_bal", "net_pl", "gross_interest_income",
            "rwa_total", "net_int_margin"]
# Codes that make accounts of one year meet those of the next.
FEW_KEYS = {"category_code": "21020", "currency_code": "AED", "customer_segment_code": "S1", "final_segment": "D0",
            "profit_centre": "21010"}

# Brand number -> account levels 1 to 6, for balance-sheet and profit-and-loss
# accounts. A missing level is null.
BS_LEVELS = {
    1: ("10000000", "10300000", "10310000", "10311000", "10311100", "100101"),
    2: ("10000000", "10500000", "10510000", "10511000", "10511100", "100102"),
    3: ("10000000", "10500000", "10510000", "10512000", "10512100", "100103"),
    4: ("10000000", "10500000", "10520000", "10521000", "10521100", "100104"),
    5: ("10000000", "10600000", "10610000", "10611000", "10611100", "100105"),
    6: ("10000000", "10700000", "10710000", "10711000", "10711100", "100106"),
    7: ("10000000", "11000000", "11010000", "11011000", "11011100", "100107"),
    8: ("10000000", "10200000", "10210000", "10211000", "10211100", "100108"),
    9: ("10000000", None, None, None, None, None),
    10: ("30000000", "30300000", "30310000", "30311000", "30311100", "300110"),
    11: ("30000000", "30300000", "30320000", "30321000", "30321100", "300111"),
    12: ("30000000", "30100000", "30130000", "30131000", "30131100", "300112"),
    13: ("30000000", "30100000", "30140000", "30141000", "30141100", "300113"),
    14: ("30000000", "30400000", "30410000", "30411000", "30411100", "300114"),
    15: ("30000000", "30500000", "30510000", "30511000", "30511100", "300115"),
    16: ("35000000", "35000000", "35010000", "35011000", "35011100", "350116"),
    17: ("35000000", "35100000", "35110000", "35111000", "35111100", "350117"),
    18: ("10000000", "10300000", "10320000", "10321000", "10321100", "100118"),
    19: ("40000000", "40100000", "40110000", "40111000", "40111100", "400119"),
    20: ("40000000", "40200000", "40210000", "40211000", "40211100", "400120"),
    21: ("10000000", "10100000", "10110000", "10111000", "10111100", "100121"),
    22: ("10000000", "10900000", "10910000", "10911000", "10911100", "100122"),
    23: ("90000000", "90100000", "90110000", "90111000", "90111100", "913716"),
    24: ("80000000", "80100000", "80110000", "80111000", "80111100", "813714"),
    25: ("80000000", "80200000", "80210000", "80211000", "80211100", "813715"),
}
PL_LEVELS = {
    1: ("60000000", "60100000", "60110000", "60111000", "60111100", "600101"),
    2: ("60000000", "60100000", "60120000", "60121000", "60121100", "619021"),
    3: ("60000000", "60100000", "60140000", "60141000", "60141100", "600103"),
    4: ("60000000", "60100000", "60140000", "60141000", "60141200", "600104"),
    5: ("60000000", "60100000", "60130000", "60131000", "60131200", "600105"),
    6: ("60000000", "60100000", "60130000", "60131000", "60131300", "600106"),
    7: ("60000000", "60100000", "60150000", "60151000", "60151100", "713071"),
    8: ("60000000", "60200000", "60210000", "60211000", "60211100", "600108"),
    9: ("60000000", "60200000", "60230000", "60231000", "60231100", "600109"),
    10: ("60000000", "60200000", "60240000", "60241000", "60241100", "600110"),
    11: ("60000000", "60100000", "60161000", "60161100", "60161110", "600111"),
    12: ("60000000", "60200000", "60250000", "60251000", "60251100", "600112"),
    13: ("60000000", "60200000", "60260000", "60261000", "60261100", "642507"),
    14: ("60000000", "60200000", "60260000", "60262000", "60262100", "642508"),
    15: ("60000000", "60200000", "60260000", "60263000", "60263100", "642509"),
    16: ("60000000", "60200000", "60260000", "60264000", None, "728695"),
    17: ("60000000", "60100000", "60130000", "60132000", "60132100", "600117"),
    18: ("60000000", "60100000", "60130000", "60131000", "60131100", "600118"),
    19: ("60000000", "60100000", "60140000", "60142000", "60141300", "600119"),
    20: ("70000000", "70300000", "70310000", "70314000", "70314100", "700120"),
    21: ("70000000", "70300000", "70310000", "70311000", "70311100", "700121"),
    22: ("70000000", "70200000", "70210000", None, None, "700122"),
    23: ("77000000", "77100000", "77110000", "77111000", "77111100", "770123"),
    24: ("78000000", "78100000", "78110000", "78111000", "78111100", "780124"),
    25: ("79000000", "79100000", "79110000", "79111000", "79111100", "790125"),
}
# Domain -> levels 1, 2 and 4.
DOMAINS = {
    "11": ("100000", "120000", "511000"), "19": ("100000", "120000", "511100"),
    "50": ("100000", "120000", "511000"), "26": ("100000", "130000", "511000"),
    "12": ("200000", "120000", "512000"), "20": ("200000", "120000", "511200"),
    "51": ("200000", "130000", "512000"), "37": ("200000", "130000", "512000"),
    "14": ("400000", "120000", "513000"), "21": ("400000", "130000", "511300"),
    "52": ("400000", "120000", "513000"), "7": ("300000", "130000", "513000"),
}
DOMAINS_BY_STATUS = {"F": ["11", "19", "50", "26"], "O": ["12", "20", "51", "37"],
                     "P": ["14", "21", "52", "7"]}
ENTITIES = {"AFRICA": "620", "AMERICA": "200", "ASIA": "300", "EUROPE": "400", "MIDDLE EAST": "100"}
CURRENCY = {"AFRICA": "ZAR", "AMERICA": "USD", "ASIA": "INR", "EUROPE": "EUR", "MIDDLE EAST": "AED"}
SOURCES = ["T24", "TI", "OGL", "MM", "AEI"]
# Order priority -> product and its second level.
PRODUCTS = {
    "1-URGENT": ("21020", "00075"), "2-HIGH": ("9591", "01000"), "3-MEDIUM": ("30010", "00050"),
    "4-NOT SPECIFIED": ("30020", "00060"), "5-LOW": ("30030", "99999"),
}
# Market segment -> code, levels 1 and 2 of the segment, level 2 of its geography.
SEGMENTS = {
    "AUTOMOBILE": ("S1", "5000", "5005", "10105"), "BUILDING": ("S2", "7000", "5010", "10107"),
    "FURNITURE": ("S3", "6000", "5015", "20100"), "HOUSEHOLD": ("S4", "5000", "5020", "20300"),
    "MACHINERY": ("S5", "0009", "5099", "99999"),
}
# Department -> levels 1 to 4.
DEPARTMENTS = {
    "D0": ("100000", "100003", "100030", "103070"), "D1": ("100000", "100003", "100030", "103080"),
    "D2": ("100000", "100003", "100040", "103070"), "D3": ("100000", "100009", "100030", "103070"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BRAND = "CAST(substring(p_brand, 7) AS INT)"
# Account number from the brand; three brands carry the risk-weight accounts.
ACCOUNT = (
    f"CASE WHEN p_size % 2 = 0 THEN CASE {BRAND} WHEN 23 THEN '913716' WHEN 24 THEN '813714' "
    f"WHEN 25 THEN '813715' ELSE concat('1001', lpad({BRAND}, 2, '0')) END "
    f"ELSE concat('6001', lpad({BRAND}, 2, '0')) END"
)
ENTITY = case_of("r_name", ENTITIES)


def _nth(items: list[str], index: str) -> str:
    listed = ", ".join(f"'{i}'" for i in items)
    return f"element_at(array({listed}), CAST({index} + 1 AS INT))"


def period_end(grain: str) -> str:
    return "last_day(o_orderdate)" if grain == "month" else "make_date(year(o_orderdate), 12, 31)"


def raw_rows(spark: SparkSession, sf_dir: str, grain: str = "month", more: list[str] = ()) -> DataFrame:
    """One raw ledger row per order line, in the columns of the extract.

    ``row_id`` joins the line's own columns; no two lines of the test tables
    agree in all of them.
    """
    names = ("lineitem", "orders", "part", "customer", "nation", "region")
    line, order, part, cust, nation, region = (table(spark, sf_dir, n) for n in names)
    # The narrow orders take on their customer first, so that lines move once for the order.
    places = cust.join(nation, F.expr("c_nationkey = n_nationkey")).join(region, F.expr("n_regionkey = r_regionkey"))
    star = line.join(part, F.expr("l_partkey = p_partkey")).join(
        order.join(places, F.expr("o_custkey = c_custkey")), F.expr("l_orderkey = o_orderkey"))
    domain = " ".join(
        f"WHEN '{status}' THEN {_nth(ids, 'l_orderkey % 4')}" for status, ids in DOMAINS_BY_STATUS.items())
    end = period_end(grain)
    price, key = "l_extendedprice", "CAST(o_custkey AS STRING)"
    return star.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        f"CAST(rint({price} * 100) AS BIGINT)) AS row_id",
        "concat_ws('-', l_orderkey, l_linenumber) AS common_key",
        f"{ENTITY} AS entity",
        f"{case_of('l_returnflag', {'A': 'FINACT', 'N': 'MGTBGT', 'R': 'MGTACT'})} AS amount_class",
        f"CASE WHEN o_custkey % 7 = 0 THEN {key} WHEN o_custkey % 3 = 0 THEN concat('RB#', {key}) "
        f"ELSE concat('CB#', {key}) END AS customer_nr",
        f"{ACCOUNT} AS account_code",
        "CASE WHEN l_orderkey % 10 = 0 THEN '0000000' WHEN l_orderkey % 2 = 0 "
        "THEN concat(' LN#', l_orderkey) ELSE concat('DP#', l_orderkey) END AS deal_id",
        "concat('2101', o_custkey % 8) AS profit_centre",
        f"{case_of('o_orderpriority', {k: v[0] for k, v in PRODUCTS.items()})} AS element1",
        f"{_nth(SOURCES, 'o_custkey % 5')} AS element3",
        "concat('D', n_nationkey % 4) AS element4",
        f"{case_of('c_mktsegment', {k: v[0] for k, v in SEGMENTS.items()})} AS element7",
        f"{case_of('r_name', CURRENCY)} AS currency",
        f"CASE o_orderstatus {domain} END AS domain_id",
        f"CAST(year({end}) AS STRING) AS year", f"CAST(month({end}) AS STRING) AS month",
        f"concat('day ', date_format({end}, 'dd')) AS date_text",
        f"{rounded(f'{price} * (1 - l_discount) * (1 + l_tax)', 5)} AS mtd_ccy_amount",
        f"{rounded(f'{price} * (1 - l_discount)', 4)} AS mtd_lcl_amount",
        f"{price} AS mtd_rpt_amount",
        *[f"0D AS ytd_{c}_amount" for c in ("ccy", "lcl", "rpt")],
        f"{rounded(f'{price} * 2', 2)} AS ytd_ccy_amount_rebased",
        f"{rounded(f'{price} * (2 - l_discount)', 4)} AS ytd_lcl_amount_rebased",
        f"{rounded(f'{price} * (1 + l_tax)', 3)} AS ytd_rpt_amount_rebased",
        "l_quantity * 3 AS mtdab_ccy", "l_quantity * 2 - 2 AS mtdab_lcl", "l_quantity - 1 AS mtdab_rpt",
        "l_quantity * 4 AS ytdab_ccy", "l_quantity * 5 - 10 AS ytdab_lcl", "l_quantity + 1 AS ytdab_rpt",
        "l_quantity * 7 AS ltdab_ccy", "l_quantity * 8 AS ltdab_lcl", "l_quantity * 9 AS ltdab_rpt",
        *more,
    )


def ledger(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    """The ledger view: raw rows through the same projection the text ingest uses."""
    end = period_end(grain)
    key = f"year({end}) * 10000 + month({end}) * 100 + day({end}) AS time_key"
    return ingest.to_ledger(raw_rows(spark, sf_dir, grain, [key]))


def account_levels(spark: SparkSession) -> DataFrame:
    rows = [(flag, str(brand), *levels) for flag, table_ in (("BS", BS_LEVELS), ("PL", PL_LEVELS))
            for brand, levels in table_.items()]
    return literal_rows(spark, rows, ["flag", "brand", *[f"gl_account_levl{n}_code" for n in range(1, 7)]])


def gl_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part, so accounts repeat and must be collapsed."""
    match = f"brand = substring(p_brand, 7) AND flag = CASE WHEN p_size % 2 = 0 THEN 'BS' ELSE 'PL' END"
    return table(spark, sf_dir, "part").join(account_levels(spark), F.expr(match)).selectExpr(
        f"{ACCOUNT} AS gl_account_id",
        *[f"gl_account_levl{n}_code" for n in range(1, 7)],
        "p_type AS gl_account_levl1_desc",
        f"CASE WHEN {BRAND} <> 7 THEN p_name END AS gl_account_levl2_desc",
        "flag AS gl_pl_flag",
        f"CASE WHEN {BRAND} % 5 = 0 THEN 'Y' ELSE 'N' END AS is_internal_account",
        "p_name AS description", "p_type AS account_type")


def _rows(spark: SparkSession, mapping: dict, columns: list[str]) -> DataFrame:
    return literal_rows(spark, [(k, *v) for k, v in mapping.items()], columns)


def domain(spark: SparkSession) -> DataFrame:
    return _rows(spark, DOMAINS, ["domain_id", "l1_code", "l2_code", "l4_code"])


def profit_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier: centres repeat, and centre 21017 is missing."""
    supp, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return (
        supp.join(nation, F.expr("s_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr("concat('2101', s_suppkey % 7) AS profit_centre_cd", f"{ENTITY} AS entity")
    )


def legal_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        f"{ENTITY} AS legal_entity",
        f"CASE WHEN r_name = 'ASIA' THEN 'ASSOCIATE' ELSE '{GROUP}' END AS legal_entity_levl1_desc")


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One validity per order of a customer; they overlap, and some stay open."""
    start = "CAST(o_orderdate AS DATE)"
    return table(spark, sf_dir, "orders").selectExpr(
        "concat(' ', o_custkey, ' ') AS customer_number",
        "CASE WHEN o_custkey % 7 = 0 THEN 'NA' WHEN o_custkey % 3 = 0 THEN 'RB' ELSE 'CB' END AS banking_type",
        f"date_format({start}, 'yyyyMMdd') AS start_time_key",
        "CASE WHEN o_orderkey % 5 = 0 THEN '99991231' ELSE date_format("
        f"date_add({start}, CAST(o_orderkey % 700 + 30 AS INT)), 'yyyyMMdd') END AS end_time_key")


def contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One validity per order line; lines of sentinel orders share one contract."""
    start = "CAST(l_shipdate AS DATE)"
    end = f"date_add({start}, CAST(l_quantity * 20 AS INT))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 10 = 0 THEN '0000000' ELSE CAST(l_orderkey AS STRING) END AS contract_id",
        "CASE WHEN l_orderkey % 10 = 0 THEN 'NA' WHEN l_orderkey % 2 = 0 THEN 'LN' ELSE 'DP ' END AS banking_type",
        f"{_nth(SOURCES, 'l_linenumber % 5')} AS source_system",
        f"upper(date_format({start}, 'dd-MMM-yyyy')) AS start_validity_date",
        f"upper(date_format({end}, 'dd-MMM-yyyy')) AS end_validity_date")


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(
        gl_accounts=gl_accounts(spark, sf_dir),
        domain=domain(spark),
        legal_entity=legal_entity(spark, sf_dir),
        profit_centre=profit_centre(spark, sf_dir),
        department=_rows(spark, DEPARTMENTS, DIMENSION_COLUMNS["department"]),
        product=literal_rows(spark, list(PRODUCTS.values()), DIMENSION_COLUMNS["product"]),
        coverage_geography=literal_rows(
            spark, [(v[0], v[3]) for v in SEGMENTS.values()], DIMENSION_COLUMNS["coverage_geography"]),
        customer_segment=literal_rows(
            spark, [v[:3] for v in SEGMENTS.values()], DIMENSION_COLUMNS["customer_segment"]),
        customer=customer_versions(spark, sf_dir),
        contracts=contract_versions(spark, sf_dir),
    )
