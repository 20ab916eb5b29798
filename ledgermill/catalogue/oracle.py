"""The same results stated in SQL, for a second engine to check.

Amounts are added as DECIMAL(38, 6). Statement lines are a UNION ALL of
filtered roll-ups, tags a join with a distinct set, comparatives three joins
and anchors a window: other ways to the results than the ones the jobs take.
"""

from __future__ import annotations

from .. import chart, schemas, testmap
from ..operators import measures
from ..operators.lines import LINE_MEASURES
from ..operators.rollup import CUSTOMER_MEASURES, CUSTOMER_RENAMES, GL_MEASURES, GL_RENAMES
from ..sources.placeholder import PLACEHOLDER_KEYS

KEYS = ", ".join([*schemas.DEAL_KEYS, "time_key"])
RELOADED = f"CASE WHEN amount_class = 'MGTBGT' AND time_key // 10000 = {testmap.RELOADED_YEAR} THEN 2 ELSE 1 END"


def sum_amount(expression: str, alias: str | None = None) -> str:
    text = f"CAST(SUM(CAST({expression} AS DECIMAL(38, 6))) AS DOUBLE)"
    return f"{text} AS {alias}" if alias else text


def sum_ratio(x: str, alias: str) -> str:
    return (f"CAST(SUM(CAST(floor({x}) AS BIGINT)) AS DOUBLE) + CAST(SUM(CAST(round_even(({x} - floor({x})) "
            f"* 1000000000, 0) AS BIGINT)) AS DOUBLE) / 1000000000 AS {alias}")


def sums(names: list[str]) -> str:
    return ", ".join(sum_ratio(n, n) if n in schemas.MARGINS else sum_amount(n, n) for n in names)


def values(rows: list[tuple]) -> str:
    quote = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(quote(v) for v in r) + ")" for r in rows)


def case(column: str, mapping: dict) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def rounded(x: str, digits: int) -> str:
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


# -- test map -----------------------------------------------------------------------
BRAND = "CAST(substr(p_brand, 7) AS INT)"
ACCOUNT = (
    "CASE WHEN p_size % 2 = 0 THEN CASE " + BRAND + " WHEN 23 THEN '913716' WHEN 24 THEN '813714' "
    "WHEN 25 THEN '813715' ELSE '1001' || lpad(CAST(" + BRAND + " AS VARCHAR), 2, '0') END "
    "ELSE '6001' || lpad(CAST(" + BRAND + " AS VARCHAR), 2, '0') END"
)
LEVELS = [("BS", b, *v) for b, v in testmap.BS_LEVELS.items()] + [
    ("PL", b, *v) for b, v in testmap.PL_LEVELS.items()]
LEVEL_NAMES = [f"gl_account_levl{n}_code" for n in range(1, 7)]

ACCOUNTS = f"""
levels(flag, brand, {", ".join(LEVEL_NAMES)}) AS ({values(LEVELS)}),
acc_rows AS (
  SELECT {ACCOUNT} AS gl_account_id, {", ".join("v." + n for n in LEVEL_NAMES)},
    p_type AS gl_account_levl1_desc,
    CASE WHEN {BRAND} = 7 THEN NULL ELSE p_name END AS gl_account_levl2_desc,
    CASE WHEN p_size % 2 = 0 THEN 'BS' ELSE 'PL' END AS gl_pl_flag,
    CASE WHEN {BRAND} % 5 = 0 THEN 'Y' ELSE 'N' END AS is_internal_account,
    p_name AS description, p_type AS account_type
  FROM part JOIN levels v ON v.brand = {BRAND} AND v.flag = CASE WHEN p_size % 2 = 0 THEN 'BS' ELSE 'PL' END),
acc AS (
  SELECT gl_account_id, {", ".join(f"max({c}) AS {c}" for c in [
      *LEVEL_NAMES, "gl_account_levl1_desc", "gl_account_levl2_desc", "gl_pl_flag",
      "is_internal_account", "description", "account_type"])}
  FROM acc_rows GROUP BY gl_account_id)"""

PERIOD_END = {
    "month": "last_day(o_orderdate)",
    "year": "make_date(CAST(year(o_orderdate) AS INT), 12, 31)",
}
DOMAIN_OF = "CASE o_orderstatus " + " ".join(
    f"WHEN '{s}' THEN CASE l_orderkey % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(ids)) + " END"
    for s, ids in testmap.DOMAINS_BY_STATUS.items()) + " END"
SOURCE_OF = "CASE {0} % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(testmap.SOURCES)) + " END"


def raw(grain: str = "month") -> str:
    zero = ", ".join(f"CAST(0 AS DOUBLE) AS ytd_{c}_amount" for c in ("ccy", "lcl", "rpt"))
    return f"""
raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS row_id,
    concat_ws('-', l_orderkey, l_linenumber) AS common_key,
    {case("r_name", testmap.ENTITIES)} AS entity,
    {case("l_returnflag", {"A": "FINACT", "N": "MGTBGT", "R": "MGTACT"})} AS amount_class,
    CASE WHEN o_custkey % 7 = 0 THEN CAST(o_custkey AS VARCHAR)
         WHEN o_custkey % 3 = 0 THEN 'RB#' || o_custkey ELSE 'CB#' || o_custkey END AS customer_nr,
    {ACCOUNT} AS account_code,
    CASE WHEN l_orderkey % 10 = 0 THEN '0000000'
         WHEN l_orderkey % 2 = 0 THEN ' LN#' || l_orderkey ELSE 'DP#' || l_orderkey END AS deal_id,
    '2101' || CAST(o_custkey % 8 AS VARCHAR) AS profit_centre,
    {case("o_orderpriority", {k: v[0] for k, v in testmap.PRODUCTS.items()})} AS element1,
    {SOURCE_OF.format("o_custkey")} AS element3,
    'D' || CAST(n_nationkey % 4 AS VARCHAR) AS element4,
    {case("c_mktsegment", {k: v[0] for k, v in testmap.SEGMENTS.items()})} AS element7,
    {case("r_name", testmap.CURRENCY)} AS currency,
    {DOMAIN_OF} AS domain_id,
    CAST(strftime({PERIOD_END[grain]}, '%Y%m%d') AS INT) AS time_key,
    {rounded("l_extendedprice * (1 - l_discount) * (1 + l_tax)", 5)} AS mtd_ccy_amount,
    {rounded("l_extendedprice * (1 - l_discount)", 4)} AS mtd_lcl_amount,
    l_extendedprice AS mtd_rpt_amount, {zero},
    {rounded("l_extendedprice * 2", 2)} AS ytd_ccy_amount_rebased,
    {rounded("l_extendedprice * (2 - l_discount)", 4)} AS ytd_lcl_amount_rebased,
    {rounded("l_extendedprice * (1 + l_tax)", 3)} AS ytd_rpt_amount_rebased,
    l_quantity * 3 AS mtdab_ccy, l_quantity * 2 - 2 AS mtdab_lcl, l_quantity - 1 AS mtdab_rpt,
    l_quantity * 4 AS ytdab_ccy, l_quantity * 5 - 10 AS ytdab_lcl, l_quantity + 1 AS ytdab_rpt,
    l_quantity * 7 AS ltdab_ccy, l_quantity * 8 AS ltdab_lcl, l_quantity * 9 AS ltdab_rpt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def ledger(grain: str = "month", factor: str = "1") -> str:
    split = "CASE WHEN instr({0}, '#') > 0 THEN trim(substr({0}, 1, instr({0}, '#') - 1)) ELSE 'NA' END"
    amounts = []
    for source, name in (("ccy", "acy"), ("lcl", "lcy"), ("rpt", "aed")):
        amounts.append(f"mtd_{source}_amount * {factor} AS outstanding_balance_mtd_{name}")
        amounts.append(f"ytd_{source}_amount_rebased * {factor} AS outstanding_balance_ytd_{name}")
        amounts += [f"{h}ab_{source} AS avg_book_bal_{h}_{name}" for h in ("mtd", "ytd", "ltd")]
    return raw(grain) + f""",
led AS (
  SELECT row_id, time_key, common_key, amount_class, entity AS legal_entity,
    {split.format("customer_nr")} AS banking_type_customer,
    substr(customer_nr, instr(customer_nr, '#') + 1) AS customer_number,
    account_code AS gl_account_id, {split.format("deal_id")} AS banking_type,
    substr(deal_id, instr(deal_id, '#') + 1) AS contract_id, profit_centre,
    element1 AS category_code, element3 AS source_system_id, element4 AS final_segment,
    element7 AS customer_segment_code, currency AS currency_code, domain_id, {", ".join(amounts)}
  FROM raw)"""


DOMAIN = f"dom(domain_id, l1_code, l2_code, l4_code) AS ({values([(k, *v) for k, v in testmap.DOMAINS.items()])})"
CENTRE = f"""centre AS (
  SELECT DISTINCT '2101' || CAST(s_suppkey % 7 AS VARCHAR) AS profit_centre_cd,
    {case("r_name", testmap.ENTITIES)} AS entity
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
ENTITY = f"""ent AS (
  SELECT {case("r_name", testmap.ENTITIES)} AS legal_entity,
    CASE WHEN r_name = 'ASIA' THEN 'ASSOCIATE' ELSE 'GROUP' END AS legal_entity_levl1_desc FROM region)"""
OTHER_DIMS = f"""
prod(prod_code, prod_l2_code) AS ({values(list(testmap.PRODUCTS.values()))}),
geo(coverage_geography, geo_l2_code) AS ({values([(v[0], v[3]) for v in testmap.SEGMENTS.values()])}),
seg(seg_code, seg_l1_code, seg_l2_code) AS ({values([v[:3] for v in testmap.SEGMENTS.values()])}),
dept(dept_id, dept_l1_code, dept_l2_code, dept_l3_code, dept_l4_code) AS
  ({values([(k, *v) for k, v in testmap.DEPARTMENTS.items()])})"""
CUSTOMERS = """cust AS (
  SELECT ' ' || CAST(o_custkey AS VARCHAR) || ' ' AS customer_number,
    CASE WHEN o_custkey % 7 = 0 THEN 'NA' WHEN o_custkey % 3 = 0 THEN 'RB' ELSE 'CB' END AS banking_type,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS start_time_key,
    CASE WHEN o_orderkey % 5 = 0 THEN 99991231 ELSE CAST(strftime(CAST(o_orderdate AS DATE)
      + CAST(o_orderkey % 700 + 30 AS INT), '%Y%m%d') AS INT) END AS end_time_key
  FROM orders)"""
CONTRACTS = f"""deal AS (
  SELECT CASE WHEN l_orderkey % 10 = 0 THEN '0000000' ELSE CAST(l_orderkey AS VARCHAR) END AS contract_id,
    CASE WHEN l_orderkey % 10 = 0 THEN 'NA' WHEN l_orderkey % 2 = 0 THEN 'LN' ELSE 'DP' END AS banking_type,
    {SOURCE_OF.format("l_linenumber")} AS source_system,
    CAST(l_shipdate AS DATE) AS from_date,
    CAST(l_shipdate AS DATE) + CAST(l_quantity * 20 AS INT) AS to_date
  FROM lineitem)"""
PERIODS = "per AS (SELECT DISTINCT time_key FROM led)"


def classified(grain: str = "month", factor: str = "1") -> str:
    chosen = ", ".join(
        f"CASE WHEN acc.gl_pl_flag = 'BS' THEN led.outstanding_balance_ytd_{c} "
        f"ELSE led.outstanding_balance_mtd_{c} END AS outstanding_balance_mtd_{c}" for c in schemas.CURRENCIES)
    kept = ", ".join(
        ["row_id", *schemas.DEAL_KEYS, "time_key", "common_key", "led.gl_account_id", *schemas.AVERAGES]
        + [f"outstanding_balance_ytd_{c}" for c in schemas.CURRENCIES])
    raw_mtd = ", ".join(f"led.outstanding_balance_mtd_{c} AS mtd_{c}" for c in schemas.CURRENCIES)
    return ledger(grain, factor) + "," + ACCOUNTS + f""",
cls AS (
  SELECT {kept}, acc.gl_account_levl2_desc AS balance_sheet_type, acc.gl_pl_flag AS bs_pl_flag,
    acc.is_internal_account, {raw_mtd}, {chosen}
  FROM led LEFT JOIN acc ON led.gl_account_id = acc.gl_account_id)"""


PIVOTED = [(measures.measure_name(m, b), c, a) for b, a in chart.BASES.items() for m, c in chart.MEASURES]


def derived_terms(name: str, basis: str) -> str:
    """The derivation spelled out in base measures."""
    known = dict(chart.DERIVED)
    return " + ".join(
        derived_terms(t, basis) if t in known else measures.measure_name(t, basis) for t in known[name])


DERIVED = [(measures.measure_name(n, b), derived_terms(n, b)) for b in chart.BASES for n, _ in chart.DERIVED]


def deal_totals() -> str:
    pivots = ", ".join(f"SUM(CAST(CASE WHEN {c} THEN {a} ELSE 0 END AS DECIMAL(38, 6))) AS {n}"
                       for n, c, a in PIVOTED)
    out = ", ".join([f"CAST({n} AS DOUBLE) AS {n}" for n, _, _ in PIVOTED]
                    + [f"CAST({t} AS DOUBLE) AS {n}" for n, t in DERIVED])
    return f"""{DOMAIN},
plq AS (
  SELECT {KEYS}, {pivots} FROM cls JOIN acc ON cls.gl_account_id = acc.gl_account_id
  WHERE bs_pl_flag = 'PL' AND domain_id IN (SELECT domain_id FROM dom WHERE {chart.MEASURE_SCOPE})
  GROUP BY {KEYS}),
pl AS (SELECT {KEYS}, {out} FROM plq)"""


RANKED = f"""
bsr AS (
  SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY outstanding_balance_mtd_aed,
    gl_account_id, common_key, row_id) AS place_in_deal,
    count(*) OVER (PARTITION BY {KEYS}) AS deal_rows
  FROM cls WHERE bs_pl_flag = 'BS')"""
ALL_MEASURES = measures.all_measures()


def base(grain: str = "month", factor: str = "1") -> str:
    keys = [*schemas.DEAL_KEYS, "time_key"]
    on = " AND ".join(f"bsr.{k} = pl.{k}" for k in keys)
    merged_keys = ", ".join(f"coalesce(bsr.{k}, pl.{k}) AS {k}" for k in keys)
    day = "strptime(CAST(coalesce(bsr.time_key, pl.time_key) AS VARCHAR), '%Y%m%d')"
    margins = []
    for basis in chart.BASES:
        b = basis or "_mtd_aed"
        days = f"day(last_day({day}))" if b.startswith("_mtd") else f"dayofyear({day})"
        margins.append(
            f"coalesce((net_interest_income{basis} / CASE WHEN avg_book_bal{b} = 0 THEN 1 ELSE avg_book_bal{b} END)"
            f" * (CAST(365 AS DOUBLE) / {days}), 0) AS net_int_margin{basis}")
    zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in [*schemas.BALANCES, *ALL_MEASURES])
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in [*ALL_MEASURES, *schemas.MARGINS])
    return classified(grain, factor) + "," + RANKED + "," + deal_totals() + f""",
base AS (
  SELECT {merged_keys}, coalesce(gl_account_id, '999999') AS gl_account_id,
    coalesce(common_key, '0') AS common_key, 'BS' AS bs_pl_flag,
    coalesce(balance_sheet_type, 'BS-PL INSERT') AS balance_sheet_type,
    coalesce(is_internal_account, '999999') AS is_internal_account, {zeros}, {", ".join(margins)}
  FROM bsr FULL OUTER JOIN pl ON {on} AND place_in_deal = 1
  UNION ALL BY NAME
  SELECT {KEYS}, gl_account_id, common_key, bs_pl_flag, balance_sheet_type, is_internal_account,
    {", ".join(schemas.BALANCES)}, {nulls}
  FROM cls WHERE bs_pl_flag = 'PL')"""


def risk(source: str) -> str:
    parts = []
    for name, (code, account) in chart.RWA_CLASSES.items():
        parts.append(
            f"CASE WHEN dom.l4_code = '{code}' OR (dom.domain_id IN ('50', '51', '52') AND "
            f"acc.gl_account_id = '{account}') THEN outstanding_balance_mtd_aed ELSE 0 END AS {name}")
    return f"""
risk AS (
  SELECT q.*, rwa_credit_risk + rwa_market_risk + rwa_operational_risk AS rwa_total FROM (
    SELECT {source}.*, dom.l1_code AS dom_l1, {", ".join(parts)}
    FROM {source} LEFT JOIN dom ON {source}.domain_id = dom.domain_id
    LEFT JOIN acc ON {source}.gl_account_id = acc.gl_account_id) q)"""


def scenarios() -> dict[str, str]:
    found = {}
    for b in ("mtd_aed", "mtd_lcy", "ytd_aed", "ytd_lcy"):
        for s, code in (("actual", "100000"), ("budget", "200000")):
            found[f"{b}_{s}"] = f"CASE WHEN dom_l1 = '{code}' THEN outstanding_balance_{b} ELSE 0 END"
        found[f"cy_ed_budget_{b}"] = f"CASE WHEN dom_l1 = '400000' THEN outstanding_balance_{b} ELSE 0 END"
    return found


def gl(grain: str = "month", factor: str = "1") -> str:
    special = {**scenarios(), **GL_RENAMES,
               "ytd_aed": "coalesce(outstanding_balance_ytd_aed, 0)",
               "ytd_lcy": "coalesce(outstanding_balance_ytd_lcy, 0)"}
    keys = ", ".join([*schemas.GL_KEYS, "time_key"])
    inner = ", ".join(f"{special.get(n, n)} AS {n}" for n in GL_MEASURES)
    return base(grain, factor) + "," + risk("base") + f""",
gl AS MATERIALIZED (SELECT {keys}, {sums(GL_MEASURES)} FROM (SELECT {keys}, {inner} FROM risk) GROUP BY {keys})"""


def prior_key(column: str, months: int) -> str:
    return (f"CAST(strftime(last_day(strptime(CAST({column} AS VARCHAR), '%Y%m%d') - INTERVAL {months} MONTH), "
            "'%Y%m%d') AS INT)")


def comparatives(source: str, keys: list[str], carried: str) -> str:
    on = lambda t, m: " AND ".join([f"a.{k} = {t}.{k}" for k in keys] + [
        f"{t}.time_key = {prior_key('a.time_key', m)}"])
    return f"""SELECT {carried},
    coalesce(y.ytd_aed_actual, 0) AS prev_yr_curr_mth_ytd_aed, coalesce(y.ytd_lcy_actual, 0) AS prev_yr_curr_mth_ytd_lcy,
    coalesce(b.mtd_aed_actual, 0) AS prev_mth1_mtd_aed, coalesce(b.mtd_lcy_actual, 0) AS prev_mth1_mtd_lcy,
    coalesce(c.mtd_aed_actual, 0) AS prev_mth2_mtd_aed, coalesce(c.mtd_lcy_actual, 0) AS prev_mth2_mtd_lcy
  FROM {source} a LEFT JOIN {source} b ON {on("b", 1)} LEFT JOIN {source} c ON {on("c", 2)}
  LEFT JOIN {source} y ON {on("y", 12)}"""


def compared(grain: str = "month", factor: str = "1") -> str:
    return gl(grain, factor) + f""",
cmp AS MATERIALIZED ({comparatives("gl", schemas.GL_KEYS, "a.*")})"""


def tag_set(source: str) -> str:
    keys = ", ".join(f"{k}" for k in [*schemas.TAG_KEYS, "time_key"])
    cascades = ", ".join(
        "CASE " + " ".join(f"WHEN {c} THEN '{label}'" for c, label in rules) + f" END AS {tag}"
        for tag, rules in chart.TAG_RULES.items())
    return f"""{OTHER_DIMS}, {ENTITY},
starred AS (
  SELECT {", ".join(f"g.{k}" for k in [*schemas.TAG_KEYS, "time_key"])}, geo_l2_code, dom.l2_code AS dom_l2_code, prod_code, prod_l2_code,
    acc.gl_account_levl1_code AS acc_l1_code, acc.gl_account_levl2_code AS acc_l2_code,
    acc.gl_account_levl3_code AS acc_l3_code, acc.gl_account_levl6_code AS acc_l6_code,
    dept_l1_code, dept_l2_code, dept_l3_code, dept_l4_code, seg_l1_code, seg_l2_code
  FROM {source} g JOIN geo ON g.customer_segment_code = geo.coverage_geography
  JOIN dom ON dom.domain_id = g.domain_id JOIN prod ON prod.prod_code = g.category_code
  JOIN ent ON ent.legal_entity = g.legal_entity JOIN acc ON acc.gl_account_id = g.gl_account_id
  JOIN dept ON dept.dept_id = g.final_segment JOIN seg ON seg.seg_code = g.customer_segment_code),
tagset AS (SELECT DISTINCT {keys}, {cascades} FROM starred WHERE {chart.TAG_ELIGIBLE})"""


def tagged(source: str, carried: str) -> str:
    on = " AND ".join(f"a.{k} = t.{k}" for k in [*schemas.TAG_KEYS, "time_key"])
    return (f"SELECT {carried}, t.gm_stmt_derivatives, t.gm_other "
            f"FROM {source} a LEFT JOIN tagset t ON {on}")


def line_blocks(by_source: bool = False) -> str:
    """One filtered roll-up per line."""
    keys = [*schemas.LINE_KEYS] + (["source_system_id"] if by_source else [])
    blocks = []
    for line, (_, joins, condition) in chart.STATEMENT_LINES.items():
        joined = "cmp"
        if "account" in joins:
            joined += " JOIN (SELECT * EXCLUDE (is_internal_account) FROM acc) b USING (gl_account_id)"
        if "centre" in joins:
            joined += " JOIN (SELECT DISTINCT profit_centre_cd FROM centre) c ON cmp.profit_centre = c.profit_centre_cd"
        if "centre_entity" in joins:
            joined += " JOIN centre c ON cmp.profit_centre = c.profit_centre_cd AND cmp.legal_entity = c.entity"
        hidden = "" if by_source else "CAST(NULL AS VARCHAR) AS source_system_id, "
        blocks.append(f"""SELECT {", ".join(keys)}, '-{line}' AS gl_account_id, 'TOTAL LINES' AS dataset, {hidden}
    CAST(NULL AS VARCHAR) AS banking_type_customer, CAST(NULL AS VARCHAR) AS currency_code,
    CAST(NULL AS VARCHAR) AS gm_stmt_derivatives, CAST(NULL AS VARCHAR) AS gm_other, {sums(LINE_MEASURES)}
  FROM {joined} WHERE {condition} GROUP BY {", ".join(keys)}""")
    return "\n  UNION ALL BY NAME ".join(blocks)


def gl_fact(grain: str = "month", factor: str = "1") -> str:
    return compared(grain, factor) + ", " + CENTRE + "," + tag_set("cmp") + f""",
fact AS (
  {tagged("cmp", "a.*, 'BASE' AS dataset")}
  UNION ALL BY NAME {line_blocks()})"""


VALID_CUSTOMERS = f"""{CUSTOMERS}, {PERIODS},
lc AS (
  SELECT * FROM (
    SELECT trim(customer_number) AS cust_key, trim(banking_type) AS cust_type_key, time_key,
      start_time_key AS cust_start_time_key, end_time_key AS cust_end_time_key,
      customer_number AS cust_number, banking_type AS cust_banking_type,
      row_number() OVER (PARTITION BY trim(customer_number), trim(banking_type), time_key
        ORDER BY start_time_key DESC, end_time_key DESC, customer_number DESC) AS rn
    FROM cust JOIN per ON per.time_key BETWEEN start_time_key AND end_time_key) WHERE rn = 1)"""
DEAL_KEY = "CAST(strftime({0}, '%Y%m%d') AS INT)"
VALID_CONTRACTS = f"""{CONTRACTS},
dv AS (
  SELECT contract_id AS deal_key, banking_type AS deal_type_key, source_system, time_key,
    {DEAL_KEY.format("from_date")} AS deal_start_key, {DEAL_KEY.format("to_date")} AS deal_end_key,
    upper(strftime(from_date, '%d-%b-%Y')) AS deal_start_validity_date,
    upper(strftime(to_date, '%d-%b-%Y')) AS deal_end_validity_date
  FROM deal JOIN per ON per.time_key BETWEEN {DEAL_KEY.format("from_date")} AND {DEAL_KEY.format("to_date")}),
routed AS (
  SELECT *, '*' AS deal_route FROM dv
  UNION ALL SELECT *, source_system AS deal_route FROM dv WHERE deal_key = '0000000'),
ld AS (
  SELECT deal_key, deal_type_key, deal_route, time_key, deal_start_key, deal_end_key,
    deal_start_validity_date, deal_end_validity_date FROM (
    SELECT *, row_number() OVER (PARTITION BY deal_key, deal_type_key, deal_route, time_key
      ORDER BY deal_start_key DESC, deal_end_key DESC, deal_start_validity_date DESC) AS rn FROM routed)
  WHERE rn = 1)"""


def with_contracts(source: str) -> str:
    """Two branches by sentinel, as the routes are defined."""
    return f"""
wc AS (
  SELECT a.*, d.* EXCLUDE (time_key) FROM {source} a LEFT JOIN ld d ON trim(a.contract_id) = d.deal_key
    AND trim(a.banking_type) = d.deal_type_key AND trim(a.source_system_id) = d.deal_route
    AND a.time_key = d.time_key
  WHERE a.contract_id = '0000000'
  UNION ALL
  SELECT a.*, d.* EXCLUDE (time_key) FROM {source} a LEFT JOIN ld d ON trim(a.contract_id) = d.deal_key
    AND trim(a.banking_type) = d.deal_type_key AND d.deal_route = '*' AND a.time_key = d.time_key
  WHERE a.contract_id <> '0000000')"""


def trial() -> str:
    rows = ", ".join([
        "common_key", "base.time_key", "source_system_id", "customer_number",
        "coalesce(contract_id, '0000000') AS contract_id", "category_code", "currency_code", "banking_type",
        "gl_account_id", "base.legal_entity", "profit_centre", "balance_sheet_type", "bs_pl_flag",
        "final_segment", "customer_segment_code", "domain_id", "is_internal_account",
        "banking_type_customer", "amount_class", *[f"coalesce({c}, 0) AS {c}" for c in schemas.BALANCES]])
    return base() + "," + ENTITY + "," + VALID_CUSTOMERS + "," + VALID_CONTRACTS + f""",
tb AS (
  SELECT {rows}, cust_start_time_key, cust_end_time_key, cust_number, cust_banking_type
  FROM base JOIN ent ON ent.legal_entity = base.legal_entity AND legal_entity_levl1_desc = 'GROUP'
  LEFT JOIN lc ON cust_key = trim(customer_number) AND cust_type_key = trim(banking_type_customer)
    AND lc.time_key = base.time_key
  WHERE balance_sheet_type <> 'BS-PL INSERT'),""" + with_contracts("tb")


def store_facts(factor: object = 1) -> str:
    return (f"SELECT time_key, amount_class, substr(domain_id, 1, 1) AS domain_id, "
            f"outstanding_balance_mtd_aed * {factor} AS mtd_aed FROM led")


def statements() -> dict[str, str]:
    """Query name -> SQL."""
    month, year = "WITH " + ledger(), "WITH " + ledger("year")
    cls = "WITH " + classified()
    amount = sum_amount("outstanding_balance_mtd_aed", "outstanding_balance_mtd_aed")
    n = "count(*) AS n_rows"
    mtd = sum_amount("mtd_aed", "mtd_aed")
    out: dict[str, str] = {}

    out["ingest_ledger_keys"] = f"WITH {raw()} SELECT {', '.join(schemas.EXTRACT_KEYS)}, time_key FROM raw"
    out["ingest_ledger_amounts"] = f"WITH {raw()} SELECT row_id, {', '.join(schemas.EXTRACT_AMOUNTS)} FROM raw"
    out["ingest_period_key"] = f"WITH {raw()} SELECT time_key, {n} FROM raw GROUP BY time_key"
    out["ingest_row_id_check"] = (
        f"WITH {raw()}, ids AS (SELECT row_id, count(*) AS n FROM raw GROUP BY row_id) "
        "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_row_ids, count(*) FILTER (n > 1) AS n_repeated_ids "
        "FROM ids")
    out["dim_scan"] = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, p_type FROM part"
    out["dim_collapse"] = f"WITH {ACCOUNTS} SELECT * FROM acc"

    def by_version(rows: str, extra: str = "") -> str:
        keys = "time_key, version_id" + (f", {extra}" if extra else "")
        return f"{year} SELECT {keys}, {n}, {mtd} FROM ({rows}) GROUP BY {keys}"

    def version(v: int, flag: str, factor: object = None, where: str = "true") -> str:
        return (f"SELECT *, CAST({v} AS INT) AS version_id, '{flag}' AS last_refresh_flag "
                f"FROM ({store_facts(v if factor is None else factor)}) WHERE {where}")

    def union(*parts: str) -> str:
        return " UNION ALL ".join(parts)

    even, odd = "(time_key // 10000) % 2 = 0", "(time_key // 10000) % 2 = 1"
    out["store_write"] = by_version(version(1, "Y"), "last_refresh_flag, amount_class, domain_id")
    out["store_publish_version"] = by_version(
        union(version(1, "N"), version(2, "N"), version(3, "Y")), "last_refresh_flag, amount_class")
    out["store_read_latest"] = by_version(
        union(version(2, "Y", where=even), version(1, "Y", where=odd)), "amount_class")
    out["store_read_version"] = by_version(
        version(1, "N", where="amount_class = 'MGTBGT'"), "amount_class, domain_id")
    out["store_read_optional"] = by_version(version(
        1, "Y", where="time_key IN (SELECT time_key - 10000 FROM led)"))
    out["store_current_version"] = (
        f"{year} SELECT DISTINCT time_key, CAST(CASE WHEN {even} THEN 2 ELSE 1 END AS INT) AS version_id FROM led")
    out["store_overwrite_period"] = by_version(union(
        version(1, "Y", 5, even), version(1, "N", 1, odd), version(2, "Y", 2, odd)), "last_refresh_flag")
    out["store_replace_class"] = by_version(union(
        version(1, "N"), version(2, "Y", where="amount_class <> 'MGTBGT'"),
        version(2, "Y", 10, "amount_class = 'MGTBGT' AND domain_id <> '5'")),
        "last_refresh_flag, amount_class, domain_id")
    out["store_retention"] = by_version(
        union(*[version(v, "Y" if v == 7 else "N") for v in range(3, 8)]), "last_refresh_flag")
    fixed = ", ".join(f"'{v}' AS {k}" for k, v in PLACEHOLDER_KEYS.items())
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS {m}" for m in LINE_MEASURES)
    out["placeholder_dataset"] = (
        f"{month}, {PERIODS} SELECT amount_class, {fixed}, {zeros}, time_key, 'Y' AS last_refresh_flag, "
        "CAST(1 AS INT) AS version_id FROM per CROSS JOIN (VALUES ('MGTBGT'), ('MGTACT'), ('FINACT')) c(amount_class)")

    out["split_composite_code"] = (
        "WITH q AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN CAST(c_custkey AS VARCHAR) "
        "WHEN 1 THEN '#' || c_custkey WHEN 2 THEN ' a #b#' || c_custkey WHEN 3 THEN NULL "
        "ELSE c_mktsegment || '#' || c_custkey END AS code FROM customer) "
        "SELECT c_custkey, CASE WHEN instr(code, '#') > 0 THEN trim(substr(code, 1, instr(code, '#') - 1)) "
        "ELSE 'NA' END AS code_type, substr(code, instr(code, '#') + 1) AS code_id FROM q")
    out["derived_keys"] = (
        "SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 THEN c_name || c_mktsegment || c_nationkey END "
        "AS customer_key, CAST(c_custkey AS VARCHAR) || CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey ELSE 0 END "
        "AS defaulted_key FROM customer")
    out["select_balance"] = (
        f"{cls} SELECT time_key, bs_pl_flag, {n}, {sums([*schemas.RAW_MTD, *schemas.OUTSTANDING])} "
        "FROM cls GROUP BY ALL")
    split = ", ".join(sum_amount(e, a) for a, e in scenarios().items())
    out["scenario_split"] = (
        f"{month}, {DOMAIN} SELECT time_key, domain_id, {split} FROM (SELECT led.*, dom.l1_code AS dom_l1 "
        "FROM led LEFT JOIN dom USING (domain_id)) GROUP BY ALL")
    risky = f"{month}, {ACCOUNTS}, {DOMAIN}, {risk('led')}"
    out["rwa_classify"] = f"{risky} SELECT domain_id, gl_account_id, {sums(list(chart.RWA_CLASSES))} FROM risk GROUP BY ALL"
    out["rwa_total"] = f"{risky} SELECT time_key, legal_entity, {sums(['rwa_total'])} FROM risk GROUP BY ALL"
    out["null_defaults"] = (
        f"{month} SELECT CASE WHEN category_code = '30030' THEN '00000' ELSE category_code END AS category_code, "
        f"contract_id = '0000000' AS no_contract, {n}, "
        + sum_amount("CASE WHEN avg_book_bal_mtd_aed = 0 THEN 1.5 ELSE avg_book_bal_mtd_aed END",
                     "avg_book_bal_mtd_aed") + " FROM led GROUP BY ALL")
    out["reshape_projection"] = (
        f"{month} SELECT final_segment AS department_id, category_code AS product_code, "
        "profit_centre AS profit_centre_cd, "
        + sum_amount("outstanding_balance_mtd_aed", "outstanding_balance_mtd") + ", "
        + sum_amount("outstanding_balance_ytd_aed", "outstanding_balance_ytd") + ", "
        + sum_amount("avg_book_bal_mtd_aed", "avg_book_bal") + ", "
        + sum_amount("avg_book_bal_ytd_lcy", "avg_book_bal_ytd_lcy") + " FROM led GROUP BY ALL")
    out["constant_tags"] = (
        f"{month} SELECT domain_id, 'BASE' AS dataset, CAST(3 AS INT) AS version_id, 'Y' AS last_refresh_flag, "
        f"'BS' AS bs_pl_flag, {n} FROM led GROUP BY domain_id")
    out["schema_padding"] = (
        f"{cls} SELECT time_key, bs_pl_flag, {n}, count(net_pl) AS n_net_pl, {sums(['mtd_aed', 'net_pl'])} FROM "
        "(SELECT time_key, bs_pl_flag, mtd_aed, mtd_lcy AS net_pl FROM cls WHERE bs_pl_flag = 'BS' "
        "UNION ALL SELECT time_key, bs_pl_flag, mtd_aed, NULL FROM cls WHERE bs_pl_flag = 'PL') GROUP BY ALL")
    out["scope_filters"] = (
        f"{cls} SELECT legal_entity, count(*) FILTER (bs_pl_flag = 'BS') AS n_balance, "
        "count(*) FILTER (balance_sheet_type <> 'BS-PL INSERT') AS n_typed, "
        "count(*) FILTER (domain_id IN ('19', '20', '21')) AS n_risk, "
        "count(*) FILTER (gl_account_id NOT IN ('913716', '813714', '813715')) AS n_not_risk, "
        "count(*) FILTER (gl_account_id NOT LIKE '1%') AS n_not_total FROM cls GROUP BY legal_entity")
    starred = f"{cls}, {DOMAIN}, {tag_set('cls')}"
    out["eligibility_filter"] = (
        f"{starred} SELECT domain_id, customer_segment_code, final_segment, {n}, {amount} FROM starred "
        f"WHERE {chart.TAG_ELIGIBLE} GROUP BY ALL")
    out["star_join"] = (
        f"{starred} SELECT geo_l2_code, dom_l2_code, prod_l2_code, acc_l1_code, dept_l4_code, seg_l1_code, "
        f"{n}, {amount} FROM starred GROUP BY ALL")
    pl_join = "FROM cls JOIN acc ON cls.gl_account_id = acc.gl_account_id WHERE bs_pl_flag = 'PL'"
    out["pl_measure_pivot"] = (
        f"{cls} SELECT time_key, " + ", ".join(
            sum_amount(f"CASE WHEN {c} THEN {a} ELSE 0 END", name) for name, c, a in PIVOTED)
        + f" {pl_join} GROUP BY time_key")
    pivots = ", ".join(f"CASE WHEN {c} THEN {a} ELSE 0 END AS {name}" for name, c, a in PIVOTED)
    out["pl_derived_measures"] = (
        f"{cls}, q AS (SELECT time_key, domain_id, {pivots} {pl_join}) SELECT time_key, domain_id, "
        + ", ".join(sum_amount(f"({t})", name) for name, t in DERIVED) + " FROM q GROUP BY ALL")
    out["pl_rollup"] = f"{cls}, {deal_totals()} SELECT * FROM pl"
    day = "strptime(CAST(time_key AS VARCHAR), '%Y%m%d')"
    out["annualised_margin"] = f"{month} SELECT row_id, " + ", ".join(
        f"(outstanding_balance_{h}_{c} / CASE WHEN avg_book_bal_{h}_{c} = 0 THEN 1 ELSE avg_book_bal_{h}_{c} END) * "
        f"(CAST(365 AS DOUBLE) / {'day(last_day(' + day + '))' if h == 'mtd' else 'dayofyear(' + day + ')'}) "
        f"AS margin_{h}_{c}" for h in ("mtd", "ytd") for c in ("aed", "lcy")) + " FROM led"
    out["dim_lookup_left"] = (
        f"{month}, {CENTRE} SELECT profit_centre, known AS known_centre, {n}, {amount} FROM led LEFT JOIN "
        "(SELECT DISTINCT profit_centre_cd AS known FROM centre) ON profit_centre = known GROUP BY ALL")
    out["dim_lookup_inner"] = (
        f"{month}, {ACCOUNTS} SELECT gl_account_levl1_code AS level1, gl_account_levl3_code AS level3, {n}, {amount} "
        "FROM led JOIN acc USING (gl_account_id) GROUP BY ALL")
    out["semi_join_scope"] = (
        f"{month}, {DOMAIN} SELECT domain_id, {n}, {amount} FROM led WHERE domain_id IN "
        f"(SELECT domain_id FROM dom WHERE {chart.MEASURE_SCOPE}) GROUP BY domain_id")
    out["entity_scope_join"] = (
        f"{month}, {ENTITY} SELECT led.legal_entity, {n}, {amount} FROM led JOIN ent USING (legal_entity) "
        "WHERE legal_entity_levl1_desc = 'GROUP' GROUP BY led.legal_entity")

    out["anchor_rank"] = (
        f"{cls}, {RANKED} SELECT {KEYS}, outstanding_balance_mtd_aed, gl_account_id, common_key, row_id, deal_rows "
        "FROM bsr WHERE place_in_deal = 1")
    on = " AND ".join(f"bsr.{k} = pl.{k}" for k in [*schemas.DEAL_KEYS, "time_key"])
    out["anchor_merge"] = (
        f"{cls}, {RANKED}, {deal_totals()} SELECT coalesce(bsr.time_key, pl.time_key) AS time_key, "
        "coalesce(bsr.amount_class, pl.amount_class) AS amount_class, "
        "count(*) FILTER (row_id IS NOT NULL AND net_pl IS NOT NULL) AS n_matched, "
        "count(*) FILTER (row_id IS NOT NULL AND net_pl IS NULL) AS n_balance_only, "
        "count(*) FILTER (row_id IS NULL) AS n_pl_only, "
        f"{sums(['net_pl', 'outstanding_balance_mtd_aed'])} FROM bsr FULL OUTER JOIN pl ON {on} AND place_in_deal = 1 "
        "GROUP BY 1, 2")
    out["base_fact"] = f"WITH {base()} SELECT * FROM base"
    stage = lambda name, source, column, where="true": (
        f"SELECT '{name}' AS stage, count(*) AS total_count, {sum_amount(column, 'total_amount')} "
        f"FROM {source} WHERE {where}")
    out["reconcile_totals"] = f"WITH {base()} " + union(
        stage("ledger", "led", "outstanding_balance_mtd_aed"),
        stage("balance rows", "cls", "mtd_aed", "bs_pl_flag = 'BS'"),
        stage("profit and loss rows", "cls", "mtd_aed", "bs_pl_flag = 'PL'"),
        stage("deal totals", "pl", "net_pl"), stage("base balances", "base", "mtd_aed"),
        stage("base measures", "base", "net_pl"))

    cust_keys = ", ".join(schemas.CUSTOMER_KEYS)
    cust_inner = ", ".join(f"{CUSTOMER_RENAMES.get(c, c)} AS {c}" for c in [*schemas.CUSTOMER_KEYS, *CUSTOMER_MEASURES])
    out["customer_aggregate"] = (
        f"WITH {base()}, {risk('base')} SELECT {cust_keys}, {sums(CUSTOMER_MEASURES)} "
        f"FROM (SELECT {cust_inner} FROM risk) GROUP BY {cust_keys}")
    factor = "CASE right(deal_id, 1) " + " ".join(f"WHEN '{k}' THEN {f}" for k, f in dict(testmap.RELOADS).items()) + " ELSE 1 END"
    out["incremental_customer"] = (
        f"WITH {base('year', factor)}, {risk('base')} SELECT {cust_keys}, {sums(testmap.RELOADED)} "
        f"FROM (SELECT {cust_inner} FROM risk) GROUP BY {cust_keys}")
    out["gl_aggregate"] = f"WITH {gl()} SELECT * FROM gl"
    coarse = ["legal_entity", "customer_segment_code", "amount_class", "domain_id"]
    compared_names = ["mtd_aed_actual", "mtd_lcy_actual", "ytd_aed_actual", "ytd_lcy_actual"]
    monthly = ", ".join(sum_amount(scenarios()[c], c) for c in compared_names)
    out["prior_period_compare"] = (
        f"{month}, {DOMAIN}, m AS (SELECT {', '.join(coarse)}, time_key, {monthly} FROM (SELECT led.*, "
        f"dom.l1_code AS dom_l1 FROM led LEFT JOIN dom USING (domain_id)) GROUP BY ALL) "
        + comparatives("m", coarse, "a.*"))
    out["gl_fact"] = f"WITH {gl_fact()} SELECT * FROM fact"

    out["asof_validity"] = (
        f"{month}, {CUSTOMERS}, {PERIODS} SELECT time_key, banking_type, {n}, min(start_time_key) AS first_start "
        "FROM cust JOIN per ON time_key BETWEEN start_time_key AND end_time_key GROUP BY ALL")
    out["latest_valid_customer"] = f"{month}, {VALID_CUSTOMERS} SELECT * EXCLUDE (rn) FROM lc"
    out["latest_valid_contract"] = f"{month}, {PERIODS}, {VALID_CONTRACTS} SELECT * FROM ld"
    out["trimmed_key_join"] = (
        f"{month}, {VALID_CUSTOMERS} SELECT row_id, cust_start_time_key, cust_end_time_key FROM led LEFT JOIN lc ON "
        "cust_key = trim(customer_number) AND cust_type_key = trim(banking_type_customer) AND lc.time_key = led.time_key")
    contracts = f"{month}, {PERIODS}, {VALID_CONTRACTS}, {with_contracts('led')}"
    out["contract_join_sentinel"] = (
        f"{contracts} SELECT row_id, source_system_id, deal_start_key, deal_end_key FROM wc "
        "WHERE contract_id = '0000000'")
    out["contract_join_latest"] = (
        f"{contracts} SELECT row_id, contract_id, deal_start_key, deal_end_key FROM wc WHERE contract_id <> '0000000'")
    out["sentinel_routing"] = (
        f"{contracts} SELECT time_key, contract_id = '0000000' AS is_sentinel, {n}, "
        "count(deal_start_key) AS n_with_contract, max(deal_start_key) AS last_start FROM wc GROUP BY ALL")
    tb_columns = ", ".join([
        "common_key", "time_key", *[k for k in schemas.DEAL_KEYS], "gl_account_id", "balance_sheet_type",
        "bs_pl_flag", "is_internal_account", *schemas.BALANCES, "cust_start_time_key", "cust_end_time_key",
        "deal_start_validity_date", "deal_end_validity_date"])
    out["trial_balance"] = f"""WITH {trial()} SELECT {tb_columns},
  cust_number || cust_banking_type || CAST(cust_start_time_key AS VARCHAR) AS cust_derived_key,
  contract_id || banking_type || CAST(deal_start_key AS VARCHAR) AS contract_derived_key,
  CAST(time_key AS VARCHAR) || contract_id || profit_centre || gl_account_id || currency_code || customer_number
    || source_system_id || coalesce(category_code, '00000') AS ftp_derived_key FROM wc"""

    out["rule_tagging"] = f"WITH {gl()}, {tag_set('gl')} SELECT * FROM tagset"
    carried = ", ".join(f"a.{k}" for k in [*schemas.GL_KEYS, "time_key", *GL_MEASURES])
    out["tag_writeback"] = f"WITH {gl()}, {tag_set('gl')} {tagged('gl', carried)}"
    out["statement_lines"] = f"WITH {compared()}, {CENTRE} {line_blocks()}"
    shown = ", ".join([*schemas.LINE_KEYS, "source_system_id", "gl_account_id", *LINE_MEASURES])
    out["statement_lines_by_source"] = (
        f"WITH {compared()}, {CENTRE} SELECT {shown} FROM ({line_blocks(by_source=True)})")

    offsets = ", ".join(f"{prior_key('time_key', m)} AS time_key_{o}" for o, m in
                        (("lm1", 1), ("lm2", 2), ("lysm", 12)))
    out["calendar_offsets"] = f"{month}, {PERIODS} SELECT time_key, {offsets} FROM per"
    out["calendar_month_end"] = (
        "SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS n_rows, "
        "CAST(strftime(last_day(CAST(o_orderdate AS DATE)), '%Y%m%d') AS INT) AS month_end_key, "
        "CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders GROUP BY ALL")
    out["calendar_series"] = (
        "SELECT o_custkey, CAST(strftime(last_day(m), '%Y%m%d') AS INT) AS time_key FROM (SELECT o_custkey, "
        "unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), "
        "INTERVAL 1 MONTH)) AS m FROM orders GROUP BY o_custkey)")
    rebased = gl_fact("year", "CASE WHEN amount_class = 'MGTBGT' THEN 2 ELSE 1 END")
    out["budget_rebase"] = (
        f"WITH {rebased} SELECT time_key, CAST(1 AS INT) AS version_id, dataset, amount_class, {n}, "
        + sums(["mtd_aed", "net_pl", "mtd_aed_actual", "mtd_lcy_budget", "prev_yr_curr_mth_ytd_aed",
                "prev_mth1_mtd_aed"]) + ", count(gm_other) AS n_tagged FROM fact GROUP BY ALL")
    once = gl_fact("year", RELOADED)
    rows = ledger("year", RELOADED)
    fixed = ", ".join(f"'{v}' AS {k}" for k, v in testmap.FEW_KEYS.items())
    once = once.replace(rows, rows.replace("led AS (", "fine AS (") + f",\nled AS (SELECT * REPLACE ({fixed}) FROM fine)")
    out["comparatives_refresh"] = (
        f"WITH {once} SELECT time_key, dataset, amount_class, {n}, "
        + sums(["mtd_aed", "mtd_aed_actual", "prev_yr_curr_mth_ytd_aed", "prev_yr_curr_mth_ytd_lcy"])
        + ", count(gm_other) AS n_tagged FROM fact GROUP BY ALL")
    return out
