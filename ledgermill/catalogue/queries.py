"""One query per operator over the test tables (see :mod:`ledgermill.testmap`)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import chart, schemas, testmap
from ..functions import calendar, codes
from ..functions.money import exact_sum
from ..functions.sql import with_exprs
from ..operators import anchor, asof, compare, incremental, lines, lookup, measures, reconcile, rollup, tags
from ..plans import base as base_plan
from ..plans import gl as gl_plan
from ..plans.pipeline import Mart
from ..plans.trial_balance import TYPED, trial_balance
from ..session import compiled, fresh_folder, stage
from ..sources import dims, ingest
from ..sources.placeholder import placeholder
from ..sources.store import FactStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def compiled_run(spark: SparkSession, d: str) -> DataFrame:
        return run(compiled(spark), d)

    QUERIES[run.__name__] = compiled_run
    return compiled_run


def count():
    return F.expr("count(1) AS n_rows")


def total(name: str, alias: str | None = None):
    return F.expr(f"{exact_sum(name)} AS {alias or name}")


def base_of(spark: SparkSession, d: str, read: list[str] | None = None) -> DataFrame:
    return base_plan.base_fact(
        testmap.ledger(spark, d), testmap.gl_accounts(spark, d), testmap.domain(spark), read)


def classified(spark: SparkSession, d: str) -> DataFrame:
    return base_plan.classify(testmap.ledger(spark, d), testmap.gl_accounts(spark, d))


def staged_rows(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    """Classified rows, written once; of the columns that a query reads, if it names them."""
    return base_plan.stage_classified(testmap.ledger(spark, d), testmap.gl_accounts(spark, d), columns=columns)


def gl_of(spark: SparkSession, d: str, read: list[str] = rollup.GL_READS) -> DataFrame:
    return rollup.gl_aggregate(base_of(spark, d, read), testmap.domain(spark), testmap.gl_accounts(spark, d))


def periods_of(rows: DataFrame) -> DataFrame:
    return rows.select("time_key").distinct()


def known_periods(spark: SparkSession, d: str) -> DataFrame:
    """The ledger's periods as a small relation of known size, as the jobs pass them."""
    return calendar.periods_frame(spark, calendar.list_periods(testmap.ledger(spark, d)))


# -- ingest --------------------------------------------------------------------------
def _parsed(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_folder(spark, "extract")
    ingest.write_extract(testmap.raw_rows(spark, d), path)
    return ingest.parse(ingest.read_lines(spark, path))


@query
def ingest_ledger_keys(spark, d):
    return ingest.accepted(_parsed(spark, d)).select(*schemas.EXTRACT_KEYS, "time_key")


@query
def ingest_ledger_amounts(spark, d):
    return ingest.accepted(_parsed(spark, d)).select("row_id", *schemas.EXTRACT_AMOUNTS)


@query
def ingest_period_key(spark, d):
    return ingest.accepted(_parsed(spark, d)).groupBy("time_key").agg(count())


@query
def ingest_row_id_check(spark, d):
    return ingest.row_ids(ingest.accepted(_parsed(spark, d))).agg(
        F.expr("sum(n_rows) AS n_rows"), F.expr("count(1) AS n_row_ids"),
        F.expr("count_if(n_rows > 1) AS n_repeated_ids"),
    )


# -- dimensions ------------------------------------------------------------------------
@query
def dim_scan(spark, d):
    return dims.scan(spark, f"{d}/part.parquet", ["p_partkey", "p_brand", "p_type"])


@query
def dim_collapse(spark, d):
    return lookup.collapse(testmap.gl_accounts(spark, d), "gl_account_id")


# -- store -----------------------------------------------------------------------------
def _facts(spark: SparkSession, d: str) -> DataFrame:
    rows = testmap.ledger(spark, d, grain="year")
    return rows.selectExpr(
        "time_key", "amount_class", "substring(domain_id, 1, 1) AS domain_id",
        "gl_account_id", "contract_id", "outstanding_balance_mtd_aed AS mtd_aed")


def _multiples(spark: SparkSession, d: str) -> Callable[[int], DataFrame]:
    """The facts with their amount times a factor; the ledger is built once for all of them."""
    rows = stage(_facts(spark, d), "facts")
    return lambda factor: rows.withColumn("mtd_aed", F.expr(f"mtd_aed * {factor}"))


def _new_store(spark: SparkSession) -> FactStore:
    return FactStore(spark, fresh_folder(spark, "store"))


def _even_years(rows: DataFrame) -> DataFrame:
    return rows.where("time_key div 10000 % 2 = 0")


def _by_version(rows: DataFrame, *more: str) -> DataFrame:
    return rows.groupBy("time_key", "version_id", *more).agg(count(), total("mtd_aed"))


@query
def store_write(spark, d):
    store = _new_store(spark)
    store.publish(_facts(spark, d))
    return _by_version(store.read_versions(), "last_refresh_flag", "amount_class", "domain_id")


@query
def store_publish_version(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    for factor in (1, 2, 3):
        store.publish(of(factor))
    return _by_version(store.read_versions(), "last_refresh_flag", "amount_class")


@query
def store_read_latest(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    store.publish(of(1))
    store.publish(_even_years(of(2)))
    return _by_version(store.read_latest(), "amount_class")


@query
def store_read_version(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    store.publish(of(1))
    store.publish(of(2))
    return _by_version(
        store.read_pinned({p: 1 for p in store.periods()}, chart.BUDGET_CLASS), "amount_class", "domain_id")


@query
def store_read_optional(spark, d):
    store = _new_store(spark)
    rows = _facts(spark, d)
    store.publish(rows)
    # Every year end looks for the one before it; the first finds nothing.
    wanted = [p - 10000 for p in store.periods()]
    return _by_version(store.read_optional(wanted, rows.selectExpr("*", "1 AS version_id").where("false")))


@query
def store_current_version(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    store.publish(of(1))
    store.publish(_even_years(of(2)))
    return store.version_table().where("last_refresh_flag = 'Y'").select("time_key", "version_id")


@query
def store_overwrite_period(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    store.publish(of(1))
    store.publish(of(2))
    store.overwrite_period(_even_years(of(5)))
    return _by_version(store.read_versions(), "last_refresh_flag")


@query
def store_replace_class(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    store.publish(of(1))
    store.publish(of(2))
    store.replace_class(of(10).where("domain_id <> '5'"), chart.BUDGET_CLASS)
    return _by_version(store.read_versions(), "last_refresh_flag", "amount_class", "domain_id")


@query
def store_retention(spark, d):
    store, of = _new_store(spark), _multiples(spark, d)
    for factor in range(1, 8):
        store.publish(of(factor))
    for period in store.periods():
        store.clean_versions(period)
    return _by_version(store.read_versions(), "last_refresh_flag")


@query
def placeholder_dataset(spark, d):
    return placeholder(periods_of(testmap.ledger(spark, d)))


# -- projections and filters --------------------------------------------------------------
@query
def split_composite_code(spark, d):
    code = ("CASE c_custkey % 5 WHEN 0 THEN CAST(c_custkey AS STRING) WHEN 1 THEN concat('#', c_custkey) "
            "WHEN 2 THEN concat(' a #b#', c_custkey) WHEN 3 THEN NULL "
            "ELSE concat(c_mktsegment, '#', c_custkey) END AS code")
    return testmap.table(spark, d, "customer").selectExpr("c_custkey", code).selectExpr(
        "c_custkey", f"{codes.code_type('code')} AS code_type", f"{codes.code_id('code')} AS code_id")


@query
def derived_keys(spark, d):
    nation = "CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END"
    return testmap.table(spark, d, "customer").selectExpr(
        "c_custkey",
        f"{codes.joined_key(['c_name', 'c_mktsegment', nation])} AS customer_key",
        f"{codes.joined_key(['c_custkey', f'coalesce({nation}, 0)'])} AS defaulted_key")


@query
def select_balance(spark, d):
    names = [*schemas.RAW_MTD, *schemas.OUTSTANDING]
    return classified(spark, d).groupBy("time_key", "bs_pl_flag").agg(count(), *[total(n) for n in names])


def _with_domain(spark, d):
    return lookup.lookup(testmap.ledger(spark, d), testmap.domain(spark), {"domain_id": "domain_id"},
                         {"dom_l1": "l1_code"})


@query
def scenario_split(spark, d):
    added = measures.scenario_columns("dom_l1")
    rows = with_exprs(_with_domain(spark, d), added)
    return rows.groupBy("time_key", "domain_id").agg(*[total(n) for n in added])


@query
def rwa_classify(spark, d):
    rows = rollup.with_risk(testmap.ledger(spark, d), testmap.domain(spark), testmap.gl_accounts(spark, d))
    return rows.groupBy("domain_id", "gl_account_id").agg(*[total(n) for n in chart.RWA_CLASSES])


@query
def rwa_total(spark, d):
    rows = rollup.with_risk(testmap.ledger(spark, d), testmap.domain(spark), testmap.gl_accounts(spark, d))
    return rows.groupBy("time_key", "legal_entity").agg(total("rwa_total"))


@query
def null_defaults(spark, d):
    rows = with_exprs(testmap.ledger(spark, d), {
        "contract_id": "nullif(contract_id, '0000000')", "category_code": "nullif(category_code, '30030')",
        "avg_book_bal_mtd_aed": "nullif(avg_book_bal_mtd_aed, 0)"})
    rows = with_exprs(rows, codes.null_defaults({
        "contract_id": chart.NO_CONTRACT, "category_code": chart.NO_CATEGORY, "avg_book_bal_mtd_aed": 1.5}))
    return rows.groupBy("category_code", F.expr(f"contract_id = '{chart.NO_CONTRACT}' AS no_contract")).agg(
        count(), total("avg_book_bal_mtd_aed"))


@query
def reshape_projection(spark, d):
    keys = ["department_id", "product_code", "profit_centre_cd"]
    amounts = ["outstanding_balance_mtd", "outstanding_balance_ytd", "avg_book_bal", "avg_book_bal_ytd_lcy"]
    rows = rollup.reshape(testmap.ledger(spark, d), [*keys, *amounts], rollup.CUSTOMER_RENAMES)
    return rows.groupBy(*keys).agg(*[total(n) for n in amounts])


@query
def constant_tags(spark, d):
    rows = testmap.ledger(spark, d).selectExpr(
        "domain_id", "'BASE' AS dataset", "3 AS version_id", "'Y' AS last_refresh_flag", "'BS' AS bs_pl_flag")
    return rows.groupBy(*rows.columns).agg(count())


@query
def schema_padding(spark, d):
    rows = classified(spark, d)
    wide = base_plan.balance_rows(rows).selectExpr("time_key", "bs_pl_flag", "mtd_aed", "mtd_lcy AS net_pl")
    narrow = base_plan.pl_rows(rows).select("time_key", "bs_pl_flag", "mtd_aed")
    both = wide.unionByName(narrow, allowMissingColumns=True)
    return both.groupBy("time_key", "bs_pl_flag").agg(
        count(), F.expr("count(net_pl) AS n_net_pl"), total("mtd_aed"), total("net_pl"))


@query
def scope_filters(spark, d):
    tests = {
        "n_balance": base_plan.BALANCE_HALF,
        "n_typed": TYPED,
        "n_risk": chart.RISK_DOMAINS,
        "n_not_risk": f"NOT {chart.RISK_ACCOUNTS}",
        "n_not_total": "gl_account_id NOT LIKE '1%'",
    }
    return classified(spark, d).groupBy("legal_entity").agg(
        *[F.expr(f"count_if({t}) AS {n}") for n, t in tests.items()])


def _tag_rows(spark, d):
    return classified(spark, d).select(*schemas.GL_KEYS, "time_key", "outstanding_balance_mtd_aed")


@query
def eligibility_filter(spark, d):
    rows = lookup.star(_tag_rows(spark, d), testmap.dimensions(spark, d).for_tags().branches())
    return rows.where(chart.TAG_ELIGIBLE).groupBy("domain_id", "customer_segment_code", "final_segment").agg(
        count(), total("outstanding_balance_mtd_aed"))


# -- measures --------------------------------------------------------------------------------
def _pl_rows(spark, d):
    return base_plan.pl_rows(classified(spark, d))


def _flags(spark, d):
    return measures.account_flags(testmap.gl_accounts(spark, d))


@query
def pl_measure_pivot(spark, d):
    rows = measures.pivot_measures(_pl_rows(spark, d), _flags(spark, d))
    return rows.groupBy("time_key").agg(*[total(n) for n in measures.base_measures()])


@query
def pl_derived_measures(spark, d):
    rows = measures.derive_measures(measures.pivot_measures(_pl_rows(spark, d), _flags(spark, d)))
    return rows.groupBy("time_key", "domain_id").agg(*[total(n) for n in measures.derived_measures()])


@query
def pl_rollup(spark, d):
    return base_plan.deal_totals(classified(spark, d), testmap.gl_accounts(spark, d), testmap.domain(spark))


@query
def annualised_margin(spark, d):
    return testmap.ledger(spark, d).selectExpr("row_id", *[
        measures.annualised_margin(
            f"outstanding_balance_{h}_{c}", f"avg_book_bal_{h}_{c}", calendar.key_to_date(), h
        ) + f" AS margin_{h}_{c}"
        for h in ("mtd", "ytd") for c in ("aed", "lcy")])


# -- lookups -----------------------------------------------------------------------------------
@query
def dim_lookup_left(spark, d):
    rows = lookup.lookup(testmap.ledger(spark, d), testmap.profit_centre(spark, d),
                         {"profit_centre": "profit_centre_cd"}, {"known_centre": "profit_centre_cd"})
    return rows.groupBy("profit_centre", "known_centre").agg(count(), total("outstanding_balance_mtd_aed"))


@query
def dim_lookup_inner(spark, d):
    rows = lookup.lookup(testmap.ledger(spark, d), testmap.gl_accounts(spark, d),
                         {"gl_account_id": "gl_account_id"},
                         {"level1": "gl_account_levl1_code", "level3": "gl_account_levl3_code"}, how="inner")
    return rows.groupBy("level1", "level3").agg(count(), total("outstanding_balance_mtd_aed"))


@query
def star_join(spark, d):
    rows = lookup.star(_tag_rows(spark, d), testmap.dimensions(spark, d).for_tags().branches())
    names = ["geo_l2_code", "dom_l2_code", "prod_l2_code", "acc_l1_code", "dept_l4_code", "seg_l1_code"]
    return rows.groupBy(*names).agg(count(), total("outstanding_balance_mtd_aed"))


@query
def semi_join_scope(spark, d):
    rows = lookup.in_scope(testmap.ledger(spark, d), testmap.domain(spark), {"domain_id": "domain_id"},
                           chart.MEASURE_SCOPE)
    return rows.groupBy("domain_id").agg(count(), total("outstanding_balance_mtd_aed"))


@query
def entity_scope_join(spark, d):
    rows = asof.group_scope(testmap.ledger(spark, d), testmap.legal_entity(spark, d), testmap.GROUP)
    return rows.groupBy("legal_entity").agg(count(), total("outstanding_balance_mtd_aed"))


# -- base fact -----------------------------------------------------------------------------------
@query
def anchor_rank(spark, d):
    rows = staged_rows(spark, d, [*base_plan.BASE_KEYS, *anchor.ANCHOR_ORDER, "bs_pl_flag"])
    return anchor.anchor_rows(base_plan.balance_rows(rows), base_plan.BASE_KEYS).drop("line_no")


@query
def anchor_merge(spark, d):
    rows = staged_rows(spark, d, ["row_id", *base_plan.BASE_KEYS, "gl_account_id", "common_key", "bs_pl_flag", *chart.BASES.values()])
    merged = anchor.anchor_merge(
        base_plan.balance_rows(rows).select("line_no", "row_id", *base_plan.BASE_KEYS, "gl_account_id", "common_key", *chart.BASES.values()),
        base_plan.deal_totals(rows, testmap.gl_accounts(spark, d), testmap.domain(spark)),
        base_plan.BASE_KEYS, measures.all_measures())
    return merged.groupBy("time_key", "amount_class").agg(
        F.expr("count_if(row_id IS NOT NULL AND net_pl IS NOT NULL) AS n_matched"),
        F.expr("count_if(row_id IS NOT NULL AND net_pl IS NULL) AS n_balance_only"),
        F.expr("count_if(row_id IS NULL) AS n_pl_only"),
        total("net_pl"), total("outstanding_balance_mtd_aed"))


@query
def base_fact(spark, d):
    return base_of(spark, d)


@query
def reconcile_totals(spark, d):
    accounts, domains = testmap.gl_accounts(spark, d), testmap.domain(spark)
    rows = staged_rows(spark, d)
    base = base_plan.base_from(rows, accounts, domains)
    totals = base_plan.deal_totals(rows, accounts, domains)
    return reconcile.control_totals({
        "ledger": (testmap.ledger(spark, d), "outstanding_balance_mtd_aed"),
        "balance rows": (base_plan.balance_rows(rows), "mtd_aed"),
        "profit and loss rows": (base_plan.pl_rows(rows), "mtd_aed"),
        "deal totals": (totals, "net_pl"),
        "base balances": (base, "mtd_aed"),
        "base measures": (base, "net_pl"),
    })


# -- aggregates ------------------------------------------------------------------------------------
@query
def customer_aggregate(spark, d):
    return rollup.customer_aggregate(base_of(spark, d, rollup.CUSTOMER_READS), testmap.domain(spark), testmap.gl_accounts(spark, d))


@query
def gl_aggregate(spark, d):
    return gl_of(spark, d)


@query
def incremental_customer(spark, d):
    """Customer sums after three reloads of some deals, each applied to the stored sums as a difference."""
    accounts, domains, keys = testmap.gl_accounts(spark, d), testmap.domain(spark), schemas.CUSTOMER_KEYS
    ledger = testmap.ledger(spark, d, grain="year")

    def loaded(rows: DataFrame, factor: int) -> DataFrame:
        """What is added up of the base rows, written once; no other measure is computed."""
        rows = with_exprs(rows, {c: f"{c} * {factor}" for c in schemas.OUTSTANDING})
        base = base_plan.base_fact(rows, accounts, domains, rollup.CUSTOMER_READS)
        added = rollup.customer_rows(base, domains, accounts, [*keys, "contract_id"])
        return stage(added.select(*keys, "contract_id", *testmap.RELOADED), "customer-rows")

    def state(rows: DataFrame) -> DataFrame:
        return incremental.whole_sums(rows, keys, testmap.RELOADED, schemas.MARGINS)

    def of(rows: DataFrame, digit: str) -> DataFrame:
        return rows.where(F.expr(f"right(contract_id, 1) = '{digit}'"))

    first = loaded(ledger, 1)
    held = {digit: of(first, digit) for digit, _ in testmap.RELOADS}
    store = FactStore(spark, fresh_folder(spark, "sums"), ["amount_class"])
    store.publish(state(first))
    for digit, factor in testmap.RELOADS:
        come = of(first, digit) if factor == 1 else loaded(of(ledger, digit), factor)
        store.publish(incremental.applied(store.read_latest(), keys, state(come), state(held[digit])))
        held[digit] = come
    return incremental.amounts_of(store.read_latest(), keys, testmap.RELOADED, schemas.MARGINS)


COARSE = ["legal_entity", "customer_segment_code", "amount_class", "domain_id"]


@query
def prior_period_compare(spark, d):
    rows = with_exprs(_with_domain(spark, d), measures.scenario_columns("dom_l1"))
    names = ["mtd_aed_actual", "mtd_lcy_actual", "ytd_aed_actual", "ytd_lcy_actual"]
    monthly = rows.groupBy(*COARSE, "time_key").agg(*[total(n) for n in names])
    return compare.compare(monthly, monthly, known_periods(spark, d), COARSE)


@query
def gl_fact(spark, d):
    return gl_plan.gl_fact(base_of(spark, d, rollup.GL_READS), None, known_periods(spark, d),
                           testmap.dimensions(spark, d))


# -- point in time -----------------------------------------------------------------------------------
def _periods(spark, d) -> list[int]:
    return calendar.list_periods(testmap.ledger(spark, d))


@query
def asof_validity(spark, d):
    rows = testmap.customer_versions(spark, d).selectExpr(
        "banking_type", "CAST(start_time_key AS INT) AS from_key", "CAST(end_time_key AS INT) AS to_key")
    valid = asof.valid_at(rows, _periods(spark, d), "from_key", "to_key")
    return valid.groupBy("time_key", "banking_type").agg(count(), F.expr("min(from_key) AS first_start"))


@query
def latest_valid_customer(spark, d):
    return asof.latest_customers(testmap.customer_versions(spark, d), _periods(spark, d))


@query
def latest_valid_contract(spark, d):
    return asof.latest_contracts(testmap.contract_versions(spark, d), _periods(spark, d))


def _group_rows(spark, d) -> tuple[DataFrame, list[int]]:
    """What the point-in-time joins need of the ledger, written once, and its periods."""
    rows = stage(testmap.ledger(spark, d).select(
        "row_id", "common_key", "gl_account_id", "time_key", "customer_number", "banking_type_customer",
        "contract_id", "banking_type", "source_system_id"), "group-rows")
    return rows, calendar.list_periods(rows)


@query
def trimmed_key_join(spark, d):
    rows, periods = _group_rows(spark, d)
    joined = asof.join_customers(rows, testmap.customer_versions(spark, d), periods)
    return joined.select("row_id", "cust_start_time_key", "cust_end_time_key")


def _with_contracts(spark, d):
    rows, periods = _group_rows(spark, d)
    return asof.join_contracts(rows, testmap.contract_versions(spark, d), periods)


@query
def contract_join_sentinel(spark, d):
    return _with_contracts(spark, d).where(f"contract_id = '{chart.NO_CONTRACT}'").select(
        "row_id", "source_system_id", "deal_start_key", "deal_end_key")


@query
def contract_join_latest(spark, d):
    return _with_contracts(spark, d).where(f"contract_id <> '{chart.NO_CONTRACT}'").select(
        "row_id", "contract_id", "deal_start_key", "deal_end_key")


@query
def sentinel_routing(spark, d):
    return _with_contracts(spark, d).groupBy(
        "time_key", F.expr(f"contract_id = '{chart.NO_CONTRACT}' AS is_sentinel")
    ).agg(count(), F.expr("count(deal_start_key) AS n_with_contract"), F.expr("max(deal_start_key) AS last_start"))


@query
def trial_balance_fact(spark, d):
    dim = testmap.dimensions(spark, d)
    return trial_balance(base_of(spark, d), dim.legal_entity, dim.customer, dim.contracts,
                         _periods(spark, d), testmap.GROUP)


QUERIES["trial_balance"] = QUERIES.pop("trial_balance_fact")


# -- tags and lines --------------------------------------------------------------------------------------
@query
def rule_tagging(spark, d):
    return tags.tag_set(gl_of(spark, d, read=[]), testmap.dimensions(spark, d).for_tags())


@query
def tag_writeback(spark, d):
    rows = gl_of(spark, d).select(*schemas.GL_KEYS, "time_key", *rollup.GL_MEASURES)
    return tags.tag_in_place(rows, testmap.dimensions(spark, d).for_tags())


def _compared(spark, d):
    return gl_plan.gl_base(base_of(spark, d, rollup.GL_READS), None, known_periods(spark, d),
                           testmap.dimensions(spark, d))


@query
def statement_lines(spark, d):
    dim = testmap.dimensions(spark, d)
    return lines.statement_lines(_compared(spark, d), dim.gl_accounts, dim.profit_centre)


@query
def statement_lines_by_source(spark, d):
    dim = testmap.dimensions(spark, d)
    out = lines.statement_lines(_compared(spark, d), dim.gl_accounts, dim.profit_centre, by_source=True)
    return out.select(*schemas.LINE_KEYS, "source_system_id", "gl_account_id", *lines.LINE_MEASURES)


# -- calendar ------------------------------------------------------------------------------------------------
@query
def calendar_offsets(spark, d):
    return calendar.with_offsets(periods_of(testmap.ledger(spark, d)))


@query
def calendar_month_end(spark, d):
    dates = testmap.table(spark, d, "orders").selectExpr("CAST(o_orderdate AS DATE) AS order_date")
    return dates.groupBy("order_date").agg(count()).selectExpr(
        "order_date", "n_rows", f"{calendar.date_to_key('last_day(order_date)')} AS month_end_key",
        f"{calendar.is_month_end('order_date')} AS month_end")


@query
def calendar_series(spark, d):
    spans = testmap.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.expr("CAST(min(o_orderdate) AS DATE) AS first_date"), F.expr("CAST(max(o_orderdate) AS DATE) AS last_date"))
    return calendar.month_series(spans, "first_date", "last_date").selectExpr(
        "o_custkey", f"{calendar.date_to_key('period_end')} AS time_key")


# -- jobs ------------------------------------------------------------------------------------------------------
@query
def budget_rebase(spark, d):
    mart = Mart(spark, fresh_folder(spark, "mart"), testmap.dimensions(spark, d), testmap.GROUP)
    ledger = testmap.ledger(spark, d, grain="year")
    mart.run("ALL", ledger)
    mart.run("BUDGET", with_exprs(ledger, {c: f"{c} * 2" for c in schemas.OUTSTANDING}))
    return mart.gl.read_latest().groupBy("time_key", "version_id", "dataset", "amount_class").agg(
        count(), *[total(n) for n in ("mtd_aed", "net_pl", "mtd_aed_actual", "mtd_lcy_budget",
                                      "prev_yr_curr_mth_ytd_aed", "prev_mth1_mtd_aed")],
        F.expr("count(gm_other) AS n_tagged"))


@query
def comparatives_refresh(spark, d):
    """A budget reload of one year; the year after it compares with it and is not reloaded."""
    mart = Mart(spark, fresh_folder(spark, "mart"), testmap.dimensions(spark, d), testmap.GROUP)
    ledger = with_exprs(testmap.ledger(spark, d, grain="year"), {k: f"'{v}'" for k, v in testmap.FEW_KEYS.items()})
    mart.run("ALL", ledger)
    one = ledger.where(f"time_key div 10000 = {testmap.RELOADED_YEAR}")
    mart.run("BUDGET", with_exprs(one, {c: f"{c} * 2" for c in schemas.OUTSTANDING}))
    return mart.gl.read_latest().groupBy("time_key", "dataset", "amount_class").agg(
        count(), *[total(n) for n in ("mtd_aed", "mtd_aed_actual", "prev_yr_curr_mth_ytd_aed", "prev_yr_curr_mth_ytd_lcy")],
        F.expr("count(gm_other) AS n_tagged"))
