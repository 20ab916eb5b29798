"""Edge cases on hand-made rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill import chart, schemas
from ledgermill.functions import calendar, codes
from ledgermill.functions.money import exact_sum, joined, ratio_sum
from ledgermill.operators import asof, compare, incremental, lines, lookup, measures
from ledgermill.plans import base as base_plan
from ledgermill.session import literal_rows
from ledgermill.sources import ingest
from ledgermill.sources.placeholder import placeholder
from ledgermill.sources.store import FactStore

LEVELS = [f"gl_account_levl{n}_code" for n in range(1, 7)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def accounts(spark):
    rows = [
        ("A1", "BS", "N", "Loans", "10000000", "10500000", "10510000", "10511000", "x", "x"),
        ("A1", "BS", "N", "Advances", "10000000", "10500000", "10510000", "10511000", "x", "x"),
        ("A2", "BS", "Y", "Cash", "10000000", "10600000", "x", "x", "x", "x"),
        ("P1", "PL", "N", "Interest", "60000000", "60100000", "60110000", "x", "x", "x"),
        ("P2", "PL", "N", "Fees", "60000000", "60200000", "60210000", "60211000", "60211100", "x"),
        ("P3", "PL", "N", "Cost", "70000000", "70300000", "70310000", None, None, "x"),
    ]
    return literal_rows(spark, rows, [
        "gl_account_id", "gl_pl_flag", "is_internal_account", "gl_account_levl2_desc", *LEVELS])


def domains(spark):
    return literal_rows(spark, [("1", "100000", "120000", "511000"), ("9", "300000", "x", "x")],
                        ["domain_id", "l1_code", "l2_code", "l4_code"])


def ledger(spark, entries, period=20000229):
    """Rows (row id, account, deal, balance, average) with all other keys equal."""
    fixed = {k: f"'{k}'" for k in schemas.DEAL_KEYS if k not in ("contract_id", "domain_id")}
    df = spark.createDataFrame(
        entries, "row_id string, gl_account_id string, contract_id string, amount double, average double, "
                 "domain_id string")
    amounts = {f"outstanding_balance_{h}_{c}": "amount" for h in ("mtd", "ytd") for c in ("acy", "lcy", "aed")}
    amounts |= {c: "average" for c in schemas.AVERAGES}
    return df.selectExpr(
        "row_id", "gl_account_id", "contract_id", "domain_id", "row_id AS common_key", f"{period} AS time_key",
        *[f"{v} AS {k}" for k, v in fixed.items()], *[f"{v} AS {k}" for k, v in amounts.items()])


def test_composite_code(spark):
    df = literal_rows(spark, [("AB#12",), ("77",), ("#5",), ("a#b#c",), (None,)], ["code"])
    got = {r[0]: (r[1], r[2]) for r in df.selectExpr("code", codes.code_type("code"), codes.code_id("code")).collect()}
    assert got == {"AB#12": ("AB", "12"), "77": ("NA", "77"), "#5": ("", "5"), "a#b#c": ("a", "b#c"),
                   None: ("NA", None)}


def test_sums_do_not_depend_on_order(spark):
    df = spark.range(10000).selectExpr("CAST(id % 97 AS DOUBLE) / 100 AS x", "rand(1) AS shuffle")
    one = df.coalesce(1).selectExpr(exact_sum("x"), ratio_sum("x / 7")).first()
    two = df.repartition(7).orderBy("shuffle").selectExpr(exact_sum("x"), ratio_sum("x / 7")).first()
    assert tuple(one) == tuple(two)
    assert one[0] == sum(i % 97 for i in range(10000)) / 100


def test_sums_keep_small_decimals(spark):
    small = spark.range(1000).selectExpr("0.004D AS a", "0.000123D AS b", "-0.5D AS c", "12345678.123456D AS d")
    got = small.selectExpr(*[exact_sum(c) for c in "abcd"]).first()
    assert tuple(got) == (4.0, 0.123, -500.0, 12345678123.456)
    assert spark.range(3).selectExpr(exact_sum("CAST(NULL AS DOUBLE)")).first()[0] is None
    large = spark.range(4).selectExpr("4e18D AS x").selectExpr(exact_sum("x / 2")).first()
    assert large[0] == 8e18


def test_sums_leave_longs_only_where_they_must(spark):
    """On both sides of 9.2e18 units the sum is the double nearest to the exact one; decimals are the exception."""
    for x, n in ((9223372036854.5, 1), (9223372036855.5, 1), (-9223372036854.75, 1), (-9223372036856.25, 3), (4e15, 1000), (0.000001, 7)):
        total = exact_sum("x")
        got = spark.range(n).selectExpr(f"{x!r}D AS x").selectExpr(f"{total} AS t").first()[0]
        units = round(Decimal(x) * 10 ** 6) * n
        assert got == float(units) / 1e6, x
    assert joined("w", "u").startswith("coalesce(CAST(try_add(try_multiply(w, 1000000L), u) AS DOUBLE)")
    unknown = spark.sql(f"SELECT {joined('CAST(NULL AS BIGINT)', '0L')}, {joined('1L', 'CAST(NULL AS BIGINT)')}").first()
    assert tuple(unknown) == (None, None)


def test_sums_take_rows_back(spark):
    """Any order of reloads ends where a rebuild does; a key leaves with its last row; nulls are known."""
    make = lambda rows: incremental.whole_sums(spark.createDataFrame(rows, "k string, x double, r double"), ["k"], ["x", "r"], ["r"])
    first = [("a", 0.1, 1 / 3), ("a", 0.2, 2 / 3), ("a", None, None), ("b", 12345678.123456, 1e12 + .5), (None, -0.7, None)]
    more, gone = [("c", 5.0, 0.25), ("a", -0.3, 1 / 7), ("b", 1e15, None)], [first[1], first[3], ("c", 5.0, 0.25)]
    state = incremental.applied(make(first), ["k"], make(more), make(gone))
    left = [r for r in first + more if r not in gone]
    show = lambda s: sorted(map(tuple, incremental.amounts_of(s, ["k"], ["x", "r"], ["r"]).collect()), key=repr)
    assert show(state) == show(make(left)) and {r[0] for r in show(state)} == {"a", "b", None}
    rebuilt = spark.createDataFrame(left, "k string, x double, r double").groupBy("k").agg(
        F.expr(f"{exact_sum('x')} AS x"), F.expr(f"{ratio_sum('r')} AS r"))
    assert show(state) == sorted(map(tuple, rebuilt.collect()), key=repr)
    assert incremental.applied(state, ["k"], go=state).count() == 0
    with pytest.raises(Exception, match="does not hold"):
        incremental.applied(state, ["k"], go=make([("z", 1.0, 1.0)])).collect()


def _line(row_id, month="3", amount="1.5", width=51):
    fields = [""] * width
    fields[0], fields[1], fields[49] = "2018", month, row_id
    fields[22] = amount
    if width > 50:
        fields[50] = "as 31"
    return "~".join(fields)


def test_ingest(spark, tmp_path):
    header = "~".join(f"h{i}" for i in range(51))
    lines_ = [header, _line("1"), _line("2", "12", ""), header, _line("3", amount="abc"), _line("4", amount=" 1.5 "),
              _line("5", amount="NaN"), _line("6", amount="-Infinity"),
              "too~short"]
    path = tmp_path / "extract.dat"
    path.write_text("\n".join(lines_) + "\n")
    rows, rejects = ingest.read_ledger(spark, str(path))
    got = rows_of(rows.select("row_id", "time_key", "outstanding_balance_mtd_acy"))
    assert got == [("1", 20180331, 1.5), ("2", 20181231, 0.0), ("4", 20180331, 1.5)]
    assert sorted(r[1] for r in rejects.collect()) == ["bad amount"] * 3 + ["too few fields"]
    assert ingest.duplicate_row_ids(rows).count() == 0
    assert rows_of(ingest.duplicate_row_ids(rows.unionByName(rows.where("row_id = '2'")))) == [("2", 2)]
    with pytest.raises(Exception, match="bad amount|too few"):
        ingest.read_ledger(spark, str(path), strict=True)[0].collect()


def test_anchor_merge_conserves_totals(spark):
    entries = [
        ("b1", "A1", "both", 5.0, 0.0, "1"), ("b2", "A1", "both", 5.0, 2.0, "1"),   # tied balances
        ("b3", "A2", "both", 9.0, 1.0, "1"),                                          # internal account
        ("p1", "P1", "both", 6.0, 1.0, "1"), ("p2", "P2", "both", 4.0, 1.0, "1"),
        ("b4", "A1", "bs", 1.0, 1.0, "1"), ("p3", "P1", "pl", 7.25, 1.0, "1"),
        ("p4", "P1", "out", 100.0, 1.0, "9"),                                         # domain out of scope
        ("z1", "??", "lost", 3.0, 1.0, "1"),                                          # unknown account
    ]
    classified = base_plan.stage_classified(ledger(spark, entries), accounts(spark))
    base = base_plan.base_from(classified, accounts(spark), domains(spark)).cache()
    assert base.count() == 4 + 1 + 4
    merged = base.where("bs_pl_flag = 'BS'")
    assert merged.selectExpr(exact_sum("net_pl")).first()[0] == 17.25
    carrying = merged.where("net_pl <> 0").select("contract_id", "gl_account_id", "common_key", "net_pl")
    assert rows_of(carrying) == [("both", "A1", "b1", 10.0), ("pl", chart.SYNTHETIC_ACCOUNT, "0", 7.25)]
    # Zero balance counts as one; February 2000 has 29 days and ends on day 60.
    margin = merged.where("common_key = 'b1'").select("net_int_margin", "net_int_margin_ytd_aed").first()
    assert tuple(margin) == (6.0 * (365 / 29), 6.0 * (365 / 60))
    assert merged.where("common_key = '0'").select("balance_sheet_type", "net_int_margin").first() == (
        chart.SYNTHETIC_TYPE, 0.0)
    raw = base.where("bs_pl_flag = 'PL'")
    assert raw.where("net_pl IS NOT NULL").count() == 0 and raw.count() == 4
    assert rows_of(base_plan.unclassified(classified).select("row_id")) == [("z1",)]


@pytest.mark.parametrize("row_ids", [["7", "7", "7"], ["", "", ""], [None, None, None]])
def test_anchor_merge_with_ids_that_are_not_unique(spark, row_ids):
    entries = [("b1", "A1", "both", 5.0, 0.0, "1"), ("b2", "A1", "both", 5.0, 2.0, "1"), ("p1", "P1", "both", 6.0, 1.0, "1")]
    rows = ledger(spark, entries)
    ids = dict(zip([e[0] for e in entries], row_ids, strict=True))
    same = " ".join(f"WHEN '{k}' THEN {'NULL' if v is None else repr(v)}" for k, v in ids.items())
    rows = rows.withColumn("row_id", F.expr(f"CASE common_key {same} END"))
    merged = base_plan.base_fact(rows, accounts(spark), domains(spark)).where("bs_pl_flag = 'BS'")
    assert merged.count() == 2
    assert merged.selectExpr(exact_sum("net_pl")).first()[0] == 6.0


def test_collapse_and_measures(spark):
    collapsed = lookup.collapse(accounts(spark), "gl_account_id")
    assert collapsed.where("gl_account_id = 'A1'").select("gl_account_levl2_desc").collect() == [("Loans",)]
    assert len(measures.all_measures()) == 64
    assert measures.derivation("net_pl", "")[0] == "gross_interest_income"


def test_validity_edges_and_latest(spark):
    versions = literal_rows(spark, [
        (" 12 ", "CB", "20000229", "20000331"), ("12", "CB", "20000101", "20000229"),
        ("13", "CB", "20000301", "20000331"), ("14", "CB", "20000101", "20000228")],
        ["customer_number", "banking_type", "start_time_key", "end_time_key"])
    one = asof.latest_customers(versions, [20000229]).select("cust_key", "cust_start_time_key")
    assert rows_of(one) == [("12", 20000229)]
    two = asof.latest_customers(versions, [20000229, 20000331]).select("time_key", "cust_key")
    assert rows_of(two) == [(20000229, "12"), (20000331, "12"), (20000331, "13")]


def test_contract_routes(spark):
    contracts = literal_rows(spark, [
        ("7", "LN", "T24", "15-JAN-2018", "31-DEC-2018"), ("7 ", "LN", "TI", "01-FEB-2018", "31-DEC-2018"),
        (chart.NO_CONTRACT, "NA", "T24", "01-JAN-2018", "31-DEC-2018"),
        (chart.NO_CONTRACT, "NA", "TI", "05-JAN-2018", "31-DEC-2018")],
        ["contract_id", "banking_type", "source_system", "start_validity_date", "end_validity_date"])
    fact = literal_rows(spark, [
        ("a", "7", "LN", "T24"), ("b", chart.NO_CONTRACT, "NA", "T24"), ("c", chart.NO_CONTRACT, "NA", "MM"),
        ("d", " " + chart.NO_CONTRACT, "NA", "MM")],
        ["common_key", "contract_id", "banking_type", "source_system_id"]).selectExpr(
            "*", "'x' AS gl_account_id", "20180331 AS time_key")
    got = asof.join_contracts(fact, contracts, [20180331])
    found = {r[0]: r[1] for r in got.select("common_key", "deal_start_key").collect()}
    assert found == {"a": 20180201, "b": 20180101, "c": None, "d": 20180105}


@pytest.mark.parametrize("most", [1000, 3, 0])
def test_versions_of_crowded_keys(spark, monkeypatch, most):
    """Overlapping versions, many of one key, against brute force; carried, met one by one, and mixed."""
    monkeypatch.setattr(asof, "MOST_VERSIONS", most)
    rnd, periods = random.Random(8), [20000131, 20000229, 20000331]
    versions = [("c0" if rnd.random() < .5 else f" c{rnd.randrange(9)}", "CB", a, a + rnd.randrange(200))
                for _ in range(120) for a in [20000101 + rnd.randrange(300)]] + [("c1", "CB", None, 20000331)]
    fact = [(i, f"c{rnd.randrange(11)} ", rnd.choice(["CB", "XX"]), rnd.choice(periods)) for i in range(200)]
    df = spark.createDataFrame(versions, "customer_number string, banking_type string, start_time_key int, end_time_key int")
    rows = spark.createDataFrame(fact, "row int, customer_number string, banking_type_customer string, time_key int")
    got = asof.join_customers(rows, df, periods).select("row", "cust_start_time_key", "cust_end_time_key", "cust_number")
    want = []
    for i, c, t, p in fact:
        fit = [(s, e, n) for n, b, s, e in versions if s and n.strip() == c.strip() and b == t and s <= p <= e]
        want.append((i, *(max(fit) if fit else (None, None, None))))
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("most", [1000, 3, 0])
def test_latest_versions_of_all_keys(spark, monkeypatch, most):
    """Latest versions per period against brute force; keys of few and of many versions, and null keys."""
    monkeypatch.setattr(asof, "MOST_VERSIONS", most)
    rnd, periods = random.Random(9), [20000131, 20000229, 20000331]
    versions = [(rnd.choice(["c0", "c0 ", f"c{rnd.randrange(9)}", None]), rnd.choice(["CB", None]), a, a + rnd.randrange(200))
                for _ in range(150) for a in [20000101 + rnd.randrange(60) * 5]] + [("c1", "CB", None, 20000331), ("c1", "CB", 20000101, None)]
    df = spark.createDataFrame(versions, "customer_number string, banking_type string, start_time_key int, end_time_key int")
    got = asof.latest_customers(df, periods).selectExpr("cust_key", "cust_type_key", "time_key", "cust_start_time_key", "cust_end_time_key")
    want = {}
    for n, b, s, e in versions:
        for p in periods:
            if s and e and s <= p <= e:
                key = (n and n.strip(), b, p)
                want[key] = max(want.get(key, (0, 0)), (s, e))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == want and got.count() == len(want)


def test_latest_versions_move_once(spark):
    """Versions are repeated for their periods behind the shuffle."""
    df = spark.createDataFrame([("c", "CB", 20000101, 20191231)], "customer_number string, banking_type string, start_time_key int, end_time_key int")
    plan = asof.latest_customers(df, [20000101 + i for i in range(28)])._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("Generate") < plan.find("Aggregate") and plan.count("Generate") == 1


def test_versions_do_not_multiply_with_periods(spark):
    """What is joined has a row for each key, however many periods there are."""
    df = spark.createDataFrame([("c", "CB", 20000101, 20191231)], "customer_number string, banking_type string, start_time_key int, end_time_key int")
    rows = spark.createDataFrame([("c", "CB", 20000101 + i) for i in range(28)], "customer_number string, banking_type_customer string, time_key int")
    got = asof.join_customers(rows, df, [20000101 + i for i in range(28)])
    assert got.count() == 28 and "explode" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_statement_line_rules(spark):
    gl = literal_rows(spark, [("P2", "PC1", "E1"), ("P3", "PC1", "E1"), ("P3", "PC9", "E1"), ("A1", "PC9", "E1")],
                      ["gl_account_id", "profit_centre", "legal_entity"]).selectExpr(
        "*", "'1' AS domain_id", "'T24' AS source_system_id")
    centres = literal_rows(spark, [("PC1", "E1"), ("PC1", "E1"), ("PC1", "E2")], ["profit_centre_cd", "entity"])
    got = lines.with_matches(gl, accounts(spark), centres).selectExpr(
        "gl_account_id", "profit_centre", f"{lines.line_ids()} AS ids")
    found = {(r[0], r[1]): r[2] for r in got.collect()}
    assert found["P2", "PC1"] == ["67002", "67003", "67004", "67007", "67011", "67013", "67017"]
    assert found["P3", "PC1"] == ["67006", "67011", "67013", "67017"]  # null level 5
    assert found["P3", "PC9"] == ["67017"]                             # unknown centre
    assert found["A1", "PC9"] == ["13001", "13002", "13004", "13010"]


def test_comparatives_match_three_joins(spark):
    rows = [("k1", 20000131, 1.0), ("k1", 19991231, 2.0), ("k1", 19990228, 4.0), ("k1", 20000229, 8.0),
            ("k2", 20000229, 16.0)]
    names = ["mtd_aed_actual", "mtd_lcy_actual", "ytd_aed_actual", "ytd_lcy_actual"]
    fact = spark.createDataFrame(rows, "k string, time_key int, v double").selectExpr(
        "k", "time_key", *[f"v AS {n}" for n in names])
    got = compare.compare(fact, fact, fact.select("time_key").distinct(), ["k"])
    at = {(r["k"], r["time_key"]): r for r in got.collect()}
    row = at["k1", 20000229]
    assert (row["prev_mth1_mtd_aed"], row["prev_mth2_mtd_aed"], row["prev_yr_curr_mth_ytd_aed"]) == (1.0, 2.0, 4.0)
    assert at["k2", 20000229]["prev_mth1_mtd_aed"] == 0.0
    assert at["k1", 20000131]["prev_mth1_mtd_lcy"] == 2.0


def test_calendar_and_placeholder(spark):
    periods = calendar.periods_frame(spark, [20000331])
    assert calendar.with_offsets(periods).first() == (20000331, 20000229, 20000131, 19990331)
    spans = spark.sql("SELECT DATE'1999-11-15' AS a, DATE'2000-02-01' AS b")
    assert calendar.month_series(spans, "a", "b").count() == 4
    zero = placeholder(periods)
    assert zero.count() == 3 and zero.selectExpr("sum(net_pl)").first()[0] == 0.0


def _facts(spark, factor, classes=("FINACT", "MGTACT", "MGTBGT"), domains_=("007", "19")):
    rows = [(20000229, c, d, float(factor)) for c in classes for d in domains_]
    return spark.createDataFrame(rows, "time_key int, amount_class string, domain_id string, x double")


def test_store_versions(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    assert store.current_version(20000229) is None
    for factor in range(1, 8):
        store.publish(_facts(spark, factor))
    assert store.clean_versions(20000229) == [1, 2]
    assert store.versions(20000229) == [3, 4, 5, 6, 7] and store.current_version(20000229) == 7
    latest = store.read_latest([20000229])
    assert rows_of(latest.select("domain_id", "x").distinct()) == [("007", 7.0), ("19", 7.0)]
    store.replace_class(_facts(spark, 50, ["MGTBGT"], ["19"]), "MGTBGT")
    got = store.read_latest().groupBy("amount_class").agg({"x": "sum"})
    assert rows_of(got) == [("FINACT", 14.0), ("MGTACT", 14.0), ("MGTBGT", 50.0)]
    store.overwrite_period(_facts(spark, 9))
    assert store.versions(20000229) == [1]
    assert store.read_optional([19990228], _facts(spark, 0).where("false")).count() == 0


def test_store_failed_write_keeps_current(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.publish(_facts(spark, 1))
    bad = _facts(spark, 2).selectExpr("time_key", "amount_class", "domain_id", "raise_error('lost') AS x")
    with pytest.raises(Exception):
        store.publish(bad.selectExpr("time_key", "amount_class", "domain_id", "CAST(x AS DOUBLE) AS x"))
    assert store.current_version(20000229) == 1
    assert store.read_latest().count() == 6


def test_store_without_class_level(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "trial"), ["domain_id"])
    store.publish(_facts(spark, 1))
    store.replace_class(_facts(spark, 5, ["MGTBGT"], ["19"]), "MGTBGT")
    got = store.read_latest().groupBy("amount_class").agg({"x": "sum"})
    assert rows_of(got) == [("FINACT", 2.0), ("MGTACT", 2.0), ("MGTBGT", 5.0)]


@pytest.mark.parametrize("levels", [["amount_class", "domain_id"], ["domain_id"]])
def test_store_class_without_rows_goes(spark, tmp_path, levels):
    store = FactStore(spark, str(tmp_path / "fact"), levels)
    store.publish(_facts(spark, 1))
    store.replace_class(_facts(spark, 5).where("false"), "MGTBGT", [20000229])
    got = store.read_latest().groupBy("amount_class").agg({"x": "sum"})
    assert rows_of(got) == [("FINACT", 2.0), ("MGTACT", 2.0)] and store.versions(20000229) == [1]


def test_store_periods_without_rows_show_none(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    other = _facts(spark, 2).withColumn("time_key", F.lit(20000331))
    store.publish(_facts(spark, 1).unionByName(other))
    assert store.save(other, [20000229, 20000331]) == {20000229: 2, 20000331: 2}
    assert rows_of(store.read_latest().groupBy("time_key").count()) == [(20000331, 6)]
    assert store.overwrite_period(other.where("false"), [20000331]) == {20000331: 1}
    assert store.read_latest([20000229, 20000331]).count() == 0
    with pytest.raises(ValueError, match="never published"):
        store.read_latest([19991231])
    with pytest.raises(ValueError, match="not named"):
        store.save(other, [20000229])


def test_store_reads_only_the_folders_asked_for(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    for factor in (1, 2):
        store.publish(_facts(spark, factor).unionByName(_facts(spark, factor).withColumn("time_key", F.lit(20000331))))
    files = store.read_latest([20000229]).inputFiles()
    assert files and all("time_key=20000229/version_id=2/" in f for f in files)


# Accounts by level 1 to 6, domain, source and centre, and the lines they belong to, by hand.
LINE_CASES = {
    "investment": (("10000000", "10300000", "x", "x", "x"), "1", "T24", "PC1", "13000 13002 13008 13010"),
    "performing loan": (("10000000", "10500000", "10510000", "10511000", "x"), "1", "T24", "PC1", "13001 13002 13004 13010"),
    "second loan class": (("10000000", "10500000", "10520000", "10521000", "x"), "1", "T24", "PC1", "13001 13002 13010"),
    "third loan class": (("10000000", "10500000", "10510000", "10512000", "x"), "1", "T24", "PC1", "13001 13002 13010"),
    "not earning": (("10000000", "10600000", "x", "x", "x"), "1", "T24", "PC1", "13002"),
    "deposits": (("30000000", "30300000", "x", "x", "x"), "1", "T24", "PC1", "13003 13005 13011"),
    "equity": (("35000000", "35000000", "x", "x", "x"), "1", "T24", "PC1", "13003"),
    "bank borrowing": (("30000000", "30100000", "30130000", "x", "x"), "1", "T24", "PC1", "13003 13008 13011"),
    "not bearing": (("30000000", "30400000", "x", "x", "x"), "1", "T24", "PC1", "13003"),
    "interest": (("60000000", "60100000", "60110000", "x", "x"), "1", "T24", "PC1", "67001 67004 67007 67011 67013 67017"),
    "fees": (("60000000", "60200000", "60210000", "x", "x"), "1", "T24", "PC1", "67002 67003 67004 67007 67011 67013 67017"),
    "fees, unknown centre": (("60000000", "60200000", "60210000", "x", "x"), "1", "T24", "PC9", "67002 67003 67004 67007 67017"),
    "direct cost": (("70000000", "70300000", "70310000", "x", "x"), "1", "T24", "PC1", "67005 67006 67007 67011 67013 67017"),
    "other cost": (("70000000", "70300000", "x", "x", "x"), "1", "T24", "PC1", "67006 67007 67011 67013 67017"),
    "apart cost": (("70000000", "70300000", "70310000", "x", "70314100"), "1", "T24", "PC1", "67007 67017"),
    "apart cost, other source": (("70000000", "70300000", "70310000", "x", "70314100"), "1", "AEI", "PC1", "67017"),
    "apart cost, own centre": (("70000000", "70300000", "70310000", "x", "70314100"), "1", "AEI", "21010", "67006 67011 67013 67017"),
    "impairment": (("77000000", "x", "x", "x", "x"), "1", "T24", "PC1", "67008 67010 67011 67013 67017"),
    "impairment, unknown centre": (("77000000", "x", "x", "x", "x"), "1", "T24", "PC9", "67008 67017"),
    "tax": (("78000000", "x", "x", "x", "x"), "1", "T24", "PC1", "67009 67011 67013 67017"),
    "equity charge": (("79000000", "x", "x", "x", "x"), "1", "T24", "PC1", "67013 67017"),
    "risk by domain": (("10000000", "10600000", "x", "x", "x"), "20", "T24", "PC1", "13002 67016"),
    "risk account elsewhere": (("10000000", "10600000", "x", "x", "x"), "50", "T24", "PC1", "13002"),
}


def test_every_statement_line(spark):
    ids = {name: f"C{i}" for i, name in enumerate(LINE_CASES)}
    known = literal_rows(spark, [(ids[n], "BS", "N", "d", *c[0], "x") for n, c in LINE_CASES.items()] + [
        ("813714", "BS", "N", "d", "10000000", "10600000", "x", "x", "x", "x")],
        ["gl_account_id", "gl_pl_flag", "is_internal_account", "gl_account_levl2_desc", *LEVELS])
    gl = literal_rows(spark, [(ids[n], c[3], "E1", c[1], c[2]) for n, c in LINE_CASES.items()] + [
        ("813714", "PC1", "E1", "50", "T24"), ("nowhere", "PC1", "E1", "19", "T24"), ("-13000", "PC1", "E1", "19", "T24")],
        ["gl_account_id", "profit_centre", "legal_entity", "domain_id", "source_system_id"])
    centres = literal_rows(spark, [("PC1", "E1"), ("21010", "E1")], ["profit_centre_cd", "entity"])
    got = {r[0]: " ".join(r[1]) for r in lines.with_matches(gl, known, centres)
           .selectExpr("gl_account_id", f"{lines.line_ids()} AS ids").collect()}
    assert {n: got[ids[n]] for n in LINE_CASES} == {n: c[4] for n, c in LINE_CASES.items()}
    assert (got["813714"], got["nowhere"], got["-13000"]) == ("13002 67016", "67016", "")
    assert len({x for c in LINE_CASES.values() for x in c[4].split()}) == 23


# Measures by account levels 3, 4 and 5, by hand.
MEASURE_CASES = [
    ("60110000", "x", "x", "gross_interest_income"), ("60120000", "x", "x", "gross_interest_expense"),
    ("x", "x", "60141100", "asset_cof"), ("x", "x", "60141200", "lp_charge"), ("x", "x", "60131200", "lp_credit"),
    ("x", "x", "60131300", "liability_cof"), ("60150000", "x", "x", "derivatives_income"),
    ("60210000", "x", "x", "fee_income"), ("60230000", "x", "x", "fx_income"),
    ("60240000", "x", "x", "net_investment_income"), ("60161000", "x", "x", "oth_income"),
    ("60250000", "x", "x", "oth_income"), ("60260000", "x", "x", "oth_income"),
    ("x", "60132000", "x", "interbranch_income"), ("x", "x", "60131100", "interbranch_income"),
    ("x", "60142000", "x", "interbranch_expense"), ("x", "x", "60141300", "interbranch_expense"),
    ("60220000", "60133000", "60131400", None),
]


def test_every_measure(spark):
    known = literal_rows(spark, [(str(i), "PL", "N", "d", "x", "x", *c[:3], "x") for i, c in enumerate(MEASURE_CASES)],
                         ["gl_account_id", "gl_pl_flag", "is_internal_account", "gl_account_levl2_desc", *LEVELS])
    names = sorted({c[3] for c in MEASURE_CASES if c[3]})
    assert len(names) == 13
    got = {r["gl_account_id"]: [n for n in names if r[f"is_{n}"]] for r in measures.account_flags(known).collect()}
    assert got == {str(i): [c[3]] if c[3] else [] for i, c in enumerate(MEASURE_CASES)}
