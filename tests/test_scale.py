"""Plans that must not do a step more often than the input asks for."""

import pytest
from pyspark.sql import functions as F

from ledgermill import schemas, testmap
from ledgermill.catalogue import queries
from ledgermill.catalogue.queries import QUERIES
from ledgermill.operators import anchor, lines, lookup, reconcile
from ledgermill.plans import base as base_plan
from ledgermill.session import stage
from ledgermill.sources import ingest

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_split_once(spark, tmp_path):
    (tmp_path / "one.dat").write_text("~".join(map(str, range(51))))
    rows = ingest.accepted(ingest.parse(ingest.read_lines(spark, str(tmp_path), header="")))
    assert plan(rows.groupBy("time_key").count()).count("split(value") == 1


def test_queries_compile_in_any_session(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    QUERIES["dim_scan"](spark, SF)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_fact_is_not_moved_for_a_few_accounts(spark, tmp_path):
    """A lookup of a dimension that is large only before it is collapsed."""
    spark.range(300_000).selectExpr("concat('A', id % 20) AS account", "uuid() AS text").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    fact = spark.range(10_000_000).selectExpr("id", "concat('A', id % 25) AS account_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        found = lookup.lookup(fact, dim, {"account_id": "account"}, {"known": "account"})
        physical = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in physical and "BroadcastHashJoin" in physical
        assert found.where("known IS NULL").count() == 2_000_000 and found.count() == 10_000_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_account_sums_that_follow_from_others_are_not_carried(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        found = plan(QUERIES["gl_aggregate"](spark, SF)).lower()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert "floor(gross_interest_income#" in found
    assert not [n for n in ("net_interest_income", "net_pl_ytd_lcy", "mtd_aed_actual", "rwa_total") if f"floor({n}#" in found]


@pytest.mark.parametrize("name", ["store_retention", "store_publish_version", "contract_join_latest", "sentinel_routing"])
def test_ledger_is_built_once(spark, monkeypatch, name):
    made, build = [], testmap.ledger
    monkeypatch.setattr(testmap, "ledger", lambda *a, **k: made.append(1) or build(*a, **k))
    QUERIES[name](spark, SF)
    assert len(made) == 1


def test_customer_sums_that_follow_from_others_are_not_carried(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        found = plan(QUERIES["customer_aggregate"](spark, SF)).lower()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert "floor(gross_interest_income#" in found
    assert not [n for n in ("net_interest_income", "net_pl_ytd_lcy", "total_ftp_amt", "rwa_total") if f"floor({n}#" in found]


def test_control_totals_compute_a_frame_once(spark):
    rows = spark.range(7).selectExpr("CAST(id AS DOUBLE) AS a", "id / 4 AS b")
    found = reconcile.control_totals({"x": (rows, "a"), "y": (spark.range(2).selectExpr("1D AS a"), "a"), "z": (rows, "b")})
    assert plan(found).count("Range (") == 2
    assert sorted(map(tuple, found.collect())) == [("x", 7, 21.0), ("y", 2, 2.0), ("z", 7, 5.25)]


@pytest.mark.parametrize("name", ["anchor_rank", "anchor_merge"])
def test_only_columns_that_are_read_are_written(spark, name):
    folders = {f.rsplit("/", 1)[0] for f in QUERIES[name](spark, SF).inputFiles() if "/classified-" in f}
    written = {c for f in folders for c in spark.read.parquet(f).columns}
    assert {"line_no", "gl_account_id"} <= written and "avg_book_bal_ltd_acy" not in written


def test_balances_that_nobody_reads_are_not_written(spark):
    """Classified rows of the aggregates; what is read after all fails and is never taken for a value."""
    def written(df):
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/classified-" in f}
        return {c for f in folders for c in spark.read.parquet(f).columns}

    tagged, aggregate = written(QUERIES["rule_tagging"](spark, SF)), written(QUERIES["gl_aggregate"](spark, SF))
    assert {"line_no", "outstanding_balance_ytd_lcy"} <= tagged and "avg_book_bal_mtd_aed" not in tagged
    assert "avg_book_bal_mtd_aed" in aggregate and not {"mtd_acy", "avg_book_bal_ltd_aed"} & aggregate
    base = base_plan.base_fact(testmap.ledger(spark, SF), testmap.gl_accounts(spark, SF), testmap.domain(spark), ["mtd_aed"])
    assert base.where("mtd_aed > 0").count() > 0
    with pytest.raises(Exception, match="not written: avg_book_bal_ltd_aed"):
        base.select("avg_book_bal_ltd_aed").collect()


def test_reloaded_sums_keep_only_what_they_add_up(spark, monkeypatch):
    made, keep = [], queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, label: made.append(keep(df, label)) or made[-1])
    QUERIES["incremental_customer"](spark, SF)
    assert len(made) == 3  # all rows, and the two reloads with new amounts
    for rows in made:
        assert set(rows.columns) == {*schemas.CUSTOMER_KEYS, "contract_id", *testmap.RELOADED}


def test_deals_are_sorted_by_what_tells_them_apart(spark):
    df = spark.createDataFrame([], ", ".join(f"{k} string" for k in [*schemas.DEAL_KEYS, *anchor.ANCHOR_ORDER, "line_no"]))
    found = anchor.anchor_rows(df, schemas.DEAL_KEYS)
    assert found.columns[:13] == schemas.DEAL_KEYS
    first = found._jdf.queryExecution().executedPlan().toString().split("Sort [")[1]
    assert first.startswith("contract_id#") and "customer_number#" in first.split(",")[1]


def test_staging_leaves_no_shuffle_files_and_little_text(spark):
    """Steps of a job do not hold the disk that earlier ones needed for their shuffles."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = files.getAllFiles().size(), spark.conf.get(setting)
    rows = stage(spark.range(1000).repartition(5).groupBy(F.expr("id % 10 AS k")).count(), "sums")
    assert files.getAllFiles().size() <= before and spark.conf.get(setting) == held
    assert rows.count() == 10 and all(f.endswith(".zstd.parquet") for f in rows.inputFiles())


def test_written_extract_is_compressed_and_read_back(spark, tmp_path):
    raw = testmap.raw_rows(spark, SF)
    ingest.write_extract(raw, str(tmp_path / "extract"))
    lines = ingest.read_lines(spark, str(tmp_path / "extract"))
    assert all(f.endswith(".csv.gz") for f in spark.read.text(str(tmp_path / "extract")).inputFiles())
    assert ingest.accepted(ingest.parse(lines)).count() == raw.count()


def test_rows_move_once_for_all_statement_lines(spark):
    names = [*schemas.GL_KEYS, "time_key"]
    gl = spark.createDataFrame([], ", ".join([*[f"{k} string" for k in names], "mtd_aed double"]))
    out = lines.statement_lines(gl, testmap.gl_accounts(spark, SF), testmap.profit_centre(spark, SF), measures=["mtd_aed"])
    found = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in found.split("Generate explode")[1] and "Exchange" not in found.split("Generate explode")[0]
