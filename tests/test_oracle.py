"""Queries against the second engine on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgermill import testmap
from ledgermill.catalogue import oracle, queries
from ledgermill.operators import tags

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
CHECKED = ["ingest_ledger_keys", "ingest_row_id_check", "scope_filters", "dim_collapse", "select_balance", "rwa_classify", "pl_rollup", "anchor_rank",
           "prior_period_compare", "latest_valid_contract", "trimmed_key_join", "sentinel_routing",
           "store_overwrite_period", "store_replace_class", "calendar_series", "base_fact", "gl_fact",
           "latest_valid_customer", "contract_join_sentinel", "contract_join_latest", "trial_balance",
           "statement_lines", "tag_writeback", "comparatives_refresh"]


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted(repr([r[i] for i in order]) for r in rows)


def test_every_query_has_a_statement():
    assert set(queries.QUERIES) == set(oracle.statements())


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, engine, name):
    df = entry.queries()[name](spark, SF)
    cursor = engine.execute(entry.oracle_sql()[name])
    expected = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_tags_in_place_equal_join(spark):
    from ledgermill.catalogue.queries import _tag_rows
    rows, dims = _tag_rows(spark, SF), testmap.dimensions(spark, SF).for_tags()
    joined = tags.write_back(rows, tags.tag_set(rows, dims))
    in_place = tags.tag_in_place(rows, dims).select(*joined.columns)
    assert in_place.exceptAll(joined).count() == 0 and joined.exceptAll(in_place).count() == 0
