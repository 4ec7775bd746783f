"""Registered queries vs their DuckDB oracle at sf0.001 (order-insensitive)."""
import duckdb
import pandas as pd
import pytest
from conftest import SF001

import __spark_entry__ as E

NAMES = ["search_orders", "final_rows", "parse_dates", "date_fallback", "date_typo_fix", "price_rules_R0",
         "price_rules_R5", "thousands_dot", "extract_quantity", "clean_strings", "pack_attributes",
         "registry_lookup", "symmetric_unique", "new_rows_anti", "upsert_latest", "attachment_select",
         "batch_status", "registry_overrides", "standardise_columns", "web_source_batch", "split_merged_text",
         "paged_source_scan", "upsert_stored", "html_row_spans", "registry_override_log", "source_outcomes", "quarantine_replay",
         "search_sketched", "lookup_indexed"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "events", "documents", "pages"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(df):
    df = df[sorted(df.columns)].astype(object).where(pd.notna(df), None)
    df = df.map(lambda v: v.isoformat() if hasattr(v, "isoformat") else (repr(float(v)) if isinstance(v, float) else v))
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(_norm(got), _norm(want))


def test_every_query_has_an_oracle():
    """All of the library's own; what else the entry adds has tests of its own."""
    from procura.plans.queries import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
