"""Plan checks: the physical strategy the operators are meant to get."""
import re

from conftest import SF001

import __spark_entry__ as E
from procura.functions import rules
from procura.operators import dedupe
from procura.plans import web


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_is_take_ordered(spark):
    plan = _plan(E.queries()["search_orders"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_registry_lookup_broadcasts_dimension(spark):
    plan = _plan(E.queries()["registry_lookup"](spark, SF001))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_cleaning_stays_in_jvm(spark):
    for name in ["parse_dates", "price_rules_R5", "final_rows", "clean_strings", "pack_attributes"]:
        plan = _plan(E.queries()[name](spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scan_prunes_columns(spark):
    from procura.plans.queries import q_clean_strings
    plan = q_clean_strings(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_attachment_suffix_match_is_equi_join(spark):
    plan = _plan(E.queries()["attachment_select"](spark, SF001))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_search_reads_pruned_parquet(spark):
    plan = _plan(E.queries()["search_orders"](spark, SF001))
    assert "PushedFilters: [IsNotNull(cena), IsNotNull(popis)" in plan or "GreaterThan(cena,1000.0)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"cena", "datum", "popis", "link"}


def test_history_lookup_prunes_sources(spark):
    plan = _plan(E.queries()["history_lookup"](spark, SF001))
    assert re.search(r"PartitionFilters: \[[^\]]*objednavatel#\d+ = unb", plan)


def test_unique_rows_take_one_shuffle(spark):
    d = spark.createDataFrame([("p", 1.0, "d", "x", "f")], "popis string, cena double, datum string, dodavatel string, file string")
    plan = _plan(dedupe.symmetric_unique(d, d))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_page_rows_need_no_shuffle(spark):
    pages = spark.createDataFrame([("fntn", 1, "<table></table>")], "source string, page long, html string")
    assert "Exchange" not in _plan(web.named_rows(pages, rules.FNTN_HEADERS))
