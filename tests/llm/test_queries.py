import duckdb
import pytest

import __spark_entry__ as E
from procura.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
#: not expressible in SQL: learned scores, hashes of other libraries, token ids, Spark's hash
WITHOUT_SQL = {"op3_simhash", "op4_cotrained_quality", "op5_license_notices", "op6_kd_shards",
               "op8_grouped_prefix_join", "op9_kneser_ney_toxicity", "op10_best_fit_packing", "pipeline"}


def test_names():
    assert set(QUERIES) == set(ORACLE) | WITHOUT_SQL
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
