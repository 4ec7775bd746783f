"""Digests and marks beside a stored table: no load reads the history."""

import re

import pytest
from pyspark.sql import functions as F

from procura.operators import dedupe, incremental
from procura.plans import mail
from procura.sources import sinks
from procura.streaming import ingest, state

SCHEMA = "objednavatel string, popis string, cena double, datum timestamp_ntz, dodavatel string, insert_date timestamp_ntz"


def _rows(spark, rows):
    return spark.createDataFrame([(*r, None, None) if len(r) == 3 else r for r in rows], "objednavatel string, popis string, cena double, "
                                 "datum string, dodavatel string").withColumns({
        "datum": F.col("datum").cast("timestamp_ntz"), "insert_date": F.lit("2024-03-01 12:00:30").cast("timestamp_ntz")})


BATCHES = [
    [("unb", "p", 1.0), ("unb", "p", 1.0), ("unb", "p", None), ("nou", "p", 1.0), ("nou", None, None), (None, "p", 1.0)],
    [("unb", "p", 1.0), ("unb", "q", 1.0), ("nou", None, None), ("nou", "null", None), (None, "p", 1.0), (None, "r", 1.0)],
    [("vou", "p", 1.0), ("unb", "p", None)],
]


def _table(spark, path):
    return sorted(map(str, spark.read.parquet(path).select("objednavatel", "popis", "cena").collect()))


def _expected(spark):
    stored = None
    for b in BATCHES:
        d = _rows(spark, b)
        new = d.dropDuplicates(dedupe.ROW_KEYS) if stored is None else dedupe.new_rows_anti(d, stored)
        stored = new if stored is None else stored.unionByName(new)
    return sorted(map(str, stored.select("objednavatel", "popis", "cena").collect()))


@pytest.mark.parametrize("colliding", [False, True])
def test_same_rows_as_a_join_with_all_history(spark, tmp_path, monkeypatch, colliding):
    if colliding:  # digests that tell nothing: the whole keys decide
        monkeypatch.setattr(state, "key_digest", lambda keys=(): F.unhex(F.lit("00" * 16)))
    path = str(tmp_path / "t")
    for b in BATCHES + BATCHES:
        ingest.append_new(_rows(spark, b), path)
    assert _table(spark, path) == _expected(spark)


def test_a_load_that_failed_between_digests_and_rows_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ingest.append_new(_rows(spark, BATCHES[0]), path)
    with monkeypatch.context() as m:
        m.setattr(sinks, "append_table", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            ingest.append_new(_rows(spark, BATCHES[1]), path)
    ingest.append_new(_rows(spark, BATCHES[1]), path)
    ingest.append_new(_rows(spark, BATCHES[2]), path)
    assert _table(spark, path) == _expected(spark)


def test_plan_reads_digests_of_the_batch_sources_only(spark, tmp_path):
    path = str(tmp_path / "t")
    many = [(s, f"p{i}", float(i)) for s in ("unb", "nou", "vou", "dfnbb") for i in range(40)]
    ingest.append_new(_rows(spark, many), path)
    new = state.unseen_rows(_rows(spark, [("nou", "new", 1.0)]), path)
    assert "JOIN" not in new._jdf.queryExecution().toString().upper()  # no hit: no stored row is read
    known = state.known_digests(spark, path, ["nou"])
    assert {re.search("objednavatel=([^/]*)", f)[1] for f in known.inputFiles()} >= {"nou"}
    plan = state.unseen_rows(_rows(spark, [("nou", "p1", 1.0), ("nou", "x", 1.0)]), path)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", physical)
    assert len(filters) >= 2 and all("nou" in f for f in filters)
    assert all("digest" in line for line in physical.splitlines() if re.search("HashJoin|SortMergeJoin", line))
    scans = [line for line in physical.splitlines() if "FileScan parquet" in line]
    assert sum("popis" not in line.split("Batched")[0] for line in scans) >= 1  # the digests' scan reads no key


def test_marks_are_kept_without_the_history(spark, tmp_path):
    path = str(tmp_path / "t")
    late = _rows(spark, [("unb", "z", 1.0, "2024-05-01", None)]).withColumn("insert_date", F.lit("2024-06-01 12:00").cast("timestamp_ntz"))
    for batch in (_rows(spark, BATCHES[0]), late, _rows(spark, [("unb", "y", 1.0, "2023-05-01", None)]), _rows(spark, BATCHES[2])):
        ingest.append_new(batch, path)
    rows = lambda d: sorted(map(str, d.collect()))
    marks = state.read_marks(spark, path)
    assert rows(marks) == rows(incremental.high_water_marks(spark.read.parquet(path)).select(*marks.columns))
    messages = spark.createDataFrame(
        [(1, "a@unb.sk", "2024-05-01", "2024-05-01", "x.csv"), (2, "a@unb.sk", "2024-07-01", "2024-07-01", "x.csv"),
         (3, "a@vou.sk", "2024-02-01", "2024-02-01", "x.csv"), (4, "a@inmm.sk", "2024-02-01", "2024-02-01", "x.csv")],
        "message_id long, sender string, r string, s string, attachment string").withColumns(
        {"received_at": F.col("r").cast("timestamp_ntz"), "sent_on": F.col("s").cast("timestamp_ntz")})
    chosen = mail.selected(spark, messages, path)
    assert sorted(r["message_id"] for r in chosen.collect()) == [2, 4]
    assert all(state.marks_path(path) in f for f in chosen.inputFiles())
    assert len(state._versions(spark, path)) <= state.KEPT_VERSIONS + 1


def test_a_mark_version_that_was_not_written_whole_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    ingest.append_new(_rows(spark, BATCHES[0]), path)
    broken = tmp_path / "t-marks" / "version=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half")
    before = state.read_marks(spark, path).count()
    ingest.append_new(_rows(spark, BATCHES[2]), path)
    assert state.read_marks(spark, path).count() == before + 1


def test_a_batch_leaves_no_stages(spark, tmp_path):
    from procura import session
    table, inbox = str(tmp_path / "t"), str(tmp_path / "in")
    _rows(spark, BATCHES[0]).coalesce(1).write.parquet(inbox)
    held = session.materialize(spark.range(3))
    before = list(session._STORED)
    ingest.ingest(spark, inbox, _rows(spark, BATCHES[0]).schema, table, str(tmp_path / "ckpt"), lambda d: session.materialize(d))
    assert session._STORED == before and held.count() == 3 and spark.read.parquet(table).count() == 5


def test_a_task_sorts_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    from procura.streaming import state
    monkeypatch.setattr(state, "ROWS_A_TASK", 10)
    rows = spark.range(100).selectExpr("concat('s', id % 2) AS objednavatel", "cast(id % 50 AS string) AS popis",
                                       "cast(id AS double) % 50 AS cena", "cast(null AS timestamp_ntz) AS datum", "'d' AS dodavatel")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    batch = state.unseen_rows(rows, str(tmp_path / "t"))
    assert batch.rdd.getNumPartitions() == 10
    assert batch.count() == 50
    assert state.unseen_rows(rows.limit(0), str(tmp_path / "t")).count() == 0
