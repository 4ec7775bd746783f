"""Stored upsert, override log, outcomes per source, replay of the quarantine."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from procura.operators import registry
from procura.plans import mail, outcome
from procura.sources import sinks
from procura.streaming import ingest

ROW = "objednavatel string, k int, v string, version int"


def _files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(str(path)).select("objednavatel", "k", "v", "version").collect()), key=str)


def test_upsert_writes_the_folders_that_change(spark, tmp_path):
    path, keys = tmp_path / "t", ["objednavatel", "k"]
    base = [(s, k, "a", 1) for s in ("unb", "nou", "vou") for k in range(6)]
    assert sinks.upsert_table(spark.createDataFrame(base, ROW), str(path), keys) == ["nou", "unb", "vou"]
    before = _files(path)
    changes = spark.createDataFrame([("unb", 1, "b", 2), ("unb", 1, "c", 3), ("unb", 9, "n", 1), ("nou", 2, "old", 0), ("vou", 0, "a", 1)], ROW)
    assert sinks.upsert_table(changes, str(path), keys) == ["unb"]
    after = _files(path)
    assert {f for f in before if "unb" not in f} == {f for f in after if "unb" not in f}
    assert all(before[f] == after[f] for f in after if "unb" not in f)
    want = sorted([r for r in base if r[:2] != ("unb", 1)] + [("unb", 1, "c", 3), ("unb", 9, "n", 1)], key=str)
    assert _rows(spark, path) == want
    assert sinks.upsert_table(changes, str(path), keys) == [] and _files(path) == after
    assert sinks.upsert_table(changes.limit(0), str(path), keys) == [] and _files(path) == after
    assert sinks.upsert_table(spark.createDataFrame([("neu", 1, "x", 1), (None, 1, "y", 1)], ROW), str(path), keys) == [None, "neu"]
    assert {r[0] for r in _rows(spark, path)} == {"unb", "nou", "vou", "neu", None}


def test_failed_upsert_leaves_the_table(spark, tmp_path):
    path, keys = tmp_path / "t", ["objednavatel", "k"]
    sinks.upsert_table(spark.createDataFrame([("unb", k, "a", 1) for k in range(6)], ROW), str(path), keys)
    before, rows = _files(path), _rows(spark, path)
    bad = spark.createDataFrame([("unb", k, "b", 2) for k in range(6)], ROW).withColumn(
        "v", F.when(F.col("k") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        sinks.upsert_table(bad, str(path), keys)
    assert _files(path) == before and _rows(spark, path) == rows
    with pytest.raises(ValueError):
        sinks.upsert_table(bad, str(path), ["k"])


def test_override_log_is_an_ordered_fold(spark):
    dim = spark.createDataFrame([("a", {"x": "0", "y": "0"}), ("b", {"x": "0"}), ("e", {})], "key string, attributes map<string,string>")
    log = [(5, "a", "x", "late", False), (1, "a", "x", "early", False), (2, "b", "x", "gone", False), (3, "b", "z", "new", True),
           (3, "b", "w", "new", True), (4, "b", "z", "patched", False), (2, "c", "q", "lost", False), (3, "c", "q", "made", True),
           (4, "c", "r", "more", False), (6, "d", "x", "lost", False), (1, "f", "p", "one", True), (2, "f", "s", "two", True)]
    for order in (log, log[::-1]):
        entries, errors = registry.apply_override_log(dim, spark.createDataFrame(order, "seq long, key string, attr string, value string, replace_all boolean"))
        assert {r["key"]: r["attributes"] for r in entries.collect()} == {
            "a": {"x": "late", "y": "0"}, "b": {"z": "patched", "w": "new"}, "c": {"q": "made", "r": "more"}, "e": {}, "f": {"s": "two"}}
        assert sorted((r["seq"], r["key"], r["error"]) for r in errors.collect()) == [(2, "c", "override:unknown_key"), (6, "d", "override:unknown_key")]
    assert registry.registered_overrides(spark).count() == 18


def test_outcomes_are_apart(spark, tmp_path):
    schema = "objednavatel string, k int, _errors array<string>"

    def load(source):
        if source == "none":
            raise outcome.DataNotAvailable(source)
        if source == "plan":
            return spark.createDataFrame([], schema).select("missing")
        d = spark.createDataFrame([] if source == "empty" else [(source, k, ["e"] if k == 1 else []) for k in range(4)], schema)
        return d.withColumn("k", F.when(F.col("k") == 3, F.raise_error(F.lit("x"))).otherwise(F.col("k"))) if source == "task" else d

    def sink(rows):
        if rows.first()["objednavatel"] == "sink":
            raise OSError("disk full")
        rows.write.mode("append").parquet(str(tmp_path / "t"))

    got = {r["objednavatel"]: tuple(r)[1:] for r in outcome.run_sources(
        spark, ["good", "plan", "task", "none", "empty", "sink", "last"], load, sink).collect()}
    assert got["good"] == got["last"] == (4, 1, "ok", None)
    assert got["none"] == got["empty"] == (0, 0, "no_new_data", None)
    assert got["plan"][2] == got["task"][2] == got["sink"][2] == "failed"
    assert "UNRESOLVED_COLUMN" in got["plan"][3] and "USER_RAISED_EXCEPTION" in got["task"][3] and got["sink"][3] == "OSError: disk full"
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8


def _raw(spark, rows):
    columns = {c: F.lit(None).cast("string") for c in mail.RAW}
    d = spark.createDataFrame(rows, "objednavatel string, objednavka_cislo string, cena string, datum string")
    d = d.withColumns({c: v for c, v in columns.items() if c not in d.columns})
    return d.withColumn("insert_date", F.lit("2024-03-01 12:00").cast("timestamp_ntz"))


def test_replay_takes_a_row_once(spark, tmp_path, monkeypatch):
    dim = spark.createDataFrame([("univerzitna nemocnica bratislava", {registry.LINK_ATTR: "l"})], "key string, attributes map<string,string>")
    raw = _raw(spark, [("unb", "1", "1,50", "1.2.2024"), ("unb", "2", "2,50", "31.4.2024"), ("unb", "3", "x", "1.2.2024"), ("unb", "4", "4", "31.4.2024")])
    table, held = str(tmp_path / "table"), str(tmp_path / "quarantine")
    rows = mail.with_raw(raw, dim)
    ingest.append_new(mail.divert_errors(rows, held), table)
    repair = lambda d: d.withColumn("datum", F.regexp_replace("datum", "^31.4", "30.4"))
    stored = lambda: sorted(r["cena"] for r in spark.read.parquet(table).collect())
    assert stored() == [1.5]
    assert mail.replay_quarantine(spark, held, table, dim, lambda d: d).count() == 0 and stored() == [1.5]
    # the list of replayed rows cannot be written: the rows are there, the next run adds nothing to them
    real = ingest.append_new
    with monkeypatch.context() as m:
        m.setattr(ingest, "append_new", lambda *a: (real(*a), (_ for _ in ()).throw(OSError("disk")))[0])
        with pytest.raises(OSError):
            mail.replay_quarantine(spark, held, table, dim, repair)
    assert stored() == [1.5, 2.5, 4.0]
    for _ in range(2):
        assert mail.replay_quarantine(spark, held, table, dim, repair).count() == 0
        assert stored() == [1.5, 2.5, 4.0]
    assert [r["cena"] for r in mail.still_quarantined(spark, held).collect()] == [None]
    assert mail.replay_quarantine(spark, str(tmp_path / "nothing"), table, dim, repair).count() == 0
