"""Files to cells, and the ingest of whole attachments."""
import json

import pandas as pd
from pyspark.sql import functions as F

from procura.sources import files
from procura.streaming import ingest


def _files(spark, folder):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(folder))


def _rows(cells):
    out = {}
    for r in cells.collect():
        out.setdefault((r["source"], r["file"]), {}).setdefault(r["row_idx"], []).append((r["col_idx"], r["value"]))
    return {k: [[v for _, v in sorted(rows[i])] for i in sorted(rows)] for k, rows in out.items()}


def test_formats(spark, tmp_path):
    unb = tmp_path / "unb"
    unb.mkdir()
    (unb / "a.csv").write_text('\ufeffcena,popis\n1,"x, ""y""\nz"\n,\n', encoding="utf-8")
    (unb / "b.json").write_text(json.dumps([{"cena": 1.5}, {"popis": "č", "x": {"a": 1}}]), encoding="utf-8")
    (unb / "c.json").write_text('{"cena": 2}\n\n{"cena": null}\n')
    pd.DataFrame({"cena": [1, 2], "popis": ["p", None]}).to_parquet(unb / "d.parquet")
    (unb / "e.png").write_bytes(b"x")
    (unb / "empty.csv").write_text("")
    good, failed = files.whole_files(files.attachment_cells(_files(spark, tmp_path)))
    assert _rows(good) == {
        ("unb", "a.csv"): [["cena", "popis"], ["1", 'x, "y"\nz'], [None, None]],
        ("unb", "b.json"): [["cena", "popis", "x"], ["1.5", None, None], [None, "č", '{"a": 1}']],
        ("unb", "c.json"): [["cena"], ["2"], [None]],
        ("unb", "d.parquet"): [["cena", "popis"], ["1", "p"], ["2", None]]}
    assert failed.count() == 0


def test_broken_files_are_listed_and_leave_no_cells(spark, tmp_path):
    (tmp_path / "source=nou" / "file=x.csv").mkdir(parents=True)
    (tmp_path / "source=nou" / "file=x.csv" / "part-0.csv").write_bytes(b"a,b\n1,2\n")
    (tmp_path / "nou").mkdir()
    (tmp_path / "nou" / "y.csv").write_bytes(b"a\n\xff\xfe")
    (tmp_path / "nou" / "z.json").write_text("[{]")
    (tmp_path / "nou" / "w.parquet").write_text("no parquet")
    good, failed = files.whole_files(files.attachment_cells(_files(spark, tmp_path)))
    assert _rows(good) == {("nou", "x.csv"): [["a", "b"], ["1", "2"]]}
    assert {r["file"] for r in failed.collect()} == {"y.csv", "z.json", "w.parquet"}


def test_ingest_adds_new_files_once_and_archives(spark, tmp_path):
    schema = "objednavatel string, popis string, cena double, datum string, dodavatel string"
    d = spark.createDataFrame([("unb", "p", 1.0, "d", "x"), ("nou", "p", 1.0, "d", "x")], schema)
    inbox, table = str(tmp_path / "in"), str(tmp_path / "table")

    def run():
        ingest.ingest(spark, inbox, d.schema, table, str(tmp_path / "ckpt"), lambda b: b, archive=str(tmp_path / "done"))
        return spark.read.parquet(table).count()

    d.coalesce(1).write.parquet(inbox)
    assert run() == 2 and run() == 2
    d.withColumn("cena", F.lit(2.0)).coalesce(1).write.mode("append").parquet(inbox)
    assert run() == 4
    d.withColumn("cena", F.lit(2.0)).coalesce(1).write.mode("append").parquet(inbox)  # stored rows again
    assert run() == 4
    assert len(list((tmp_path / "done").rglob("*.parquet"))) >= 1
