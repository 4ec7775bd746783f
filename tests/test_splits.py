"""Files read by splits give the rows of plain readers."""

import csv
import io
import json
import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from procura.sources import delimited, files


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _files(spark, folder):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(folder))


def _rows(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["path"].rsplit("/", 1)[-1], []).append((r["row_idx"], r["fields"]))
    return {k: sorted(v) for k, v in out.items()}


def _plain(text):
    return list(enumerate(csv.reader(io.StringIO(text, newline=""))))


def _write(folder, texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / name).write_text(text, encoding="utf-8", newline="")
    return [str(folder / n) for n in texts]


def test_csv_rows_equal_a_sequential_reader(spark, tmp_path, small_splits):
    rng = random.Random(8)
    cells = ["", "a", "x y", "č,ď", 'say "hi"', "two\nlines", '"', '""', ",", "\n\n", "1.5", " lead", "a\n\"b\",\nc"]

    def well_formed(n, choice):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator="\n")
        for _ in range(n):
            writer.writerow([rng.choice(choice) for _ in range(rng.randrange(1, 6))])
        return out.getvalue()

    texts = {"plain.csv": well_formed(150, cells[:4]), "breaks.csv": well_formed(300, cells), "one.csv": "a,b", "end.csv": "a,b\n1,2\n\n3\n\n",
             "windows.csv": well_formed(60, cells[:5]).replace("\n", "\r\n"), "[odd] {name}*+ č%41.csv": 'a,"b\nc"\n'}
    # quotes anywhere: the rules of a lenient reader
    for i in range(4):
        texts[f"odd{i}.csv"] = "".join(rng.choice(['"', '""', ",", "a", "b", "\n", "a,b\n", '",', ',"', '"\n']) for _ in range(400)) + '\n"x"\n'
    paths = _write(tmp_path / "in", texts)
    assert delimited.lines_of(spark, [paths[1]]).rdd.getNumPartitions() > 4
    rows, failed = delimited.csv_rows(spark, paths)
    got = _rows(rows)
    assert failed.count() == 0
    for name, text in texts.items():
        assert got.get(name, []) == _plain(text), name


def test_breaks_across_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(200))
    text = f'k,v\n1,"{long}"\n2,"y"\n3,"{long}\n"\n4,z\n' * 3
    paths = _write(tmp_path / "in", {"a.csv": text})
    rows, failed = delimited.csv_rows(spark, paths)
    assert _rows(rows)["a.csv"] == _plain(text) and failed.count() == 0


def test_a_quote_that_is_never_closed(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(delimited, "ROW_CHARS", 500)
    paths = _write(tmp_path / "unb", {"a.csv": 'k\n"' + "x\n" * 400, "b.csv": 'k\n"x\ny"\n'})
    good, failed = files.whole_files(files.attachment_cells(_files(spark, tmp_path)))
    assert [(r["file"], r["file_error"]) for r in failed.collect()] == [("a.csv", "file:row_too_long")]
    assert sorted((r["file"], r["row_idx"], r["value"]) for r in good.collect()) == [("b.csv", 0, "k"), ("b.csv", 1, "x\ny")]
    assert len(paths) == 2


def test_json_in_any_layout(spark, tmp_path, small_splits):
    rng = random.Random(3)
    records = [{k: rng.choice(["a", "é \"q\" [,]", 1, 2.5, None, True, {"x": [1, "b: c"], "a": {}}, [], "true", "[x"])
                for k in rng.sample("pqrstu", rng.randrange(1, 6))} for _ in range(90)]
    texts = {"lines.json": "\n".join(json.dumps(r) for r in records), "gaps.json": "\n\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n",
             "array.json": json.dumps(records), "pretty.json": json.dumps(records, indent=1),
             "broken.json": "[\n" + ",\n".join(json.dumps(r) for r in records) + "\n]\n",
             "tight.json": "[" + "\n,".join(json.dumps(r) for r in records) + "]", "none.json": "", "empty.json": "[]"}
    rows, failed = delimited.json_rows(spark, _write(tmp_path / "in", texts))
    names = list(dict.fromkeys(k for r in records for k in r))

    def text(v):
        return v if v is None else json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else str(v)

    want = [(0, names)] + [(i, [text(r.get(n)) for n in names]) for i, r in enumerate(records, 1)]
    got = _rows(rows)
    assert failed.count() == 0
    for name in ("lines.json", "gaps.json", "array.json", "pretty.json", "broken.json", "tight.json"):
        assert got[name] == want, name
    assert "none.json" not in got


def test_parquet_of_several_schemas_and_row_groups(spark, tmp_path, small_splits):
    folder = tmp_path / "unb"
    folder.mkdir()
    big = pa.table({"cena": list(range(500)), "popis": [f"p{i}" if i % 7 else None for i in range(500)]})
    pq.write_table(big, folder / "big.parquet", row_group_size=40)
    pq.write_table(big.slice(0, 3), folder / "small.parquet")
    pd.DataFrame({"x": [1.5], "s": [[1, 2]]}).to_parquet(folder / "other.parquet")
    rows, failed = files.parquet_rows(spark, [str(folder / n) for n in ("big.parquet", "small.parquet", "other.parquet")])
    got = _rows(rows)
    assert got["big.parquet"] == [(0, ["cena", "popis"])] + [(i + 1, [str(i), f"p{i}" if i % 7 else None]) for i in range(500)]
    assert got["small.parquet"] == got["big.parquet"][:4] and got["other.parquet"] == [(0, ["x", "s"]), (1, ["1.5", "[1,2]"])]
    assert failed.count() == 0


def test_no_python_reads_the_cells(spark, tmp_path):
    folder = tmp_path / "unb"
    _write(folder, {"a.csv": 'k\n"x\ny"\n', "b.json": '{"k": 1}', "c.csv": "k\n1\n"})
    pd.DataFrame({"k": [1]}).to_parquet(folder / "d.parquet")
    cells = files.attachment_cells(_files(spark, tmp_path))
    plan = cells._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan and "ArrowEval" not in plan
    assert cells.where(F.col("row_idx") == 1).count() == 4
