import base64
import hashlib
import random

from procura.llm import warc


def _expected(rows, min_revisit):
    top = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= min_revisit:
            top[body] = max(top.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = body in top and top[body] != page
        out.append((page, len(body), digest, "revisit" if revisit else "response", top[body] if revisit else None))
    return sorted(out)


def _round_trip(spark, rows, path, parts, min_revisit=0, split=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    warc.write_warc(pages, str(path), min_revisit)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = warc.read_warc(spark, str(path), payload=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    out = []
    for r in got:
        revisit = r["type"] == "revisit"
        out.append((int(r["id"][10:-1]), r["claimed_bytes"] if revisit else r["payload_bytes"],
                    r["digest"][5:] if revisit else r["payload_digest"], r["type"],
                    int(r["refers"][10:-1]) if revisit else None))
    return sorted(out), got


INNER = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n")
TRICKY = [INNER, "x\r\n" + INNER, "x\n" + INNER + INNER, "x\n" + INNER + "\nWARC/1.0\r\nContent-Length: 999999\r\n\r\n",
          "\r\nWARC/1.0", "\nWARC/1.", "WARC/1.0\r\n", "\r\n\r\nWARC/1.0", "\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
          "", None, "é ß\r\n\r\n", "a\r\n", "\n"]


def test_start_lines_in_payloads(spark, tmp_path):
    urls = ["http://x/WARC/1.0", None, "http://y\r\nWARC/1.0\r\nContent-Length: 1", "u"]
    rows = [(i, urls[i % 4], t) for i, t in enumerate(TRICKY * 3)]
    for parts in (1, 3):
        got, full = _round_trip(spark, rows, tmp_path / f"a{parts}", parts)
        assert got == _expected(rows, 0)
        body = {int(r["id"][10:-1]): bytes(r["payload"]) for r in full if r["type"] == "response"}
        assert all(body[i] == (t or "").encode() for i, _, t in rows if i in body)


def test_split_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, f"u{i}", rng.choice(TRICKY) or "y" * rng.randrange(300)) for i in range(120)]
    for split in (97, 400, 1500):
        got, _ = _round_trip(spark, rows, tmp_path / f"s{split}", 2, split=split)
        assert got == _expected(rows, 0)


def test_small_payloads_are_responses(spark, tmp_path):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb"), (5, None, None)]
    got, _ = _round_trip(spark, rows, tmp_path / "m", 1, min_revisit=3)
    assert got == _expected(rows, 3)


def test_no_pages_and_extra_columns(spark, tmp_path):
    schema = "page_id long, url string, html string, value string, at int, file string"
    warc.write_warc(spark.createDataFrame([], schema), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
    warc.write_warc(spark.createDataFrame([(None, None, None, "v", 1, "f")], schema), str(tmp_path / "f"))
    r = warc.read_warc(spark, str(tmp_path / "f")).collect()
    assert len(r) == 1 and r[0]["payload_bytes"] == 0 and r[0]["id"] == "<urn:page:null>"


def test_cut_and_broken_archives(spark, tmp_path):
    record = lambda i, n: f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{i}>\r\nContent-Length: {n}\r\n\r\n"
    (tmp_path / "b").mkdir()
    (tmp_path / "b/one").write_bytes((record(1, 3) + "abc\r\n\r\n" + record(2, 9) + "ab").encode())
    (tmp_path / "b/two").write_bytes(("x" + record(3, 3) + "abc\r\n\r\n" + record(4, 1) + "a\r\n\r\n").encode())
    (tmp_path / "b/three").write_bytes((record(5, 7) + "abc\r\n\r\n" + record(6, 1) + "a\r\n\r\n").encode())
    got = {r["id"]: bytes(r["payload"]) for r in warc.read_warc(spark, str(tmp_path / "b"), payload=True).collect()}
    assert got["<1>"] == b"abc" and got["<2>"] == b"ab" and set(got) == {"<1>", "<2>", "<5>"}
