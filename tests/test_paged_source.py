"""The paged data source against the rule over all pages."""

import datetime as dt
import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from procura.functions import dates
from procura.sources import paged


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Site:
    """Pages in memory; each fetch leaves a file, a page may fail."""

    def __init__(self, folder, pages, broken=()):
        self.folder, self.all, self.broken = str(folder), pages, set(broken)

    def sources(self):
        return sorted(self.all)

    def pages(self, source):
        import os
        import uuid
        for n, html in enumerate(self.all[source], 1):
            with open(os.path.join(self.folder, f"{source}-{n}-{uuid.uuid4().hex}"), "w"):
                pass
            if (source, n) in self.broken:
                raise ConnectionError("gone")
            yield n, html

    def fetched(self):
        import os
        out = sorted(f.rsplit("-", 1)[0] for f in os.listdir(self.folder))
        for f in os.listdir(self.folder):
            os.remove(os.path.join(self.folder, f))
        return out


def _page(*days):
    return "<table>" + "".join(f"<tr><td>{d}</td></tr>" for d in days) + "</table>"


PAGES = {"a": [_page(f"{28 - i}.3.2024", f"2024-03-{27 - i:02d}") for i in range(0, 18, 2)],
         "b": [_page(f"{9 - i}. 2. 2024") for i in range(9)], "c": [_page("x"), _page("y")]}


def test_reads_no_page_behind_the_first_below_the_mark(spark, tmp_path):
    site = Site(tmp_path, PAGES)
    pages, failed = paged.read_pages(spark, site, {"a": "2024-03-22", "b": "2024-02-09 10:00:00"}, "counted")
    got = sorted((r["source"], r["page"]) for r in pages.collect())
    # page 4 holds 22. and 21. March, page 5 is the first below the mark; c has no mark
    assert got == [("a", n) for n in range(1, 6)] + [("b", 1), ("b", 2), ("c", 1)]
    assert site.fetched() == [f"{s}-{n}" for s, n in got]
    assert failed.count() == 0


def test_a_failed_page_keeps_the_pages_before_it(spark, tmp_path):
    site = Site(tmp_path, PAGES, {("b", 4), ("c", 1)})
    pages, failed = paged.read_pages(spark, site, {"a": "2024-01-01", "b": "2024-01-01"}, "failing")
    assert sorted((r["source"], r["page"]) for r in pages.collect()) == [("a", n) for n in range(1, 10)] + [("b", n) for n in (1, 2, 3)]
    rows = {r["source"]: (r["page"], r["page_error"]) for r in failed.collect()}
    assert rows == {"b": (4, "page:ConnectionError: gone"), "c": (None, "page:ConnectionError: gone")}


def test_stream_reads_what_is_new_since_the_last_trigger(spark, tmp_path):
    root, log, out = tmp_path / "site", tmp_path / "log", str(tmp_path / "out")

    def write(days):
        # newest first: all pages move on
        for old in root.rglob("page.html"):
            old.unlink()
        for n, d in enumerate(days, 1):
            (root / "source=a" / f"page={n}").mkdir(parents=True, exist_ok=True)
            (root / "source=a" / f"page={n}" / "page.html").write_text(_page(d))

    spark.dataSource.register(paged.paged_source(paged.FolderPages(str(root)), "moving"))

    def trigger():
        q = (spark.readStream.format("moving").load().select("source", "html").writeStream.format("parquet")
                  .option("checkpointLocation", str(log)).option("path", out).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r["html"] for r in spark.read.schema("source string, html string").parquet(out).collect())

    write([f"{9 - i}.2.2024" for i in range(4)])
    first = trigger()
    assert first == sorted(_page(f"{9 - i}.2.2024") for i in range(4))
    assert trigger() == first
    write([f"{12 - i}.2.2024" for i in range(7)])
    # the new pages, the one on the mark again, and the one that ended the scan
    assert trigger() == sorted(first + [_page(f"{d}.2.2024") for d in (12, 11, 10, 9, 8)])


FORMS = ["2024-03-05 00:00:00", "5.3.2024", "5. 3. 2024", "5/3/24", "05.03.2024 - 09.03.2024", "1. - 5.3.2024", "1 5.3.2024",
         "pondelok. marca 05. 2024", "31.4.2024", "12.-16.10.2018", "1.-2.3", "streda 6.februar 2019", "5.9.1999", "x", ""]


def test_bound_is_never_below_a_parsed_date(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice(FORMS) for _ in range(rng.randrange(1, 4))]) for i in range(80)]
    d = spark.createDataFrame([(i, x, _page(*v), x) for i, v in rows for x in v], "i int, x string, html string, raw string")
    d = dates.parse_dates_df(d, "raw", "datum")
    d = d.groupBy("i").agg(F.max("datum").alias("top"), F.first("html").alias("html")).withColumn("bound", paged.date_bound_of(F.col("html")))
    for r in d.collect():
        assert r["bound"] == paged.date_bound(r["html"])
        assert r["top"] is None or r["bound"] >= int(r["top"].strftime("%Y%m%d"))
    assert paged.date_bound(None) == 0 and spark.range(1).select(paged.date_bound_of(F.lit(None).cast("string"))).first()[0] == 0


@pytest.mark.parametrize("mark", [None, "2024-03-22", "2024-03-01"])
def test_pages_within_the_mark(spark, mark):
    d = spark.createDataFrame([(s, n, h) for s, v in PAGES.items() for n, h in enumerate(v, 1)], "source string, page int, html string")
    marks = spark.createDataFrame([("a", dt.datetime.fromisoformat(mark) if mark else None)], "source string, hwm timestamp_ntz")
    got = [r["page"] for r in paged.pages_within(d.where("source = 'a'"), marks).collect()]
    assert len(got) == {None: 1, "2024-03-22": 5, "2024-03-01": 9}[mark]
    assert json.dumps(sorted(got)) == json.dumps(list(range(1, len(got) + 1)))
