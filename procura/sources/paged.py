"""Paged web sources (S4, W2): a Spark data source that reads the pages of a source in
order, newest first, and stops at the first page below the source's mark.

Which page is below the mark is told by an upper bound of the dates on it (``DATES``):
never too early, so ``incremental.paged_hwm_scan`` over the pages read gives the rows of a
scan over all pages.  A page that cannot be fetched ends its source: the pages before it are
kept, and a row with ``page_error`` names it; other sources are not touched.

Batch: one partition a source, whose pages are fetched lazily.  Stream: the offset holds the
mark of each source; a trigger moves it to the bound of the newest page and reads what lies
between (rows dated on the old mark come again, for the key comparison of the append).
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# the source goes to the executors by value: they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "source string, page long, html string, page_error string"
#: whole dates as (pattern, groups of year, month, day); every form of the date parser has
#: its year in one of these, or is a loose year, or has the fixed year below
DATES = ((r"(?<!\d)(20\d{2})-(\d{1,2})-(\d{1,2})", (1, 2, 3)),
         (r"(?<!\d)(\d{1,2})\.\s*(\d{1,2})\.\s*(20\d{2})(?!\d)", (3, 2, 1)),
         (r"(?<!\d)(\d{1,2})/(\d{1,2})/(\d{2})", (3, 2, 1)))
LOOSE_YEAR = r"20\d{2}"
NO_YEAR, FIXED_YEAR = r"\d+\.-\d+\.\d+", 2017


def date_bound(page: str | None) -> int:
    """No date on the page is later: yyyymmdd, 0 without any."""
    text, best = page or "", 0
    for pattern, (y, m, d) in DATES:
        for found in re.finditer(pattern, text):
            best = max(best, (int(found[y]) % 100 + 2000) * 10_000 + int(found[m]) * 100 + int(found[d]))
    rest = text
    for pattern, _ in DATES:
        rest = re.sub(pattern, " ", rest)
    best = max([best, *(int(y) * 10_000 + 1231 for y in re.findall(LOOSE_YEAR, rest))])
    return max(best, FIXED_YEAR * 10_000 + 1231) if re.search(NO_YEAR, text) else best


def date_bound_of(page: Column) -> Column:
    """``date_bound`` as an expression."""
    number = lambda c: c.cast("int")
    bounds, rest = [F.lit(0)], F.coalesce(page, F.lit(""))
    for pattern, (y, m, d) in DATES:
        found = [F.regexp_extract_all(page, F.lit(pattern), F.lit(g)) for g in (y, m, d)]
        bounds.append(F.array_max(F.zip_with(F.zip_with(*found[:2], lambda a, b: (number(a) % 100 + 2000) * 10_000 + number(b) * 100),
                                             found[2], lambda a, b: a + number(b))))
        rest = F.regexp_replace(rest, pattern, " ")
    loose = F.array_max(F.transform(F.regexp_extract_all(rest, F.lit(LOOSE_YEAR), F.lit(0)), number)) * 10_000 + 1231
    fixed = F.when(page.rlike(NO_YEAR), F.lit(FIXED_YEAR * 10_000 + 1231))
    return F.greatest(*bounds, loose, fixed)


def as_number(mark: str | None) -> int | None:
    """A mark (ISO date or time) as yyyymmdd."""
    return None if mark is None else int(mark[:10].replace("-", ""))


def pages_within(pages: DataFrame, marks: DataFrame) -> DataFrame:
    """The stored ``pages`` (source, page, html) that a scan to ``marks`` (source,
    hwm) would fetch: up to the first one below the mark, or the first page of a
    source without a mark.  One regex pass; no table is parsed."""
    bound = pages.select("source", "page", date_bound_of(F.col("html")).alias("_bound")).join(marks.select("source", "hwm"), "source", "left")
    mark = F.date_format("hwm", "yyyyMMdd").cast("int")
    stops = bound.groupBy("source").agg(F.min(F.when(F.coalesce(F.col("_bound") < mark, F.lit(True)), F.col("page"))).alias("_stop"))
    return pages.join(stops, "source").where(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop"))).drop("_stop")


class FolderPages:
    """A site kept as text files ``source=<name>/page=<number>/`` below a folder that all
    tasks reach.  ``pages`` fetches one page after the other."""

    def __init__(self, root: str):
        self.root = root

    def _open(self):
        from pyarrow import fs
        local = re.sub(r"^file:/*", "/", self.root)
        return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(self.root)

    def _folders(self, path: str, key: str) -> list[str]:
        from pyarrow import fs
        system, _ = self._open()
        names = [i.base_name for i in system.get_file_info(fs.FileSelector(path))]
        return [n.split("=", 1)[1] for n in names if n.startswith(key + "=")]

    def sources(self) -> list[str]:
        return sorted(self._folders(self._open()[1], "source"))

    def numbers(self, source: str) -> list[int]:
        return sorted(int(n) for n in self._folders(f"{self._open()[1]}/source={source}", "page"))

    def fetch(self, source: str, page: int) -> str:
        from pyarrow import fs
        system, root = self._open()
        files = system.get_file_info(fs.FileSelector(f"{root}/source={source}/page={page}"))
        parts = sorted(i.path for i in files if not i.base_name.startswith(("_", ".")))
        return "".join(system.open_input_stream(p).read().decode("utf-8") for p in parts)

    def pages(self, source: str) -> Iterator[tuple[int, str]]:
        for n in self.numbers(source):
            yield n, self.fetch(source, n)


def scan(site, source: str, mark: int | None) -> Iterator[tuple]:
    """Rows of SCHEMA for the pages of a source down to ``mark`` (None: one page)."""
    last = None
    try:
        for page, html in site.pages(source):
            yield source, page, html, None
            last = page
            if mark is None or date_bound(html) < mark:
                return
    except Exception as e:  # noqa: BLE001  whatever a site raises ends its own source only
        yield source, None if last is None else last + 1, None, f"page:{type(e).__name__}: {e}"[:200]


class _Source(InputPartition):
    def __init__(self, source: str, mark: int | None):
        self.source, self.mark = source, mark


def paged_source(site, name: str = "paged") -> type[DataSource]:
    """A data source over ``site`` (``sources()`` and ``pages(source)``), to be
    registered with ``spark.dataSource.register``.  Option ``marks``: JSON of source
    to mark; option ``only``: JSON list of sources (default: all of the site)."""

    def asked(options) -> tuple[list[str], dict]:
        only = options.get("only")
        return json.loads(only) if only else site.sources(), json.loads(options.get("marks", "{}"))

    class Batch(DataSourceReader):
        def __init__(self, options):
            self.names, self.marks = asked(options)

        def partitions(self):
            return [_Source(s, as_number(self.marks.get(s))) for s in self.names]

        def read(self, partition):
            return scan(site, partition.source, partition.mark)

    class Stream(DataSourceStreamReader):
        def __init__(self, options):
            self.names, self.marks = asked(options)
            self.before = {}

        def initialOffset(self):
            return {s: as_number(self.marks.get(s)) for s in self.names}

        def latestOffset(self):
            out = {}
            for s in self.names:
                first = next((r for r in scan(site, s, None)), None)
                # a source that cannot be reached, or is empty, stays where it was
                known = date_bound(first[2]) if first is not None and first[3] is None else None
                out[s] = max((x for x in (self.before.get(s), known) if x), default=None)
            self.before = out
            return out

        def partitions(self, start, end):
            self.before = dict(end)
            return [_Source(s, start.get(s)) for s in self.names if end.get(s) != start.get(s) or start.get(s) is None]

        def read(self, partition):
            # without a mark all pages are new
            return scan(site, partition.source, partition.mark or 1)

        def commit(self, end):
            pass

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Batch(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return Paged


def read_pages(spark: SparkSession, site, marks: dict[str, str | None], name: str = "paged") -> tuple[DataFrame, DataFrame]:
    """(pages, failed): the pages of each source down to its mark, and the pages
    that could not be fetched with the reason."""
    spark.dataSource.register(paged_source(site, name))
    read = spark.read.format(name).option("marks", json.dumps(marks)).load()
    return read.where("page_error IS NULL").drop("page_error"), read.where("page_error IS NOT NULL").drop("html")
