"""The paged high-water-mark scan against a plain page-by-page loop."""
import datetime as dt
import random

from procura.operators.incremental import paged_hwm_scan


def _loop(pages, hwm):
    """The pager as written: read page 1, keep reading while the mark is at
    or before the latest date of the last page read, then drop older rows."""
    read = [pages[0]]
    last_max = max([d for d in pages[0] if d is not None], default=None)
    if last_max is None:
        return [(1, d) for d in pages[0]]
    i = 1
    while hwm is not None and i < len(pages) and hwm <= last_max:
        read.append(pages[i])
        last_max = max([d for d in pages[i] if d is not None], default=None)
        i += 1
        if last_max is None:
            break
    rows = [(p + 1, d) for p, page in enumerate(read) for d in page]
    if hwm is None:
        return [(1, d) for d in pages[0]]
    return [(p, d) for p, d in rows if d is None or d >= hwm]


def test_scan_matches_loop(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows, marks, expected = [], [], []
    for s in range(40):
        src = f"s{s}"
        n_pages = rnd.randint(1, 6)
        pages, day = [], 400
        for _ in range(n_pages):
            page = []
            for _ in range(rnd.randint(1, 5)):
                day -= rnd.randint(0, 9)
                page.append(None if rnd.random() < 0.15 else base + dt.timedelta(days=day))
            if rnd.random() < 0.1:
                page = [None] * len(page)
            pages.append(page)
        hwm = None if s % 9 == 0 else base + dt.timedelta(days=rnd.randint(250, 420))
        for p, page in enumerate(pages, start=1):
            rows += [(src, p, d) for d in page]
        marks.append((src, hwm))
        expected += [(src, p, d) for p, d in _loop(pages, hwm)]
    df = spark.createDataFrame(rows, "source string, page int, datum timestamp_ntz")
    mk = spark.createDataFrame(marks, "source string, hwm timestamp_ntz")
    got = [(r.source, r.page, r.datum) for r in paged_hwm_scan(df, mk).collect()]
    key = lambda t: (t[0], t[1], t[2] or dt.datetime.min)
    assert sorted(got, key=key) == sorted(expected, key=key)
