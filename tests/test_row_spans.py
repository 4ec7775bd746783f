"""Row spans of html tables against a plain grid fill."""

import random

from pyspark.sql import functions as F

from procura.sources import html


def _grid(rows):
    """Cells (text, cols, rows) row by row into the free columns."""
    out, above = [], {}
    for cells in rows:
        row, spare = {}, {}
        for i, (text, left) in above.items():
            row[i] = text
            spare[i] = (text, left - 1)
        at = 0
        for text, cols, n in cells:
            for _ in range(cols):
                while at in row:
                    at += 1
                row[at] = text
                spare[at] = (text, n - 1)
        out.append(row)
        above = {i: x for i, x in spare.items() if x[1] > 0}
    while above:
        out.append({i: text for i, (text, _) in above.items()})
        above = {i: (text, left - 1) for i, (text, left) in above.items() if left > 1}
    return [[r.get(i) for i in range(max(r, default=-1) + 1)] for r in out]


def _page(rows):
    cell = lambda t, c, r: f"<td{f' colspan={c}' if c > 1 else ''}{f' rowspan=\"{r}\"' if r > 1 else ''}>{t or ''}</td>"
    return "<table>" + "".join("<tr>" + "".join(cell(*c) for c in row) + "</tr>" for row in rows) + "</table>"


def test_a_span_moves_the_cells_of_the_next_row(spark):
    pages = [(1, "<table><tr><td rowspan=2>1<td>2</tr><tr><td>3</table>"),
             (2, "<table><tr><th ROWSPAN='2'>a</th><th colspan=2>b</th></tr><tr><th>c</th><th>d</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"),
             (3, "<table><tr><td rowspan=0>1</td><td rowspan=x>2</td></tr><tr></tr><tr><td>3</td></tr></table>"),
             (4, "<table><tr><td>1</td><td rowspan=3>2</td></tr></table>"), (5, "<p>rowspan</p>"), (6, None)]
    got = {r["i"]: r["r"] for r in spark.createDataFrame(pages, "i int, html string").select("i", html.table_rows("html").alias("r")).collect()}
    assert got[1] == [["1", "2"], ["1", "3"]]
    assert got[2] == [["a", "b", "b"], ["a", "c", "d"], ["1", "2", "3"]]
    assert got[3] == [["1", "2"], [], ["3"]]
    assert got[4] == [["1", "2"], [None, "2"], [None, "2"]]
    assert got[5] == [] and got[6] is None


def test_any_spans(spark):
    rng = random.Random(9)
    pages = []
    for i in range(60):
        rows = [[(rng.choice(["x", "y z", None, f"{i}"]), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 2, 4])) for _ in range(rng.randrange(5))]
                for _ in range(rng.randrange(1, 7))]
        pages.append((i, _page(rows), rows))
    d = spark.createDataFrame([p[:2] for p in pages], "i int, html string")
    got = {r["i"]: r["r"] for r in d.select("i", html.table_rows("html").alias("r")).collect()}
    for i, _, rows in pages:
        assert got[i] == _grid(rows), rows


def test_cells_of_spanned_tables_in_one_pass(spark):
    d = spark.createDataFrame([("s", n, _page([[("h", 1, 2), ("k", 1, 1)], [("v", 1, 1)]])) for n in range(50)], "source string, page long, html string")
    cells = html.table_cells(d)
    assert "Exchange" not in cells._jdf.queryExecution().executedPlan().toString()
    assert cells.where(F.col("value") == "h").count() == 100
