"""HTML table extraction (S3): the first ``<table>`` of a page, as rows inside
the page's own row or as long cells."""

from __future__ import annotations

from html.entities import name2codepoint
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions.text import _c, py_strip

_TABLE_TAG = r"(?i)(?=<table\b|</table\s*>)"
_ROW_START = r"(?i)<tr\b[^>]*>"
_CELL_START = r"(?i)<t[hd]\b"
#: in a cell from behind its tag's name: the rest of the tag, what follows its end, tags inside
_NOT_TEXT = r"(?is)^[^>]*>|</t[hdr]\b.*|<[^>]+>"
_COLSPAN = r"(?i)^[^>]*?\bcolspan\s*=\s*[\"']?\s*(\d{1,3})"
_ROWSPAN = r"(?i)^[^>]*?\browspan\s*=\s*[\"']?\s*(\d{1,5})"
_REF = r"&(?=#\d{1,7};|#[xX][0-9a-fA-F]{1,6};|[A-Za-z][A-Za-z0-9]*;)"


def unescape(c: Column) -> Column:
    """Character references to characters: named (from the standard table),
    decimal and hexadecimal ones; anything else stays as it stands.  Each
    reference is decoded once (``&amp;lt;`` becomes ``&lt;``)."""
    named = F.create_map(*chain.from_iterable((F.lit(n), F.lit(chr(p))) for n, p in
                                              {**name2codepoint, "apos": 39}.items()))

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, r"^([^;]+);", 1)
        hexed = F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]+)$", 1)
        code = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(name, r"^#(\d+)$", 1)).try_cast("int")
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(named, name))
        rest = F.substr(part, F.length(name) + F.lit(2))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part))

    parts = F.split(c, _REF)
    text = F.concat(F.element_at(parts, 1), F.array_join(F.transform(_rest(parts), decoded), ""))
    return F.when(F.contains(c, F.lit("&")), text).otherwise(c)


def _first_table(html: Column) -> Column:
    """Inner html of the first table.  Segments between table tags are folded
    with the nesting depth: text of nested tables stays as text of its cell,
    rows after a nested table belong to the outer one."""
    def step(acc: Column, seg: Column) -> Column:
        start = F.left(seg, F.lit(8))
        opens, closes = start.rlike(r"(?i)^<table\b"), start.rlike(r"(?i)^</table")
        depth = F.greatest(acc["depth"] + opens.cast("int") - closes.cast("int"), F.lit(0))
        body = F.regexp_replace(seg, r"(?i)^</?table\b[^>]*>", "")
        done = acc["done"] | (closes & (acc["depth"] == 1))
        add = (F.when(done | (depth == 0), F.lit("")).when(depth == 1, body)
               .otherwise(F.concat(F.lit(" "), F.regexp_replace(body, r"<[^>]+>", " "))))
        return F.struct(depth.alias("depth"), done.alias("done"), F.concat(acc["out"], add).alias("out"))

    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("out"))
    return F.aggregate(F.split(html, _TABLE_TAG), zero, step, lambda acc: acc["out"])


def _rest(parts: Column) -> Column:
    """All but the first of the parts of a split."""
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _span(c: Column, pattern: str) -> Column:
    return F.greatest(F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(1)), F.lit(1))


def _row_cells(row: Column) -> Column:
    """The row's cells (text, rows), once for each column a cell spans; empty cells
    are null."""
    def value(text: Column) -> Column:
        return F.nullif(py_strip(F.regexp_replace(unescape(text), r"[\r\n]+|\s{2,}", " ")), F.lit(""))

    cells = F.transform(_rest(F.split(row, _CELL_START)), lambda c: F.struct(
        value(F.regexp_replace(c, _NOT_TEXT, "")).alias("text"), _span(c, _ROWSPAN).alias("rows"), _span(c, _COLSPAN).alias("cols")))
    return F.flatten(F.transform(cells, lambda c: F.array_repeat(F.struct(c["text"].alias("text"), c["rows"].alias("rows")), c["cols"])))


_GRID = "array<struct<text:string,rows:int>>"


def _next_grid(above: Column, cells: Column) -> Column:
    """One row of the grid: columns that a cell from above still spans keep its text,
    the row's cells take the free columns in order.  ``rows`` counts the rows that a
    cell spans from here on."""
    spanned = lambda i: F.coalesce(F.try_element_at(above, i)["rows"], F.lit(0)) > 1
    free = F.slice(F.filter(F.sequence(F.lit(1), F.size(above) + F.size(cells) + 1), lambda i: ~spanned(i)), 1, F.greatest(F.size(cells), F.lit(0)))
    held = F.filter(F.sequence(F.lit(1), F.size(above) + 1), spanned)
    width = F.greatest(F.coalesce(F.array_max(free), F.lit(0)), F.coalesce(F.array_max(held), F.lit(0)))
    row = F.transform(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), lambda i: F.when(
        spanned(i), F.struct(F.try_element_at(above, i)["text"].alias("text"), (F.try_element_at(above, i)["rows"] - 1).alias("rows"))).otherwise(
        F.coalesce(F.try_element_at(cells, F.nullif(F.array_position(free, i), F.lit(0)).cast("int")),
                   F.struct(F.lit(None).cast("string").alias("text"), F.lit(1).alias("rows")))))
    return F.when(width == 0, F.array().cast(_GRID)).otherwise(row)


def _with_row_spans(rows: Column) -> Column:
    """The rows as a grid, with the rows that only spans from above fill."""
    def step(acc: Column, cells: Column) -> Column:
        row = _next_grid(acc["row"], cells)
        return F.struct(row.alias("row"), F.array_append(acc["out"], row).alias("out"))

    begin = F.struct(F.array().cast(_GRID).alias("row"), F.array().cast(f"array<{_GRID}>").alias("out"))
    done = F.aggregate(rows, begin, step)
    last = done["row"]
    left = F.coalesce(F.array_max(F.transform(last, lambda c: c["rows"])), F.lit(1)) - 1
    below = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(left, F.lit(1))), lambda k: k <= left), lambda k: F.transform(
        F.filter(last, lambda c, i: F.exists(F.slice(last, i + 1, F.size(last)), lambda d: d["rows"] > k)),
        lambda c: F.struct(F.when(c["rows"] > k, c["text"]).alias("text"), c["rows"].alias("rows"))))
    return F.concat(done["out"], below)


def table_rows(html) -> Column:
    """``array<array<string>>``: the rows of the page's first table (the first
    one holds the header) with the text of their cells.  Tags inside cells
    are removed, references decoded, line breaks and runs of whitespace made
    one space, the ends stripped; an empty cell is null (as a data-frame
    reader gives NaN), a cell over several columns or rows is repeated in each, and
    moves the cells after it.  Spans beyond the last row make rows of their own.  A
    page without a table, or null, gives no rows."""
    page = _c(html)
    cells = F.transform(_rest(F.split(_first_table(page), _ROW_START)), _row_cells)
    grid = F.when(F.regexp_like(page, F.lit(r"(?i)\browspan\b")), _with_row_spans(cells)).otherwise(cells)
    return F.transform(grid, lambda r: F.transform(r, lambda c: c["text"]))


def table_cells(pages: DataFrame, key_cols=("source", "page")) -> DataFrame:
    """Long cells: row ``i`` of the first table is ``row_idx = i``, its column
    ``j`` is ``col_idx = j``.  Each page is processed whole in its own task."""
    keys = [F.col(c) for c in key_cols]
    rows = pages.select(*keys, F.posexplode(table_rows("html")).alias("row_idx", "_r"))
    return rows.select(*keys, F.col("row_idx").cast("bigint"), F.posexplode("_r").alias("col_idx", "value"))
