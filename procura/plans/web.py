"""Web sources (E2, E5, E6): html pages -> cells -> named rows -> paged
high-water-mark scan -> per-source cleaning -> packed rows -> new rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import dates, rules, text
from procura.operators import dedupe, incremental
from procura.operators.cells import columns_by_name
from procura.plans import cleaning as P
from procura.functions.rules import DONSP_HEADERS, FNTN_HEADERS
from procura.session import materialize
from procura.sources.html import table_rows
from procura.sources.paged import pages_within

PAGE_KEY = ["source", "page"]
DATE_COLUMN = {"fntn": "Dátum vyhotovenia", "donsp": DONSP_HEADERS[5]}


def named_rows(pages: DataFrame, headers: list[str]) -> DataFrame:
    """S3 + header row: one row per table row with one column per raw
    header name (row 0 of each page's table names the columns).  All of it
    happens inside the page's row: no shuffle."""
    rows = pages.select(*PAGE_KEY, table_rows("html").alias("_rows"))
    head = F.transform(F.try_element_at(F.col("_rows"), F.lit(1)), lambda v, i: F.named_struct(F.lit("col"), i, F.lit("name"), v))
    body = F.slice("_rows", 2, F.greatest(F.size("_rows"), F.lit(1)))
    j = (rows.select(*PAGE_KEY, columns_by_name(head).alias("hm"), F.posexplode(body).alias("row_idx", "m"))
             .withColumn("row_idx", F.col("row_idx") + F.lit(1).cast("bigint")))
    return j.select(*PAGE_KEY, "row_idx", *[
        F.try_element_at(F.col("m"), F.try_element_at(F.col("hm"), F.lit(h)) + 1).alias(h) for h in headers])


def with_scan_date(rows: DataFrame, date_col: str) -> DataFrame:
    """``datum`` parsed from the raw page text, as the pager sees it."""
    return dates.parse_dates_df(rows, date_col, "datum")


def clean_fntn(rows: DataFrame, insert_date: Column | None = None) -> DataFrame:
    """E5: clean strings, normalised names, provenance constants, renames,
    company id, price cast (no rules), distinct.  ``insert_date`` is the load
    time (default: now)."""
    loaded = F.localtimestamp() if insert_date is None else insert_date
    norm = {h: text.normalise_name(h) for h in FNTN_HEADERS}  # P1 on the column names
    df = rows.select("datum", *[text.clean_string(F.col(f"`{h}`")).alias(norm[h]) for h in FNTN_HEADERS])
    df = df.withColumnsRenamed(rules.RENAME_FNTN)
    price, err = text.to_double(F.col("`cena s dph (EUR)`"))
    df = df.withColumns({
        "objednavatel": F.lit("fntn"), "file": F.lit("web"), "insert_date": loaded, "cena_s_dph": F.lit("ano"),
        "dodavatel_ico": text.clean_ico(F.col("`ico dodavatela`")),
        "cena": price, "_errors": text.collect_errors(err),
    })
    return df.distinct()


def clean_donsp(rows: DataFrame, compat: bool = True, insert_date: Column | None = None, set_column_names: bool = True,
                renames: dict[str, str] | None = None) -> DataFrame:
    """Noise rows (search match on raw text), renames, clean strings,
    R7 price rules + cast, impossible-day fix, date parse, constants.  The
    parsed date is taken from the renamed text column.

    ``set_column_names``: the columns were named by the first row of a page, so the
    pages' footers and repeated headers are among the rows and go.  Without it the
    rows are a table that had its names before (a file of an earlier year), all of
    its rows and columns stay, and ``renames`` gives its names.  A table without a
    price has none (null, no reason)."""
    loaded = F.localtimestamp() if insert_date is None else insert_date
    renames = rules.RENAME_DONSP if renames is None else renames
    headers = [h for h in (DONSP_HEADERS if set_column_names else rows.columns) if h in rows.columns]
    df = rows
    if set_column_names:
        raw_vals = F.array(*[F.col(f"`{h}`") for h in headers])
        df = df.where(~F.exists(raw_vals, lambda v: F.coalesce(v.rlike(rules.NOISE_DONSP), F.lit(False))))
    df = df.select(*[F.col(f"`{h}`").alias(renames.get(h, h)) for h in headers])
    df = P.clean_values(df, [c for c in df.columns])
    df = df.withColumns({"objednavatel": F.lit("donsp"), "datum": text.date_typo_fix("datum")})
    if "cena" in df.columns:
        df = text.clean_price_df(df, "objednavatel", "cena", "cena", "_cena_err")
    else:
        df = df.withColumns({"cena": F.lit(None).cast("double"), "_cena_err": F.lit(None).cast("string")})
    df = dates.parse_dates_df(df, "datum", "datum", "_datum_err", compat=compat)
    return (df.withColumns({"cena_s_dph": F.lit("nie"), "file": F.lit("web"), "insert_date": loaded,
                            "_errors": text.collect_errors("_cena_err", "_datum_err")})
              .drop("_cena_err", "_datum_err"))


POPIS = {"fntn": rules.POPIS_FNTN, "donsp": rules.POPIS_DONSP}


def web_final(cleaned: DataFrame, source: str, dim: DataFrame) -> DataFrame:
    """P8 + P7: packed attributes with the source's lists, registry link,
    per-source drops, final projection."""
    return P.final_rows(cleaned, dim, popis_list=POPIS[source], source=source)


def scanned_rows(pages: DataFrame, source: str, marks: DataFrame) -> DataFrame:
    headers = FNTN_HEADERS if source == "fntn" else DONSP_HEADERS
    # only the pages down to the mark are parsed
    rows = named_rows(pages_within(pages.where(F.col("source") == source), marks), headers)
    # the scan reads its rows twice (page maxima, then the rows): parse pages once
    rows = materialize(with_scan_date(rows, DATE_COLUMN[source]))
    return incremental.paged_hwm_scan(rows, marks.select("source", "hwm"))


CLEANERS = {"fntn": clean_fntn, "donsp": lambda rows, **kw: clean_donsp(rows.drop("datum"), **kw)}


def web_batch(pages: DataFrame, source: str, marks: DataFrame, history: DataFrame, dim: DataFrame,
                 cleaner=None, **cleaner_args) -> DataFrame:
    """S3 -> S4 -> cleaner (X1: any ``DataFrame -> DataFrame`` function,
    applied with ``DataFrame.transform`` and its keyword arguments; default
    E5 / E6) -> P8 -> P7 -> S5 -> J3 -> P9.  ``history`` is the stored
    table; rows of the source on the mark's date are compared."""
    scan = scanned_rows(pages, source, marks)
    cleaned = scan.transform(cleaner or CLEANERS[source], **cleaner_args)
    new = web_final(cleaned, source, dim).drop("_errors")
    hwm = marks.where(F.col("source") == source).select(F.to_date("hwm").alias("_d"))
    stored = (history.where(F.col("objednavatel") == source)
                     .join(hwm, F.to_date("datum") == F.col("_d"), "left_semi"))
    return dedupe.symmetric_unique(new, stored.select(*new.columns))
