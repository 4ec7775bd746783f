"""PDF source (E3): page tables -> noise (F2) -> first row as header
-> union of page layouts (U1) -> clean (P2, P1) -> date (C7) -> merged
subject/price split (C11) -> renames (P6) -> packed rows (P8) -> drops (P7)
-> distinct (A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import dates, rules, text
from procura.operators import cells as C
from procura.plans import cleaning as P

MERGED = "predbeznapredmet objednaniacena bez dph"
PRICE = "predbeznacena bez dph"
SUBJECT = "predmet objednania"
COLUMNS = ["datumobjednania", SUBJECT, PRICE, MERGED, "objednavka", "dodavatel", "zmluva", "schvalil"]


def page_rows(cells: DataFrame) -> DataFrame:
    """Per page: drop noise rows (search match on raw text), promote the
    first remaining row to the header, drop the unnamed ('') column, and
    name every value by its (P2-cleaned, P1-normalised) header.  Missing
    columns of a page layout are null (union by name)."""
    rows = (cells.groupBy(*C.SHEET_KEY, "row_idx")
                 .agg(C.row_map("col_idx", F.coalesce("value", F.lit(""))).alias("m")))
    rows = rows.where(~F.exists(F.map_values("m"), lambda v: v.rlike(rules.NOISE_TRSTENA)))
    data, heads = C.promote_header(rows, skip_marker="\u0000")
    # header names: raw -> P2 -> P1 (the job cleans strings, then names)
    heads = heads.select(*C.SHEET_KEY, F.transform_values(
        "h", lambda k, v: text.normalise_header(text.clean_string(v))).alias("h"))
    j = data.join(heads, C.SHEET_KEY, "inner")
    by_name = C.columns_by_name(F.sort_array(F.transform(F.map_entries("h"), lambda e: F.struct(
        e["key"].alias("col"), e["value"].alias("name")))))
    j = j.withColumn("_by", by_name)
    return j.select(*C.SHEET_KEY, "row_idx",
                    *[F.try_element_at(F.col("m"), F.try_element_at(F.col("_by"), F.lit(c))).alias(c) for c in COLUMNS])


def clean_merged(rows: DataFrame, compat: bool = True, insert_date: Column | None = None) -> DataFrame:
    """``insert_date`` is the load time (default: now)."""
    loaded = F.localtimestamp() if insert_date is None else insert_date
    df = P.clean_values(rows, COLUMNS)
    df = dates.parse_dates_df(df, "datumobjednania", "datum", "_datum_err", compat=compat)
    m2, _p3, s1, val, err = text.split_merged_text(F.col(f"`{MERGED}`"), F.col(f"`{PRICE}`"), F.col(f"`{SUBJECT}`"))
    df = df.withColumns({SUBJECT: s1, "cena": val, "_cena_err": err, MERGED: m2})
    df = df.withColumns({"cena_s_dph": F.lit("nie"), "insert_date": loaded, "objednavatel": F.lit("nsptrstena")})
    df = df.withColumnsRenamed(rules.RENAME_TRSTENA)
    df = df.withColumn("_errors", text.collect_errors("_cena_err", "_datum_err")).drop("_cena_err", "_datum_err")
    return df


def merged_final(cleaned: DataFrame, dim: DataFrame) -> DataFrame:
    out = P.final_rows(cleaned, dim, popis_list=rules.POPIS_TRSTENA, dodavatel_list=rules.DODAVATEL_TRSTENA,
                       source="nsptrstena")
    return out.distinct()
