"""Keyword / price-range top-k search (E7: F8, F9, T1, P10) and F12."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.functions import rules

SEARCH_COLUMNS = ["objednavatel", "cena", "datum", "popis", "link"]


def keyword_filter(df: DataFrame, keyword: str, mode: str = "like", col: str = "popis") -> DataFrame:
    """F8.  ``like``: ``popis LIKE '%kw%'`` with ``%``/``_`` in the keyword
    acting as wildcards (the keyword is bound as a literal, never spliced into
    SQL text).  ``literal``: plain substring.  ``insensitive``: case- and
    accent-insensitive substring through the UNICODE_CI_AI collation."""
    c = F.col(col)
    if mode == "like":
        # a backslash escapes only % and _ and itself; elsewhere it is a character
        pattern = re.sub(r"\\([\\%_])|\\", lambda m: m[0] if m[1] else r"\\", keyword)
        return df.where(c.like("%" + pattern + "%"))
    if mode == "literal":
        return df.where(c.contains(F.lit(keyword)))
    if mode == "insensitive":
        return df.where(F.contains(F.collate(c, "UNICODE_CI_AI"), F.collate(F.lit(keyword), "UNICODE_CI_AI")))
    raise ValueError(mode)


def price_range(df: DataFrame, price_min=None, price_max=None, col: str = "cena") -> DataFrame:
    """strict bounds, each only when given (falsy values mean 'not given')."""
    if price_min:
        df = df.where(F.col(col) > F.lit(price_min))
    if price_max:
        df = df.where(F.col(col) < F.lit(price_max))
    return df


def search_orders(df: DataFrame, keyword: str, price_min=None, price_max=None,
                  limit: int = rules.SEARCH_LIMIT, tiebreak=("objednavatel", "popis"),
                  mode: str = "like") -> DataFrame:
    """Filter, ``order by cena desc, datum desc`` (+ a unique tiebreak so
    results are deterministic), ``limit`` -> TakeOrderedAndProject: each task
    keeps only its own top ``limit`` rows, so no full sort is shuffled."""
    f = price_range(keyword_filter(df, keyword, mode), price_min, price_max)
    order = [F.col("cena").desc_nulls_last(), F.col("datum").desc_nulls_last()] + [F.col(c).asc() for c in tiebreak]
    return f.orderBy(*order).limit(limit).select(*SEARCH_COLUMNS)


LOOKUP_FIELDS = {
    "nazov_dodavatela": ("dodavatel_nazov", "contains"),
    "cislo_objednavky": ("objednavka_cislo", "equals"),
    "ICO": ("dodavatel_ico", "equals"),
}


def lookup_by_field(df: DataFrame, search_by: str, value: str) -> DataFrame:
    """supplier name by substring, order number and company id by equality."""
    col, how = LOOKUP_FIELDS[search_by]
    c = F.col(col)
    return df.where(c.contains(F.lit(value)) if how == "contains" else c == F.lit(value))
