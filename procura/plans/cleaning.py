"""Composite cleaning steps (E1, E4, final projection).

Each stage is one projection of native expressions; stages are separate
``select``s so that an expensive intermediate (a regex fold) is computed once
and referenced by the next stage instead of being inlined twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.functions import dates, rules, text
from procura.operators import registry
from procura.session import materialize  # noqa: F401  (re-export)


def clean_values(df: DataFrame, cols=None) -> DataFrame:
    """P2 over the given (default: all canonical present) string columns."""
    cols = [c for c in (cols or rules.CANONICAL) if c in df.columns and c != "objednavatel"]
    return df.withColumns({c: text.clean_string(c) for c in cols})


def clean_orders(df: DataFrame, compat: bool = True, source_col: str = "objednavatel") -> DataFrame:
    """Price and date cleaning of standardised mail-source rows.

    fnspza takes its own path (E4: quantity extraction, R0 rules, date text
    corrections and the 1-January fallback); every other source applies its
    price rule set, the thousands dot, the float cast and the date parser.
    Failures leave null plus a reason in ``_errors``."""
    src = F.col(source_col)
    is_za = src == F.lit("fnspza")
    subj, qty = text.extract_quantity("objednavka_predmet", "mnozstvo")
    stage1 = df.withColumns({
        "objednavka_predmet": F.when(is_za, subj).otherwise(F.col("objednavka_predmet")),
        "mnozstvo": F.when(is_za, qty).otherwise(F.col("mnozstvo")),
        "_year": F.when(is_za, text.extract_year("datum")),
        "_datum_txt": F.when(is_za, dates.date_corrections("datum")).otherwise(F.col("datum")),
    })
    stage2 = dates.parse_dates_df(stage1, "_datum_txt", "_parsed", "_datum_err", compat=compat)
    stage2 = text.clean_price_df(stage2, source_col, "cena", "cena", "_cena_err")
    prev = F.col("_errors") if "_errors" in df.columns else F.array().cast("array<string>")
    return (stage2.withColumns({
                "datum": dates.date_fallback("_parsed", "_year"),
                "_errors": F.concat(prev, text.collect_errors("_cena_err", "_datum_err")),
            })
            .drop("_year", "_datum_txt", "_cena_err", "_parsed", "_datum_err"))


def pack_attributes(df: DataFrame, popis_list=None, dodavatel_list=None) -> DataFrame:
    """JSON of the non-null attributes (missing attributes count as null)."""
    popis_list = popis_list or rules.POPIS_LIST
    dodavatel_list = dodavatel_list or rules.DODAVATEL_LIST
    missing = [c for c in popis_list + dodavatel_list if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
    return df.withColumns({"popis": text.pack(popis_list), "dodavatel": text.pack(dodavatel_list)})


def packed_rows(df: DataFrame, popis_list=None, dodavatel_list=None, source: str | None = None) -> DataFrame:
    """P8 + P7: packed attributes without the columns that the source drops
    after packing."""
    return pack_attributes(df, popis_list, dodavatel_list).drop(*rules.DROP_COLUMNS.get(source, ()))


def final_rows(df: DataFrame, dim: DataFrame, popis_list=None, dodavatel_list=None,
               keep_errors: bool = True, extra=(), source: str | None = None) -> DataFrame:
    """P8 + P7 + J1 + P9: packed attributes, registry link, the 8 final columns."""
    packed = packed_rows(df, popis_list, dodavatel_list, source)
    linked = registry.lookup_link(packed, dim)
    if "_errors" not in linked.columns:
        linked = linked.withColumn("_errors", F.array().cast("array<string>"))
    linked = linked.withColumn("_errors", F.concat("_errors", text.collect_errors("link_error")))
    cols = list(extra) + rules.FINAL_COLUMNS + (["_errors"] if keep_errors else [])
    return linked.select(*cols)


def drop_all_null_keys(df: DataFrame) -> DataFrame:
    """drop rows whose subject, price and date are all null.  Apply it to
    the standardised text columns, before cleaning (as the source system
    does): a filter on a cleaned column would be pushed back through every
    cleaning stage."""
    return df.dropna(how="all", subset=["objednavka_predmet", "cena", "datum"])
