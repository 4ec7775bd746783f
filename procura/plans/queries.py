"""Registered queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL | None).

Every query derives its input from the driver's tables with Spark and runs
over the whole tables.  Column names match the oracle's aliases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.functions import dates, rules, text
from procura.operators import cells as C
from procura.operators import registry, search
from procura.plans import oracle as O
from procura.plans import cleaning as P
from procura.plans import mail as ML
from procura.session import scratch_path
from procura.sources import fixtures as FX
from procura.sources import searchable as SE
from procura.sources.sinks import append_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


MAIL = O.MAIL


# ---------------------------------------------------------------- shared inputs

def mail_raw(spark, sf_dir) -> DataFrame:
    return FX.raw_orders(spark, sf_dir).where(F.col("objednavatel").isin(MAIL))


def mail_clean(spark, sf_dir) -> DataFrame:
    return P.clean_orders(P.clean_values(P.drop_all_null_keys(mail_raw(spark, sf_dir))))


def registry_dim(spark, sf_dir) -> DataFrame:
    return registry.registry_dim(FX.registry_raw(spark, sf_dir))


def mail_final(spark, sf_dir) -> DataFrame:
    return P.final_rows(mail_clean(spark, sf_dir), registry_dim(spark, sf_dir))


_SERVING: dict[tuple[str, str], str] = {}


def load_serving_table(spark, sf_dir) -> DataFrame:
    """Write the searchable table: final rows appended to Parquet partitioned
    by source, so searches prune columns, row groups and sources."""
    path = scratch_path(spark, "serving")
    append_table(mail_final(spark, sf_dir).drop("_errors"), path)
    _SERVING[spark.sparkContext.applicationId, sf_dir] = path
    return spark.read.parquet(path)


def serving_table(spark, sf_dir) -> DataFrame:
    """The searchable table of these inputs; loaded once per application."""
    path = _SERVING.get((spark.sparkContext.applicationId, sf_dir))
    return spark.read.parquet(path) if path else load_serving_table(spark, sf_dir)


# ---------------------------------------------------------------- E7 search (flagship)

SEARCH_ARGS = dict(keyword="ring", price_min=1000, price_max=400000)


@register("search_orders", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + f"""
SELECT objednavatel, cena, datum, popis, link FROM mail_final
WHERE popis LIKE '%{SEARCH_ARGS['keyword']}%' AND cena > {SEARCH_ARGS['price_min']} AND cena < {SEARCH_ARGS['price_max']}
ORDER BY cena DESC NULLS LAST, datum DESC NULLS LAST, objednavatel, popis
LIMIT {rules.SEARCH_LIMIT}""")
def q_search_orders(spark, sf_dir):
    return search.search_orders(serving_table(spark, sf_dir), **SEARCH_ARGS)


@register("search_price_range", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + """
SELECT objednavatel, cena, datum, popis, link FROM mail_final
WHERE popis LIKE '%' AND cena > 250000
ORDER BY cena DESC NULLS LAST, datum DESC NULLS LAST, objednavatel, popis
LIMIT 1000""")
def q_search_price_range(spark, sf_dir):
    # empty keyword (matches every row), lower bound only
    return search.search_orders(serving_table(spark, sf_dir), keyword="", price_min=250000)


_SEARCHABLE: dict[tuple[str, str, str], str] = {}


def _searchable(spark, sf_dir, name: str, rows, texts, equal=()) -> str:
    """Path of a table stored with its sketch; loaded once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SEARCHABLE:
        path = scratch_path(spark, name)
        SE.append_searchable(rows(), path, texts, equal, file_rows=10_000)
        _SEARCHABLE[key] = path
    return _SEARCHABLE[key]


@register("search_sketched", ORACLE["search_orders"])
def q_search_sketched(spark, sf_dir):
    path = _searchable(spark, sf_dir, "searchable", lambda: serving_table(spark, sf_dir), ("popis",))
    return search.search_orders(SE.may_hold(spark, path, "popis", SEARCH_ARGS["keyword"]), **SEARCH_ARGS)


@register("final_rows", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + """
SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM mail_final""")
def q_final_rows(spark, sf_dir):
    return mail_final(spark, sf_dir).drop("_errors")


# ---------------------------------------------------------------- C1-C3 price rules

def _price_set_query(rset: str):
    sources = O.sources_of_sets(rset)

    def fn(spark, sf_dir):
        raw = FX.raw_orders(spark, sf_dir).where(F.col("objednavatel").isin(sources))
        cleaned = P.clean_values(raw, ["cena"])
        out = text.clean_price_df(cleaned, "objednavatel", "cena", "cena", "cena_error")
        return out.select("k", "cena", "cena_error")

    sql = O.with_(O.BASE) + f"""SELECT k, {O.PRICE} AS cena, {O.PRICE_ERR} AS cena_error
FROM base WHERE src IN {O._in(sources)}"""
    register(f"price_rules_{rset}", sql)(fn)


for _r in rules.PRICE_RULES:
    _price_set_query(_r)


@register("thousands_dot", O.with_(O.BASE) + f"""
SELECT k, CASE WHEN src <> 'fntn' AND k % 6 = 3 THEN (cents // 100)::VARCHAR || '.' || lpad((cents % 100)::VARCHAR, 2, '0')
               ELSE {O.dirty_price()} END AS cena_txt
FROM base""")
def q_thousands_dot(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir)
    return raw.select("k", text.thousands_dot("cena").alias("cena_txt"))


@register("price_to_double", O.with_(O.BASE) + """
SELECT k, CASE WHEN src = 'fntn' OR k % 6 = 0 THEN cents / 100 END AS cena,
          CASE WHEN NOT (src = 'fntn' OR k % 6 = 0) THEN 'cena:not_a_number' END AS cena_error
FROM base""")
def q_price_to_double(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir)
    val, err = text.to_double("cena")
    return raw.select("k", val.alias("cena"), err.alias("cena_error"))


# ---------------------------------------------------------------- C4-C10 scalar functions

@register("extract_quantity", O.with_(O.BASE) + f"""
SELECT k, p_name AS objednavka_predmet, CASE WHEN k % 4 = 0 THEN {O.QTY} END AS mnozstvo FROM base""")
def q_extract_quantity(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["objednavka_predmet", "mnozstvo"])
    subj, qty = text.extract_quantity("objednavka_predmet", "mnozstvo")
    return raw.select("k", subj.alias("objednavka_predmet"), qty.alias("mnozstvo"))


@register("extract_year", O.with_(O.BASE) + """
SELECT k, CASE WHEN k % 10 IN (3, 8) THEN NULL ELSE year(d) END::INTEGER AS rok FROM base""")
def q_extract_year(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir)
    return raw.select("k", text.extract_year("datum").alias("rok"))


@register("date_corrections", O.with_(O.BASE) + f"""
SELECT k, CASE WHEN k % 10 = 7 THEN '. ' || strftime(d, '%d') || '. ' || strftime(d, '%Y')
               ELSE {O.dirty_date_lower()} END AS datum_txt
FROM base""")
def q_date_corrections(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["datum"])
    return raw.select("k", dates.date_corrections("datum").alias("datum_txt"))


@register("parse_dates", O.with_(O.BASE) + f"""
SELECT k, {O.DATE} AS datum, {O.DATE_ERR} AS datum_error FROM base""")
def q_parse_dates(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["datum"])
    return dates.parse_dates_df(raw, "datum", "datum", "datum_error").select("k", "datum", "datum_error")


@register("date_fallback", O.with_(O.BASE) + f"""
SELECT k, {O.DATE_FNSPZA} AS datum FROM base""")
def q_date_fallback(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["datum"])
    s1 = raw.select("k", text.extract_year("datum").alias("rok"),
                    dates.date_corrections("datum").alias("txt"))
    s2 = dates.parse_dates_df(s1, "txt", "parsed")
    return s2.select("k", dates.date_fallback("parsed", "rok").alias("datum"))


@register("date_typo_fix", O.with_(O.BASE) + f"""
SELECT k, {O.DATE_DONSP} AS datum FROM base""")
def q_date_typo_fix(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["datum"])
    fixed = raw.select("k", text.date_typo_fix("datum").alias("txt"))
    return dates.parse_dates_df(fixed, "txt", "datum").select("k", "datum")


@register("clean_ico", O.with_(O.BASE) + """
SELECT k, s_suppkey::VARCHAR AS dodavatel_ico FROM base""")
def q_clean_ico(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir)
    return raw.select("k", text.clean_ico("dodavatel_ico").alias("dodavatel_ico"))


@register("clean_strings", """
SELECT doc_id, replace(strip_accents(lower(text)), 'ß', 'ss') AS text FROM documents""")
def q_clean_strings(spark, sf_dir):
    docs = FX.table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", text.clean_string("text").alias("text"))


@register("pack_attributes", O.with_(O.BASE) + f"""
SELECT k, {O.popis_json(O.SUBJECT_WITH_QTY)} AS popis, {O.DODAVATEL_JSON} AS dodavatel FROM base""")
def q_pack_attributes(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir))
    return P.pack_attributes(raw).select("k", "popis", "dodavatel")


# ---------------------------------------------------------------- registry

@register("registry_dim", O.with_(O.LINK_CTE) + """
SELECT src AS skratka, link FROM links""")
def q_registry_dim(spark, sf_dir):
    d = registry_dim(spark, sf_dir)
    return d.select(F.col("attributes")["skratka"].alias("skratka"),
                    F.col("attributes")[registry.LINK_ATTR].alias("link"))


@register("registry_lookup", O.with_(O.BASE, O.LINK_CTE) + """
SELECT b.k, b.src AS objednavatel, l.link, CAST(NULL AS VARCHAR) AS link_error
FROM base b LEFT JOIN links l ON l.src = b.src""")
def q_registry_lookup(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir).select("k", "objednavatel")
    return registry.lookup_link(raw, registry_dim(spark, sf_dir)).select("k", "objednavatel", "link", "link_error")


# ---------------------------------------------------------------- sheets in long cells

def _cells(spark, sf_dir):
    # the derived attachment cells stand in for files read from storage
    return P.materialize(FX.raw_cells(spark, sf_dir))


SHEET_COLS_SQL = "s.source, s.file"


@register("normalise_headers", O.with_(O.BASE, O.SHEETS, O.header_values()) + f"""
SELECT s.source, s.file, h.col_idx::INTEGER AS col_idx, {O.P1_SQL.format(x='h.raw')} AS header
FROM sheets s JOIN hdr h ON h.f = s.f AND h.title = (s.f % 4 = 3)""")
def q_normalise_headers(spark, sf_dir):
    cells = _cells(spark, sf_dir).where(F.col("row_idx") == 0)
    return cells.select("source", "file", "col_idx", text.normalise_header("value").alias("header"))


@register("noise_rows_prefix", O.with_(O.BASE) + f"""
SELECT src AS source, 'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.xlsx' AS file,
       (k // 16) * 4 + 5 AS row_idx
FROM base WHERE src IN {O._in(MAIL)} AND k % 16 % 4 = 1 AND k % 7 = 1""")
def q_noise_rows_prefix(spark, sf_dir):
    rows, _ = C.to_rows(_cells(spark, sf_dir))
    rows = P.materialize(rows)  # read twice
    kept = C.drop_noise_rows(rows)
    return rows.join(kept, C.SHEET_KEY + ["row_idx"], "left_anti").select("source", "file", "row_idx")


@register("drop_sparse_columns", O.with_(O.BASE, O.SHEETS) + """
SELECT source, file, 11 AS col_idx FROM sheets
WHERE f % 4 = 0 OR (f % 4 = 2 AND n_sparse < ceil(0.1 * n))""")
def q_drop_sparse_columns(spark, sf_dir):
    rows, heads = C.to_rows(_cells(spark, sf_dir))
    rows = C.drop_noise_rows(rows)
    _, kept_heads = C.drop_sparse_columns(rows, heads)
    return C.dropped_columns(heads, kept_heads).select("source", "file", "col_idx")


@register("drop_empty_columns", O.with_(O.BASE, O.SHEETS) + """
SELECT source, file, 11 AS col_idx FROM sheets
WHERE f % 4 = 0 OR (f % 4 = 2 AND n_sparse = 0)""")
def q_drop_empty_columns(spark, sf_dir):
    rows, heads = C.to_rows(_cells(spark, sf_dir))
    _, kept_heads = C.drop_empty_columns(rows, heads)
    return C.dropped_columns(heads, kept_heads).select("source", "file", "col_idx")


@register("drop_sparse_rows", O.with_(O.BASE) + f"""
SELECT src AS source, 'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.xlsx' AS file,
       (k // 16) * 4 + 6 AS row_idx
FROM base WHERE src IN {O._in(MAIL)} AND k % 16 % 4 = 0 AND k % 11 = 5""")
def q_drop_sparse_rows(spark, sf_dir):
    rows, heads = C.to_rows(_cells(spark, sf_dir))
    rows = P.materialize(C.drop_noise_rows(rows))  # read three times
    rows, heads = C.drop_sparse_columns(rows, heads)
    kept = C.drop_sparse_rows(rows, 2)
    return rows.join(kept, C.SHEET_KEY + ["row_idx"], "left_anti").select("source", "file", "row_idx")


@register("promote_header", O.with_(O.BASE, O.SHEETS) + """
SELECT source, file, 3::BIGINT AS header_row_idx, CASE WHEN f = 15 THEN 11 ELSE 11 END AS n_cols
FROM sheets WHERE f % 4 = 3""")
def q_promote_header(spark, sf_dir):
    _, heads = C.clean_sheets(_cells(spark, sf_dir))
    return heads.where(F.col("header_row_idx") > 0).select("source", "file", "header_row_idx",
                                                           F.size("h").alias("n_cols"))


@register("header_census", O.with_(O.BASE, O.SHEETS, O.header_values()) + f"""
SELECT s.source, s.file, 'harok1' AS sheet,
       string_agg(DISTINCT {O.P1_SQL.format(x='h.raw')}, '|' ORDER BY {O.P1_SQL.format(x='h.raw')}) AS headers
FROM sheets s JOIN hdr h ON h.f = s.f AND NOT h.title
WHERE NOT (h.col_idx = 11 AND (s.f % 4 = 0 OR (s.f % 4 = 2 AND s.n_sparse < ceil(0.1 * s.n))))
GROUP BY ALL""")
def q_header_census(spark, sf_dir):
    _, heads = C.clean_sheets(_cells(spark, sf_dir))
    return C.header_census(heads)


@register("distinct_headers", "WITH c AS (" + ORACLE["header_census"] + """)
SELECT DISTINCT unnest(string_split(headers, '|')) AS header FROM c""")
def q_distinct_headers(spark, sf_dir):
    _, heads = C.clean_sheets(_cells(spark, sf_dir))
    return C.distinct_headers(heads)


STD_VALUES = f"""
  'obj-' || k::VARCHAR AS objednavka_cislo,
  {O.dirty_date_lower()} AS datum,
  {O.SUBJECT_WITH_QTY} AS objednavka_predmet,
  lower(p_type) AS kategoria,
  {O.dirty_price()} AS cena,
  lower(s_name) AS dodavatel_nazov,
  s_suppkey::VARCHAR || CASE WHEN s_suppkey % 2 = 1 THEN '.0' ELSE '' END AS dodavatel_ico,
  CASE WHEN k % 5 <> 0 THEN 'vlastne zdroje' END AS zdroj_financovania,
  CASE WHEN k % 3 <> 0 THEN lower(o_orderpriority) END AS poznamka,
  ((k % 3) + 1)::VARCHAR AS pocet_oslovenych,
  NULL::VARCHAR AS objednavatel, NULL::VARCHAR AS balenie, NULL::VARCHAR AS sukl_kod,
  NULL::VARCHAR AS mnozstvo, NULL::VARCHAR AS odkaz_na_zmluvu,
  CASE WHEN k % 16 IN {O.VAT_FILES} THEN 'ano' ELSE 'nie' END AS cena_s_dph"""


@register("standardise_columns", O.with_(O.BASE) + f"""
SELECT src AS source, 'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.xlsx' AS file, {STD_VALUES}
FROM base WHERE src IN {O._in(MAIL)}""")
def q_standardise_columns(spark, sf_dir):
    rows, heads = C.clean_sheets(_cells(spark, sf_dir))
    return C.standardise(rows, heads).drop("sheet", "row_idx")


@register("vat_flag", O.with_(O.BASE, O.SHEETS) + f"""
SELECT source, file, CASE WHEN f IN {O.VAT_FILES} THEN 'ano' ELSE 'nie' END AS cena_s_dph FROM sheets""")
def q_vat_flag(spark, sf_dir):
    rows, heads = C.clean_sheets(_cells(spark, sf_dir))
    return C.standardise(rows, heads).select("source", "file", "cena_s_dph").distinct()


def mail_batch(spark, sf_dir) -> DataFrame:
    """E1 from cells on."""
    return ML.sheet_rows(_cells(spark, sf_dir), registry_dim(spark, sf_dir), FX.insert_ts())


@register("mail_source_batch", O.with_(O.BASE, O.LINK_CTE, O.mail_final_cte(
    "mail_final", f"CASE WHEN k % 16 IN {O.VAT_FILES} THEN 'ano' ELSE 'nie' END")) + """
SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM mail_final""")
def q_mail_source_batch(spark, sf_dir):
    return mail_batch(spark, sf_dir).drop("_errors")


# ---------------------------------------------------------------- de-duplication and keyed merges

from procura.operators import dedupe as D  # noqa: E402
from procura.operators import incremental as INC  # noqa: E402


def mail_final_k(spark, sf_dir) -> DataFrame:
    return P.final_rows(mail_clean(spark, sf_dir), registry_dim(spark, sf_dir), keep_errors=False, extra=["k"])


def _dedupe_sides(spark, sf_dir):
    fr = P.materialize(mail_final_k(spark, sf_dir))
    stored = fr.where(F.col("k") % 2 == 0)
    nulls = fr.where(F.col("k") % 1000 == 3).select(
        "k", F.lit("unknown").alias("objednavatel"),
        *[F.lit(None).cast(fr.schema[c].dataType).alias(c) for c in D.DEDUPE_KEYS])
    new = (fr.where(F.col("k") % 3 == 0)
             .unionByName(fr.where(F.col("k") % 9 == 0))          # a key repeated in the batch
             .unionByName(nulls, allowMissingColumns=True))        # rows whose keys are all null
    return new, stored


@register("symmetric_unique", O.with_(O.BASE, O.LINK_CTE, O.mail_final_k()) + """
SELECT k, objednavatel, cena, datum FROM mf
WHERE (k % 3 = 0 AND k % 2 <> 0 AND k % 9 <> 0) OR (k % 2 = 0 AND k % 3 <> 0)""")
def q_symmetric_unique(spark, sf_dir):
    new, stored = _dedupe_sides(spark, sf_dir)
    return D.symmetric_unique(new, stored).select("k", "objednavatel", "cena", "datum")


@register("new_rows_anti", O.with_(O.BASE, O.LINK_CTE, O.mail_final_k()) + """
SELECT objednavatel, popis, cena, datum, dodavatel FROM mf WHERE k % 3 = 0 AND k % 2 <> 0
UNION ALL SELECT 'unknown', NULL, NULL, NULL, NULL""")
def q_new_rows_anti(spark, sf_dir):
    new, stored = _dedupe_sides(spark, sf_dir)
    return D.new_rows_anti(new, stored).select("objednavatel", "popis", "cena", "datum", "dodavatel")


@register("distinct_rows", O.with_(O.BASE) + """
SELECT k, src AS objednavatel, 'OBJ-' || k::VARCHAR AS objednavka_cislo FROM base""")
def q_distinct_rows(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir)
    doubled = raw.unionByName(raw.where(F.col("k") % 7 == 0))
    return D.distinct_rows(doubled).select("k", "objednavatel", "objednavka_cislo")


@register("upsert_latest", O.with_(O.BASE, O.LINK_CTE, O.mail_final_k()) + """
SELECT k, CASE WHEN k % 5 = 0 THEN cena + 1 ELSE cena END AS cena FROM mf""")
def q_upsert_latest(spark, sf_dir):
    fr = mail_final_k(spark, sf_dir).select("k", "cena")
    base = fr.withColumn("version", F.lit(0))
    changes = fr.where(F.col("k") % 5 == 0).select("k", (F.col("cena") + 1).alias("cena"), F.lit(1).alias("version"))
    return D.upsert_latest(base, changes, ["k"]).select("k", "cena")


@register("union_missing", O.with_(O.BASE, O.LINK_CTE, O.mail_final_k()) + """
SELECT k, objednavatel, cena, NULL::VARCHAR AS poznamka_web FROM mf
UNION ALL
SELECT k, src AS objednavatel, NULL::DOUBLE AS cena, 'web ' || k::VARCHAR AS poznamka_web FROM base WHERE k % 50 = 0""")
def q_union_missing(spark, sf_dir):
    a = mail_final_k(spark, sf_dir).select("k", "objednavatel", "cena")
    b = FX.raw_orders(spark, sf_dir).where(F.col("k") % 50 == 0).select(
        "k", "objednavatel", F.concat(F.lit("web "), F.col("k").cast("string")).alias("poznamka_web"))
    return D.union_missing(a, b)


@register("dedupe_columns", O.with_(O.BASE) + f"""
SELECT k, {O.DATE} AS datum, {O.DATE_ERR} AS datum_error, k % 7 AS k7 FROM base""")
def q_dedupe_columns(spark, sf_dir):
    raw = P.clean_values(FX.raw_orders(spark, sf_dir), ["datum"])
    parsed = dates.parse_dates_df(raw, "datum", "datum", "datum_error").select(
        "k", "datum", F.col("datum").alias("datum_copy"), "datum_error", (F.col("k") % 7).alias("k7"))
    return D.dedupe_columns(P.materialize(parsed))


# ---------------------------------------------------------------- incremental loading and status

@register("high_water_marks", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + """
SELECT objednavatel, date_trunc('minute', max(insert_date)) AS last_update, max(datum) AS last_datum
FROM mail_final GROUP BY objednavatel""")
def q_high_water_marks(spark, sf_dir):
    return INC.high_water_marks(mail_final(spark, sf_dir))


@register("history_lookup", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + """
SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM mail_final
WHERE objednavatel = 'unb' AND file LIKE '%1%'""")
def q_history_lookup(spark, sf_dir):
    return INC.history_lookup(serving_table(spark, sf_dir).select(*rules.FINAL_COLUMNS), "unb", year=1)


@register("attachment_select", O.with_(O.MSG) + f"""
SELECT m.source, m.message_id, strftime(m.received_at - INTERVAL 1 MINUTE, '%d_%m_%Y_%I_%M_%S') || '_' || m.attachment AS saved_name
FROM msg m JOIN marks USING (source)
WHERE m.source IN {O._in(MAIL)} AND m.user_id % 5 <> 0 AND m.received_at > marks.last_update
  AND NOT regexp_matches(m.attachment, '^.*\\.(png|jpg)')""")
def q_attachment_select(spark, sf_dir):
    return INC.select_attachments(FX.messages(spark, sf_dir), FX.source_marks(spark))


@register("incremental_batch", O.with_(O.MSG) + """
SELECT m.source, count(*) AS rows FROM msg m JOIN marks USING (source)
WHERE m.received_at > marks.last_update GROUP BY m.source""")
def q_incremental_batch(spark, sf_dir):
    msgs = FX.table(spark, sf_dir, "events").select(FX.source_of(F.col("user_id")).alias("source"),
                                                    F.col("ts").alias("received_at"))
    newer = INC.incremental_batch(msgs, FX.source_marks(spark), "received_at")
    return newer.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


@register("batch_status", O.with_(O.MSG) + f"""
, sel AS (
  SELECT m.source FROM msg m JOIN marks USING (source)
  WHERE m.source IN {O._in(MAIL)} AND m.user_id % 5 <> 0 AND m.received_at > marks.last_update
    AND NOT regexp_matches(m.attachment, '^.*\\.(png|jpg)')
)
SELECT s.source AS objednavatel, count(sel.source) AS rows,
       CASE WHEN count(sel.source) > 0 THEN 'ok' ELSE 'no_new_data' END AS status
FROM (SELECT unnest({O.SRC_LIST}) AS source) s LEFT JOIN sel USING (source) GROUP BY s.source""")
def q_batch_status(spark, sf_dir):
    sel = INC.select_attachments(FX.messages(spark, sf_dir), FX.source_marks(spark))
    sources = spark.createDataFrame([(s,) for s in rules.SOURCES], "objednavatel string")
    return INC.batch_status(sel.withColumnRenamed("source", "objednavatel"), sources)


@register("lookup_by_field", O.with_(O.BASE) + f"""
SELECT 'nazov_dodavatela' AS search_by, k FROM base WHERE src IN {O._in(MAIL)} AND contains(lower(s_name), 'supplier#00000001')
UNION ALL SELECT 'cislo_objednavky', k FROM base WHERE src IN {O._in(MAIL)} AND k = 42
UNION ALL SELECT 'ICO', k FROM base WHERE src IN {O._in(MAIL)} AND s_suppkey = 17""")
def q_lookup_by_field(spark, sf_dir):
    rows = P.clean_values(mail_raw(spark, sf_dir))
    parts = [search.lookup_by_field(rows, "nazov_dodavatela", "supplier#00000001").select(F.lit("nazov_dodavatela").alias("search_by"), "k"),
             search.lookup_by_field(rows, "cislo_objednavky", "obj-42").select(F.lit("cislo_objednavky").alias("search_by"), "k"),
             search.lookup_by_field(rows, "ICO", "17.0").select(F.lit("ICO").alias("search_by"), "k")]
    return D.union_missing(*parts)


@register("lookup_indexed", ORACLE["lookup_by_field"])
def q_lookup_indexed(spark, sf_dir):
    columns = ["objednavatel", "k", "dodavatel_nazov", "objednavka_cislo", "dodavatel_ico"]
    path = _searchable(spark, sf_dir, "lookups", lambda: P.clean_values(mail_raw(spark, sf_dir)).select(*columns),
                       ("dodavatel_nazov",), ("objednavka_cislo", "dodavatel_ico"))
    names = SE.may_hold(spark, path, "dodavatel_nazov", "supplier#00000001", "literal")
    table = spark.read.parquet(path)
    parts = [search.lookup_by_field(d, by, value).select(F.lit(by).alias("search_by"), "k")
             for d, by, value in ((names, "nazov_dodavatela", "supplier#00000001"), (table, "cislo_objednavky", "obj-42"),
                                  (table, "ICO", "17.0"))]
    return D.union_missing(*parts)


# ---------------------------------------------------------------- registry overrides

OVERRIDES = [
    (rules.REGISTRY_KEY["fnnitra"], "objednavky_faktury_link", "https://example.org/fnnitra/new/", False),
    (rules.REGISTRY_KEY["donsp"] + "_2020", registry.LINK_ATTR, "https://example.org/donsp/2020/", True),
    (rules.REGISTRY_KEY["nsptrstena"], registry.LINK_ATTR, "https://example.org/nsptrstena/2023.pdf", True),
]


def _ov_sql() -> str:
    return ", ".join(f"('{k}', '{a}', '{v}', {str(r).lower()})" for k, a, v, r in OVERRIDES)


@register("registry_overrides", O.with_(O.LINK_CTE) + f"""
, keys AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{k}')" for s, k in rules.REGISTRY_KEY.items())}) t(src, key)),
ov(key, attr, value, replace_all) AS (VALUES {_ov_sql()}),
base_attrs AS (
  SELECT keys.key, 'zverejnovanie_objednavok_faktur_rozne' AS attr, links.link AS value FROM links JOIN keys USING (src)
  UNION ALL SELECT keys.key, 'skratka', links.src FROM links JOIN keys USING (src)
)
SELECT key, attr, value FROM base_attrs
WHERE key NOT IN (SELECT key FROM ov WHERE replace_all) AND (key, attr) NOT IN (SELECT key, attr FROM ov)
UNION ALL SELECT key, attr, value FROM ov""")
def q_registry_overrides(spark, sf_dir):
    ov = spark.createDataFrame(OVERRIDES, "key string, attr string, value string, replace_all boolean")
    dim = registry.apply_overrides(registry_dim(spark, sf_dir), ov)
    return dim.select("key", F.explode("attributes").alias("attr", "value"))


# ---------------------------------------------------------------- web sources

from procura.plans import web as WEB  # noqa: E402
from procura.sources import html as HTML  # noqa: E402
from procura.sources import paged as PG  # noqa: E402


def web_marks(spark) -> DataFrame:
    return spark.createDataFrame(list(O.WEB_MARKS.items()), "source string, hwm string").select(
        "source", F.col("hwm").cast("timestamp_ntz").alias("hwm"))


def _pages(spark, sf_dir):
    return P.materialize(FX.html_pages(spark, sf_dir))


@register("html_table_cells", O.with_(O.BASE, O.LINK_CTE, O.WEB) + """
SELECT src AS source, page, CASE WHEN src = 'fntn' THEN count(*) + 1 ELSE count(*) + 2 END AS n_rows,
       CASE WHEN src = 'fntn' THEN (count(*) + 1) * 11 ELSE (count(*) + 2) * 7 END AS n_cells
FROM web GROUP BY src, page""")
def q_html_table_cells(spark, sf_dir):
    drv = FX.table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("page"), "html")
    pages = _pages(spark, sf_dir).select("source", "page", "html").unionByName(drv)
    cells = HTML.table_cells(pages)
    return cells.groupBy("source", "page").agg(F.countDistinct("row_idx").alias("n_rows"),
                                               F.count(F.lit(1)).alias("n_cells"))


@register("paged_hwm_scan", O.with_(O.BASE, O.WEB) + """
SELECT src AS source, 'obj-' || k::VARCHAR AS objednavka_cislo, page, scan_d AS datum FROM scanned
UNION ALL  -- donsp footer rows ('Strana n') of every page read: no date, so kept by the scan
SELECT DISTINCT 'donsp', 'strana ' || page::VARCHAR, page, NULL::TIMESTAMP FROM web JOIN pstop USING (src)
WHERE src = 'donsp' AND (pstop.stop IS NULL OR page <= pstop.stop)""")
def q_paged_hwm_scan(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    out = [WEB.scanned_rows(pages, s, web_marks(spark)).select(
        "source", text.clean_string(F.col(f"`{FX.FNTN_HEADERS[0]}`")).alias("objednavka_cislo"), "page", "datum")
        for s in FX.WEB_SOURCES]
    return out[0].unionByName(out[1])


@register("paged_source_scan", ORACLE["paged_hwm_scan"])
def q_paged_source_scan(spark, sf_dir):
    """S4 as a data source: pages are fetched one by one down to the mark."""
    root = SK.scratch_path(spark, "site")
    FX.html_pages(spark, sf_dir).select("source", "page", "html").write.partitionBy("source", "page").text(root)
    pages, _ = PG.read_pages(spark, PG.FolderPages(root), O.WEB_MARKS)
    pages = P.materialize(pages)  # fetched once
    out = [WEB.scanned_rows(pages, s, web_marks(spark)).select(
        "source", text.clean_string(F.col(f"`{FX.FNTN_HEADERS[0]}`")).alias("objednavka_cislo"), "page", "datum")
        for s in FX.WEB_SOURCES]
    return out[0].unionByName(out[1])


@register("clean_fntn", O.with_(O.BASE, O.LINK_CTE, O.WEB, O.WEB_FINAL) + """
SELECT cena, datum, dodavatel, popis, file, link FROM web_final WHERE objednavatel = 'fntn'""")
def q_clean_fntn(spark, sf_dir):
    rows = WEB.with_scan_date(WEB.named_rows(_pages(spark, sf_dir).where("source = 'fntn'"), FX.FNTN_HEADERS),
                              WEB.DATE_COLUMN["fntn"])
    return WEB.web_final(WEB.clean_fntn(rows, insert_date=FX.insert_ts()), "fntn", registry_dim(spark, sf_dir)).select(
        "cena", "datum", "dodavatel", "popis", "file", "link")


@register("clean_donsp", O.with_(O.BASE, O.LINK_CTE, O.WEB, O.WEB_FINAL) + """
SELECT cena, datum, dodavatel, popis, file, link FROM web_final WHERE objednavatel = 'donsp'""")
def q_clean_donsp(spark, sf_dir):
    rows = WEB.named_rows(_pages(spark, sf_dir).where("source = 'donsp'"), FX.DONSP_HEADERS)
    return WEB.web_final(WEB.clean_donsp(rows, insert_date=FX.insert_ts()), "donsp", registry_dim(spark, sf_dir)).select(
        "cena", "datum", "dodavatel", "popis", "file", "link")


@register("noise_rows_search", O.with_(O.BASE, O.WEB) + """
SELECT DISTINCT page FROM web WHERE src = 'donsp'""")
def q_noise_rows_search(spark, sf_dir):
    rows = WEB.named_rows(_pages(spark, sf_dir).where("source = 'donsp'"), FX.DONSP_HEADERS)
    raw_vals = F.array(*[F.col(f"`{h}`") for h in FX.DONSP_HEADERS])
    return rows.where(F.exists(raw_vals, lambda v: v.rlike(rules.NOISE_DONSP))).select("page")


def web_history(spark, sf_dir, pages, dim) -> DataFrame:
    """Stored web rows: every even order of both sources (all pages)."""
    out = []
    for s in FX.WEB_SOURCES:
        hdr = FX.FNTN_HEADERS if s == "fntn" else FX.DONSP_HEADERS
        rows = WEB.named_rows(pages.where(F.col("source") == s), hdr)
        even = F.try_element_at(F.split(F.col(f"`{hdr[0]}`"), "-"), F.lit(2)).try_cast("bigint") % 2 == 0
        rows = rows.where(even)
        cleaned = (WEB.clean_fntn(WEB.with_scan_date(rows, WEB.DATE_COLUMN[s]), FX.insert_ts()) if s == "fntn"
                   else WEB.clean_donsp(rows, insert_date=FX.insert_ts()))
        out.append(WEB.web_final(cleaned, s, dim).drop("_errors"))
    return out[0].unionByName(out[1])


@register("web_source_batch", O.with_(O.BASE, O.LINK_CTE, O.WEB, O.WEB_FINAL) + """
, new_rows AS (SELECT wf.* FROM web_final wf JOIN scanned USING (k)),
stored AS (SELECT wf.* FROM web_final wf JOIN web USING (k)
           WHERE k % 2 = 0 AND CAST(wf.datum AS DATE) = CAST(web.hwm AS DATE)),
u AS (SELECT * FROM new_rows UNION ALL SELECT * FROM stored)
SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM u
QUALIFY count(*) OVER (PARTITION BY popis, cena, datum, dodavatel) = 1""")
def q_web_source_batch(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    dim = registry_dim(spark, sf_dir)
    hist = P.materialize(web_history(spark, sf_dir, pages, dim))
    out = [WEB.web_batch(pages, s, web_marks(spark), hist, dim, insert_date=FX.insert_ts()) for s in FX.WEB_SOURCES]
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- PDF source

from procura.plans import merged as MG  # noqa: E402

TRSTENA_SQL = f"""trstena AS (
  SELECT k, src, s_name,
         CASE WHEN k % 4 % 2 = 0 THEN '  ' || {O.SUBJECT_WITH_QTY} ELSE {O.SUBJECT_WITH_QTY} END AS objednavka_predmet,
         CASE WHEN k % 4 % 2 = 1 AND k % 5 = 0 THEN 0.0 ELSE cents / 100 END AS cena,
         {O.DATE} AS datum
  FROM base WHERE src = 'nsptrstena'
), trstena_final AS (
  SELECT k, 'nsptrstena' AS objednavatel, t.cena, t.datum,
         json_object('dodavatel', lower(s_name))::VARCHAR AS dodavatel,
         json_object('objednavka_predmet', objednavka_predmet, 'objednavka_cislo', 'obj-' || k::VARCHAR,
                     'zmluva', 'z-' || k::VARCHAR, 'cena_s_dph', 'nie')::VARCHAR AS popis,
         TIMESTAMP '2024-06-01 12:00:00' AS insert_date, '{FX.PDF_FILE}' AS file, l.link
  FROM trstena t LEFT JOIN links l USING (src)
)"""


def _trstena_rows(spark, sf_dir):
    return MG.clean_merged(MG.page_rows(P.materialize(FX.pdf_cells(spark, sf_dir))), insert_date=FX.insert_ts())


@register("split_merged_text", O.with_(O.BASE, O.LINK_CTE, TRSTENA_SQL) + """
SELECT 'obj-' || k::VARCHAR AS objednavka_cislo, objednavka_predmet, cena FROM trstena""")
def q_split_merged_text(spark, sf_dir):
    return _trstena_rows(spark, sf_dir).select("objednavka_cislo", "objednavka_predmet", "cena")


@register("pdf_source_batch", O.with_(O.BASE, O.LINK_CTE, TRSTENA_SQL) + """
SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM trstena_final WHERE k % 2 = 1""")
def q_pdf_source_batch(spark, sf_dir):
    dim = registry_dim(spark, sf_dir)
    new = MG.merged_final(_trstena_rows(spark, sf_dir), dim).drop("_errors")
    # stored history of the source: earlier loads of the even orders of this year's file
    hist = P.materialize(MG.merged_final(
        _trstena_rows(spark, sf_dir).where(
            F.try_element_at(F.split("objednavka_cislo", "-"), F.lit(2)).try_cast("bigint") % 2 == 0), dim)
        .drop("_errors"))
    stored = INC.history_lookup(hist, "nsptrstena", year=2024)
    return D.symmetric_unique(new, stored)


@register("rename_sources", O.with_(O.BASE, O.WEB) + """
SELECT src AS source, 'obj-' || k::VARCHAR AS objednavka_cislo, lower(s_name) AS dodavatel_nazov,
       NULL::VARCHAR AS dodavatel FROM web
UNION ALL
SELECT src, 'obj-' || k::VARCHAR, NULL, lower(s_name) FROM base WHERE src = 'nsptrstena'""")
def q_rename_sources(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    fntn = WEB.clean_fntn(WEB.with_scan_date(WEB.named_rows(pages.where("source = 'fntn'"), FX.FNTN_HEADERS),
                                             WEB.DATE_COLUMN["fntn"]))
    donsp = WEB.clean_donsp(WEB.named_rows(pages.where("source = 'donsp'"), FX.DONSP_HEADERS))
    tr = _trstena_rows(spark, sf_dir)
    parts = [fntn.select(F.col("objednavatel").alias("source"), "objednavka_cislo", "dodavatel_nazov"),
             donsp.select(F.col("objednavatel").alias("source"), "objednavka_cislo", "dodavatel_nazov"),
             tr.select(F.col("objednavatel").alias("source"), "objednavka_cislo", "dodavatel")]
    return D.union_missing(*parts)


# ---------------------------------------------------------------- sources and sinks

from procura.sources import sinks as SK  # noqa: E402
from procura.streaming import ingest as ING  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("source_manifest", "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}.parquet', 'parquet', 'load')" for t in TABLES) + ") t(file, ext, action)")
def q_source_manifest(spark, sf_dir):
    return SK.source_manifest(spark, sf_dir).select("file", "ext", "action")


FINAL_SELECT = "SELECT objednavatel, cena, datum, dodavatel, popis, insert_date, file, link FROM mail_final"
FINAL_SQL = O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + FINAL_SELECT


def _read_final(spark, path) -> DataFrame:
    return spark.read.parquet(path).select(*rules.FINAL_COLUMNS)


@register("append_roundtrip", FINAL_SQL)
def q_append_roundtrip(spark, sf_dir):
    fr = P.materialize(mail_final_k(spark, sf_dir))
    path = SK.scratch_path(spark, "append")
    SK.append_table(fr.where(F.col("k") % 2 == 0).drop("k"), path)   # first load
    SK.append_table(fr.where(F.col("k") % 2 == 1).drop("k"), path)   # second load appends
    return _read_final(spark, path)


@register("serving_load", FINAL_SQL)
def q_serving_load(spark, sf_dir):
    return load_serving_table(spark, sf_dir).select(*rules.FINAL_COLUMNS)


@register("quarantine_rows", O.with_(O.BASE) + f"""
SELECT objednavatel, reason, count(*) AS n_rows, count(cena) AS n_with_price, count(datum) AS n_with_date FROM (
  SELECT src AS objednavatel, unnest([{O.PRICE_ERR},
           {O.DATE_ERR}]) AS reason,
         {O.PRICE} AS cena, CASE WHEN src = 'fnspza' THEN {O.DATE_FNSPZA} ELSE {O.DATE} END AS datum
  FROM base WHERE src IN {O._in(MAIL)}) WHERE reason IS NOT NULL GROUP BY ALL""")
def q_quarantine_rows(spark, sf_dir):
    path = SK.scratch_path(spark, "quarantine")
    SK.write_quarantine(mail_final(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return (stored.select("objednavatel", "cena", "datum", F.explode("_errors").alias("reason"))
                  .groupBy("objednavatel", "reason")
                  .agg(F.count(F.lit(1)).alias("n_rows"), F.count("cena").alias("n_with_price"),
                       F.count("datum").alias("n_with_date")))


@register("snapshot_roundtrip", FINAL_SQL)
def q_snapshot_roundtrip(spark, sf_dir):
    fr = P.materialize(mail_final_k(spark, sf_dir))
    first = SK.scratch_path(spark, "snapshot")
    SK.write_snapshot(fr.where(F.col("k") % 3 != 0).drop("k"), first)
    nxt = SK.scratch_path(spark, "snapshot")
    # the next snapshot = previous snapshot + new rows, written to a new path
    SK.write_snapshot(spark.read.parquet(first).unionByName(fr.where(F.col("k") % 3 == 0).drop("k")), nxt)
    return _read_final(spark, nxt)


@register("csv_roundtrip", ORACLE["search_orders"])
def q_csv_roundtrip(spark, sf_dir):
    res = q_search_orders(spark, sf_dir)
    path = SK.scratch_path(spark, "export")
    SK.export_csv(res, path)
    return spark.read.schema(res.schema).option("header", True).option("escape", "\"").csv(path)


@register("chunk_counts", O.with_(O.BASE, O.LINK_CTE, O.MAIL_FINAL) + """
SELECT count(*) AS n_rows, true AS chunks_bounded FROM mail_final""")
def q_chunk_counts(spark, sf_dir):
    fr = mail_final(spark, sf_dir).drop("_errors")
    path = SK.scratch_path(spark, "chunks")
    SK.write_chunks(fr, path)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count()
    return per_file.agg(F.sum("count").alias("n_rows"),
                        F.bool_and(F.col("count") <= rules.CHUNK_ROWS).alias("chunks_bounded"))


#: rows in a file of the inbox, at most
INBOX_ROWS = 100_000


@register("incremental_ingest", FINAL_SQL)
def q_incremental_ingest(spark, sf_dir):
    inbox = SK.scratch_path(spark, "inbox")
    raw = FX.raw_orders(spark, sf_dir).where(F.col("objednavatel").isin(MAIL)).drop("k")
    # files of bounded size: more orders come in more files, and in more batches
    raw.repartition(max(4, spark.sparkContext.defaultParallelism)).write.option("maxRecordsPerFile", INBOX_ROWS).parquet(inbox)
    dim = P.materialize(registry_dim(spark, sf_dir))

    def transform(df):
        cleaned = P.clean_orders(P.clean_values(P.drop_all_null_keys(df)))
        return P.final_rows(cleaned, dim, keep_errors=False)

    table_path, ckpt = SK.scratch_path(spark, "table"), SK.scratch_path(spark, "stream-ckpt")
    archive = SK.scratch_path(spark, "archive")   # processed files move here (after a later batch)
    for _ in range(2):  # the second run finds no unseen file and appends nothing
        ING.ingest(spark, inbox, raw.schema, table_path, ckpt, transform, archive=archive)
    return _read_final(spark, table_path)


FIRST_LOAD, SECOND_LOAD = "2024-03-01 12:00:00", "2024-06-01 12:00:00"


@register("mail_attachment_job", O.with_(O.BASE, O.LINK_CTE, O.mail_final_k().replace(
    O.PRICE, f"CASE WHEN k % 6 = 5 THEN NULL ELSE {O.PRICE} END").replace(
    O.popis_json(O.SUBJECT_WITH_QTY, vat="'nie'"), O.popis_json(O.SUBJECT_WITH_QTY, vat=O.VAT_OF_FILE)).replace(
    O.popis_json("p_name", f"CASE WHEN k % 4 = 0 THEN {O.QTY} END", "'nie'"),
    O.popis_json("p_name", f"CASE WHEN k % 4 = 0 THEN {O.QTY} END", O.VAT_OF_FILE))) + f"""
SELECT objednavatel, cena, datum, dodavatel, popis, link,
       CASE WHEN k % 16 < 8 THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END AS insert_date,
       lpad((k % 16 + 1)::VARCHAR, 2, '0') || CASE WHEN k % 16 < 8 THEN '_02' ELSE '_04' END || '_2024_09_29_00_'
         || 'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.csv' AS file
FROM mf""")
def q_mail_attachment_job(spark, sf_dir):
    """E1 end to end: marks of the stored table -> selected attachments ->
    files -> ... -> append, run three times: the first load, a second one of
    newer messages, and one that finds nothing new."""
    cells, messages = _cells(spark, sf_dir), P.materialize(FX.sheet_messages(spark, sf_dir))
    dim = P.materialize(registry_dim(spark, sf_dir))
    table_path = SK.scratch_path(spark, "table")
    for loaded in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD):
        arrived = messages.where(F.col("received_at") < F.lit(loaded).cast("timestamp_ntz"))
        inbox = SK.scratch_path(spark, "inbox")
        FX.save_attachments(cells, messages, ML.selected(spark, arrived, table_path), inbox)
        ML.load_attachments(spark, inbox, table_path, SK.scratch_path(spark, "stream-ckpt"), dim,
                            F.lit(loaded).cast("timestamp_ntz"), archive=SK.scratch_path(spark, "archive"))
    return _read_final(spark, table_path)


# ---------------------------------------------------------------- F7, E4, F8 variants

@register("drop_all_null_keys", O.with_(O.BASE) + f"""
SELECT k, src AS objednavatel FROM base WHERE src IN {O._in(MAIL)}""")
def q_drop_all_null_keys(spark, sf_dir):
    raw = mail_raw(spark, sf_dir)
    # rows whose subject, price and date are all missing (e.g. a totals line)
    empty = raw.where(F.col("k") % 100 == 1).withColumns({
        "k": -F.col("k"), "objednavka_predmet": F.lit(None).cast("string"),
        "cena": F.lit(None).cast("string"), "datum": F.lit(None).cast("string")})
    return P.drop_all_null_keys(raw.unionByName(empty)).select("k", "objednavatel")


def clean_fnspza(df: DataFrame) -> DataFrame:
    """P2 -> C4 -> R0 -> C2 -> C3 -> C5 -> C6 -> C7 -> C8 -> A6 (the
    fnspza branch of ``clean_orders``), then distinct rows."""
    return D.distinct_rows(P.clean_orders(P.clean_values(df)))


@register("clean_fnspza", O.with_(O.BASE) + f"""
SELECT 'obj-' || k::VARCHAR AS objednavka_cislo, p_name AS objednavka_predmet,
       CASE WHEN k % 4 = 0 THEN {O.QTY} END AS mnozstvo, {O.PRICE} AS cena, {O.DATE_FNSPZA} AS datum
FROM base WHERE src = 'fnspza'""")
def q_clean_fnspza(spark, sf_dir):
    raw = FX.raw_orders(spark, sf_dir).where(F.col("objednavatel") == "fnspza").drop("k")
    return clean_fnspza(raw).select("objednavka_cislo", "objednavka_predmet", "mnozstvo", "cena", "datum")


@register("search_insensitive", ORACLE["search_orders"].replace(
    f"popis LIKE '%{SEARCH_ARGS['keyword']}%'", f"lower(strip_accents(popis)) LIKE '%{SEARCH_ARGS['keyword']}%'"))
def q_search_insensitive(spark, sf_dir):
    args = dict(SEARCH_ARGS, keyword="RÍNG")
    return search.search_orders(serving_table(spark, sf_dir), mode="insensitive", **args)


# ---------------------------------------------------------------- stored upsert, row spans, override log, outcomes, replay

from procura.plans import outcome as OUT  # noqa: E402


@register("upsert_stored", ORACLE["upsert_latest"])
def q_upsert_stored(spark, sf_dir):
    """S7 on a table: the changes are written once, a second run writes nothing."""
    fr = P.materialize(mail_final_k(spark, sf_dir).select("objednavatel", "k", "cena"))
    path = SK.scratch_path(spark, "table")
    base = fr.withColumn("version", F.lit(0))
    late = F.col("k") % 10 == 0  # rows that come with the changes
    SK.append_table(base.where(~late), path)
    changes = base.where(late).unionByName(fr.where(F.col("k") % 5 == 0).select(
        "objednavatel", "k", (F.col("cena") + 1).alias("cena"), F.lit(1).alias("version")))
    for _ in range(2):
        SK.upsert_table(changes, path, ["objednavatel", "k"])
    return spark.read.parquet(path).select("k", "cena")


@register("html_row_spans", O.with_(O.BASE, O.WEB) + """
SELECT src AS source, page, strftime(d, '%Y-%m-%d') AS datum, 'obj-' || k::VARCHAR AS objednavka_cislo,
       (k % 7)::VARCHAR AS skupina FROM web""")
def q_html_row_spans(spark, sf_dir):
    """S3 with spans: the rows of a date share one cell, which moves the others."""
    r = FX.web_rows(spark, sf_dir)
    day = F.date_format("_d", "yyyy-MM-dd")
    days = r.groupBy("objednavatel", "page", day.alias("day")).agg(F.sort_array(F.collect_list("k")).alias("ks"))
    cell = lambda v: F.concat(F.lit("<td>"), v.cast("string"), F.lit("</td>"))
    body = F.array_join(F.transform("ks", lambda k, i: F.concat(
        F.lit("<tr>"), F.when(i == 0, F.concat(F.lit('<td rowspan="'), F.size("ks").cast("string"), F.lit('">'), F.col("day"),
                                               F.lit("</td>"))).otherwise(F.lit("")),
        cell(F.concat(F.lit("obj-"), k.cast("string"))), cell(k % 7), F.lit("</tr>"))), "")
    pages = days.select(F.col("objednavatel").alias("source"), "page", body.alias("b")).groupBy("source", "page").agg(
        F.concat(F.lit("<table><tr><th>datum</th><th>objednavka_cislo</th><th>skupina</th></tr>"),
                 F.array_join(F.collect_list("b"), ""), F.lit("</table>")).alias("html"))
    return WEB.named_rows(P.materialize(pages), ["datum", "objednavka_cislo", "skupina"]).drop("row_idx")


#: the configured entries, then patches around a replacement
OVERRIDE_LOG = [(i, *x) for i, x in enumerate(rules.REGISTRY_OVERRIDES)] + [
    (100, rules.REGISTRY_KEY["unb"], "skratka", "before", False),
    (101, rules.REGISTRY_KEY["unb"], registry.LINK_ATTR, "https://example.org/unb/", True),
    (101, rules.REGISTRY_KEY["unb"], "objednavky_link", "https://example.org/unb/1", True),
    (102, rules.REGISTRY_KEY["unb"], "objednavky_link", "https://example.org/unb/2", False),
    (103, rules.REGISTRY_KEY["fnnitra"], "skratka", "one", False),
    (104, rules.REGISTRY_KEY["fnnitra"], "skratka", "two", False)]


@register("registry_override_log", O.with_(O.LINK_CTE) + f"""
, keys AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{k}')" for s, k in rules.REGISTRY_KEY.items())}) t(src, key)),
log(seq, key, attr, value, whole) AS (VALUES {", ".join(f"({s}, '{k}', '{a}', '{v}', {str(w).lower()})" for s, k, a, v, w in OVERRIDE_LOG)}),
base_attrs AS (
  SELECT keys.key, '{registry.LINK_ATTR}' AS attr, links.link AS value FROM links JOIN keys USING (src)
  UNION ALL SELECT keys.key, 'skratka', links.src FROM links JOIN keys USING (src)),
last AS (SELECT key, min(seq) AS first, max(seq) AS last FROM log WHERE whole GROUP BY key),
j AS (SELECT log.*, first, last, log.key IN (SELECT key FROM base_attrs) AS known FROM log LEFT JOIN last USING (key)),
good AS (SELECT * FROM j WHERE (known OR seq >= first) AND (last IS NULL OR seq >= last)),
entries AS (
  SELECT key, attr, value, -1 AS seq FROM base_attrs WHERE key NOT IN (SELECT key FROM last)
  UNION ALL SELECT key, attr, value, seq FROM good)
SELECT key, attr, arg_max(value, seq) AS value, NULL::VARCHAR AS error FROM entries GROUP BY key, attr
UNION ALL SELECT key, attr, value, 'override:unknown_key' FROM j WHERE NOT known AND (first IS NULL OR seq < first)""")
def q_registry_override_log(spark, sf_dir):
    log = spark.createDataFrame(OVERRIDE_LOG, "seq long, key string, attr string, value string, replace_all boolean")
    entries, errors = registry.apply_override_log(P.materialize(registry_dim(spark, sf_dir)), log)
    return (entries.select("key", F.explode("attributes").alias("attr", "value"), F.lit(None).cast("string").alias("error"))
                   .unionByName(errors.select("key", "attr", "value", "error")))


@register("source_outcomes", O.with_(O.BASE) + """
SELECT s.source AS objednavatel,
       CASE WHEN s.source IN ('fnnitra', 'unb') THEN 0 ELSE count(k) END AS rows,
       CASE WHEN s.source IN ('fnnitra', 'unb') THEN 0 ELSE count(k) END AS stored,
       CASE WHEN s.source IN ('fnnitra', 'unb') THEN 'failed' WHEN count(k) > 0 THEN 'ok' ELSE 'no_new_data' END AS status,
       CASE s.source WHEN 'fnnitra' THEN 'AnalysisException: PATH_NOT_FOUND' WHEN 'unb' THEN 'SparkRuntimeException: USER_RAISED_EXCEPTION' END AS reason
FROM (SELECT unnest(""" + O.SRC_LIST + """) AS source) s
LEFT JOIN (SELECT * FROM base WHERE src NOT IN ('fntn', 'donsp', 'nsptrstena')) b ON s.source = b.src GROUP BY s.source""")
def q_source_outcomes(spark, sf_dir):
    """one source whose files are gone, one with a row that raises, three with
    nothing new; the rows of all others are stored."""
    raw_path, table_path = SK.scratch_path(spark, "raw"), SK.scratch_path(spark, "table")
    FX.raw_orders(spark, sf_dir).select("k", "objednavatel", "objednavka_predmet", "cena", "datum").write.partitionBy("objednavatel").parquet(raw_path)

    def load(source):
        if source == "fnnitra":
            return spark.read.parquet(f"{raw_path}/objednavatel=gone")
        rows = spark.read.parquet(raw_path).where(F.col("objednavatel") == source)
        if source == "unb":
            rows = rows.withColumn("datum", F.when(F.length("objednavka_predmet") >= 0, F.raise_error(F.lit("a row that cannot be read"))))
        return P.drop_all_null_keys(rows.where(~F.col("objednavatel").isin("fntn", "donsp", "nsptrstena")))

    status = OUT.run_sources(spark, rules.SOURCES, load, lambda rows: SK.append_table(rows, table_path))
    stored = spark.read.parquet(table_path).groupBy("objednavatel").agg(F.count(F.lit(1)).alias("stored"))
    return status.drop("rows_with_errors").join(stored, "objednavatel", "left").fillna(0, ["stored"])


@register("quarantine_replay", O.with_(O.BASE) + f"""
, r AS (SELECT src AS objednavatel, {O.PRICE_ERR} AS price_err, {O.DATE_ERR} AS date_err,
               {O.PRICE} AS cena,
               CASE WHEN k % 10 = 9 THEN make_timestamp(year(d), 4, 30, 0, 0, 0) WHEN src = 'fnspza' THEN {O.DATE_FNSPZA} ELSE {O.DATE} END AS datum
        FROM base WHERE src IN {O._in(MAIL)})
SELECT objednavatel, count(*) FILTER (WHERE price_err IS NULL) AS n_stored,
       count(*) FILTER (WHERE price_err IS NULL AND date_err IS NOT NULL) AS n_replayed,
       count(*) FILTER (WHERE price_err IS NOT NULL) AS n_held, 0::BIGINT AS n_second,
       round(sum(cena) FILTER (WHERE price_err IS NULL), 2) AS cena, max(datum) FILTER (WHERE price_err IS NULL) AS datum
FROM r GROUP BY objednavatel""")
def q_quarantine_replay(spark, sf_dir):
    """Rows with errors go to the quarantine; after a rule for the 31st of April they
    are replayed, once; rows without a price stay."""
    dim = P.materialize(registry_dim(spark, sf_dir))
    quarantine, table_path = SK.scratch_path(spark, "quarantine"), SK.scratch_path(spark, "table")
    std = P.clean_values(P.drop_all_null_keys(mail_raw(spark, sf_dir)))
    ING.append_new(ML.divert_errors(P.materialize(ML.with_raw(std, dim)), quarantine), table_path)
    april = lambda d: d.withColumn("datum", F.regexp_replace("datum", r"^31\.4\.", "30.4."))
    first, second = [P.materialize(ML.replay_quarantine(spark, quarantine, table_path, dim, april)) for _ in range(2)]
    n = lambda frame, name: frame.groupBy("objednavatel").agg(F.count(F.lit(1)).alias(name))
    table = spark.read.parquet(table_path).groupBy("objednavatel").agg(
        F.count(F.lit(1)).alias("n_stored"), F.round(F.sum("cena"), 2).alias("cena"), F.max("datum").alias("datum"))
    for frame, name in ((first, "n_replayed"), (ML.still_quarantined(spark, quarantine), "n_held"), (second, "n_second")):
        table = table.join(n(frame, name), "objednavatel", "left").fillna(0, [name])
    return table
