"""Order-shaped inputs derived by Spark from the driver's TPC-H-style tables.

The derivation follows FIXTURES.md: every dirty text is generated from a
clean column, so an oracle can state the clean value without repeating any
parsing logic.  All derivations are narrow projections plus equi-joins on a
computed key; no window, no collect, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.functions import rules
from procura.operators import registry
from procura.operators.cells import row_map
from procura.session import spread

LINK_BASE = "https://example.org/"

# Injected constant for the load timestamp (the source system used now()).
INSERT_DATE = "2024-06-01 12:00:00"
N_FILES = 16
MONTH_NAMES = ["januara", "februara", "marca", "aprila", "maja", "juna", "jula", "augusta", "septembra",
               "oktobra", "novembra", "decembra"]
DAY_SPREAD = 4  # second date of a date range, in days


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def insert_ts() -> Column:
    return F.lit(INSERT_DATE).cast("timestamp_ntz")


def source_of(custkey: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in rules.SOURCES]), (custkey % len(rules.SOURCES) + 1).cast("int"))


def clean_date(orderdate: Column) -> Column:
    return orderdate + F.expr("INTERVAL 24 YEARS")


def cents_of(totalprice: Column) -> Column:
    return F.round(totalprice * 100).cast("bigint")


def registry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry workbook rows derived from ``customer``: every customer is an
    entry of its source's full name in one of three spellings; ``seq`` is the
    sheet order, so later customers win."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    src = source_of(F.col("c_custkey"))
    key = registry.registry_key_of(src)
    v = F.col("c_custkey") % 3
    full = (F.when(v == 0, F.initcap(key)).when(v == 1, F.concat(F.initcap(key), F.lit(",")))
            .otherwise(F.concat(F.upper(key), F.lit("."))))
    attrs = F.create_map(
        F.lit(registry.LINK_ATTR), F.concat(F.lit(LINK_BASE), src, F.lit("/"), F.col("c_custkey").cast("string")),
        F.lit("skratka"), src)
    return c.select(full.alias("Nazov_full"), attrs.alias("attributes"), F.col("c_custkey").alias("seq"))


def dirty_price(k: Column, cents: Column, source: Column) -> Column:
    """Price text by k % 6 (fntn always the plain form)."""
    e = (cents / 100).cast("bigint")
    cc = F.lpad((cents % 100).cast("string"), 2, "0")
    e_s = e.cast("string")
    plain = F.concat(e_s, F.lit("."), cc)
    comma = F.concat(e_s, F.lit(","), cc)
    thousands = F.concat((e / 1000).cast("bigint").cast("string"), F.lit("."),
                         F.lpad((e % 1000).cast("string"), 3, "0"), F.lit("."), cc)
    f = k % 6
    return (F.when(source == F.lit("fntn"), plain)
            .when(f == 0, plain).when(f == 1, comma).when(f == 2, F.concat(comma, F.lit(" eur")))
            .when(f == 3, thousands).when(f == 4, F.concat(e_s, F.lit(",-"))).otherwise(F.lit("")))


def dirty_date(k: Column, d: Column) -> Column:
    """Date text by k % 10."""
    month_name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d))
    f = k % 10
    return (F.when(f == 0, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00")))
            .when(f == 1, F.date_format(d, "d.M.yyyy"))
            .when(f == 2, F.date_format(d, "d. M. yyyy"))
            .when(f == 3, F.date_format(d, "d/M/yy"))
            .when(f == 4, F.concat(F.date_format(d, "dd.MM.yyyy"), F.lit(" - "),
                                   F.date_format(F.date_add(d, DAY_SPREAD), "dd.MM.yyyy")))
            .when(f == 5, F.concat(F.lit("1. - "), F.date_format(d, "d.M.yyyy")))
            .when(f == 6, F.concat(F.lit("1 "), F.date_format(d, "d.M.yyyy")))
            .when(f == 7, F.concat(F.lit("Pondelok. "), F.initcap(month_name), F.lit(" "),
                                   F.date_format(d, "dd"), F.lit(". "), F.date_format(d, "yyyy")))
            .when(f == 8, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("31.4."), F.date_format(d, "yyyy"))))


def quantity_n(k: Column) -> Column:
    return (k / 4).cast("bigint") % 12 + 1


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to one part and one supplier through computed keys."""
    o = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_part = part.select(F.count(F.lit(1))).scalar()
    n_supp = supp.select(F.count(F.lit(1))).scalar()
    o = o.withColumns({"_pk": F.col("o_orderkey") % n_part, "_sk": F.col("o_orderkey") % n_supp})
    return (o.join(part, o["_pk"] == part["p_partkey"], "left")
             .join(supp, o["_sk"] == supp["s_suppkey"], "left")
             .drop("_pk", "_sk"))


def raw_orders(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """One dirty, all-string order row per order (schema of FIXTURES §1);
    ``clean`` adds the clean date ``_d`` and the price in cents ``_c``."""
    b = orders_base(spark, sf_dir)
    k = F.col("o_orderkey")
    src = source_of(F.col("o_custkey"))
    d = clean_date(F.col("o_orderdate"))
    cents = cents_of(F.col("o_totalprice"))
    null = F.lit(None).cast("string")
    return b.select(
        k.alias("k"),
        src.alias("objednavatel"),
        F.col("p_type").alias("kategoria"),
        F.concat(F.initcap("p_name"),
                 F.when(k % 4 == 0, F.concat(F.lit(" "), quantity_n(k).cast("string"), F.lit("x")))
                 .otherwise(F.lit(""))).alias("objednavka_predmet"),
        dirty_price(k, cents, src).alias("cena"),
        dirty_date(k, d).alias("datum"),
        F.concat(F.lit("OBJ-"), k.cast("string")).alias("objednavka_cislo"),
        F.when(k % 5 != 0, F.lit("Vlastné zdroje")).otherwise(null).alias("zdroj_financovania"),
        null.alias("balenie"),
        null.alias("sukl_kod"),
        null.alias("mnozstvo"),
        F.when(k % 3 == 0, null).otherwise(F.col("o_orderpriority")).alias("poznamka"),
        F.concat(F.col("s_suppkey").cast("string"),
                 F.when(F.col("s_suppkey") % 2 == 1, F.lit(".0")).otherwise(F.lit(""))).alias("dodavatel_ico"),
        F.col("s_name").alias("dodavatel_nazov"),
        null.alias("odkaz_na_zmluvu"),
        (k % 3 + 1).cast("string").alias("pocet_oslovenych"),
        F.concat(F.lit("objednavky_"), F.lpad((k % N_FILES).cast("string"), 2, "0"), F.lit(".xlsx")).alias("file"),
        insert_ts().alias("insert_date"),
        F.lit("nie").alias("cena_s_dph"),
        *([d.alias("_d"), cents.alias("_c")] if clean else []),
    )


# ---------------------------------------------------------------- raw_cells (long sheet layout)

SHEET = "harok1"
SHEET_COLUMNS = ["objednavka_cislo", "datum", "objednavka_predmet", "kategoria", "cena", "dodavatel_nazov",
                 "dodavatel_ico", "zdroj_financovania", "poznamka", "pocet_oslovenych"]
ROWNUM_HEADER = "Poradové číslo"    # not an alias: dropped by standardisation
SPARSE_HEADER = "SUKL kód lieku"    # ~1 % filled: dropped by the sparse-column rule
EMPTY_HEADER = "Poznámka 2"         # never filled
TITLE = "Zoznam objednávok"
INFO_ROW = ["Informácie o vystavení objednávok", "za obdobie", "01.01.2019", "strana", "1"]
NOISE_ROW = ["Vypracovala: Nováková", "tel.: 041/123"]
LONE_CELL = "Medzisúčet"


def decorate(alias: str, f: int) -> str:
    """Raw spelling of an alias in file ``f`` (undone by header normalisation)."""
    m = f % 4
    if m == 0:
        return alias
    if m == 1:
        return alias.upper()
    if m == 2:
        return "  " + alias.replace(" ", " \n", 1) + " "
    return alias.replace("a", "á")


def sheet_headers(f: int) -> list[str]:
    """Raw header row of file ``f`` (index = col_idx)."""
    h = [ROWNUM_HEADER] + [decorate(rules.ALIASES[c][f % len(rules.ALIASES[c])], f) for c in SHEET_COLUMNS]
    if f % 4 == 2:
        h.append(SPARSE_HEADER)
    if f % 4 == 0:
        h.append(EMPTY_HEADER)
    return h


def title_headers(f: int) -> list[str]:
    return [TITLE] + [f"Unnamed: {i}" for i in range(1, len(sheet_headers(f)))]


def data_row_idx(k: Column) -> Column:
    return (k / N_FILES).cast("bigint") * 4 + 4


def raw_cells(spark: SparkSession, sf_dir: str, sources=None) -> DataFrame:
    """Mail attachments as long cells ``(source, file, sheet, row_idx, col_idx,
    value)``; row 0 is the header row, null cells are present.  Files by
    ``k % 16``: f%4==1 carry noise rows, f%4==2 an almost empty column,
    f%4==0 an empty column and lone-cell rows, f%4==3 a title row with
    'Unnamed' headers (the real header is row 3; file 15 adds an info row)."""
    from procura.functions import rules as R
    ro = raw_orders(spark, sf_dir).where(F.col("objednavatel").isin(list(sources or R.MAIL_DOMAIN)))
    k = F.col("k")
    f = (k % N_FILES).cast("int")
    null = F.lit(None).cast("string")
    data_vals = [(k / N_FILES).cast("bigint").__add__(1).cast("string")] + [F.col(c) for c in SHEET_COLUMNS]
    extra = (F.when(f % 4 == 2, F.array(F.when(k % 97 == 0, F.concat(F.lit("S"), k.cast("string"))).otherwise(null)))
             .when(f % 4 == 0, F.array(null)).otherwise(F.array().cast("array<string>")))
    data = F.concat(F.array(*data_vals), extra)
    base_idx = data_row_idx(k)
    n_cols = len(SHEET_COLUMNS) + 2
    noise = F.array(*[F.lit(v) for v in NOISE_ROW], *[null] * (n_cols - len(NOISE_ROW) - 1))
    lone = F.array(null, F.lit(LONE_CELL), *[null] * (n_cols - 3))
    rows = F.array(
        F.struct(base_idx.alias("row_idx"), data.alias("vals")),
        F.when((f % 4 == 1) & (k % 7 == 1), F.struct((base_idx + 1).alias("row_idx"), noise.alias("vals"))),
        F.when((f % 4 == 0) & (k % 11 == 5), F.struct((base_idx + 2).alias("row_idx"), lone.alias("vals"))),
    )
    body = (ro.select(F.col("objednavatel").alias("source"), F.col("file"), f.alias("f"),
                      F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
              .select("source", "file", "f", "r.row_idx", F.posexplode("r.vals").alias("col_idx", "value")))
    # header rows: one per (source, file); the literal header lists are indexed by f
    sheets = ro.select(F.col("objednavatel").alias("source"), "file", f.alias("f")).distinct()
    lit_rows = lambda rows_by_f: F.element_at(
        F.array(*[F.array(*[F.lit(v) for v in rows_by_f(i)]) for i in range(N_FILES)]), F.col("f") + 1)
    head = F.array(
        F.struct(F.lit(0).cast("bigint").alias("row_idx"),
                 F.when(F.col("f") % 4 == 3, lit_rows(title_headers)).otherwise(lit_rows(sheet_headers)).alias("vals")),
        F.when(F.col("f") == 15, F.struct(F.lit(2).cast("bigint").alias("row_idx"),
                                          F.array(*[F.lit(v) for v in INFO_ROW],
                                                  *[null] * (n_cols - 1 - len(INFO_ROW))).alias("vals"))),
        F.when(F.col("f") % 4 == 3, F.struct(F.lit(3).cast("bigint").alias("row_idx"),
                                             lit_rows(sheet_headers).alias("vals"))),
    )
    heads = (sheets.select("source", "file", "f", F.explode(F.filter(head, lambda r: r.isNotNull())).alias("r"))
                   .select("source", "file", "f", "r.row_idx", F.posexplode("r.vals").alias("col_idx", "value")))
    return (body.unionByName(heads)
                .select("source", "file", F.lit(SHEET).alias("sheet"), "row_idx",
                        F.col("col_idx").cast("int"), "value"))


# ---------------------------------------------------------------- mail messages (from events)

ATTACHMENT_EXT = {"view": "xlsx", "click": "png", "signup": "pdf", "error": "jpg", "purchase": "ods"}
WRONG_DOMAIN = ".cz"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail-client listing derived from ``events``: sender by ``user_id % 21``
    with the source's domain (every fifth user writes from a foreign
    domain), received at ``ts``, one attachment named by the event type."""
    from itertools import chain
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    src = source_of(F.col("user_id"))
    dom = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in rules.MAIL_DOMAIN.items()))
    ext = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ATTACHMENT_EXT.items()))
    domain = F.when(F.col("user_id") % 5 == 0, F.lit(WRONG_DOMAIN)).otherwise(
        F.coalesce(F.try_element_at(dom, src), F.lit(".sk")))
    return e.select(
        F.col("event_id").alias("message_id"),
        F.concat(F.lit("podatelna@"), src, domain).alias("sender"),
        F.col("ts").alias("received_at"),
        (F.col("ts") - F.expr("INTERVAL 1 MINUTE")).alias("sent_on"),
        F.concat(F.lit("objednavky_"), F.col("event_id").cast("string"), F.lit("."),
                 F.try_element_at(ext, F.col("event_type"))).alias("attachment"),
    )


def sheet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per mail source and file of ``raw_cells``: files 0 to 7
    arrive in February, the others in April; sent at 9:29, received at 9:30."""
    ro = raw_orders(spark, sf_dir).where(F.col("objednavatel").isin(list(rules.MAIL_DOMAIN)))
    d = ro.select(F.col("objednavatel").alias("source"), "file", (F.col("k") % N_FILES).cast("int").alias("f")).distinct()
    sent = F.make_timestamp_ntz(F.lit(2024), F.when(F.col("f") < 8, 2).otherwise(4), F.col("f") + 1,
                                F.lit(9), F.lit(29), F.lit(0).cast("decimal(16,6)"))
    domains = F.create_map(*[F.lit(x) for kv in rules.MAIL_DOMAIN.items() for x in kv])
    return d.select(F.concat_ws("-", "source", "file").alias("message_id"), "source", "file",
                    F.concat(F.lit("podatelna@"), "source", domains[F.col("source")]).alias("sender"),
                    (sent + F.expr("INTERVAL 1 MINUTE")).alias("received_at"), sent.alias("sent_on"),
                    F.regexp_replace("file", "xlsx$", "csv").alias("attachment"))


def save_attachments(cells: DataFrame, messages: DataFrame, selected: DataFrame, inbox: str) -> None:
    """What the mail client does: the selected messages' sheets saved as CSV,
    one file each, under their saved names."""
    n_cols = len(SHEET_COLUMNS) + 2
    names = messages.select("message_id", "file").join(selected, "message_id").select("source", "file", "saved_name")
    rows = (cells.join(names, ["source", "file"]).groupBy("source", "saved_name", "row_idx")
                 .agg(row_map("col_idx", F.col("value")).alias("m")))
    rows = rows.select("source", F.col("saved_name").alias("file"), "row_idx", *[
        F.try_element_at("m", F.lit(i)).alias(f"c{i}") for i in range(n_cols)])
    (rows.repartition("source", "file").sortWithinPartitions("source", "file", "row_idx").drop("row_idx")
         .write.option("escape", '"').partitionBy("source", "file").csv(inbox))


def source_marks(spark: SparkSession) -> DataFrame:
    """Per-source load marks used by the incremental examples: day ``i`` of
    January 2024 for the i-th source."""
    rows = [(s, i) for i, s in enumerate(rules.SOURCES)]
    return (spark.createDataFrame(rows, "source string, i int")
                 .select("source", (F.lit("2024-01-01").cast("timestamp_ntz")
                                    + F.make_interval(days=F.col("i"))).alias("last_update")))


# ---------------------------------------------------------------- web tables (html pages)

ROWS_PER_PAGE = 25
FNTN_HEADERS, DONSP_HEADERS = rules.FNTN_HEADERS, rules.DONSP_HEADERS
WEB_SOURCES = ("fntn", "donsp")
PAGE_SPAN = 1_000_000_000  # pages of one week: week_index * PAGE_SPAN + sub-page


def web_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the two web sources with their page number: newest week is
    page 0..; a week is split into sub-pages of ~25 rows by ``k % n_sub``."""
    ro = raw_orders(spark, sf_dir, clean=True).where(F.col("objednavatel").isin(list(WEB_SOURCES)))
    mx = ro.groupBy("objednavatel").agg(F.max("_d").alias("_mx"))
    ro = ro.join(mx, "objednavatel").withColumn("_w", (F.datediff("_mx", "_d") / 7).cast("bigint"))
    nw = ro.groupBy("objednavatel", "_w").agg(F.count(F.lit(1)).alias("_n"))
    ro = ro.join(nw, ["objednavatel", "_w"]).withColumn(
        "page", F.col("_w") * PAGE_SPAN + F.col("k") % F.ceil(F.col("_n") / ROWS_PER_PAGE))
    return ro.drop("_mx", "_n", "_w")


def _td(x: Column, tag: str = "td") -> Column:
    return F.concat(F.lit(f"<{tag}>"), F.coalesce(x, F.lit("")), F.lit(f"</{tag}>"))


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One html page per (source, page) holding a single ``<table>``: fntn
    with a ``<th>`` header, donsp with the header as first plain row and a
    'Strana n' footer row.  Rows in a page are ordered by date, newest first."""
    r = web_rows(spark, sf_dir)
    k = F.col("k")
    fntn_cells = [F.col("objednavka_cislo"), F.col("dodavatel_nazov"), F.col("objednavka_predmet"),
                  F.col("dodavatel_ico"), F.col("cena"), F.col("datum"),
                  F.concat(F.lit("Z-"), k.cast("string")), F.lit("Ing. Novák"), F.lit("Trenčín"),
                  F.lit("911 01"), F.lit("Legionárska 28")]
    donsp_cells = [F.col("objednavka_cislo"), F.col("dodavatel_nazov"), F.col("dodavatel_ico"), F.col("cena"),
                   F.col("objednavka_predmet"), F.col("datum"), F.lit("Mgr. Kováč")]
    row_html = F.when(F.col("objednavatel") == "fntn", F.concat(F.lit("<tr>"), *[_td(c) for c in fntn_cells],
                                                                F.lit("</tr>"))) \
                .otherwise(F.concat(F.lit("<tr>"), *[_td(c) for c in donsp_cells], F.lit("</tr>")))
    pages = (r.groupBy("objednavatel", "page")
              .agg(F.sort_array(F.collect_list(F.struct(F.col("_d").alias("d"), k.alias("k"), row_html.alias("h"))),
                                asc=False).alias("rows")))
    body = F.array_join(F.transform("rows", lambda x: x["h"]), "")
    head_fntn = F.concat(F.lit("<thead><tr>"), *[F.lit(f"<th>{h}</th>") for h in FNTN_HEADERS], F.lit("</tr></thead>"))
    head_donsp = F.concat(F.lit("<tr>"), *[F.lit(f"<td>{h}</td>") for h in DONSP_HEADERS], F.lit("</tr>"))
    footer = F.concat(F.lit("<tr><td>Strana "), F.col("page").cast("string"), F.lit("</td>"),
                      *[F.lit("<td></td>")] * (len(DONSP_HEADERS) - 1), F.lit("</tr>"))
    html = F.when(F.col("objednavatel") == "fntn",
                  F.concat(F.lit("<html><body><table>"), head_fntn, F.lit("<tbody>"), body,
                           F.lit("</tbody></table></body></html>"))) \
            .otherwise(F.concat(F.lit("<html><body><table>"), head_donsp, body, footer,
                                F.lit("</table></body></html>")))
    return pages.select(F.col("objednavatel").alias("source"), "page",
                        F.concat(F.lit("https://example.org/"), F.col("objednavatel"), F.lit("/objednavky?page="),
                                 F.col("page").cast("string")).alias("url"),
                        html.alias("html"))


# ---------------------------------------------------------------- PDF tables (nsptrstena)

PDF_FILE = "objednavky_2024.pdf"
PDF_PAGES = 4
PDF_LAYOUT_A = ["Dátum\nobjednania", "Predmet objednania", "Predbežná\ncena bez DPH", "Objednávka", "Dodávateľ",
                "Zmluva", "Schválil"]
PDF_LAYOUT_B = ["Dátum\nobjednania", "Predbežná\npredmet objednania\ncena bez DPH", "Objednávka", "Dodávateľ",
                "Zmluva", "Schválil", ""]
PDF_TITLE = "Vystavené objednávky za obdobie: 2024"


def pdf_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables extracted from the PDF of the PDF source, as long cells.  Page
    ``k % 4``: odd pages keep subject and price apart (layout A), even pages
    merge them into one column and add an unnamed empty column (layout B).
    Every page starts with a title row, then the header row; 'Str: n' rows
    are page breaks.  Empty cells are '' (as a PDF table reader gives)."""
    ro = raw_orders(spark, sf_dir, clean=True).where(F.col("objednavatel") == "nsptrstena")
    k = F.col("k")
    pg = (k % PDF_PAGES).cast("int")
    e = (F.col("_c") / 100).cast("bigint").cast("string")
    cc = F.lpad((F.col("_c") % 100).cast("string"), 2, "0")
    price = F.concat(e, F.lit("."), cc)
    subj = F.col("objednavka_predmet")
    date = F.coalesce(F.col("datum"), F.lit(""))
    common = [F.concat(F.lit("OBJ-"), k.cast("string")), F.col("dodavatel_nazov"),
              F.concat(F.lit("Z-"), k.cast("string")), F.lit("Ing. Novák")]
    layout_a = F.array(date, subj, F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(price, F.lit(" eur"))), *common)
    layout_b = F.array(date, F.concat(price, F.lit(" eur "), subj), *common, F.lit(""))
    vals = F.when(pg % 2 == 1, layout_a).otherwise(layout_b)
    idx = (k / PDF_PAGES).cast("bigint") * 2 + 10
    n = len(PDF_LAYOUT_A)
    brk = F.array(F.concat(F.lit("Str: "), pg.cast("string")), *[F.lit("")] * (n - 1))
    rows = F.array(F.struct(idx.alias("row_idx"), vals.alias("vals")),
                   F.when(k % 50 == 7, F.struct((idx + 1).alias("row_idx"), brk.alias("vals"))))
    body = (ro.select(pg.alias("pg"), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
              .select("pg", "r.row_idx", F.posexplode("r.vals").alias("col_idx", "value")))
    pages = ro.select(pg.alias("pg")).distinct()
    title = F.array(F.lit(PDF_TITLE), *[F.lit("")] * (n - 1))
    header = F.when(F.col("pg") % 2 == 1, F.array(*[F.lit(h) for h in PDF_LAYOUT_A])) \
              .otherwise(F.array(*[F.lit(h) for h in PDF_LAYOUT_B]))
    heads = (pages.select("pg", F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("row_idx"), title.alias("vals")),
                                                    F.struct(F.lit(1).cast("bigint").alias("row_idx"), header.alias("vals"))))
                                         .alias("r"))
                  .select("pg", "r.row_idx", F.posexplode("r.vals").alias("col_idx", "value")))
    return (body.unionByName(heads)
                .select(F.lit("nsptrstena").alias("source"), F.lit(PDF_FILE).alias("file"),
                        F.concat(F.lit("p"), F.col("pg").cast("string")).alias("sheet"), "row_idx",
                        F.col("col_idx").cast("int"), "value"))
