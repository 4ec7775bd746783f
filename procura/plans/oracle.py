"""DuckDB oracle SQL building blocks.

The oracle states the *clean* value each query should recover, from the
same derivation rule the Spark fixtures use (FIXTURES.md §2).  It never
repeats the parsers: it only says "form 3 of a price is E.CC", "form 9 of
a date has no valid value", and so on.
"""

from __future__ import annotations

from procura.functions import rules

SRC_LIST = "[" + ", ".join(f"'{s}'" for s in rules.SOURCES) + "]"
N_SRC = len(rules.SOURCES)

BASE = f"""base AS (
  SELECT o.o_orderkey AS k,
         {SRC_LIST}[(o.o_custkey % {N_SRC}) + 1] AS src,
         o.o_orderdate + INTERVAL 24 YEAR AS d,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents,
         p.p_name, p.p_type, s.s_suppkey, s.s_name, o.o_orderpriority
  FROM orders o
  LEFT JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM part)
  LEFT JOIN supplier s ON s.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)
)"""


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def sources_of_sets(*sets) -> list[str]:
    return [s for s, r in rules.PRICE_SET_OF_SOURCE.items() if r in sets]


MAIL = [s for s in rules.SOURCES if s in rules.MAIL_DOMAIN]
ZERO_ON_EMPTY = sources_of_sets("R4", "R5", "R6", "R7")

QTY = "(((k // 4) % 12) + 1)::VARCHAR || 'x'"
SUBJECT_WITH_QTY = f"p_name || CASE WHEN k % 4 = 0 THEN ' ' || {QTY} ELSE '' END"

# price after the source's rules (mail sources and donsp), and its error
PRICE = f"""CASE WHEN src = 'fntn' THEN cents / 100
     WHEN k % 6 = 3 AND src = 'donsp' THEN NULL
     WHEN k % 6 = 4 THEN CAST(cents // 100 AS DOUBLE)
     WHEN k % 6 = 5 THEN CASE WHEN src IN {_in(ZERO_ON_EMPTY)} THEN 0.0 ELSE NULL END
     ELSE cents / 100 END"""
PRICE_ERR = f"""CASE WHEN src = 'fntn' THEN NULL
     WHEN k % 6 = 3 AND src = 'donsp' THEN 'cena:not_a_number'
     WHEN k % 6 = 5 AND src NOT IN {_in(ZERO_ON_EMPTY)} THEN 'cena:not_a_number' END"""

# date of the plain parser (mail sources other than fnspza), and its error
DATE = "CASE WHEN k % 10 IN (8, 9) THEN NULL ELSE d END"
DATE_ERR = "CASE WHEN k % 10 = 9 THEN 'datum:invalid_date' END"
# fnspza: letters deleted (form 7) and invalid days (form 9) fall back to 1 January
DATE_FNSPZA = "CASE WHEN k % 10 = 8 THEN NULL WHEN k % 10 IN (7, 9) THEN make_timestamp(year(d), 1, 1, 0, 0, 0) ELSE d END"
# donsp: 29.2. becomes 27.2. where the day is written unpadded
DATE_DONSP = ("CASE WHEN k % 10 IN (8, 9) THEN NULL "
              "WHEN k % 10 IN (1, 5, 6) AND month(d) = 2 AND day(d) = 29 THEN d - INTERVAL 2 DAY ELSE d END")


def dirty_price(k="k", cents="cents", src="src") -> str:
    e = f"({cents} // 100)"
    cc = f"lpad(({cents} % 100)::VARCHAR, 2, '0')"
    return f"""CASE WHEN {src} = 'fntn' OR {k} % 6 = 0 THEN {e}::VARCHAR || '.' || {cc}
     WHEN {k} % 6 = 1 THEN {e}::VARCHAR || ',' || {cc}
     WHEN {k} % 6 = 2 THEN {e}::VARCHAR || ',' || {cc} || ' eur'
     WHEN {k} % 6 = 3 THEN ({e} // 1000)::VARCHAR || '.' || lpad(({e} % 1000)::VARCHAR, 3, '0') || '.' || {cc}
     WHEN {k} % 6 = 4 THEN {e}::VARCHAR || ',-'
     ELSE '' END"""


def dirty_date_lower(k="k", d="d") -> str:
    """Dirty date text after lower-casing (the month name only matters there)."""
    months = "['januara', 'februara', 'marca', 'aprila', 'maja', 'juna', 'jula', 'augusta', 'septembra', " \
             "'oktobra', 'novembra', 'decembra']"
    return f"""CASE {k} % 10
     WHEN 0 THEN strftime({d}, '%Y-%m-%d') || ' 00:00:00'
     WHEN 1 THEN strftime({d}, '%-d.%-m.%Y')
     WHEN 2 THEN strftime({d}, '%-d. %-m. %Y')
     WHEN 3 THEN strftime({d}, '%-d/%-m/%y')
     WHEN 4 THEN strftime({d}, '%d.%m.%Y') || ' - ' || strftime({d} + INTERVAL 4 DAY, '%d.%m.%Y')
     WHEN 5 THEN '1. - ' || strftime({d}, '%-d.%-m.%Y')
     WHEN 6 THEN '1 ' || strftime({d}, '%-d.%-m.%Y')
     WHEN 7 THEN 'pondelok. ' || {months}[month({d})] || ' ' || strftime({d}, '%d') || '. ' || strftime({d}, '%Y')
     WHEN 8 THEN NULL
     ELSE '31.4.' || strftime({d}, '%Y') END"""


def popis_json(predmet: str, mnozstvo: str = "NULL", vat: str = "'nie'") -> str:
    return f"""json_merge_patch('{{}}', json_object(
    'objednavka_predmet', {predmet},
    'kategoria', lower(p_type),
    'objednavka_cislo', 'obj-' || k::VARCHAR,
    'zdroj_financovania', CASE WHEN k % 5 <> 0 THEN 'vlastne zdroje' END,
    'balenie', NULL, 'sukl_kod', NULL,
    'mnozstvo', {mnozstvo},
    'poznamka', CASE WHEN k % 3 <> 0 THEN lower(o_orderpriority) END,
    'odkaz_na_zmluvu', NULL,
    'pocet_oslovenych', ((k % 3) + 1)::VARCHAR,
    'cena_s_dph', {vat}))::VARCHAR"""


DODAVATEL_JSON = """json_merge_patch('{}', json_object(
    'dodavatel_nazov', lower(s_name),
    'dodavatel_ico', s_suppkey::VARCHAR || CASE WHEN s_suppkey % 2 = 1 THEN '.0' ELSE '' END))::VARCHAR"""

LINK_CTE = f"""links AS (
  SELECT {SRC_LIST}[(c_custkey % {N_SRC}) + 1] AS src,
         'https://example.org/' || {SRC_LIST}[(c_custkey % {N_SRC}) + 1] || '/' || max(c_custkey)::VARCHAR AS link
  FROM customer GROUP BY 1
)"""

VAT_FILES = "(3, 9, 13)"   # files whose price header is a VAT-inclusive alias
VAT_OF_FILE = f"CASE WHEN k % 16 IN {VAT_FILES} THEN 'ano' ELSE 'nie' END"


def mail_final_cte(name: str = "mail_final", vat: str = "'nie'") -> str:
    """Final rows of the mail sources (E1 result over the order-shaped input)."""
    return f"""{name} AS (
  SELECT src AS objednavatel,
         {PRICE} AS cena,
         CASE WHEN src = 'fnspza' THEN {DATE_FNSPZA} ELSE {DATE} END AS datum,
         {DODAVATEL_JSON} AS dodavatel,
         CASE WHEN src = 'fnspza' THEN {popis_json('p_name', f"CASE WHEN k % 4 = 0 THEN {QTY} END", vat)}
              ELSE {popis_json(SUBJECT_WITH_QTY, vat=vat)} END AS popis,
         TIMESTAMP '2024-06-01 12:00:00' AS insert_date,
         'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.xlsx' AS file,
         l.link
  FROM (SELECT * FROM base WHERE src IN {_in(MAIL)}) b LEFT JOIN links l USING (src)
)"""


MAIL_FINAL = mail_final_cte()

P1_SQL = ("replace(strip_accents(replace(replace(regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g'), chr(10), ''), "
          "'  ', ' ')), '€', 'EUR')")


def header_values() -> str:
    """Raw header rows of the 16 files as a VALUES list (f, col_idx, raw, titled)."""
    from procura.sources import fixtures as FX
    rows = []
    for f in range(FX.N_FILES):
        for i, h in enumerate(FX.sheet_headers(f)):
            rows.append(f"({f}, {i}, '{h}', false)")
        if f % 4 == 3:
            for i, h in enumerate(FX.title_headers(f)):
                rows.append(f"({f}, {i}, '{h}', true)")
    return "hdr(f, col_idx, raw, title) AS (VALUES " + ", ".join(rows).replace("\n", "\n") + ")"


SHEETS = f"""sheets AS (
  SELECT src AS source, k % 16 AS f, 'objednavky_' || lpad((k % 16)::VARCHAR, 2, '0') || '.xlsx' AS file,
         count(*) AS n, count(*) FILTER (WHERE k % 97 = 0) AS n_sparse
  FROM base WHERE src IN {_in(MAIL)} GROUP BY ALL
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


MSG = f"""msg AS (
  SELECT event_id AS message_id, ts AS received_at, user_id,
         {SRC_LIST}[(user_id % {N_SRC}) + 1] AS source,
         'objednavky_' || event_id::VARCHAR || '.' ||
           CASE event_type WHEN 'view' THEN 'xlsx' WHEN 'click' THEN 'png' WHEN 'signup' THEN 'pdf'
                           WHEN 'error' THEN 'jpg' WHEN 'purchase' THEN 'ods' END AS attachment
  FROM events
),
marks AS (
  SELECT unnest({SRC_LIST}) AS source, TIMESTAMP '2024-01-01' + to_days(CAST(generate_subscripts({SRC_LIST}, 1) - 1 AS INTEGER)) AS last_update
)"""


def mail_final_k(name: str = "mf") -> str:
    """Mail final rows with their order key."""
    return mail_final_cte(name).replace("  SELECT src AS objednavatel,", "  SELECT k, src AS objednavatel,", 1)


WEB_MARKS = {"fntn": "2025-01-01", "donsp": "2024-07-01"}
# page assignment of the web fixture and the date the pager parses (raw text:
# the capitalised weekday form and invalid days give no date).  An empty web
# cell is missing (not ''), so an empty donsp price stays null.
WEB = f"""web0 AS (
  SELECT b.*, max(d) OVER (PARTITION BY src) AS mx FROM base b WHERE src IN ('fntn', 'donsp')
), web1 AS (
  SELECT *, date_diff('day', d, mx) // 7 AS w FROM web0
), web AS (
  SELECT *, w * 1000000000 + k % CAST(ceil(count(*) OVER (PARTITION BY src, w) / 25) AS BIGINT) AS page,
         CASE WHEN k % 10 IN (7, 8, 9) THEN NULL ELSE d END AS scan_d,
         CASE src WHEN 'fntn' THEN TIMESTAMP '{WEB_MARKS["fntn"]}' ELSE TIMESTAMP '{WEB_MARKS["donsp"]}' END AS hwm
  FROM web1
), pstop AS (
  SELECT src, min(page) FILTER (WHERE NOT coalesce(pmax >= hwm, false)) AS stop
  FROM (SELECT src, page, max(scan_d) AS pmax, any_value(hwm) AS hwm FROM web GROUP BY src, page) GROUP BY src
), scanned AS (
  SELECT web.* FROM web JOIN pstop USING (src)
  WHERE (pstop.stop IS NULL OR web.page <= pstop.stop) AND (scan_d IS NULL OR scan_d >= hwm)
)"""

FNTN_POPIS = """json_merge_patch('{}', json_object(
    'objednavka_predmet', p_name || CASE WHEN k % 4 = 0 THEN ' ' || (((k // 4) % 12) + 1)::VARCHAR || 'x' ELSE '' END,
    'objednavka_cislo', 'obj-' || k::VARCHAR, 'cislo zmluvy', 'z-' || k::VARCHAR, 'schvalil', 'ing. novak',
    'cena_s_dph', 'ano'))::VARCHAR"""
DONSP_POPIS = """json_merge_patch('{}', json_object(
    'objednavka_predmet', p_name || CASE WHEN k % 4 = 0 THEN ' ' || (((k // 4) % 12) + 1)::VARCHAR || 'x' ELSE '' END,
    'objednavka_cislo', 'obj-' || k::VARCHAR, 'cena_s_dph', 'nie'))::VARCHAR"""
FNTN_DODAVATEL = """json_merge_patch('{}', json_object('dodavatel_nazov', lower(s_name), 'dodavatel_ico', s_suppkey::VARCHAR))::VARCHAR"""

WEB_FINAL = f"""web_final AS (
  SELECT k, src AS objednavatel,
         CASE WHEN src = 'fntn' THEN cents / 100 WHEN k % 6 = 5 THEN NULL ELSE {PRICE} END AS cena,
         CASE WHEN src = 'fntn' THEN scan_d ELSE {DATE_DONSP} END AS datum,
         CASE WHEN src = 'fntn' THEN {FNTN_DODAVATEL} ELSE {DODAVATEL_JSON} END AS dodavatel,
         CASE WHEN src = 'fntn' THEN {FNTN_POPIS} ELSE {DONSP_POPIS} END AS popis,
         TIMESTAMP '2024-06-01 12:00:00' AS insert_date, 'web' AS file, l.link
  FROM web LEFT JOIN links l USING (src)
)"""
