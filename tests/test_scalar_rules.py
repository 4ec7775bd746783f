"""Literal unit tables for the scalar rules (dates, prices, headers, strings)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from procura.functions import dates, text

D = dt.datetime


def _dates(spark, values, compat=True):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = dates.parse_dates_df(df, "s", "d", "e", compat=compat).orderBy("i").collect()
    return [(r["d"], r["e"]) for r in out]


DATE_CASES = [
    ("2022-08-31 00:00:00", D(2022, 8, 31), None),
    ("2022-08-31T00:00", D(2022, 8, 31), None),
    ("31.8.2022", D(2022, 8, 31), None),
    ("31. 8. 2022", D(2022, 8, 31), None),
    ("31/8/22", D(2022, 8, 31), None),
    ("31/8/2022", None, "datum:invalid_date"),
    ("05.09.2022-09.09.2022", D(2022, 9, 5), None),
    ("05.09.2022 - 09.09.2022", D(2022, 9, 5), None),
    ("2.-6.10.", D(2017, 10, 6), None),
    ("12.-16.10.2018", D(2017, 10, 16), None),
    ("12. - 16.10.2018", D(2018, 10, 16), None),
    ("1. - 5.3.2019", D(2019, 3, 5), None),
    ("12 16.10.2018", D(2018, 10, 16), None),
    ("pondelok. aprila 04. 2022", D(2022, 4, 4), None),
    ("pondelok. aprila 4. 2022", None, "datum:invalid_date"),
    ("streda 6.februar 2019", D(2019, 2, 6), None),
    ("streda 6. februar 2019", None, None),
    ("5.9.1999", None, None),
    ("31.4.2022", None, "datum:invalid_date"),
    ("29,2,2020", D(2020, 2, 29), None),
    ("", None, None),
    (None, None, None),
]


def test_parse_dates_literals(spark):
    got = _dates(spark, [c[0] for c in DATE_CASES])
    for (s, want, err), (d, e) in zip(DATE_CASES, got):
        assert (d, e) == (want, err), s


def test_parse_dates_repaired_order(spark):
    got = _dates(spark, ["12.-16.10.2018", "streda 6. februar 2019"], compat=False)
    assert got == [(D(2018, 10, 16), None), (D(2019, 2, 6), None)]


def test_date_corrections_and_fallback(spark):
    df = spark.createDataFrame([("pondelok. marca 05. 2019",), ("31.4.2019",), ("..",), ("19.12.202",)], "s string")
    s1 = df.select("s", text.extract_year("s").alias("y"), dates.date_corrections("s").alias("t"))
    s2 = dates.parse_dates_df(s1, "t", "p")
    rows = s2.select("t", dates.date_fallback("p", "y").alias("d")).collect()
    assert rows[0]["t"] == ". 05. 2019" and rows[0]["d"] == D(2019, 1, 1)
    assert rows[1]["d"] == D(2019, 1, 1)
    assert rows[2]["t"] == "." and rows[2]["d"] is None
    assert rows[3]["t"] == "19.12.2022" and rows[3]["d"] == D(2022, 12, 19)


def _prices(spark, source, values):
    df = spark.createDataFrame([(i, source, v) for i, v in enumerate(values)], "i int, src string, p string")
    out = text.clean_price_df(df, "src", "p", "c", "e").orderBy("i").collect()
    return [(r["c"], r["e"]) for r in out]


PRICE_CASES_R5 = [
    ("1 234,50", 1234.5, None),
    ("1.234.567.89", None, "cena:not_a_number"),
    ("112.946.26", 112946.26, None),
    ("-5,00", 5.0, None),
    ("5d", 5.0, None),
    ("10,-", 10.0, None),
    ("10,", 10.0, None),
    ("1234,56 eur", 1234.56, None),
    ("", 0.0, None),
    (None, None, None),
]


def test_price_rules_r5(spark):
    got = _prices(spark, "dfnbb", [c[0] for c in PRICE_CASES_R5])
    for (s, want, err), (v, e) in zip(PRICE_CASES_R5, got):
        assert (v, e) == (want, err), s


def test_price_rules_other_sets(spark):
    assert _prices(spark, "nusch", ["12:30:00", "=A1", "5 12:30:00"]) == [
        (None, "cena:not_a_number"), (None, "cena:not_a_number"), (0.0, None)]
    assert _prices(spark, "fnsppresov", [""]) == [(None, "cena:not_a_number")]
    assert _prices(spark, "fnspza", ["mc 1.234,5", "12:30", "1234,- eur"]) == [
        (1234.5, None), (0.0, None), (1234.0, None)]
    assert _prices(spark, "donsp", ["1.234.56"]) == [(None, "cena:not_a_number")]
    assert _prices(spark, "unb", ["12_5"]) == [(1205.0, None)]


def test_to_double_guard(spark):
    df = spark.createDataFrame([("5d",), (" 12.5 ",), ("1e3",), ("abc",)], "s string")
    v, e = text.to_double("s")
    rows = df.select(v.alias("v"), e.alias("e")).collect()
    assert [(r.v, r.e) for r in rows] == [(None, "cena:not_a_number"), (12.5, None), (1000.0, None),
                                          (None, "cena:not_a_number")]


HEADER_CASES = [
    ("Cena s DPH (€)", "cena s dph (EUR)"),
    ("hodnota zakazky      s dph", "hodnota zakazky   s dph"),
    ("  Dátum \nobjednávky ", "datum objednavky"),
    ("PREDMET OBJEDNÁVKY", "predmet objednavky"),
]


@pytest.mark.parametrize("raw,want", HEADER_CASES)
def test_normalise_header(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "h string").select(text.normalise_header("h")).first()[0]
    assert got == want
    assert text.normalise_name(raw) == want


def test_clean_string_and_quantity(spark):
    df = spark.createDataFrame([("  Vlastné Zdroje ß ", "Small Ring 3x", None), ("", "ring", "2x")],
                               "a string, s string, q string")
    s, q = text.extract_quantity(text.clean_string("s"), "q")
    rows = df.select(text.clean_string("a").alias("a"), s.alias("s"), q.alias("q")).collect()
    assert (rows[0].a, rows[0].s, rows[0].q) == ("vlastne zdroje ss", "small ring", "3x")
    assert (rows[1].a, rows[1].s, rows[1].q) == ("", "ring", "2x")


def test_merged_text_split(spark):
    df = spark.createDataFrame([("1234.56 eur small ring", None, None), (None, "99.5 eur", "x"), (None, "", "y")],
                               "m string, p string, s string")
    _, _, s, v, e = text.split_merged_text(F.col("m"), F.col("p"), F.col("s"))
    rows = df.select(s.alias("s"), v.alias("v"), e.alias("e")).collect()
    assert [(r.s, r.v, r.e) for r in rows] == [("  small ring", 1234.56, None), ("x", 99.5, None), ("y", 0.0, None)]
