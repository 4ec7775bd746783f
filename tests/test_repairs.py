"""Cases that ended a job, lost rows or could not be read back."""

import csv

from pyspark.sql import functions as F

from procura.operators import dedupe, registry, search
from procura.operators.cells import columns_by_name
from procura.functions import text
from procura.plans import web
from procura.sources import html, sinks


def test_new_rows_are_compared_within_their_source(spark):
    schema = "objednavatel string, popis string, cena double, datum string, dodavatel string"
    new = spark.createDataFrame([("unb", "p", 1.0, "d", "x"), ("nou", "p", 1.0, "d", "x"), ("nou", "p", 1.0, "d", "x")], schema)
    stored = spark.createDataFrame([("unb", "p", 1.0, "d", "x")], schema)
    assert [r["objednavatel"] for r in dedupe.new_rows_anti(new, stored).collect()] == ["nou"]


def test_null_and_repeated_headers(spark):
    d = spark.createDataFrame([([(0, "a"), (1, None), (2, "a"), (3, "b")],)], "p array<struct<col:int,name:string>>")
    assert d.select(columns_by_name(F.col("p")).alias("m")).first()["m"] == {"a": 0, "b": 3}


def test_upsert_with_null_and_equal_versions(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "k int, v string, version int")
    more = spark.createDataFrame([(2, "c", 1), (3, "d", None)], "k int, v string, version int")
    rows = {r["k"]: r["v"] for r in dedupe.upsert_latest(base, more, ["k"]).collect()}
    assert rows[1] == "a" and rows[3] == "d" and rows[2] in "bc"


def test_backslash_in_a_keyword(spark):
    d = spark.createDataFrame([(r"x a\b y",), ("ab",), ("50%",), ("50 p",)], "popis string")
    got = lambda k: [r["popis"] for r in search.keyword_filter(d, k).collect()]
    assert got(r"a\b") == [r"x a\b y"] and got(r"50\%") == ["50%"] and got("\\") == [r"x a\b y"]


def test_csv_is_read_by_other_readers(spark, tmp_path):
    rows = [('{"a": "q \\" r", "b": "1,2"}', 2.0), ("x\ny", None)]
    sinks.export_csv(spark.createDataFrame(rows, "popis string, cena double"), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("*.csv"))
    with part.open(newline="") as f:
        got = list(csv.reader(f))
    assert [r[0] for r in got[1:]] == [r[0] for r in rows]


def test_entry_without_attributes_survives_overrides(spark):
    dim = spark.createDataFrame([("a", {}), ("b", {"x": "1"})], "key string, attributes map<string,string>")
    over = spark.createDataFrame([("b", "x", "2", False)], "key string, attr string, value string, replace_all boolean")
    rows = {r["key"]: r["attributes"] for r in registry.apply_overrides(dim, over).collect()}
    assert rows == {"a": {}, "b": {"x": "2"}}


def test_cell_text_of_html(spark):
    page = "<table><tr><th>\n   D&aacute;tum \n vystavenia\n</th><th>\n</th></tr><tr><td>a&amp;b</td><td>&nbsp;x&ndash;y </td></tr></table>"
    d = spark.createDataFrame([("s", 1, page)], "source string, page long, html string")
    got = {(r["row_idx"], r["col_idx"]): r["value"] for r in html.table_cells(d).collect()}
    assert got == {(0, 0): "D\u00e1tum vystavenia", (0, 1): None, (1, 0): "a&b", (1, 1): "x\u2013y"}


def test_append_writes_few_files(spark, tmp_path):
    d = spark.range(4000).selectExpr("concat('s', id % 9) AS objednavatel", "id").repartition(8)
    sinks.append_table(d, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 18
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


def test_spans_references_and_nested_tables(spark):
    page = ("<table><tr><th colspan=\"2\">&#225; &#x10D;</th><th>c</th></tr><tr><td>&amp;lt; &bogus; &</td>"
            "<td><table><tr><td>in</td></tr></table></td><td>z</td></tr><tr><td>after</td></tr></table>"
            "<table><tr><td>second</td></tr></table>")
    d = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<table></table>")], "id int, html string")
    got = {r["id"]: r["r"] for r in d.select("id", html.table_rows("html").alias("r")).collect()}
    assert got[1] == [["\u00e1 \u010d", "\u00e1 \u010d", "c"], ["&lt; &bogus; &", "in", "z"], ["after"]]
    assert got[2] is None and got[3] == [] and got[4] == []


def test_headers_in_any_latin_spelling(spark):
    d = spark.createDataFrame([("Dod\u00e1vate\u013e \u2013 I\u010cO",), ("\u0151\u0171\u0142\u00f8",), ("a\u00a0b",)], "v string")
    assert [r[0] for r in d.select(text.normalise_header("v")).collect()] == ["dodavatel - ico", "oulo", "a b"]
    assert text.normalise_name("Dod\u00e1vate\u013e \u2013 I\u010cO") == "dodavatel - ico"


def test_odd_pages_do_not_end_the_web_job(spark):
    page = "<table><tr><th></th><th>Suma</th><th>Suma</th></tr><tr><td>x</td><td>1</td><td>2</td></tr></table>"
    d = spark.createDataFrame([("donsp", 1, page), ("donsp", 2, None), ("donsp", 3, "<p>")], "source string, page long, html string")
    rows = web.named_rows(d, ["Suma", "I\u010cO"]).collect()
    assert [(r["page"], r["row_idx"], r["Suma"], r["I\u010cO"]) for r in rows] == [(1, 1, "1", None)]


def test_unique_rows_compare_nulls_as_equal(spark):
    schema = "popis string, cena double, datum string, dodavatel string, file string"
    new = spark.createDataFrame([("p", None, None, "x", "n"), ("q", 1.0, "d", "x", "n"), ("r", 1.0, "d", "x", None)], schema)
    stored = spark.createDataFrame([("p", None, None, "x", "s"), ("s", 1.0, "d", "x", "s")], schema)
    got = dedupe.symmetric_unique(new, stored)
    assert got.columns == new.columns
    assert {(r["popis"], r["file"]) for r in got.collect()} == {("q", "n"), ("r", None), ("s", "s")}


def test_cells_given_twice_do_not_end_the_sheet_job(spark):
    from procura.operators import cells
    from procura.plans import merged
    schema = "source string, file string, sheet string, row_idx long, col_idx int, value string"
    rows = [("unb", "a.csv", "0", r, c, f"v{r}{c}") for r in range(3) for c in range(2)]
    twice = rows + [("unb", "a.csv", "0", 1, 0, "a0"), ("unb", "a.csv", "0", 0, 1, None), ("unb", "a.csv", "0", 2, 1, "v21")]
    data, heads = cells.to_rows(spark.createDataFrame(twice, schema))
    assert {r["row_idx"]: r["m"] for r in data.collect()} == {1: {0: "a0", 1: "v11"}, 2: {0: "v20", 1: "v21"}}
    assert heads.first()["h"] == {0: "v00", 1: "nan"}
    assert merged.page_rows(spark.createDataFrame(twice, schema)).count() == 2


def test_files_of_one_name_stay_apart(spark, tmp_path):
    from procura.sources import files
    for folder in ("x", "y"):
        (tmp_path / folder / "unb").mkdir(parents=True)
        (tmp_path / folder / "unb" / "a.csv").write_text(f"cena,popis\n1,{folder}\n")
    (tmp_path / "y" / "unb" / "b.json").write_text("{")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    good, failed = files.whole_files(files.attachment_cells(found))
    assert sorted((r["sheet"], r["value"]) for r in good.where("row_idx = 1 AND col_idx = 1").collect()) == [("0", "x"), ("1", "y")]
    assert [r["file"] for r in failed.collect()] == ["b.json"]


def test_each_source_drops_its_columns_after_packing(spark):
    from procura.functions import rules
    from procura.plans import cleaning, merged
    dropped = {}
    fntn = web.clean_fntn(spark.createDataFrame([["x"] * 11], [f"`{h}`".strip("`") for h in rules.FNTN_HEADERS]).withColumn(
        "datum", F.lit(None).cast("timestamp_ntz")))
    donsp = web.clean_donsp(spark.createDataFrame([["x"] * 7], rules.DONSP_HEADERS))
    trstena = merged.clean_merged(spark.createDataFrame([["x"] * 8], merged.COLUMNS))
    for source, rows, lists in (("fntn", fntn, {"popis_list": rules.POPIS_FNTN}), ("donsp", donsp, {"popis_list": rules.POPIS_DONSP}),
                                ("nsptrstena", trstena, {"popis_list": rules.POPIS_TRSTENA, "dodavatel_list": rules.DODAVATEL_TRSTENA})):
        before, after = cleaning.pack_attributes(rows, **lists).columns, cleaning.packed_rows(rows, source=source, **lists)
        dropped[source] = [c for c in before if c not in after.columns]
        assert set(dropped[source]) == set(before) & set(rules.DROP_COLUMNS[source]) and dropped[source]
        # what is packed was packed before it was dropped
        assert {"popis", "dodavatel", "cena", "datum", "objednavka_cislo"} <= set(after.columns) and after.first()["popis"]
    assert "schvalil" in dropped["fntn"] and "zmluva" in dropped["nsptrstena"] and dropped["donsp"] == ["Meno schva\u013euj\u00faceho"]


def test_donsp_tables_with_and_without_names_of_their_own(spark):
    from procura.functions import rules
    page = [["1", "Firma", "2", "1,50", "vec", "1.2.2024", "M"], ["Strana 1", None, None, None, None, None, None]]
    d = spark.createDataFrame(page, rules.DONSP_HEADERS)
    assert [(r["objednavka_cislo"], r["cena"]) for r in web.clean_donsp(d).collect()] == [("1", 1.5)]
    # a table that had its names: all rows stay, other renames, no price
    year = spark.createDataFrame([("1", "Firma", "29.2.2019"), ("Strana 1", "Dod\u00e1vate\u013e", None)], ["C", "Dod\u00e1vate\u013e", "D\u00e1tum"])
    got = web.clean_donsp(year, set_column_names=False, renames={"C": "objednavka_cislo", "Dod\u00e1vate\u013e": "dodavatel_nazov", "D\u00e1tum": "datum"})
    rows = {r["objednavka_cislo"]: r for r in got.collect()}
    assert set(rows) == {"1", "strana 1"} and rows["1"]["cena"] is None and rows["1"]["_errors"] == []
    assert str(rows["1"]["datum"]) == "2019-02-27 00:00:00" and rows["strana 1"]["dodavatel_nazov"] == "dodavatel"


def test_cells_are_collected_once_behind_their_shuffle(spark):
    from procura.operators import cells
    schema = "source string, file string, sheet string, row_idx long, col_idx int, value string"
    rows = [("s", "f", "h", r, c, f"  \u00c1{r}.{c} " if c else None) for r in range(3) for c in range(3)]
    data, _ = cells.to_rows(spark.createDataFrame(rows, schema))
    plan = data._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("REPARTITION_BY_COL"):]
    assert "Aggregate" not in below and "trim" in below
    assert sorted((r["row_idx"], r["m"]) for r in data.collect()) == [
        (r, {c: f"a{r}.{c}" for c in (1, 2)}) for r in (1, 2)]
