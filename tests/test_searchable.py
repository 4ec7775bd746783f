"""F8 / F12 on a stored table: files that cannot hold the keyword are not opened."""
import pytest

from procura.operators import search
from procura.session import scratch_path
from procura.sources import searchable as SE

WORDS = ["gold ring", "ring 100%", "a_b ring", "čaj zelený", "😀😀 smile", "copper\\wire", "plain\nbreak", "xy", ""]
SCHEMA = "objednavatel string, popis string, cislo string, cena double"


def _rows(n=400):
    made = [(f"s{i % 2}", f"{i // 40:03d} {WORDS[i % len(WORDS)]}", f"n{i * 7919 % 100003}", float(i)) for i in range(n)]
    return made + [("s0", None, None, 1.0), ("s1", "", "n1", 2.0), (None, "no source ring", "n2", 3.0)]


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "searchable-test")
    SE.append_searchable(spark.createDataFrame(_rows(), SCHEMA), path, ("popis",), ("cislo",), file_rows=20)
    return path


def _scan(df):
    """Rows, and the scan's own figures."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    figures = [leaves.apply(i).metrics() for i in range(leaves.size())]
    value = lambda name: sum(m.apply(name).value() for m in figures if m.contains(name))
    return rows, value("numFiles"), value("numOutputRows")


KEYWORDS = ["ring", "gold ring", "ring 100\\%", "a\\_b", "a_b", "003%ring", "čaj", "😀😀 s", "copper\\wire", "plain\nbreak", "xy", "", "absent", "%", "007 "]


@pytest.mark.parametrize("mode", ["like", "literal", "insensitive"])
@pytest.mark.parametrize("keyword", KEYWORDS)
def test_same_rows_as_the_whole_scan(spark, stored, keyword, mode):
    whole = search.keyword_filter(spark.read.parquet(stored), keyword, mode)
    some = search.keyword_filter(SE.may_hold(spark, stored, "popis", keyword, mode), keyword, mode)
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


def test_files_read_fall_with_selectivity(spark, stored):
    files = len(spark.read.parquet(stored).inputFiles())
    read = lambda k: _scan(search.keyword_filter(SE.may_hold(spark, stored, "popis", k), k))[1]
    assert files > 15
    assert 0 < read("007 ") <= 4
    assert read("no source") == 1
    assert read("xy") == files
    assert SE.may_hold(spark, stored, "popis", "absent keyword").isEmpty()


def test_files_without_a_sketch_are_read(spark):
    path = scratch_path(spark, "searchable-late")
    SE.append_searchable(spark.createDataFrame(_rows(80), SCHEMA), path, ("popis",), file_rows=20)
    late = spark.createDataFrame([("s0", "a late ring", "n9", 9.0)], SCHEMA)
    late.write.mode("append").partitionBy("objednavatel").parquet(path)  # a load that ended before its sketch
    found = lambda: search.keyword_filter(SE.may_hold(spark, path, "popis", "late ring"), "late ring").count()
    assert found() == 1
    SE.sketch(spark, path, ("popis",))
    assert found() == 1
    assert len(SE._sketched(spark, path, "popis")) == len(spark.read.parquet(path).inputFiles())
    # a column without a sketch excludes nothing
    assert search.keyword_filter(SE.may_hold(spark, path, "cislo", "n9", "literal"), "n9", "literal", "cislo").count() >= 1


def test_equality_skips_row_groups(spark):
    paths = [scratch_path(spark, "bloom"), scratch_path(spark, "no-bloom")]
    d = spark.range(60_000).selectExpr("'s' AS objednavatel", "cast(id AS string) AS popis", "cast(id * 7919 % 1000003 AS string) AS cislo")
    SE.append_searchable(d, paths[0], ("popis",), ("cislo",))
    SE.append_searchable(d, paths[1], ("popis",))
    rows = lambda path, v: _scan(spark.read.parquet(path).where(f"cislo = '{v}'").select("popis"))
    present = {i * 7919 % 1000003 for i in range(60_000)}
    absent = next(str(v) for v in range(500_000, 600_000) if v not in present)
    assert rows(paths[0], absent)[2] == 0 and rows(paths[1], absent)[2] > 0
    assert len(rows(paths[0], 3 * 7919)[0]) == 1


def test_nothing_stored(spark):
    path = scratch_path(spark, "searchable-none")
    SE.sketch(spark, path, ("popis",))
    SE.append_searchable(spark.createDataFrame([], SCHEMA), path, ("popis",))


def test_pieces():
    assert SE.keyword_pieces("ab%cde_f\\%gh") == {"cde", "f%g", "%gh"}
    assert SE.keyword_pieces("ab\\cd") == {"ab\\", "b\\c", "\\cd"}
    assert SE.keyword_pieces("a%b", "literal") == {"a%b"}
    assert SE.keyword_pieces("abcd", "insensitive") == set()


def test_pieces_are_cut_up_in_the_task(monkeypatch):
    import pyarrow as pa

    from procura.sources import searchable as SE
    rows = [("a", "ring"), ("a", "ring"), ("b", "ring"), ("a", "x"), ("b", ""), ("b", "a\nb\u10d0\U0001f600c"), ("a", "aaaaaa")]
    want = {(t[i:i + 3], f) for f, t in rows for i in range(len(t) - 2)}
    batches = [pa.RecordBatch.from_arrays([pa.array([f for f, _ in part]), pa.array([t.encode() for _, t in part], pa.binary())], names=["file", "text"])
               for part in (rows[:3], rows[3:])]
    for held in (SE.PIECES_HELD, 1):
        monkeypatch.setattr(SE, "PIECES_HELD", held)
        made = [tuple(r.values()) for b in SE._pieces(iter(batches)) for r in b.to_pylist()]
        assert set(made) == want
        # distinct for as long as they are held
        assert held == 1 or len(made) == len(want)
