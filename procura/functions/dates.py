"""Date text -> timestamp_ntz as native Column expressions."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import rules
from procura.functions.text import U, _c, py_strip

DEFAULT_YEAR = 2017
# pandas Timestamp bounds: values outside raise in the source system
_TS_MIN, _TS_MAX = "1677-09-22", "2262-04-11"


def _months() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in rules.MONTHS.items()))


def date_corrections(c) -> Column:
    """Ordered text fixes of fnspza dates, then strip."""
    def step(acc, rule):
        pat, rep, is_regex = rule
        if is_regex:
            return F.regexp_replace(acc, U + pat, rep)
        # whole-cell replacement as an anchored literal (keeps one reference to acc)
        return F.regexp_replace(acc, r"\A\Q" + pat + r"\E\z", rep)
    return py_strip(reduce(step, rules.DATE_CORRECTIONS, _c(c)))


def _int(x) -> Column:
    """Python int() on text: optional sign, digits, surrounding whitespace
    (a decimal point or inner space gives null, as int() raises)."""
    return py_strip(x).try_cast("int")


def _part(arr, i) -> Column:
    return F.try_element_at(arr, F.lit(i))


def _ts(y, m, d) -> Column:
    ts = F.call_function("try_make_timestamp_ntz", y, m, d, F.lit(0), F.lit(0), F.lit(0))
    return F.when((ts >= F.lit(_TS_MIN).cast("timestamp_ntz")) & (ts < F.lit(_TS_MAX).cast("timestamp_ntz")), ts)


def parse_dates_df(df: DataFrame, in_col: str, out_col: str, err_col: str | None = None,
                   compat: bool = True, default_year: int = DEFAULT_YEAR) -> DataFrame:
    """Multi-format date parse as a staged transform.

    Stage 1 normalises the text once (strip, ',' -> '.') and splits the
    tokens every branch needs; stage 2 is one CASE over the branches whose
    values only reference those columns, which keeps generated code small.
    First matching branch wins; all are prefix-anchored.  A branch that
    matches but yields no valid date gives null plus the reason
    ``datum:invalid_date``; text that matches no branch gives null without a
    reason."""
    s = F.col("_dt_s")
    stage1 = df.withColumn("_dt_s", F.replace(py_strip(F.col(in_col)), F.lit(","), F.lit(".")))
    stage2 = stage1.withColumns({
        "_dt_dash": F.split(py_strip(_part(F.split(s, "-"), 2)), r"\."),
        "_dt_sp": F.split(s, " "),
        "_dt_sl": F.split(s, "/"),
        "_dt_y4": _int(F.regexp_substr(s, F.lit(r"\d{4}"))),
    })
    dash, sp, sl, y4 = (F.col(c) for c in ("_dt_dash", "_dt_sp", "_dt_sl", "_dt_y4"))

    def ymd_dot(text):
        p = F.split(py_strip(text), r"\.")
        return _int(_part(p, 3)), _int(_part(p, 2)), _int(_part(p, 1))

    def month_of(token):
        return F.try_element_at(_months(), F.substring(token, 1, 3))

    branches = []
    # 1: yyyy-mm-dd... (10-char prefix, so 'T' separators parse)
    branches.append((s.rlike(r"^20\d{2}-\d{2}-\d{2}"),
                     (F.substring(s, 1, 4).cast("int"), F.substring(s, 6, 2).cast("int"),
                      F.substring(s, 9, 2).cast("int"))))
    # 2: d.m.yyyy with optional spaces
    r2 = U + r"^(\d+)\.\s*(\d+)\.\s*(20\d{2})$"
    branches.append((s.rlike(r2), (_int(F.regexp_extract(s, r2, 3)), _int(F.regexp_extract(s, r2, 2)),
                                   _int(F.regexp_extract(s, r2, 1)))))
    # 3: d/m/yy (end unanchored: longer years give an invalid date)
    branches.append((s.rlike(r"^\d+/\d+/\d{2}"),
                     (_int(F.concat(F.lit("20"), _part(sl, 3))), _int(_part(sl, 2)), _int(_part(sl, 1)))))
    # 4: date range -> its first date
    r4 = r"^(\d+)\.(\d+)\.(20\d{2})"
    branches.append((s.rlike(r"^\d+\.\d+\.20\d{2}.*-*.*\d+\.\d+\.20\d{2}"),
                     (_int(F.regexp_extract(s, r4, 3)), _int(F.regexp_extract(s, r4, 2)),
                      _int(F.regexp_extract(s, r4, 1)))))
    # 5: d.-d.m. -> part after '-', fixed year
    b5 = (s.rlike(r"^\d+\.-\d+\.\d+"), (F.lit(default_year), _int(_part(dash, 2)), _int(_part(dash, 1))))
    # 6: range with a dash -> date after the first '-'
    b6 = (s.rlike(r"^\d+.*-.*\d+\.\d+\..*20\d{2}"), (_int(_part(dash, 3)), _int(_part(dash, 2)), _int(_part(dash, 1))))
    branches += [b5, b6] if compat else [b6, b5]
    # 7: '<n> d.m.yyyy' -> second space-separated token
    branches.append((s.rlike(U + r"^\d+.*\s.*\d+\.\d+\..*20\d{2}"), ymd_dot(_part(sp, 2))))
    # 8: 'weekday. month dd. yyyy'
    day8 = F.regexp_extract(s, U + r"\s(\d{2})\.", 1)
    branches.append((s.rlike(U + r"^[a-z]+\.\s[a-z]+\s\d+\.\s\d+"),
                     (y4, month_of(_part(sp, 2)), _int(F.nullif(day8, F.lit(""))))))
    # 9: 'weekday d.month yyyy' (month taken from the letters after the day)
    day9 = _int(F.regexp_extract(s, r"(\d{1,})\.", 1))
    branches.append((s.rlike(U + r"^[a-z]+\s\d+\.[a-z]+\s\d{4}"),
                     (y4, month_of(F.regexp_extract(s, r"\d+\.([a-z]+)", 1)), day9)))
    if not compat:
        # 9b: 'weekday d. month yyyy'
        branches.append((s.rlike(U + r"^[a-z]+\s\d+\.\s[a-z]+\s\d{4}"),
                         (y4, month_of(_part(sp, 3)), day9)))

    # stage 3: index of the first matching branch (0 = none)
    idx = None
    for i, (cond, _) in enumerate(branches, start=1):
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    stage3 = stage2.withColumn("_dt_b", idx.otherwise(F.lit(0)))
    b = F.col("_dt_b")

    # stage 4: year / month / day of the chosen branch, one small CASE each
    def pick(j):
        out = None
        for i, (_, parts) in enumerate(branches, start=1):
            out = F.when(b == i, parts[j]) if out is None else out.when(b == i, parts[j])
        return out
    stage4 = stage3.withColumns({"_dt_y": pick(0), "_dt_m": pick(1), "_dt_d": pick(2)})
    stage5 = stage4.withColumn(out_col if out_col != in_col else "_dt_v",
                               _ts(F.col("_dt_y"), F.col("_dt_m"), F.col("_dt_d")))
    v = F.col(out_col if out_col != in_col else "_dt_v")
    if err_col:
        stage5 = stage5.withColumn(err_col, F.when((b > 0) & v.isNull(), F.lit("datum:invalid_date")))
    if out_col == in_col:
        stage5 = stage5.withColumn(out_col, v)
    return stage5.drop("_dt_s", "_dt_dash", "_dt_sp", "_dt_sl", "_dt_y4", "_dt_b", "_dt_y", "_dt_m", "_dt_d", "_dt_v")


def date_fallback(parsed, year) -> Column:
    """1 January of the extracted year when no date was parsed."""
    p, y = _c(parsed), _c(year)
    return F.when(p.isNull() & y.isNotNull(), _ts(y, F.lit(1), F.lit(1))).otherwise(p)
