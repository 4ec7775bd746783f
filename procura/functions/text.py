"""Column expressions for string cleaning and price parsing.

Every function takes and returns ``Column`` objects, so all work stays in
JVM-side codegen.  Functions that can fail on a row return ``(value, error)``
where ``error`` is a reason string or null; nothing raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from procura.functions import rules

U = "(?U)"  # Unicode character classes, as Python's re


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold_accents(c) -> Column:
    """Transliterate accented letters to ASCII (one-to-one plus ß and €).
    Pure-ASCII values (byte length = character length) skip the work."""
    x = _c(c)
    out = F.translate(x, rules.ACCENTED, rules.UNACCENTED)
    for src, dst in rules.MULTI_FOLD:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return F.when(F.octet_length(x) == F.char_length(x), x).otherwise(out)


# every character Python's str.strip() removes (str.isspace)
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (a character-set trim, no regex)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def clean_string(c) -> Column:
    """Lower-case, strip, fold accents.  Nulls stay null, '' stays ''."""
    return fold_accents(py_strip(F.lower(_c(c))))


def normalise_header(c) -> Column:
    """Lower -> strip -> drop newlines -> first double space to single ->
    transliterate (so a euro sign becomes upper-case EUR)."""
    x = py_strip(F.lower(_c(c)))
    x = F.replace(x, F.lit("\n"), F.lit(""))
    # replace '  ' by ' ' once per occurrence, non-overlapping (Python str.replace)
    x = F.replace(x, F.lit("  "), F.lit(" "))
    return fold_accents(x)


def normalise_name(name: str) -> str:
    """P1 for a column *name* known on the driver (metadata, not data)."""
    x = str(name).lower().strip().replace("\n", "").replace("  ", " ")
    x = x.translate(str.maketrans(rules.ACCENTED, rules.UNACCENTED))
    for src, dst in rules.MULTI_FOLD:
        x = x.replace(src, dst)
    return x


def collapse_spaces(c) -> Column:
    """Whitespace-collapsed form used to compare headers with aliases."""
    return F.regexp_replace(_c(c), U + r"\s+", " ")


def apply_rules(c, rule_list) -> Column:
    """Ordered regex replacements; pattern '' replaces a whole empty cell."""
    def step(acc, rule):
        pat, rep = rule
        if pat == "":
            # a whole empty cell only: \A\z cannot match inside a non-empty string
            return F.regexp_replace(acc, r"\A\z", rep)
        return F.regexp_replace(acc, U + pat, rep)
    return reduce(step, rule_list, _c(c))


def thousands_dot(c) -> Column:
    """If the text starts like d*.d*.d*, delete its first dot only (the
    first dot follows the leading digits; the lookahead asks for a second)."""
    return F.regexp_replace(_c(c), r"^(\d*)\.(?=\d*\.)", "$1")


NUMBER_RE = U + r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def to_double(c, field: str = "cena"):
    """Text -> double like Python float(); failure -> (null, reason)."""
    x = _c(c)
    ok = x.rlike(NUMBER_RE)
    val = F.when(ok, (py_strip(x)).try_cast("double"))
    err = F.when(x.isNotNull() & ~ok, F.lit(f"{field}:not_a_number"))
    return val, err


def _sets_by_rule(sets=None) -> dict[str, list[str]]:
    by_set: dict[str, list[str]] = {}
    for s, r in (sets or rules.PRICE_SET_OF_SOURCE).items():
        by_set.setdefault(r, []).append(s)
    return dict(sorted(by_set.items()))


def price_rules_df(df, source_col: str, in_col: str, out_col: str, sets=None):
    """Per-source price rules (C1) + thousands dot (C2), one projection per
    rule set.  Each row runs only its own source's chain; staging keeps every
    generated method small (one CASE over all sets exceeds the JVM limit)."""
    src = F.col(source_col)
    df = df.withColumn("_pr", F.col(in_col))
    for rset, sources in _sets_by_rule(sets).items():
        df = df.withColumn("_pr", F.when(src.isin(sources), apply_rules(F.col("_pr"), rules.PRICE_RULES[rset]))
                           .otherwise(F.col("_pr")))
    td = F.when(src.isin(list(rules.THOUSANDS_DOT_SOURCES)), thousands_dot("_pr")).otherwise(F.col("_pr"))
    return df.withColumn(out_col, td).drop("_pr")


def clean_price_df(df, source_col: str, in_col: str, out_col: str, err_col: str, sets=None):
    """Price text of any source -> double + reason (C1 -> C2 -> C3)."""
    staged = price_rules_df(df, source_col, in_col, "_pt", sets)
    val, err = to_double("_pt")
    return staged.withColumns({out_col: val, err_col: err}).drop("_pt")


def extract_quantity(subject, quantity):
    """C4: move a trailing ' <n>x' from the subject into an empty quantity.
    Returns (subject, quantity)."""
    s, q = _c(subject), _c(quantity)
    found = F.regexp_substr(s, F.lit(U + r"\s+\d+x$"))
    new_q = F.when(q.isNull() & found.isNotNull(), py_strip(found)).otherwise(q)
    new_s = F.regexp_replace(s, U + r"\s+\d+x$", "")
    return new_s, new_q


def extract_year(c) -> Column:
    """First 20xx in the raw date text, as int (null if none)."""
    return (F.regexp_substr(_c(c), F.lit(r"20\d{2}"))).try_cast("int")


def date_typo_fix(c) -> Column:
    """Impossible-day text fixes (substring replacements)."""
    return reduce(lambda acc, r: F.regexp_replace(acc, r[0], r[1]), rules.DATE_TYPO_FIXES, _c(c))


def clean_ico(c) -> Column:
    """Company id without everything from the first dot."""
    return F.regexp_replace(_c(c), r"\..*", "")


def pack(cols: list[str]) -> Column:
    """JSON object of the non-null attributes, in list order."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]))


def collect_errors(*errs) -> Column:
    """Array of the non-null reasons."""
    return F.filter(F.array(*[_c(e).cast("string") for e in errs]), lambda e: e.isNotNull())


def split_merged_text(merged, price, subject):
    """C11 (PDF tables whose subject and price columns merged).

    Returns (merged_clean, price_text, subject, price_double, error)."""
    m, p, s = _c(merged), _c(price), _c(subject)
    m1 = F.regexp_replace(m, U + r"\seur\s", " ")
    extracted = F.regexp_substr(m1, F.lit(r"\d{1,}\.\d*"))
    m2 = F.regexp_replace(m1, r"\d{1,}\.\d*", " ")
    p1 = F.when(m2.isNotNull() & p.isNull(), extracted).otherwise(p)
    s1 = F.when(m2.isNotNull() & s.isNull(), m2).otherwise(s)
    p2 = F.when(p1 == F.lit(""), F.lit("0")).otherwise(p1)
    p3 = F.regexp_replace(p2, U + r"[(a-z)|\s]", "")
    val, err = to_double(p3)
    return m2, p3, s1, val, err
