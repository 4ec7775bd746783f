"""Sheet cleaning over long cells.

Input: ``raw_cells(source, file, sheet, row_idx, col_idx, value)`` with the
header in row 0.  Each sheet row becomes one ``map<col_idx, value>`` of its
non-null cells (one shuffle of the cells, grouped by sheet row -- bounded groups
even when one sheet holds a third of all rows; collected once, behind the
shuffle: lists gathered before it would have to be sorted, and spilled, twice).  Row rules are then map expressions;
column rules aggregate per ``(sheet, col_idx)`` with partial aggregation and
join a small per-sheet result back (AQE picks broadcast or a skew-split
sort-merge join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import rules
from procura.functions.text import U, clean_string, collapse_spaces, normalise_header
from procura.session import materialize

SHEET_KEY = ["source", "file", "sheet"]


def noise_prefix_regex(personal_names=None) -> str:
    names = tuple(personal_names if personal_names is not None else rules.NOISE_PERSONAL_NAMES)
    branches = list(rules.NOISE_BRANCHES) + [n for n in names]
    return U + "^(?:" + "|".join(f"(?:{b})" for b in branches) + ")"


def columns_by_name(pairs):
    """Map name -> column from a sorted array of (column, name): null names are
    left out, of equal names the first column counts."""
    names = F.transform(pairs, lambda e: e["name"])
    kept = F.filter(pairs, lambda e, i: F.array_position(names, e["name"]) == i + 1)
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["name"], e["col"])))


def row_map(col, value: Column) -> Column:
    """Aggregate: map column -> value of a group of cells; of a column given more
    than once the first value in order counts, null before all."""
    found = F.collect_list(F.struct(F.col(col).alias("col"), value.alias("v")))
    ordered = F.sort_array(found)
    first = F.filter(ordered, lambda e, i: F.array_position(ordered["col"], e["col"]) == i + 1)
    once = F.size(F.array_distinct(found["col"])) == F.size(found)
    return F.map_from_entries(F.when(once, found).otherwise(first))


def to_rows(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split cells into data rows ``(sheet, row_idx, m)`` with P2-cleaned
    values and header maps ``(sheet, h)`` with P1-normalised names."""
    body = cells.where(F.col("row_idx") > 0).select(*SHEET_KEY, "row_idx", "col_idx", clean_string("value").alias("value"))
    data = (body.repartition(*SHEET_KEY, "row_idx")
                .groupBy(*SHEET_KEY, "row_idx")
                .agg(row_map("col_idx", F.col("value")).alias("m"))
                .withColumn("m", F.map_filter("m", lambda k, v: v.isNotNull())))
    heads = (cells.where(F.col("row_idx") == 0)
                  .groupBy(*SHEET_KEY)
                  .agg(row_map("col_idx", F.coalesce(normalise_header("value"), F.lit("nan"))).alias("h")))
    return data, heads


def drop_noise_rows(rows: DataFrame, regex: str | None = None) -> DataFrame:
    """F1 (F2 with a search pattern): drop a row when any cell matches."""
    regex = regex or noise_prefix_regex()
    return rows.where(~F.exists(F.map_values("m"), lambda v: v.rlike(regex)))


def kept_columns(rows: DataFrame, heads: DataFrame, fraction: float = 0.1, min_count: int | None = None) -> DataFrame:
    """Per sheet, the columns with at least ``ceil(fraction * rows)`` non-null
    cells (F3) -- or at least ``min_count`` (F5 uses 1).

    One pass over the rows: every row contributes its keys plus a marker
    (-1) that counts the row itself; partial aggregation keeps the shuffle to
    one small record per (sheet, column) per task."""
    counts = (rows.select(*SHEET_KEY, F.explode(F.array_append(F.map_keys("m"), F.lit(-1))).alias("col"))
                  .groupBy(*SHEET_KEY, "col").agg(F.count(F.lit(1)).alias("c"))
                  .groupBy(*SHEET_KEY).agg(F.map_from_entries(F.collect_list(F.struct("col", "c"))).alias("cnt")))
    n = F.coalesce(F.element_at("cnt", F.lit(-1)), F.lit(0))
    thr = F.lit(min_count) if min_count is not None else F.ceil(n * F.lit(fraction))
    return (heads.join(counts, SHEET_KEY, "left")
                 .select(*SHEET_KEY, F.filter(F.map_keys("h"), lambda c: F.coalesce(
                     F.try_element_at(F.col("cnt"), c), F.lit(0)) >= F.coalesce(thr, F.lit(0))).alias("keep")))


def restrict(rows: DataFrame, heads: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    keep_rows = rows.join(kept, SHEET_KEY, "left").withColumn(
        "m", F.map_filter("m", lambda k, v: F.array_contains(F.coalesce("keep", F.array().cast("array<int>")), k)))
    keep_heads = heads.join(kept, SHEET_KEY, "left").withColumn(
        "h", F.map_filter("h", lambda k, v: F.array_contains(F.coalesce("keep", F.array().cast("array<int>")), k)))
    return keep_rows.drop("keep"), keep_heads.drop("keep")


def drop_sparse_columns(rows, heads, fraction: float = 0.1):
    """drop columns with fewer than ``ceil(fraction * rows)`` values."""
    return restrict(rows, heads, kept_columns(rows, heads, fraction))


def drop_empty_columns(rows, heads):
    """drop columns without any value."""
    return restrict(rows, heads, kept_columns(rows, heads, min_count=1))


def drop_sparse_rows(rows: DataFrame, min_values: int | Column = 2) -> DataFrame:
    """keep rows with at least ``min_values`` non-null cells."""
    t = min_values if isinstance(min_values, Column) else F.lit(min_values)
    return rows.where(F.size("m") >= t)


def _has_unnamed(h: Column) -> Column:
    return F.exists(F.map_values(h), lambda v: v.contains("unnamed"))


def _restricted(keep: str) -> Column:
    return F.map_filter("m", lambda k, v: F.array_contains(F.coalesce(keep, F.array().cast("array<int>")), k))


def clean_sheets(cells: DataFrame, noise_regex: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The per-sheet cleaning chain F1 -> F3 -> F4 -> (F4' -> F3' -> F6) -> P1.

    Returns (rows, heads) after cleaning; sheets left empty have no rows.
    The row set is written once, after F1.  Every later rule is decided per
    sheet by a small aggregate over the stored rows (``plan``: one row a
    sheet) and applied in one projection and filter on reading them back."""
    rows, heads = to_rows(cells)
    rows = materialize(drop_noise_rows(rows, noise_regex))
    # F3, and whether the header row is a title ("unnamed" columns): such sheets promote a data row
    plan = (heads.join(kept_columns(rows, heads), SHEET_KEY, "left")
                 .withColumn("h", F.map_filter("h", lambda k, v: F.array_contains("keep", k)))
                 .withColumn("_u", _has_unnamed(F.col("h"))))
    plan = materialize(plan.withColumn("_min", F.when(F.col("_u"), F.greatest(
        F.lit(2), (F.size("h") / 3).cast("int"))).otherwise(F.lit(2))))
    rows = (rows.join(plan.select(*SHEET_KEY, "keep", "_u", "_min"), SHEET_KEY, "left")
                .withColumn("m", _restricted("keep")).where(F.size("m") >= F.coalesce("_min", F.lit(2))))  # F4, F4'
    titled = rows.where("_u").drop("keep", "_u", "_min")
    t_heads = plan.where("_u").select(*SHEET_KEY, "h")
    titled, _ = drop_sparse_columns(titled, t_heads)  # F3'
    promoted_rows, promoted = promote_header(titled)  # F6
    plain = rows.where(F.coalesce("_u", F.lit(False)) == F.lit(False)).drop("keep", "_u", "_min")
    out_heads = (plan.where(~F.col("_u")).select(*SHEET_KEY, "h", F.lit(0).cast("bigint").alias("header_row_idx"))
                     .unionByName(promoted))
    return plain.unionByName(promoted_rows), out_heads


def promote_header(rows: DataFrame, skip_marker: str = "vystaveni objednavok") -> tuple[DataFrame, DataFrame]:
    """the first remaining row becomes the header (skipping one leading
    row that contains ``skip_marker``); rows up to it are dropped.  Two
    partial aggregations per sheet -- no sort of the sheet."""
    first = rows.groupBy(*SHEET_KEY).agg(F.min_by(F.struct("row_idx", "m"), "row_idx").alias("r1"))
    first = first.withColumn("_skip", F.exists(F.map_values("r1.m"), lambda v: v.contains(skip_marker)))
    second = (rows.join(first.where("_skip").select(*SHEET_KEY, F.col("r1.row_idx").alias("_r1")), SHEET_KEY)
                  .where(F.col("row_idx") > F.col("_r1"))
                  .groupBy(*SHEET_KEY).agg(F.min_by(F.struct("row_idx", "m"), "row_idx").alias("r2")))
    hdr = (first.join(second, SHEET_KEY, "left")
                .select(*SHEET_KEY, F.when(F.col("_skip"), F.col("r2")).otherwise(F.col("r1")).alias("hr"))
                .where(F.col("hr").isNotNull()))
    # P1 on the promoted names; a null cell becomes the name 'nan'
    heads = materialize(hdr.select(*SHEET_KEY, F.col("hr.row_idx").alias("header_row_idx"),
                                   F.transform_values("hr.m", lambda k, v: normalise_header(v)).alias("h")))
    data = (rows.join(heads.select(*SHEET_KEY, "header_row_idx"), SHEET_KEY)
                .where(F.col("row_idx") > F.col("header_row_idx")).drop("header_row_idx"))
    return data, heads


def alias_dim(spark) -> DataFrame:
    """(alias_key, canonical, is_alias): whitespace-collapsed alias -> canonical
    name.  Canonical names that are not their own alias map to themselves
    but do not count as a hit that admits the sheet."""
    pairs = [(" ".join(a.split()), c, True) for c, al in rules.ALIASES.items() for a in al]
    pairs += [(c, c, False) for c in rules.CANONICAL if c not in rules.SELF_LISTED]
    pairs = list(dict.fromkeys(pairs))
    return spark.createDataFrame(pairs, "alias_key string, canonical string, is_alias boolean")


def header_columns(heads: DataFrame) -> DataFrame:
    """One row per (sheet, col_idx, header)."""
    return heads.select(*SHEET_KEY, F.explode("h").alias("col_idx", "header"))


def dropped_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Header columns present in ``before`` but not in ``after`` heads."""
    return header_columns(before).join(header_columns(after), SHEET_KEY + ["col_idx"], "left_anti")


def standardise(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """P3 + P4: map headers to canonical names through the alias table
    (broadcast: a fixed list), keep sheets with at least one alias hit, and
    project every row onto the 15 canonical columns (the first non-null value,
    by column, when several headers share a canonical name).  Adds ``cena_s_dph``."""
    spark = rows.sparkSession
    hc = header_columns(heads).withColumn("alias_key", collapse_spaces("header"))
    vat_keys = [" ".join(v.split()) for v in rules.VAT_HEADERS]
    hits = hc.join(F.broadcast(alias_dim(spark)), "alias_key", "inner")
    # canonical -> its columns, once per sheet; a row then looks up each name in one map
    per_sheet = (hits.groupBy(*SHEET_KEY)
                     .agg(*[F.sort_array(F.collect_set(F.when(F.col("canonical") == c, F.col("col_idx")))).alias(f"_i_{c}")
                            for c in rules.CANONICAL],
                          F.max(F.col("is_alias").cast("int")).alias("_hit"),
                          F.max(F.col("alias_key").isin(vat_keys).cast("int")).alias("_vat"))
                     .where(F.col("_hit") == 1).drop("_hit"))
    joined = rows.join(per_sheet, SHEET_KEY, "inner")

    def value_of(canonical: str) -> Column:
        idx = F.col(f"_i_{canonical}")
        first = F.try_element_at(F.col("m"), F.try_element_at(idx, F.lit(1)))
        others = F.filter(F.transform(idx, lambda i: F.try_element_at(F.col("m"), i)), lambda v: v.isNotNull())
        return F.when(first.isNotNull() | (F.size(idx) < 2), first).otherwise(F.try_element_at(others, F.lit(1)))

    return joined.select(*SHEET_KEY, "row_idx", *[value_of(c).alias(c) for c in rules.CANONICAL],
                         F.when(F.col("_vat") == 1, F.lit("ano")).otherwise(F.lit("nie")).alias("cena_s_dph"))


def header_census(heads: DataFrame) -> DataFrame:
    """A5: per sheet, its sorted distinct headers joined by '|'."""
    return (header_columns(heads).groupBy(*SHEET_KEY)
            .agg(F.array_join(F.sort_array(F.collect_set("header")), "|").alias("headers")))


def distinct_headers(heads: DataFrame) -> DataFrame:
    """A5: the overall distinct header set."""
    return header_columns(heads).select("header").distinct()
