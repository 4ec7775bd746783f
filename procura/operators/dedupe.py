"""Row / column de-duplication and keyed merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUPE_KEYS = ["popis", "cena", "datum", "dodavatel"]
#: across sources the source belongs to the key
ROW_KEYS = ["objednavatel", *DEDUPE_KEYS]


def symmetric_unique(new: DataFrame, stored: DataFrame, keys=DEDUPE_KEYS) -> DataFrame:
    """J3 (reference form): union both sides and keep rows whose key occurs
    exactly once; nulls compare equal.  Unmatched stored rows survive and a
    key repeated inside ``new`` vanishes.  A key that occurs once needs no
    join back: one aggregate counts it and carries a row of it, combined on
    each task first, so a hot key reaches the shuffle as one row per task."""
    both = new.unionByName(stored, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    once = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_r")).where("_n = 1")
    return once.select(*[c if c in keys else F.col("_r")[c].alias(c) for c in both.columns])


def new_rows_anti(new: DataFrame, stored: DataFrame, keys=ROW_KEYS) -> DataFrame:
    """J4 (evident intent): rows of ``new`` whose key is not stored for their
    source (null-safe equality), one row per key."""
    cond = reduce(lambda a, b: a & b, [new[k].eqNullSafe(stored[k]) for k in keys])
    return new.join(stored.select(*keys), cond, "left_anti").dropDuplicates(keys)


def distinct_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop duplicate rows (nulls equal)."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def upsert_latest(base: DataFrame, changes: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """S7 re-aimed as upsert: union and keep the highest ``version`` per key;
    a null version is the lowest, equal versions go by a hash of the row.
    ``max_by`` aggregates partially per task, so a hot key is combined
    map-side instead of being sorted in one partition."""
    cols = [c for c in base.columns if c not in keys]
    u = base.unionByName(changes, allowMissingColumns=True)
    latest = u.groupBy(*keys).agg(F.max_by(
        F.struct(*cols), F.struct(F.col(version), F.xxhash64(F.to_json(F.struct(*cols))))).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def union_missing(*frames: DataFrame) -> DataFrame:
    """Union by name, missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def duplicate_columns(df: DataFrame) -> list[str]:
    """P11 helper: names of columns equal (null-safe) in every row to an
    earlier column.  One aggregate over all column pairs; only the flag row
    (one boolean per pair) reaches the driver."""
    cols = df.columns
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]
             if df.schema[a].dataType == df.schema[b].dataType]
    if not pairs:
        return []
    flags = df.agg(*[F.bool_and(F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"p{i}")
                     for i, (a, b) in enumerate(pairs)]).first()
    dup = []
    for i, (a, b) in enumerate(pairs):
        if flags[f"p{i}"] is not False and b not in dup and a not in dup:
            dup.append(b)
    return dup


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that are equal in every row."""
    return df.drop(*duplicate_columns(df))
