"""Source registry: load (S11), overrides (S12), lookup."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import rules
from procura.functions.text import clean_string

LINK_ATTR = "zverejnovanie_objednavok_faktur_rozne"


def registry_key_of(source: Column) -> Column:
    """Source code -> cleaned registry key (fixed mapping, a literal map)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in rules.REGISTRY_KEY.items()))
    return F.try_element_at(m, source)


def registry_dim(raw: DataFrame) -> DataFrame:
    """Clean the full name, drop ',' and '.', index by it; the last
    entry (highest ``seq``) of a duplicated key wins.  Partial aggregation,
    no window: one small row per key reaches the shuffle per task."""
    key = F.regexp_replace(clean_string("Nazov_full"), r"[,.]", "")
    latest = F.max_by(F.struct(F.col("Nazov_full").alias("nazov"), "attributes", "seq"), "seq")
    return (raw.groupBy(key.alias("key")).agg(latest.alias("e"))
               .select("key", "e.nazov", "e.attributes", "e.seq"))


def apply_overrides(dim: DataFrame, overrides: DataFrame) -> DataFrame:
    """``overrides(key, attr, value, replace_all)``.  ``replace_all``
    rows replace the whole entry of their key (keys may be new); the others
    patch single attributes, last override wins over the base value."""
    base = dim.select("key", F.explode_outer("attributes").alias("attr", "value"), F.lit(0).alias("prio"))
    replaced = overrides.where("replace_all").select("key").distinct()
    base = base.join(replaced, "key", "left_anti")
    ov = overrides.select("key", "attr", "value", F.lit(1).alias("prio"))
    merged = (base.unionByName(ov).groupBy("key", "attr")
                  .agg(F.max_by("value", "prio").alias("value")))
    return (merged.groupBy("key")
                  .agg(F.map_from_entries(F.sort_array(F.filter(F.collect_list(F.struct("attr", "value")),
                                                           lambda e: e["attr"].isNotNull())))
                       .alias("attributes")))


def apply_override_log(dim: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S12 in order: ``log(seq, key, attr, value, replace_all)``.  The last
    replacement of a key is a barrier: the base entry and all before it are gone, its
    own attributes (rows of its ``seq``) and later patches stay, and of each attribute
    the last value counts.  A patch of a key that is neither in ``dim`` nor replaced
    before it creates nothing.

    Returns (entries: key, attributes; errors: the log rows without an entry, with
    ``error``)."""
    known = dim.select("key").distinct().withColumn("_known", F.lit(True))
    barriers = log.where("replace_all").groupBy("key").agg(F.min("seq").alias("_first"), F.max("seq").alias("_last"))
    log = log.join(barriers, "key", "left").join(known, "key", "left")
    lost = F.col("_known").isNull() & (F.col("_first").isNull() | (F.col("seq") < F.col("_first")))
    errors = log.where(lost).select("seq", "key", "attr", "value", "replace_all", F.lit("override:unknown_key").alias("error"))
    kept = log.where(~lost & (F.col("_last").isNull() | (F.col("seq") >= F.col("_last")))).select("key", "attr", "value", "seq")
    # the base entry comes before the log
    base = dim.join(barriers.select("key"), "key", "left_anti").select("key", F.explode_outer("attributes").alias("attr", "value"),
                                                                       F.lit(None).cast("long").alias("seq"))
    order = F.struct(F.col("seq").isNotNull(), "seq")
    merged = base.unionByName(kept.withColumn("seq", F.col("seq").cast("long"))).groupBy("key", "attr").agg(F.max_by("value", order).alias("value"))
    entries = (merged.groupBy("key").agg(F.map_from_entries(F.sort_array(F.filter(
        F.collect_list(F.struct("attr", "value")), lambda e: e["attr"].isNotNull()))).alias("attributes")))
    return entries, errors


def registered_overrides(spark) -> DataFrame:
    """The entries that the configuration adds to the registry, in its order."""
    rows = [(i, key, attr, value, whole) for i, (key, attr, value, whole) in enumerate(rules.REGISTRY_OVERRIDES)]
    return spark.createDataFrame(rows, "seq long, key string, attr string, value string, replace_all boolean")


def lookup_link(df: DataFrame, dim: DataFrame, source_col: str = "objednavatel",
                attr: str = LINK_ATTR) -> DataFrame:
    """Attach ``link`` (registry attribute of the source's key) and a
    ``link_error`` for sources without an entry.  The dimension holds one row
    per registry key -- bounded by the configured sources -- so it is
    broadcast."""
    links = dim.select(F.col("key").alias("_rk"), F.col("attributes")[attr].alias("link"))
    out = (df.withColumn("_rk", registry_key_of(F.col(source_col)))
             .join(F.broadcast(links), "_rk", "left"))
    return (out.withColumn("link_error", F.when(F.col("link").isNull(), F.lit("link:unknown_source")))
               .drop("_rk"))
