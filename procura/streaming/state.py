"""Small tables kept beside a stored table so that a load reads no history:
key digests (J4 / W3) and the last marks of each source (A1).

*Digests.*  One row per stored row: its source (a folder) and the 128-bit digest of its
key.  A batch is compared with the digests of its own sources only; a hit is confirmed on
the whole key, read from the stored rows of the hit sources.  Digests are written before
the rows: after a failure between the two, a hit without a stored row is not confirmed and
the row is stored by the next run.

*Marks.*  One row per source, written as a new version by each append and merged with the
version before it; readers take the last version that was written whole.  A version that is
missing after a failure only means that attachments are selected again, whose rows are
known by their digests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.operators.dedupe import ROW_KEYS
from procura.operators.incremental import high_water_marks

SOURCE = "objednavatel"
#: versions of the marks that are kept for readers that have begun
KEPT_VERSIONS = 3
#: rows of a batch that one task sorts by their keys, about
ROWS_A_TASK = 50_000


def digests_path(table_path: str) -> str:
    return table_path.rstrip("/") + "-digests"


def marks_path(table_path: str) -> str:
    return table_path.rstrip("/") + "-marks"


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The stored table, or None where nothing is stored yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet
            return None
        raise


def key_digest(keys=ROW_KEYS) -> Column:
    """128 bits of a key; null and any text are told apart."""
    return F.unhex(F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).cast("binary")))


def _same(a: DataFrame, b: DataFrame, keys) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _of_sources(sources: list) -> Column:
    """Rows of these sources; the condition prunes folders."""
    named = F.col(SOURCE).isin([x for x in sources if x is not None])
    return named | F.col(SOURCE).isNull() if None in sources else named


def known_digests(spark: SparkSession, table_path: str, sources: list) -> DataFrame | None:
    """Digests of the stored rows of ``sources``: other folders are not read."""
    found = read_or_none(spark, digests_path(table_path), f"digest binary, {SOURCE} string")
    return None if found is None else found.where(_of_sources(sources)).select("digest")


def unseen_rows(rows: DataFrame, table_path: str, keys=ROW_KEYS) -> DataFrame:
    """The rows of ``rows`` (a stored batch: it is read several times) whose key
    is not stored for their source, one row per key.  Adds ``digest``."""
    spark = rows.sparkSession
    keys = list(dict.fromkeys([SOURCE, *keys]))
    # dealt out first: the rows are sorted by their keys in partitions of bounded size, and
    # not in whole splits of the input
    tasks = max(1, -(-rows.count() // ROWS_A_TASK))
    exact = [k for k in keys if dict(rows.dtypes)[k] not in ("double", "float")]  # others are normalised, and dealt anew
    batch = rows.withColumn("digest", key_digest(keys)).repartition(tasks, *exact).dropDuplicates(keys)
    # sources: a fixed list in the registry
    sources = [r[0] for r in rows.select(SOURCE).distinct().collect()]
    known = known_digests(spark, table_path, sources)
    stored = read_or_none(spark, table_path, rows.schema)
    if known is None or stored is None:
        return batch
    hits = batch.join(known, "digest", "left_semi")
    hit_sources = [r[0] for r in hits.select(SOURCE).distinct().collect()]
    if not hit_sources:
        return batch
    # the whole key decides: stored rows of the hit sources, cut down to the digests that were hit
    old = stored.where(_of_sources(hit_sources)).select(*keys).withColumn("digest", key_digest(keys))
    old = old.join(hits.select("digest"), "digest", "left_semi")
    return batch.join(old, (batch["digest"] == old["digest"]) & _same(batch, old, keys), "left_anti")


def append_digests(rows: DataFrame, table_path: str) -> None:
    """``rows``: with ``digest``."""
    (rows.select(SOURCE, "digest").hint("rebalance", SOURCE).write.mode("append").partitionBy(SOURCE)
         .parquet(digests_path(table_path)))


def _versions(spark: SparkSession, table_path: str) -> list[int]:
    """Versions of the marks that were written whole, oldest first."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(marks_path(table_path))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    whole = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in whole if n.startswith("version="))


def read_marks(spark: SparkSession, table_path: str) -> DataFrame | None:
    """A1: (objednavatel, last_update, last_datum) as of the last append."""
    versions = _versions(spark, table_path)
    return spark.read.parquet(f"{marks_path(table_path)}/version={versions[-1]}") if versions else None


def merge_marks(rows: DataFrame, table_path: str) -> None:
    """The marks of the appended ``rows`` and of all before them, as a new version."""
    spark = rows.sparkSession
    versions = _versions(spark, table_path)
    marks = high_water_marks(rows)
    if versions:
        before = spark.read.schema(marks.schema).parquet(f"{marks_path(table_path)}/version={versions[-1]}")
        marks = marks.unionByName(before).groupBy(SOURCE).agg(F.max("last_update").alias("last_update"),
                                                              F.max("last_datum").alias("last_datum"))
    # a folder of a failed write is written over
    new = (versions[-1] if versions else 0) + 1
    marks.coalesce(1).write.mode("overwrite").parquet(f"{marks_path(table_path)}/version={new}")
    jvm = spark.sparkContext._jvm
    for old in versions[:-KEPT_VERSIONS]:
        path = jvm.org.apache.hadoop.fs.Path(f"{marks_path(table_path)}/version={old}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
