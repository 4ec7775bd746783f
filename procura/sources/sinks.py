"""Sources and sinks: file manifest (S1), append (S6), upsert (S7), snapshot (S8), CSV
export (S9), bounded chunks (S10).  Every path lives under the shared
checkpoint folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from procura.functions import rules
from procura.operators import dedupe
from procura.session import materialize, scratch_path  # noqa: F401  (scratch_path: re-export)
from procura.streaming import state


def source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Route files by their last extension.  Only path metadata is read
    (the binary content column is pruned away)."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.element_at(F.split(name, r"\."), -1)
    action = (F.when(ext.isin(list(rules.SKIP_EXTENSIONS)), F.lit("skip"))
               .when(ext.isin(list(rules.MANUAL_EXTENSIONS)), F.lit("manual"))
               .when(ext.isin(list(rules.SPREADSHEET_EXTENSIONS)), F.lit("spreadsheet"))
               .when(ext.isin(list(rules.CONVERT_EXTENSIONS)), F.lit("convert"))
               .otherwise(F.lit("load")))
    return files.select(name.alias("file"), ext.alias("ext"), action.alias("action"), "length")


def stringify_complex(df: DataFrame) -> DataFrame:
    """Dictionary-like columns are stored as JSON text."""
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, (MapType, StructType))})


def append_table(df: DataFrame, path: str, partition_by: str | None = "objednavatel") -> None:
    """Append (always; no index column), partitioned by source so a
    source lookup prunes files.  Rows are rebalanced by source first (large
    sources are split), so that tasks do not write a file for each source."""
    out = stringify_complex(df)
    if not partition_by:
        return out.write.mode("append").parquet(path)
    out.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)


def upsert_table(changes: DataFrame, path: str, keys: list[str], version: str = "version",
                 partition_by: str = "objednavatel") -> list:
    """S7 on a stored table: ``changes`` (one or more versions a key) are merged by
    ``dedupe.upsert_latest``.  Only folders in which a row changes are written: the
    merged rows are staged first, then they replace these folders (dynamic partition
    overwrite); a job that fails before leaves the table as it was.  Changes that are
    stored already, or superseded, write nothing.  ``partition_by`` is one of the keys.
    Returns the folders written."""
    if partition_by not in keys:
        raise ValueError("a row must not move between folders: the partition column belongs to the keys")
    spark = changes.sparkSession
    new = materialize(dedupe.upsert_latest(changes.limit(0), changes, keys, version))
    stored = state.read_or_none(spark, path)
    if stored is None:
        new.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
        return sorted((r[0] for r in new.select(partition_by).distinct().collect()), key=str)
    kind = dict(changes.dtypes)[partition_by]
    stored = stored.withColumn(partition_by, F.col(partition_by).cast(kind))

    def of(frame: DataFrame, values: list) -> DataFrame:
        c = F.col(partition_by)
        found = c.isin([v for v in values if v is not None])
        return frame.where(found | c.isNull() if None in values else found)

    # what the changes alter: the rows they touch, before and after
    touched = of(stored, [r[0] for r in new.select(partition_by).distinct().collect()])
    same = lambda a, b, cols: reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])
    before = touched.join(new.select(*keys), same(touched, new, keys), "left_semi").select(*changes.columns)
    after = dedupe.upsert_latest(before, new, keys, version)
    altered = after.join(before, same(after, before, changes.columns), "left_anti")
    written = sorted((r[0] for r in altered.select(partition_by).distinct().collect()), key=str)
    if written:
        merged = dedupe.upsert_latest(of(stored, written).select(*changes.columns), of(new, written), keys, version)
        staged = materialize(merged)
        (staged.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(partition_by).parquet(path))
    return written


def write_quarantine(df: DataFrame, path: str) -> None:
    """Rows with a reason in ``_errors``, whole and apart from the table, for
    later correction; partitioned by source like the table."""
    df.where(F.size("_errors") > 0).hint("rebalance", "objednavatel").write.mode("append") \
      .partitionBy("objednavatel").parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a snapshot to a new path (never over the path being read)."""
    df.write.mode("errorifexists").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header.  Only for bounded results (the
    search returns at most 1000 rows), hence the single partition.  Quotes
    inside fields are doubled, as CSV readers expect."""
    df.coalesce(1).write.option("header", True).option("escape", '"').mode("errorifexists").csv(path)


def write_chunks(df: DataFrame, path: str, chunk_rows: int = rules.CHUNK_ROWS) -> None:
    """Bounded files of at most ``chunk_rows`` rows, never an empty one."""
    df.write.option("maxRecordsPerFile", chunk_rows).mode("errorifexists").parquet(path)
