"""Attachment files to long cells (S1): CSV, JSON and Parquet, by Spark's readers.

Files are read by splits (see ``delimited``; Parquet by row groups), so that one large
file uses all cores.  A file that cannot be read is listed with a reason instead of
ending the job, and leaves no cells.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from procura.sources.delimited import _escaped, _split_starts, csv_rows, file_path, json_rows, one_name

CELL_SCHEMA = ("source string, file string, sheet string, row_idx bigint, col_idx int, value string, "
               "file_error string")
FORMATS = ("csv", "json", "parquet")


def _places(paths: list[str]) -> list[tuple[str, str, str, str]]:
    """(path, source, file, sheet): the folders ``source=`` and ``file=`` where the
    path has them, else its last two parts.  Files of one source and name are told
    apart by their sheet."""
    seen, out = Counter(), []
    for p in paths:
        parts = p.split("/")
        named = dict(x.split("=", 1) for x in parts[:-1] if x.startswith(("source=", "file=")))
        place = named.get("source") or parts[-2], named.get("file") or parts[-1]
        out.append((p, *place, str(seen[place])))
        seen[place] += 1
    return out


def _as_text(name: str, kind) -> Column:
    """Cell text; structures are JSON."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.to_json(c)
    return F.base64(c) if isinstance(kind, BinaryType) else c.cast("string")


def parquet_rows(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """(rows, failed) as ``csv_rows``.  Files of one schema are read together; a
    file is whole when as many rows are read as its footer tells."""
    by_schema, bad = defaultdict(list), []
    for p in paths:
        try:
            by_schema[spark.read.parquet(_escaped(p)).schema.json()].append(p)
        except PySparkException:
            bad.append((p, "file:no_parquet"))
        except Exception as e:  # noqa: BLE001  an unreadable footer, whatever the JVM calls it
            bad.append((p, f"file:{type(e).__name__}"))
    rows = None
    for text, group in by_schema.items():
        schema = StructType.fromJson(json.loads(text))
        read = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*[_escaped(p) for p in group])
        cells = read.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"),
                            F.array(*[_as_text(f.name, f.dataType) for f in schema.fields]).alias("fields"),
                            F.monotonically_increasing_id().alias("id"))
        splits = cells.groupBy("path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        starts = _split_starts(splits.select("path", "block", "first", F.array(F.lit(False), F.lit(False)).alias("end"),
                                             F.array("n", "n").alias("rows")))
        starts = F.broadcast(spark.createDataFrame(starts.collect(), starts.schema))
        body = cells.join(starts, ["path", "block"]).select(
            "path", (F.col("before") + F.col("id") - F.col("first") + 1).alias("row_idx"), "fields")
        names = spark.createDataFrame([(p,) for p in group], "path string").select(
            "path", F.lit(0).cast("long").alias("row_idx"), F.array(*[F.lit(n) for n in schema.names]).alias("fields"))
        both = names.unionByName(body)
        rows = both if rows is None else rows.unionByName(both)
    return rows, spark.createDataFrame(bad, "path string, reason string")


def attachment_cells(files: DataFrame) -> DataFrame:
    """``files`` (rows with ``path``, as of ``binaryFile``, whose content is not
    read) of the known formats to cells.  A file that could not be read whole has
    a row with its ``file_error`` (see ``whole_files``).

    ``files`` is one batch (``files_per_batch`` of the ingest): its names, and one
    row for each split of its files, are at the driver."""
    spark = files.sparkSession
    by_format, known = defaultdict(list), []
    for path in sorted({one_name(r["path"]) for r in files.select("path").collect()}):
        ext = path.rsplit(".", 1)[-1].lower()
        if ext in FORMATS:
            by_format[ext].append(path)
            known.append(path)
    readers = {"csv": csv_rows, "json": json_rows, "parquet": parquet_rows}
    out = spark.createDataFrame([], CELL_SCHEMA)
    if known:
        places = F.broadcast(spark.createDataFrame(_places(known), "path string, source string, file string, sheet string"))
    for ext, paths in sorted(by_format.items()):
        rows, failed = readers[ext](spark, paths)
        if rows is not None:
            cells = rows.select("path", "row_idx", F.posexplode("fields").alias("col_idx", "value"))
            out = out.unionByName(cells.join(places, "path").select(
                "source", "file", "sheet", "row_idx", "col_idx", F.nullif("value", F.lit("")).alias("value"),
                F.lit(None).cast("string").alias("file_error")))
        out = out.unionByName(failed.join(places, "path").select("source", "file", "sheet", F.col("reason").alias("file_error")),
                              allowMissingColumns=True)
    return out


def whole_files(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of the files that were read whole, failed files with the reason)."""
    failed = cells.where(F.col("file_error").isNotNull()).select("source", "file", "sheet", "file_error")
    good = cells.where(F.col("file_error").isNull()).drop("file_error")
    sheet = ["source", "file", "sheet"]
    return good.join(failed.select(*sheet), sheet, "left_anti"), failed.drop("sheet")
