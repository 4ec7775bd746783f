"""Stored tables that a search does not read whole.

*Keywords.*  Beside the table lies a sketch: which three-character pieces the texts of
each file hold, sorted by piece, so that a search reads a few row groups of it.  A file
without one of the keyword's pieces cannot hold the keyword and is not opened.  Rows are
stored in the order of their texts, which keeps like texts in few files.

*Equality.*  The columns named in ``equal`` get Parquet Bloom filters; a row group whose
filter excludes the value is skipped by the scan itself.

A file counts as sketched only once a second write, after its pieces, has named it; any
other file of the table is read by every search.  A load that fails half way so costs
time, never rows."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.sources.sinks import stringify_complex
from procura.streaming.state import read_or_none

#: rows in a file; files are what a search skips
FILE_ROWS = 1_000_000
#: pieces that a task holds before it hands them on
PIECES_HELD = 500_000
SKETCH = "column string, piece string, file string"


def sketch_path(table_path: str) -> str:
    return table_path.rstrip("/") + "-pieces"


def append_searchable(df: DataFrame, path: str, texts: tuple[str, ...], equal: tuple[str, ...] = (),
                      partition_by: str = "objednavatel", file_rows: int = FILE_ROWS) -> None:
    """Append ``df``, in the order of the first of ``texts`` within a source, and sketch
    what has no sketch yet.  A text that many rows share is dealt out by a hash."""
    order = [partition_by, texts[0]]
    df = stringify_complex(df)
    out = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    writer = out.write.mode("append").option("maxRecordsPerFile", file_rows)
    for c in equal:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True).option(f"parquet.bloom.filter.adaptive.enabled#{c}", True)
    writer.partitionBy(partition_by).parquet(path)
    sketch(df.sparkSession, path, texts)


def _listed(table: DataFrame) -> set[str]:
    """The table's files as ``_metadata.file_path`` names them: no empty authority."""
    return {re.sub(r"^(\w+):///", r"\1:/", f) for f in table.inputFiles()}


def _pieces(batches):
    """Distinct (piece, file) of a task's rows (file, text as UTF-8): every run of three
    characters, overlapping ones too.  They are cut up here, not exploded to rows."""
    held: dict[str, set[str]] = {}

    def flush():
        for file, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([file] * len(found), pa.string())], names=["piece", "file"])
        held.clear()

    for batch in batches:
        last = None
        for file, text in zip(batch.column("file").to_pylist(), batch.column("text").to_pylist()):
            if (file, text) != last:
                last, t = (file, text), text.decode("utf-8", "replace")
                held.setdefault(file, set()).update(map("".join, zip(t, t[1:], t[2:])))
        if sum(map(len, held.values())) > PIECES_HELD:
            yield from flush()
    yield from flush()


def sketch(spark: SparkSession, path: str, texts: tuple[str, ...]) -> None:
    """Sketch the files of the table that have no sketch of these columns."""
    stored = read_or_none(spark, path)
    for c in texts if stored is not None else ():
        new = sorted(_listed(stored) - _sketched(spark, path, c))
        if not new:
            continue
        rows = stored.where(F.col("_metadata.file_path").isin(new)).select(F.col("_metadata.file_path").alias("file"), F.col(c).alias("text"))
        found = rows.where("text IS NOT NULL").select("file", F.col("text").cast("binary").alias("text"))
        pieces = found.mapInArrow(_pieces, "piece string, file string").distinct().select(F.lit(c).alias("column"), "piece", "file")
        (pieces.repartitionByRange("column", "piece", "file").sortWithinPartitions("column", "piece")
               .write.mode("append").parquet(sketch_path(path)))
        named = rows.select(F.lit(c).alias("column"), F.lit("").alias("piece"), "file").distinct()
        named.write.mode("append").parquet(sketch_path(path))


def _sketched(spark: SparkSession, path: str, column: str) -> set[str]:
    """Names of the files with a sketch: no more than the table's own listing has."""
    found = read_or_none(spark, sketch_path(path), SKETCH)
    of = F.col("column") == column
    return set() if found is None else {r[0] for r in found.where(of & (F.col("piece") == "")).select("file").distinct().collect()}


def keyword_pieces(keyword: str, mode: str = "like") -> set[str]:
    """Pieces that any text with the keyword holds (modes as in ``search.keyword_filter``).
    None of them for a mode that folds characters: a text need not hold the keyword's own."""
    runs = [keyword] if mode == "literal" else [""]
    # a bare wildcard ends a run, an escaped one is a character of it
    for escaped, wild, other in re.findall(r"(?s)\\([\\%_])|([%_])|(.)", keyword) if mode == "like" else ():
        if wild:
            runs.append("")
        else:
            runs[-1] += escaped or other
    return {r[i:i + 3] for r in runs for i in range(len(r) - 2)}


def may_hold(spark: SparkSession, path: str, column: str, keyword: str, mode: str = "like") -> DataFrame:
    """The stored table without files that cannot hold the keyword in ``column``; the
    filter itself is still to be applied.  Keywords without three characters in a row,
    columns without a sketch and modes that fold characters exclude nothing."""
    table = spark.read.parquet(path)
    pieces = keyword_pieces(keyword, mode)
    sketched = _sketched(spark, path, column) if pieces else set()
    if not sketched:
        return table
    known = spark.read.schema(SKETCH).parquet(sketch_path(path))
    of = known.where((F.col("column") == column) & F.col("piece").isin(sorted(pieces)))
    hits = of.groupBy("file").agg(F.count_distinct("piece").alias("n")).where(F.col("n") == len(pieces))
    listed = _listed(table)
    wanted = (listed - sketched) | (listed & {r[0] for r in hits.select("file").collect()})
    if wanted == listed:
        return table
    return table.where(F.col("_metadata.file_path").isin(sorted(wanted)) if wanted else F.lit(False))
