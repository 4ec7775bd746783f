"""Mail sources (E1): marks -> attachment selection -> files -> cells -> clean
sheets -> standardise -> distinct -> F7 -> price and date cleaning -> packed
final rows -> rows not stored yet -> append -> archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.functions import rules
from procura.operators import cells as C
from procura.operators import incremental
from procura.plans import cleaning as P
from procura.session import materialize
from procura.sources import files, sinks
from procura.streaming import ingest, state

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


#: what a quarantined row keeps of its text, to be cleaned again
RAW = list(dict.fromkeys([*rules.CANONICAL, "file", "insert_date", "cena_s_dph", "objednavatel"]))


def raw_rows(cells: DataFrame, insert_date: Column | None = None) -> DataFrame:
    """Cells to standardised rows of text."""
    rows, heads = C.clean_sheets(cells)
    std = (C.standardise(rows, heads)
             .withColumn("objednavatel", F.col("source"))
             .withColumn("insert_date", F.localtimestamp() if insert_date is None else insert_date)
             .drop("row_idx", "source")
             .distinct()  # within a sheet: equal rows of two sheets both stay
             .drop("sheet"))
    return P.drop_all_null_keys(std)


def sheet_rows(cells: DataFrame, dim: DataFrame, insert_date: Column | None = None, keep_errors: bool = True) -> DataFrame:
    """Cells to final rows; ``insert_date`` is the load time (default: now)."""
    return P.final_rows(P.clean_orders(raw_rows(cells, insert_date)), dim, keep_errors=keep_errors)


def with_raw(std: DataFrame, dim: DataFrame) -> DataFrame:
    """Final rows with ``_errors`` and, in ``_raw``, the text they come from."""
    std = std.withColumn("_raw", F.to_json(F.struct(*RAW)))
    return P.final_rows(P.clean_orders(std), dim, extra=["_raw"])


def divert_errors(rows: DataFrame, quarantine: str) -> DataFrame:
    """The rows of ``with_raw`` (stored: they are read twice) without errors; the
    others are written to ``quarantine`` and nowhere else."""
    sinks.write_quarantine(rows, quarantine)
    return rows.where(F.size("_errors") == 0).drop("_errors", "_raw")


def replay_quarantine(spark: SparkSession, quarantine: str, table_path: str, dim: DataFrame, repair) -> DataFrame:
    """Cleans the quarantined rows again after ``repair`` (``DataFrame -> DataFrame``
    over the rows of text: what a changed rule or a correction does).  Rows without an
    error now are appended to the table and leave the quarantine, the others stay.

    Exactly once: the append knows stored keys by their digests, and what was replayed
    is listed beside the quarantine after the append, so a run that fails in between
    is repeated without a second row.  Returns the appended rows."""
    held, done = state.read_or_none(spark, quarantine), state.read_or_none(spark, quarantine.rstrip("/") + "-replayed")
    schema = ", ".join(f"`{c}` {'timestamp_ntz' if c == 'insert_date' else 'string'}" for c in RAW)
    if held is None:
        return P.final_rows(P.clean_orders(spark.createDataFrame([], schema)), dim, keep_errors=False)
    held = held.select("_raw").distinct()
    if done is not None:
        held = held.join(done.select("_raw").distinct(), "_raw", "left_anti")
    std = held.select("_raw", F.from_json("_raw", schema).alias("r")).select("_raw", "r.*")
    again = materialize(P.final_rows(P.clean_orders(repair(std)), dim, extra=["_raw"]))
    good = again.where(F.size("_errors") == 0)
    new = ingest.append_new(good.drop("_errors", "_raw"), table_path)
    good.select("_raw").write.mode("append").parquet(quarantine.rstrip("/") + "-replayed")
    return new


def still_quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """The quarantined rows that no replay has taken."""
    held, done = spark.read.parquet(quarantine), state.read_or_none(spark, quarantine.rstrip("/") + "-replayed")
    return held if done is None else held.join(done.select("_raw").distinct(), "_raw", "left_anti")


def selected(spark: SparkSession, messages: DataFrame, table_path: str) -> DataFrame:
    """A1 + S2: attachments newer than the last load of their source.  The marks
    are kept by the appends: no stored row is read."""
    marks = state.read_marks(spark, table_path)
    if marks is None:
        marks = spark.createDataFrame([], "source string, last_update timestamp_ntz")
    else:
        marks = marks.select(F.col("objednavatel").alias("source"), "last_update")
    return incremental.select_attachments(messages, marks)


def load_attachments(spark: SparkSession, inbox: str, table_path: str, checkpoint: str, dim: DataFrame,
                     insert_date: Column | None = None, archive: str | None = None, failures: str | None = None,
                     files_per_batch: int = 2000, quarantine: str | None = None) -> None:
    """S1 .. S13 for the files saved in ``inbox``: every unseen file once, new
    rows appended, unreadable files listed under ``failures``, read ones
    moved to ``archive``.  With ``quarantine``, rows with errors go there with their
    text (see ``replay_quarantine``) and not into the table."""
    def transform(batch: DataFrame) -> DataFrame:
        # parsed once: the failed files, the header rows and the rows read the cells
        good, failed = files.whole_files(materialize(files.attachment_cells(batch)))
        if failures:
            failed.write.mode("append").parquet(failures)
        if quarantine:
            return divert_errors(materialize(with_raw(raw_rows(good, insert_date), dim)), quarantine)
        return sheet_rows(good, dim, insert_date, keep_errors=False)

    ingest.ingest(spark, inbox, BINARY_FILE, table_path, checkpoint, transform, archive=archive,
                  files_per_batch=files_per_batch, source_format="binaryFile")
