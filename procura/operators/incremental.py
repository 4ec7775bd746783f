"""Incremental loading: high-water marks (A1), attachment selection (S2),
paged scan to a mark (S4), incremental predicate (F10), batch status
(F11/A2), history lookup (S5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.functions import rules


def high_water_marks(history: DataFrame, by: str = "objednavatel", ts: str = "insert_date",
                     date: str = "datum") -> DataFrame:
    """A1: per source the last load time (minute precision, as the mail
    filter formats it) and the latest order date (web sources)."""
    return history.groupBy(by).agg(F.date_trunc("minute", F.max(ts)).alias("last_update"),
                                   F.max(date).alias("last_datum"))


def select_attachments(messages: DataFrame, marks: DataFrame, sources=None) -> DataFrame:
    """For every mail source, messages whose sender ends with
    ``source + domain`` received after the source's mark (no mark: all),
    minus image attachments (case-sensitive prefix match); the saved name is
    ``dd_MM_yyyy_hh_mm_ss_<name>`` of the time it was sent (12-hour clock, as the
    source system).

    The suffix test is an equi-join: each message offers its sender's
    suffixes of the few lengths the configured suffixes have, which are
    matched against the (small, fixed) source list by hash join -- no nested
    loop over messages x sources."""
    spark = messages.sparkSession
    names = list(sources or rules.MAIL_DOMAIN)
    suffixes = [(s, s + rules.MAIL_DOMAIN.get(s, ".sk")) for s in names]
    lengths = sorted({len(x) for _, x in suffixes})
    srcs = spark.createDataFrame(suffixes, "source string, suffix string").join(marks, "source", "left")
    used = messages.select("message_id", "sender", "received_at", "sent_on", "attachment")
    cand = used.withColumn("suffix", F.explode(F.array_distinct(F.array(
        *[F.substring(F.col("sender"), -n, n) for n in lengths]))))
    m = cand.join(F.broadcast(srcs), "suffix", "inner")
    m = m.where(F.col("last_update").isNull() | (F.col("received_at") > F.col("last_update")))
    m = m.where(~F.col("attachment").rlike(r"^.*\.(png|jpg)"))
    return m.select("source", "message_id", F.concat(F.date_format("sent_on", "dd_MM_yyyy_hh_mm_ss"),
                                                      F.lit("_"), F.col("attachment")).alias("saved_name"))


def incremental_batch(df: DataFrame, marks: DataFrame, ts: str, by: str = "source") -> DataFrame:
    """rows strictly newer than their source's mark (no mark: all rows)."""
    j = df.join(marks, by, "left")
    return j.where(F.col("last_update").isNull() | (F.col(ts) > F.col("last_update"))).drop("last_update")


def batch_status(df: DataFrame, sources: DataFrame, by: str = "objednavatel") -> DataFrame:
    """Per source the row count and 'ok' / 'no_new_data' (the
    source system raised DataNotAvailable; here it is a status row)."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    return (sources.join(counts, by, "left")
                   .select(by, F.coalesce("rows", F.lit(0)).alias("rows"),
                           F.when(F.coalesce("rows", F.lit(0)) > 0, F.lit("ok")).otherwise(F.lit("no_new_data"))
                           .alias("status")))


def paged_hwm_scan(rows: DataFrame, marks: DataFrame, by: str = "source", page: str = "page",
                   date: str = "datum") -> DataFrame:
    """Pages are read in order while the previous page's latest date is
    at or after the source's mark (page 1 always; an all-null page stops);
    then rows dated before the mark are dropped, null dates kept.  With no
    mark only the first page is read and nothing is dropped.

    The read pages are exactly those up to the first page whose maximum is
    below the mark (that page was read before the check failed), so the
    rule is two aggregates -- page maxima, then the first stopping page per
    source -- with no window and no sort of a source's pages."""
    pm = rows.groupBy(by, page).agg(F.max(date).alias("_pmax")).join(marks, by, "left")
    cont = F.coalesce(F.col("_pmax") >= F.col("hwm"), F.lit(False))
    per_source = pm.groupBy(by).agg(F.min(F.when(~cont, F.col(page))).alias("_stop"),
                                    F.min(page).alias("_first"), F.first("hwm").alias("hwm"))
    out = rows.join(per_source, by, "inner")
    read = F.when(F.col("hwm").isNull(), F.col(page) == F.col("_first")).otherwise(
        F.col("_stop").isNull() | (F.col(page) <= F.col("_stop")))
    keep = F.col(date).isNull() | F.col("hwm").isNull() | (F.col(date) >= F.col("hwm"))
    return out.where(read & keep).drop("_stop", "_first", "hwm")


def history_lookup(history: DataFrame, source: str, datum=None, year=None) -> DataFrame:
    """Whole rows of one source on one date, or whose file name
    contains the year.  Equality on the partition column prunes files."""
    q = history.where(F.col("objednavatel") == F.lit(source))
    if datum is not None:
        q = q.where(F.col("datum") == F.lit(datum).cast("timestamp_ntz"))
    if year is not None:
        q = q.where(F.col("file").contains(str(year)))
    return q
