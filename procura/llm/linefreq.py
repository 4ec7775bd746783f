"""Quality rules with cross-document line frequency.

Normalised lines are hashed and the documents that hold them counted per host;
lines above the limit are removed, and a document that keeps too little is
rejected.  Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.llm.common import SPACE, WORD, stored, word_count

MIN_WORDS = 50
#: a line is removed when more than this many documents of the host hold it, whatever the host's size
MAX_HOLDERS = 100
#: a document that keeps a smaller share of its words is rejected
MIN_LEFT = 0.3


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), SPACE, " "))


def _sorted_windows(words: Column) -> Column:
    """Hash and place of each window of three words, sorted: equal windows
    become neighbours."""
    n = F.size(words)
    windows = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(
        F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")))
    return F.sort_array(windows)


def _flagged(s: Column) -> Column:
    """Places of the windows whose neighbour in the sorted list is equal."""
    hit = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    return F.sort_array(F.transform(hit, lambda x: x["at"]))


def _covered(at: Column) -> Column:
    """Words covered by windows of three that start at the sorted places."""
    gaps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long")


def features(docs: DataFrame, host: str) -> DataFrame:
    """One row per row of ``docs``: a row number, doc_id, host, the measured
    rules, and per distinct normalised line its hash and words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.col(host).alias("_host"),
                    text.alias("_text"), F.filter(F.split(text, SPACE), lambda w: w != "").alias("_words"),
                    F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))).alias("_lines"))
    d = d.withColumn("_sorted", _sorted_windows(F.col("_words"))).withColumn("_at", _flagged(F.col("_sorted")))
    lines = F.transform(F.col("_lines"), lambda x: F.struct(
        F.xxhash64(normalised(x)).alias("h"), word_count(x).alias("n")))
    stripped = F.regexp_replace("_text", SPACE, "")
    return d.select("_row", "doc_id", "_host", F.size("_words").cast("long").alias("n_words"),
                    F.char_length(stripped).cast("long").alias("word_chars"),
                    (F.char_length("_text") - F.char_length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                    (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                    _covered(F.col("_at")).alias("n_repeat_words"), lines.alias("_hashes"))


def line_rules(docs: DataFrame, host: str, min_words: int = MIN_WORDS, max_holders: int = MAX_HOLDERS,
               min_left: float = MIN_LEFT) -> DataFrame:
    """Per row of ``docs``: doc_id, the measured rules, base_failed, n_left_words
    (words outside the removed lines) and kept.

    A line of a host is removed when more than max_holders of the host's documents
    hold it: as many in a hot host as in a cold one.  kept is false where
    base_failed, or where fewer than min_words words or less than min_left of
    the words remain.  Null text: no words, base_failed.  Null host: a host of
    its own.  Each row counts as a document, also where rows are equal.  Other
    columns are ignored; empty input gives no rows."""
    d = stored(features(docs, host), "lines")
    seen = d.select("_host", F.explode(F.array_distinct(F.transform("_hashes", lambda x: x["h"]))).alias("h"))
    often = seen.groupBy("_host", "h").agg(F.count("*").alias("_holders")).filter(F.col("_holders") > max_holders)
    often = stored(often.select(F.col("_host").alias("_of"), F.col("h").alias("_h")), "often")
    lines = d.select("_row", "_host", F.explode("_hashes").alias("x"))
    removed = lines.join(often, lines["_host"].eqNullSafe(often["_of"]) & (F.col("x.h") == often["_h"])).groupBy(
        F.col("_row").alias("_r")).agg(F.sum("x.n").alias("_removed"))
    d = d.join(removed, d["_row"] == removed["_r"], "left")
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), left.alias("n_left_words"),
                    (~failed & (left >= min_words) & (left >= F.lit(min_left) * F.col("n_words"))).alias("kept"))
