"""CSV and JSON text files as numbered rows, read by splits.

A file is read as lines by Spark's text source, so one large file is parsed by as many
tasks as it has splits.  Row numbers come from the number of rows of each split and the
sums of them before it; within a split the order of its lines counts.  All passes over
the lines read the same splits, and ``monotonically_increasing_id`` (consecutive within
a task, and a barrier for filters) tells their order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: where a CSV reader is before a character
START, FIELD, QUOTED, CLOSED = range(4)
#: separates the fields of a line with quotes; a noncharacter, never part of text
MARK = "﷐"
#: characters of a row over several lines, at most: a quote that is never closed must not gather a file
ROW_CHARS = 1 << 24
SPLIT = ["path", "block"]


def _escaped(path: str) -> str:
    """A path whose characters are no wildcards."""
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)


def one_name(path: str) -> str:
    """A path as all readers name it."""
    return re.sub(r"^file:/+", "file:/", path)


def file_path() -> Column:
    """The path of a row's file, decoded, as ``one_name`` gives it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def lines_of(spark: SparkSession, paths: list[str], whole: bool = False) -> DataFrame:
    """(path, block, id, value): the lines (or whole texts) of the files."""
    text = spark.read.option("recursiveFileLookup", "true").text([_escaped(p) for p in paths], wholetext=whole)
    lines = text.select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
                        F.monotonically_increasing_id().alias("id"))
    first = (F.col("block") == 0) & F.startswith("value", F.lit("﻿"))
    return lines.withColumn("value", F.when(first, F.substring("value", 2, 1 << 30)).otherwise(F.col("value")))


# ---------------------------------------------------------------- CSV

def _after_text(state: Column, part: Column) -> Column:
    """The state behind text without quotes: within quotes nothing happens, else
    a separator at its end starts a field."""
    return (F.when((part == "") | (state == QUOTED), state)
            .when(F.endswith(part, F.lit(",")), F.lit(START)).otherwise(F.lit(FIELD)))


def _after_quote(state: Column) -> Column:
    return (F.when(state == START, F.lit(QUOTED)).when(state == QUOTED, F.lit(CLOSED))
            .when(state == CLOSED, F.lit(QUOTED)).otherwise(state))


def _parts(line: Column) -> Column:
    return F.split(line, '"', -1)


def ends_quoted(line: Column, begins_quoted: bool) -> Column:
    """Whether a line break at the end of the line lies within a quoted field."""
    begin = QUOTED if begins_quoted else START
    end = F.aggregate(_parts(line), F.lit(-1), lambda state, part: _after_text(
        F.when(state == -1, F.lit(begin)).otherwise(_after_quote(state)), part))
    return F.when(F.contains(line, F.lit('"')), end == QUOTED).otherwise(F.lit(begins_quoted))


def fields(row: Column) -> Column:
    """The fields of a whole row; an empty row has none.  Quotes count only at a
    field's start, two of them within a quoted field are one."""
    def step(acc: Column, part: Column) -> Column:
        before = acc["state"]
        state = F.when(before == -1, F.lit(START)).otherwise(_after_quote(before))
        # a quote is text in the middle of a field, or as the second of two
        quote = F.when((before == FIELD) | (before == CLOSED) & (state == QUOTED), F.lit('"')).otherwise(F.lit(""))
        text = F.when(state == QUOTED, part).otherwise(F.replace(part, F.lit(","), F.lit(MARK)))
        return F.struct(_after_text(state, part).alias("state"), F.concat(acc["out"], quote, text).alias("out"))

    begin = F.struct(F.lit(-1).alias("state"), F.lit("").alias("out"))
    quoted = F.split(F.aggregate(_parts(F.replace(row, F.lit(MARK), F.lit("�"))), begin, step, lambda a: a["out"]), MARK, -1)
    return (F.when(row == "", F.array().cast("array<string>"))
            .when(F.contains(row, F.lit('"')), quoted).otherwise(F.split(row, ",", -1)))


def _split_starts(splits: DataFrame) -> DataFrame:
    """Per split of a file: whether it begins within quotes (``inside``) and the
    rows before it (``before``).  A split is a function of how it begins: ``end``
    and ``rows`` are (outside, inside) pairs, composed in order along the file."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "first", "end", "rows")))

    def step(acc: Column, s: Column) -> Column:
        at = acc["inside"].cast("int") + 1
        entry = F.struct(s["block"].alias("block"), s["first"].alias("first"), acc["inside"].alias("inside"), acc["rows"].alias("before"))
        return F.struct(F.element_at(s["end"], at).alias("inside"), (acc["rows"] + F.element_at(s["rows"], at)).alias("rows"),
                        F.array_append(acc["out"], entry).alias("out"))

    entry = "array<struct<block:bigint,first:bigint,inside:boolean,before:bigint>>"
    begin = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("rows"), F.array().cast(entry).alias("out"))
    files = splits.groupBy("path").agg(ordered.alias("s"))
    return files.select("path", F.inline(F.aggregate("s", begin, step, lambda a: a["out"])))


def csv_rows(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, failed): ``rows`` are (path, row_idx, fields), the header is row 0;
    ``failed`` are (path, reason) of files with bytes that are no UTF-8 or a row
    of more than ROW_CHARS characters.  A line break within a cell is ``\\n``."""
    lines = lines_of(spark, paths)
    lines = lines.withColumns({"opens": ends_quoted(F.col("value"), False), "valid": F.is_valid_utf8("value")})
    per_split = lines.groupBy(*SPLIT).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"),
                                          F.bool_or("opens").alias("opens"), F.bool_and("valid").alias("valid"))
    per_split = per_split.persist()
    try:
        odd = [r["path"] for r in per_split.groupBy("path").agg(F.bool_or("opens").alias("o")).where("o").collect()]
        bad = per_split.groupBy("path").agg(F.bool_and("valid").alias("v")).where("NOT v").select("path")
        failed = bad.select("path", F.lit("file:UnicodeDecodeError").alias("reason"))
        failed = spark.createDataFrame(failed.collect(), failed.schema)
        pairs = lambda c: F.array(c, c)
        plain = per_split.where(~F.col("path").isin(odd)) if odd else per_split
        starts = _split_starts(plain.select(*SPLIT, "first", pairs(F.lit(False)).alias("end"), pairs(F.col("n")).alias("rows")))
        starts = spark.createDataFrame(starts.collect(), starts.schema)  # one row a split
    finally:
        per_split.unpersist()
    out = (lines.join(F.broadcast(starts), SPLIT)
                .select("path", (F.col("before") + F.col("id") - F.col("first")).alias("row_idx"), fields(F.col("value")).alias("fields")))
    if odd:
        rows, long = _rows_over_lines(spark, odd)
        out, failed = out.unionByName(rows), failed.unionByName(long)
    return out, failed


def _rows_over_lines(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of files in which a quoted field holds a line break.  Each line is a
    function of whether it begins within quotes; the functions are composed along
    a split (a window of one split) and along the splits of the file."""
    lines = lines_of(spark, paths)
    lines = lines.withColumns({"out": ends_quoted(F.col("value"), False), "in": ends_quoted(F.col("value"), True)})
    order = W.partitionBy(*SPLIT).orderBy("id")
    upto, behind = order.rowsBetween(W.unboundedPreceding, W.currentRow), order.rowsBetween(W.unboundedPreceding, -1)
    swaps = F.col("out") & ~F.col("in")
    lines = lines.withColumn("turns", F.sum(swaps.cast("long")).over(upto))
    # behind the last line that ends the same way in either case, only the turns count
    lines = lines.withColumn("fixed", F.when(F.col("out") == F.col("in"), F.struct(F.col("out").alias("state"), "turns")))
    lines = lines.withColumns({"last": F.last("fixed", ignorenulls=True).over(behind),
                               "turned": F.coalesce(F.lag("turns").over(order), F.lit(0))})
    flipped = lambda n: n % 2 == 1

    def begins(inside: bool) -> Column:
        known = F.col("last.state") != flipped(F.col("turned") - F.col("last.turns"))
        return F.when(F.col("last").isNotNull(), known).otherwise(F.lit(inside) != flipped(F.col("turned")))

    lines = lines.withColumns({"b0": begins(False), "b1": begins(True)})
    lines = lines.withColumns({f"n{i}": F.sum((~F.col(f"b{i}")).cast("long")).over(upto) for i in (0, 1)})
    end = lambda b: F.max_by(F.when(F.col(b), F.col("in")).otherwise(F.col("out")), "id")
    splits = lines.groupBy(*SPLIT).agg(F.min("id").alias("first"), F.array(end("b0"), end("b1")).alias("end"),
                                       F.array(F.max("n0"), F.max("n1")).alias("rows"))
    starts = _split_starts(splits)
    starts = F.broadcast(spark.createDataFrame(starts.collect(), starts.schema))  # one row a split
    at = lines.join(starts, SPLIT)
    pick = lambda a, b: F.when(F.col("inside"), F.col(b)).otherwise(F.col(a))
    at = at.withColumns({"begins": pick("b0", "b1"), "row_idx": F.col("before") + pick("n0", "n1") - 1})
    at = at.withColumn("ends", F.when(F.col("begins"), F.col("in")).otherwise(F.col("out")))
    single = at.where(~F.col("begins") & ~F.col("ends")).select("path", "row_idx", "value")
    parts = at.where(F.col("begins") | F.col("ends"))
    size = parts.groupBy("path", "row_idx").agg((F.sum(F.length("value") + 1)).alias("size"))
    long = size.where(F.col("size") > ROW_CHARS).select("path", F.lit("file:row_too_long").alias("reason")).distinct()
    short = size.where(F.col("size") <= ROW_CHARS).select("path", "row_idx")
    joined = (parts.join(short, ["path", "row_idx"]).groupBy("path", "row_idx")
                   .agg(F.sort_array(F.collect_list(F.struct("block", "id", "value"))).alias("p"))
                   .select("path", "row_idx", F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value")))
    return single.unionByName(joined).select("path", "row_idx", fields(F.col("value")).alias("fields")), long


# ---------------------------------------------------------------- JSON

def _record_text(line: Column) -> Column:
    """A line of records as a JSON array: brackets and commas that belong to the
    array around the lines are taken off."""
    text = F.trim(line)
    opens, closes = F.startswith(text, F.lit("[")), F.endswith(text, F.lit("]"))
    text = F.when(opens & ~closes, F.substring(text, 2, 1 << 30)).when(closes & ~opens, F.left(text, F.length(text) - 1)).otherwise(text)
    text = F.regexp_replace(text, r"^[\s,]+|[\s,]+$", "")
    return F.when(opens & closes, text).otherwise(F.concat(F.lit("["), text, F.lit("]")))


def _spaced(structure: Column) -> Column:
    """Compact JSON with a space behind each comma and colon outside of strings."""
    slash, quote = "\ufdd1", "\ufdd2"
    plain = F.replace(F.replace(structure, F.lit("\\\\"), F.lit(slash)), F.lit('\\"'), F.lit(quote))
    parts = F.transform(F.split(plain, '"', -1), lambda p, i: F.when(
        i % 2 == 0, F.replace(F.replace(p, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))).otherwise(p))
    return F.replace(F.replace(F.array_join(parts, '"'), F.lit(quote), F.lit('\\"')), F.lit(slash), F.lit("\\\\"))


def _records(text: Column) -> Column:
    """Records as maps of key to text; structures and truth values as Python writes
    them.  A second, typed reading tells them from strings that look alike."""
    told = F.from_json(text, "array<map<string,variant>>")

    def value(v: Column, typed: Column) -> Column:
        literal = F.to_json(typed)
        return (F.when(v.rlike(r"^[\[{]") & literal.rlike(r"^[\[{]"), _spaced(v))
                .when(v.isin("true", "false") & (literal == v), F.initcap(v)).otherwise(v))

    found = F.from_json(text, "array<map<string,string>>")
    odd = F.exists(found, lambda r: F.exists(F.map_values(r), lambda v: v.rlike(r"^([\[{]|true$|false$)")))
    typed = F.transform(F.arrays_zip(found.alias("s"), told.alias("t")), lambda r: F.transform_values(
        r["s"], lambda k, v: value(v, F.try_element_at(r["t"], k))))
    return F.when(odd, typed).otherwise(found)


def json_rows(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, failed) as ``csv_rows``: records of files with one or more records to
    a line (JSON lines, or an array broken between records) are read by splits;
    other files (records over several lines) are read whole, each by one task.

    Row 0 holds the keys in order of appearance; values are text, see ``_records``."""
    records = _records
    lines = lines_of(spark, paths).where(F.trim("value") != "")
    read = lines.withColumns({"records": records(_record_text(F.col("value"))), "valid": F.is_valid_utf8("value")})
    bracket = F.trim("value").isin("[", "]")
    read = read.withColumn("records", F.when(bracket, F.array().cast("array<map<string,string>>")).otherwise(F.col("records")))
    fits = F.col("records").isNotNull() & ~F.exists("records", lambda r: r.isNull())
    state = read.groupBy("path").agg(F.bool_and(fits).alias("fits"), F.bool_and("valid").alias("valid")).collect()
    by_line = [r["path"] for r in state if r["fits"] and r["valid"]]
    over_lines = [r["path"] for r in state if not r["fits"] and r["valid"]]
    bad = [(r["path"], "file:UnicodeDecodeError") for r in state if not r["valid"]]

    each = [lines_of(spark, by_line).where(F.trim("value") != "").select(
        *SPLIT, F.when(F.trim("value").isin("[", "]"), None).otherwise(records(_record_text(F.col("value")))).alias("records"))] if by_line else []
    if over_lines:
        whole = lines_of(spark, over_lines, whole=True).select(*SPLIT, records(F.col("value")).alias("records"))
        broken = whole.where(F.col("records").isNull() | F.exists("records", lambda r: r.isNull())).select("path").distinct().collect()
        bad += [(r["path"], "file:JSONDecodeError") for r in broken]
        each.append(whole.where(~F.col("path").isin([r["path"] for r in broken])))
    failed = spark.createDataFrame(bad, "path string, reason string")
    if not each:
        return spark.createDataFrame([], "path string, row_idx long, fields array<string>"), failed
    rows = None
    for frame in each:
        found = frame.select(*SPLIT, F.explode("records").alias("m")).withColumn("id", F.monotonically_increasing_id())
        splits = found.groupBy(*SPLIT).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        starts = _split_starts(splits.select(*SPLIT, "first", F.array(F.lit(False), F.lit(False)).alias("end"),
                                             F.array("n", "n").alias("rows")))
        starts = F.broadcast(spark.createDataFrame(starts.collect(), starts.schema))
        found = found.join(starts, SPLIT).select("path", (F.col("before") + F.col("id") - F.col("first") + 1).alias("row_idx"), "m")
        rows = found if rows is None else rows.unionByName(found)
    # keys in order of appearance: one row a key and task reaches the shuffle
    keys = (rows.select("path", "row_idx", F.posexplode(F.map_keys("m")).alias("at", "key"))
                .groupBy("path", "key").agg(F.min(F.struct("row_idx", "at")).alias("first"))
                .groupBy("path").agg(F.sort_array(F.collect_list(F.struct("first", "key"))).alias("k"))
                .select("path", F.transform("k", lambda x: x["key"]).alias("keys")))
    body = rows.join(keys, "path").select("path", "row_idx", F.transform(
        "keys", lambda k: F.try_element_at(F.col("m"), k)).alias("fields"))
    return keys.select("path", F.lit(0).cast("long").alias("row_idx"), F.col("keys").alias("fields")).unionByName(body), failed
