"""WARC archives written and read as Spark text tables.

Reading finds records by boundary-chain verification.  The archive is cut at
every line that looks like the start of a record; each such candidate gives its
offset and, from its Content-Length, the offset of its successor.  Candidates
that follow each other within a file split are joined to runs, and pointer
jumping over the runs, from the start of each file, keeps the reachable ones.
A start line inside a payload is a candidate that nothing points to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import stored

CRLF = "\r\n"
END = CRLF + CRLF
MAGIC = "WARC/1."
#: every record but a file's first follows a line end, so this separator finds
#: all true starts; it cannot overlap itself
SEPARATOR = "\n" + MAGIC
ID = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(body: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits give four
    characters."""
    digest = F.sha1(body)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\r\n]+", "%0D%0A")


def records(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """One record text per row of ``pages`` (page_id, url, html).

    Of the records with equal payloads of at least ``min_revisit`` bytes the one
    with the largest page_id is a response, the others are revisits of it;
    smaller ones are all responses.  Rows that repeat page_id and payload of a
    response are responses too.  Null html: empty payload.  Null page_id ranks
    lowest.  Null url: no target line.  Other columns are ignored."""
    body = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", body.alias("_body"))
    p = p.withColumns({"_bytes": F.octet_length("_body"), "_digest": base32_sha1(F.col("_body")),
                       "_same": F.sha2("_body", 256)})
    copies = (p.filter(F.col("_bytes") >= min_revisit).groupBy(F.col("_same").alias("_of"))
              .agg(F.max("page_id").alias("_top"), F.count("*").alias("_n")).filter("_n > 1"))
    # only payloads that occur more than once; Spark broadcasts them below its
    # size limit and shuffles the pages otherwise
    copies = stored(copies.drop("_n"), "warc_copies")
    p = p.join(copies, p["_same"] == copies["_of"], "left")
    revisit = F.col("_of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    name = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("_body")))
    head = F.concat_ws(
        CRLF, F.lit(f"{MAGIC}0"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))), F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("_top")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return p.select(F.concat(head, F.lit(END), block).alias("value"))


def write_warc(pages: DataFrame, path: str, min_revisit: int = 0) -> None:
    """Archives below ``path``, one a task; records end with two line ends."""
    records(pages, min_revisit).write.option("lineSep", END).text(path)


def _field(head: str, name: str) -> Column:
    """Value of a header line; null where there is none."""
    value = F.regexp_extract(head, rf"(?i)\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.nullif(F.rtrim(value), F.lit(""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at SEPARATOR, with file, split, order and byte length.
    A file's first piece starts with MAGIC itself, where it is a record."""
    d = spark.read.option("lineSep", SEPARATOR).text(path)
    return d.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("order"),
                    "value", F.octet_length("value").cast("long").alias("bytes"))


def _placed(d: DataFrame) -> DataFrame:
    """Adds ``at``: the byte offset of the piece's MAGIC (file start: 0).
    Lengths are summed within splits, then over the splits of a file."""
    step = F.col("bytes") + len(SEPARATOR)
    inside = W.partitionBy("file", "split").orderBy("order").rowsBetween(W.unboundedPreceding, -1)
    splits = d.groupBy("file", "split").agg(F.sum(step).alias("_sum"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("_file"), F.col("split").alias("_split"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    d = d.withColumn("_in", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    d = d.join(splits, (d["file"] == splits["_file"]) & (d["split"] == splits["_split"]))
    begin = F.col("_start") + F.col("_in")
    return d.withColumn("at", F.greatest(begin - len(MAGIC), F.lit(0))).drop("_file", "_split", "_start", "_in")


def _parsed(d: DataFrame, payload: bool) -> DataFrame:
    """Header fields of each piece; span (bytes from MAGIC to the successor, null
    where the piece is no record); whether the piece is the whole record, and
    then bytes and digest of its payload (and the payload itself)."""
    first = F.col("value").startswith(MAGIC)
    d = d.withColumn("_body", F.when(first, F.substr("value", F.lit(len(MAGIC) + 1))).otherwise(F.col("value")))
    # the separator may have taken the line end that closes the header
    d = d.withColumn("_head", F.substring_index(F.concat("_body", F.lit("\n")), END, 1))
    length = F.when(F.regexp_like("_head", F.lit(r"^[01]\r\n")), _field("_head", "content-length").try_cast("long"))
    d = d.withColumn("_length", length)
    d = d.withColumn("span", len(MAGIC) + F.octet_length("_head") + len(END) + F.col("_length") + len(END))
    own = len(MAGIC) + F.octet_length("_body")
    # the next piece's separator has taken the last byte, or the file ends
    d = d.withColumn("whole", F.coalesce(F.col("span").isin(own + 1, own), F.lit(False)))
    names = {"type": "warc-type", "id": "warc-record-id", "refers": "warc-refers-to", "uri": "warc-target-uri",
             "digest": "warc-payload-digest", "content": "content-type"}
    d = d.withColumns({c: _field("_head", name) for c, name in names.items()})
    d = d.withColumn("_block", F.when(F.col("_length").isNotNull(), F.expr(
        "substring(cast(_body AS binary), octet_length(_head) + 5, cast(_length AS int))")))
    http = F.coalesce(F.lower("content").startswith("application/http"), F.lit(False))
    d = d.withColumn("_http", F.when(http, F.substring_index(F.col("_block").cast("string"), END, 1)))
    d = d.withColumn("payload", F.expr(
        "CASE WHEN _http IS NULL THEN _block ELSE substring(_block, octet_length(_http) + 5) END"))
    d = d.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                       "payload_digest": base32_sha1(F.col("payload")),
                       "claimed_bytes": _field("_http", "content-length").try_cast("long")})
    return d.select("file", "split", *(["at"] if "at" in d.columns else []), "order", "bytes", "span", "whole", *names, "claimed_bytes", "payload_bytes",
                    "payload_digest", *(["payload"] if payload else []))


def _reachable(d: DataFrame) -> DataFrame:
    """The candidates that the chain from their file's start reaches."""
    c = d.filter("span IS NOT NULL").withColumn("_next", F.col("at") + F.col("span"))
    by = W.partitionBy("file", "split").orderBy("at")
    head = ~F.coalesce(F.lag("_next").over(by) == F.col("at"), F.lit(False))
    c = c.withColumn("_head", F.when(head, F.col("at")))
    c = stored(c.withColumn("_run", F.max("_head").over(by.rowsBetween(W.unboundedPreceding, 0))).drop("_head"), "warc_runs")
    exits = c.groupBy("file", "_run").agg(F.max_by("_next", "at").alias("_exit"))
    into = c.select(F.col("file").alias("_f"), F.col("at").alias("_entry"), F.col("_run").alias("_to"))
    jump = stored(exits.join(into, (F.col("file") == F.col("_f")) & (F.col("_exit") == F.col("_entry")))
                  .select("file", "_run", "_to", "_entry"), "warc_jump")
    reached = stored(c.filter("at = 0").select("file", "_run", F.col("at").alias("_entry")), "warc_reached")
    while not jump.isEmpty():
        j = jump.select(F.col("file").alias("_f"), F.col("_run").alias("_from"), "_to", F.col("_entry").alias("_e"))
        step = reached.join(j, (F.col("file") == F.col("_f")) & (F.col("_run") == F.col("_from")))
        reached = stored(reached.unionByName(step.select("file", F.col("_to").alias("_run"), F.col("_e").alias("_entry"))),
                         "warc_reached")
        k = jump.select(F.col("file"), F.col("_run"), F.col("_to").alias("_via"))
        step = k.join(j, (F.col("file") == F.col("_f")) & (F.col("_via") == F.col("_from")))
        jump = stored(step.select("file", "_run", "_to", F.col("_e").alias("_entry")), "warc_jump")
    r = reached.select(F.col("file").alias("_f"), F.col("_run").alias("_r"), "_entry")
    on = (F.col("file") == F.col("_f")) & (F.col("_run") == F.col("_r")) & (F.col("at") >= F.col("_entry"))
    return c.join(r, on).drop("_f", "_r", "_entry", "_run", "_next")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record of the uncompressed archives below ``path``: file, at
    (byte offset), type, id, refers, uri, digest, content, claimed_bytes (of an
    HTTP header), payload_bytes and payload_digest as measured, and with
    ``payload`` the bytes themselves.

    Start lines inside payloads give no rows.  Where a record's length leads to
    no record start, the file's chain ends there and what follows is not read.
    A last record that is cut short has the payload that is there.  A file that
    does not begin with a record, or is empty, gives no rows."""
    d = _placed(stored(_parsed(_pieces(spark, path), payload), "warc_pieces"))
    r = stored(_reachable(d), "warc_records")
    # records with start lines in their payloads: their pieces are read again
    split = stored(r.filter("NOT whole").select("file", "at", "span"), "warc_split")
    if not split.isEmpty():
        starts = r.select(F.col("file").alias("_f"), F.col("at").alias("_at"), F.col("span").alias("_span"),
                          F.col("whole").alias("_whole"))
        p = _placed(_pieces(spark, path).join(split.select("file").distinct(), "file", "left_semi"))
        p = p.join(starts, (p["file"] == starts["_f"]) & (p["at"] == starts["_at"]), "left")
        by = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
        own = F.last(F.when(F.col("_at").isNotNull(), F.struct("_at", "_span", "_whole")), True).over(by)
        p = p.withColumn("_own", own).filter(~F.col("_own._whole") & (F.col("at") < F.col("_own._at") + F.col("_own._span")))
        p = p.groupBy("file", F.col("_own._at").alias("at")).agg(
            F.sort_array(F.collect_list(F.struct("at", "value"))).alias("_parts"), F.min("split").alias("split"),
            F.min("order").alias("order"), F.sum("bytes").alias("bytes"))
        p = p.withColumn("value", F.array_join(F.transform("_parts", lambda x: x["value"]), SEPARATOR))
        r = r.filter("whole").unionByName(_parsed(p, payload).select(*r.columns))
    return r.drop("split", "order", "bytes", "span", "whole")
