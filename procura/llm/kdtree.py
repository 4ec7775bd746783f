"""Sharding by a k-d tree over document metadata.

A node that is to become k shards is cut at the weighted quantile of
floor(k/2)/k of its bytes along its widest dimension, until each leaf is one
shard of about the target bytes.  The quantile is found on the cluster: a
histogram of the node's coordinate range, then of the bin that holds the
quantile, and so on; equal coordinates are cut along a hash of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import running_before, stored

BINS = 4096
#: a cut may miss its quantile by this share of the node's bytes
TOLERANCE = 0.0005
TIE_MAX = (1 << 62) - 1


DIMS = ("_x0", "_x1", "_x2", "_x3")


def ranks(values: DataFrame) -> DataFrame:
    """(value, rank): the distinct values of a column of text in byte order, from 0;
    null has none.  Values are range-sorted over many tasks: a row's rank is the
    number of values in the parts before its own and its place in it."""
    found = values.toDF("value").filter("value IS NOT NULL").distinct().orderBy("value")
    found = stored(found.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    parts = found.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row a part
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return found.join(parts, part == F.col("_part")).select("value", (F.col("_before") + place).alias("rank"))


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text + 1; null text: 1), text_crc32,
    the dimensions (size, ranks of source and lang, doc_id; null before all) and a
    hash of the row."""
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    size = (F.octet_length(body) + 1).cast("long")
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    d = docs.select("doc_id", size.alias("size"), F.crc32(body).alias("text_crc32"), size.alias("_x0"),
                    F.col("source").cast("string").alias("_source"), F.col("lang").cast("string").alias("_lang"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("_x3"), tie.alias("_tie"))
    d = stored(d, "metadata")
    for name, out in (("_source", "_x1"), ("_lang", "_x2")):
        of = ranks(d.select(name))
        d = d.join(of, d[name] == of["value"], "left").withColumn(out, F.coalesce("rank", F.lit(-1).cast("long"))).drop("value", "rank", name)
    return d.select("doc_id", "size", "text_crc32", *DIMS, "_tie")


def _coordinate(dim: Column) -> Column:
    out = F.col(DIMS[0])
    for i, c in enumerate(DIMS[1:], 1):
        out = F.when(dim == i, F.col(c)).otherwise(out)
    return out


def _joined(t: DataFrame, nodes: list[dict], cols: list[str]) -> DataFrame:
    """Rows of the named nodes with the nodes' numbers: one small row per node."""
    return t.join(_table(t, nodes, cols), "_node")


def _table(t: DataFrame, nodes: list[dict], cols: list[str]) -> DataFrame:
    """The nodes, fewer than shards; Spark broadcasts the table below its size limit."""
    rows = [tuple(int(n[c]) for c in cols) for n in nodes]
    return t.sparkSession.createDataFrame(rows, ", ".join(f"_{c} long" for c in cols))


def _widest(t: DataFrame, quota: dict[int, int], root: list[int] | None) -> tuple[list[dict], list[int]]:
    """The nodes still to be cut, each with its widest dimension (extents
    relative to those of all rows); one row per node comes to the driver."""
    aggs = [F.sum("size").alias("w")]
    for c in DIMS:
        aggs += [F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")]
    rows = t.groupBy("_node").agg(*aggs).collect()
    extent = lambda r, c: r[f"{c}_hi"] - r[f"{c}_lo"]
    root = root or [max([1, *(extent(r, c) for r in rows)]) for c in DIMS]
    nodes = []
    for r in rows:
        k = quota[r["_node"]]
        if k > 1:
            i = max(range(len(DIMS)), key=lambda i: (extent(r, DIMS[i]) / root[i], -i))
            nodes.append({"node": r["_node"], "dim": i, "weight": r["w"], "goal": r["w"] * (k // 2) // k,
                          "lo": r[f"{DIMS[i]}_lo"], "hi": r[f"{DIMS[i]}_hi"], "below": 0, "tied": 0, "at": 0})
    return nodes, root


def _cuts(t: DataFrame, nodes: list[dict]) -> None:
    """Sets ``cut`` and ``tie_cut``: rows whose (coordinate, hash) is below go
    left.  A round is one aggregation for all open nodes (at most BINS groups a
    node, combined before the shuffle) and brings back one row per node."""
    active = list(nodes)
    while active:
        for n in active:
            n["width"] = -(-(n["hi"] - n["lo"] + 1) // BINS)
        d = _joined(t, active, ["node", "dim", "lo", "hi", "width", "goal", "below", "tied", "at"])
        c = _coordinate(F.col("_dim"))
        value = F.when(F.col("_tied") == 1, F.when(c == F.col("_at"), F.col("_tie"))).otherwise(c)
        d = d.withColumn("_value", value).filter(F.col("_value").between(F.col("_lo"), F.col("_hi")))
        d = d.withColumn("_bin", F.expr("(_value - _lo) div _width"))
        h = d.groupBy("_node", "_bin").agg(F.sum("size").alias("w"), F.first("_goal").alias("_goal"),
                                           F.first("_below").alias("_below"))
        upto = W.partitionBy("_node").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)
        h = h.withColumn("upto", F.col("_below") + F.sum("w").over(upto))
        hit = {r["_node"]: r["x"] for r in h.filter(F.col("upto") >= F.col("_goal")).groupBy("_node")
               .agg(F.min(F.struct("_bin", "upto", "w")).alias("x")).collect()}
        again = []
        for n in active:
            x = hit[n["node"]]
            lo = n["lo"] + x["_bin"] * n["width"]
            hi = min(n["hi"], lo + n["width"] - 1)
            if x["w"] <= TOLERANCE * n["weight"] or n["tied"] and n["width"] == 1:
                end = hi + 1 if x["upto"] - n["goal"] <= x["w"] / 2 else lo
                n["cut"], n["tie_cut"] = (n["at"], end) if n["tied"] else (end, 0)
                continue
            n["below"] = x["upto"] - x["w"]
            if n["width"] == 1:
                n |= {"tied": 1, "at": lo, "lo": 0, "hi": TIE_MAX}
            else:
                n |= {"lo": lo, "hi": hi}
            again.append(n)
        active = again


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              rows_per_bucket: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, shard (0..) and slot (gapless from 0 within
    the shard) of every row of ``docs``; give the number of shards or the
    target bytes of a shard.

    Null text counts as empty; null source, lang or doc_id come first in their
    dimension.  Repeated rows are separate rows; only rows equal in doc_id and
    text must share a shard, all others can be cut apart.  Other columns are
    ignored.  Empty input: no rows."""
    t = stored(metadata(docs), "kd")
    total = t.agg(F.count("*").alias("n"), F.sum("size").alias("w")).first()
    if shards is None:
        shards = max(1, round((total["w"] or 0) / target_bytes))
    t = t.withColumn("_node", F.lit(1).cast("long"))
    quota, first, root = {1: shards}, {1: 0}, None
    while any(k > 1 for k in quota.values()) and total["n"]:
        nodes, root = _widest(t, quota, root)
        if not nodes:
            break
        _cuts(t, nodes)
        open_ = _joined(t, nodes, ["node", "dim", "cut", "tie_cut"])
        c = _coordinate(F.col("_dim"))
        left = (c < F.col("_cut")) | ((c == F.col("_cut")) & (F.col("_tie") < F.col("_tie_cut")))
        moved = open_.withColumn("_node", F.col("_node") * 2 + F.when(left, 0).otherwise(1))
        ids = [n["node"] for n in nodes]
        done = t.join(_table(t, nodes, ["node"]), "_node", "left_anti").select(*t.columns)
        t = stored(moved.select(*t.columns).unionByName(done), "kd")
        for n in ids:
            k, f = quota.pop(n), first.pop(n)
            quota |= {2 * n: k // 2, 2 * n + 1: k - k // 2}
            first |= {2 * n: f, 2 * n + 1: f + k // 2}
    leaves = t.sparkSession.createDataFrame([(n, f) for n, f in first.items()], "_node long, shard int")
    t = t.join(leaves, "_node").withColumn("_digest", F.lpad(F.lower(F.hex("_tie")), 16, "0"))
    t = running_before(t, "shard", "_digest", F.lit(1), "slot", total["n"], rows_per_bucket)
    return t.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
