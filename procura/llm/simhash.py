"""SimHash fingerprints and all fingerprints within a Hamming radius.

Terms are runs of words; each votes with its weight for or against every bit,
by the bits of its hash.  For the search, fingerprints are cut into BLOCKS
blocks: two within the radius differ by at most radius // BLOCKS bits in at least
one.  The fingerprints are put into one table per block, keyed by it, each query
asks for its block with any such bits flipped, and a pair counts in the table of
the first block that is as near as that.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import small_batches, stored

LANES = 4
BITS = 64 * LANES
WIDTH = 3
#: pairs of this Jaccard similarity (of the terms' sets) are to be caught
SIMILARITY = 0.8
BLOCKS = 16


def radius_for(similarity: float) -> int:
    """Bits by which fingerprints of sets of equal size and this Jaccard similarity
    differ: the angle between the sets, as a share of pi, is each bit's chance;
    one and a half deviations are added."""
    chance = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(BITS * chance + 1.5 * math.sqrt(BITS * chance * (1 - chance)))


RADIUS = radius_for(SIMILARITY)
#: a key of a table with more rows than this is cut into parts
HOT_KEY = 2_000
WORDS_HELD = 50_000


class _Hashes(dict):
    """Hashes of words; the first WORDS_HELD are held."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORDS_HELD:
            self[word] = h
        return h


def fingerprinter(width: int = WIDTH):
    """A function of a text: its fingerprint (LANES longs).  A term's weight is
    1 + ln of its count; fewer words than ``width``: all of them are one term;
    no words: all bits 0."""
    known = _Hashes()
    step = np.uint64(0x9E3779B97F4A7C15)
    lanes = (np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[None, :]

    def fingerprint(text: str | None) -> np.ndarray:
        w = (text or "").encode("utf-8", "replace").lower().split()
        if not w:
            return np.zeros(LANES, np.int64)
        h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
        k = min(width, len(w))
        t = h[:len(w) - k + 1] + np.uint64(k)
        for i in range(1, k):
            t *= step
            t += h[i:len(w) - k + 1 + i]
        t, n = np.unique(t, return_counts=True)
        t = t[:, None] + lanes
        t ^= t >> np.uint64(30)
        t *= np.uint64(0xBF58476D1CE4E5B9)
        t ^= t >> np.uint64(27)
        t *= np.uint64(0x94D049BB133111EB)
        t ^= t >> np.uint64(31)
        weight = (1 + np.log(n)).astype(np.float32)
        bits = np.unpackbits(t.view(np.uint8).reshape(len(n), -1), axis=1)
        votes = weight @ bits.astype(np.float32)
        return np.packbits(votes > weight.sum() / 2).view(np.int64)

    return fingerprint


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bits."""
    return 1 - int(np.unpackbits((a ^ b).view(np.uint8)).sum()) / BITS


def _hex(v: np.ndarray) -> str:
    return v.tobytes().hex()


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _measured(fingerprint, text: str, own: np.ndarray, after: str, next_: np.ndarray) -> tuple:
    n = len(text)
    edited = text[:n - n // 2] + after[:n // 2]
    other = fingerprint(edited)
    return (n, hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), _hex(own), _hex(other),
            likeness(own, other), likeness(own, next_))


def fingerprint_edits(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars (code points), fingerprint, and of the
    text with its last half replaced by the start of the next document's:
    edited_sha256, edited_fingerprint, near_edited; near_next: likeness to the
    next document.  Next: by ascending doc_id, after the last the first.

    Documents are range-sorted by doc_id and walked in order; each range's last
    document meets the first of the range after it in a second step.  Null text:
    empty.  Null doc_ids come first; rows with equal doc_ids go by a hash of
    their text.  A single document is its own next.  Empty input gives no rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("_h"))
    order = [F.asc_nulls_first("doc_id"), F.asc("_h")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("_part"))

    def walk(batches):
        f = fingerprinter(width)
        held = part = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows, ids = [], []
                s = batch.slice(at, 512)
                for i, t, p in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist(), s.column("_part").to_pylist()):
                    own = f(t)
                    if held is None:
                        ids.append(i)
                        rows.append((None,) * 6 + (p, "first", t))
                    else:
                        ids.append(held[0])
                        rows.append((*_measured(f, held[1], held[2], t, own), p, None, None))
                    held, part = (i, t, own), p
                yield _batch(ids, rows, s.schema.field("doc_id").type)
                kind_ = s.schema.field("doc_id").type
        if held is not None:
            yield _batch([held[0]], [(None,) * 6 + (part, "last", held[1])], kind_)

    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double, _part int, _end string, _text string"
    small_batches(docs.sparkSession)
    d = stored(d.mapInArrow(walk, schema), "simhash")
    # one row per range
    ends = d.filter("_end = 'first'").select("_part")
    by = W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select(F.col("_part").alias("_from"), F.coalesce(
        F.lead("_part").over(W.orderBy("_part")), F.first("_part").over(by)).alias("_to"))
    last = d.filter("_end = 'last'").select("doc_id", F.col("_text").alias("text"), "_part")
    first = d.filter("_end = 'first'").select(F.col("_part").alias("_to"), F.col("_text").alias("_after"))
    last = last.join(ends, F.col("_part") == F.col("_from")).join(first, "_to").select("doc_id", "text", "_after")

    def close(batches):
        f = fingerprinter(width)
        for b in batches:
            rows = [(*_measured(f, t, f(t), a, f(a)), 0, None, None)
                    for t, a in zip(b.column("text").to_pylist(), b.column("_after").to_pylist())]
            yield _batch(b.column("doc_id"), rows, b.schema.field("doc_id").type)

    closed = last.mapInArrow(close, schema)
    return d.filter("_end IS NULL").select(*_COLUMNS).unionByName(closed.select(*_COLUMNS))


def _batch(ids, rows, kind) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 9
    types = [*_TYPES, pa.int32(), pa.string(), pa.string()]
    names = [*_COLUMNS, "_part", "_end", "_text"]
    first = ids if isinstance(ids, pa.Array) else pa.array(ids, kind)
    return pa.RecordBatch.from_arrays([first, *(pa.array(c, t) for c, t in zip(columns, types))], names=names)


def near_fingerprints(queries: DataFrame, all_: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per fingerprint of ``queries``: n_near, how many rows of ``all_`` have a
    fingerprint within ``radius`` bits, and near, those fingerprints in order.
    Both have a column fingerprint, BITS / 4 hexadecimal digits.  A pair counts
    by its distance alone, so any radius below BITS is exact.  Equal fingerprints
    are one row until they are counted: they are the classes, and the rows of
    ``all_`` say which documents belong to one."""
    size = BITS // BLOCKS
    flips = radius // BLOCKS
    masks = [sum(1 << i for i in c) for n in range(flips + 1) for c in combinations(range(size), n)]
    digits = size // 4
    lanes = [F.conv(F.substring("fingerprint", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(BITS // 32)]
    lanes = [F.shiftleft(a, 32).bitwiseOR(b).alias(f"l{i}") for i, (a, b) in enumerate(zip(lanes[::2], lanes[1::2]))]
    blocks = F.array(*[F.conv(F.substring("fingerprint", 1 + digits * i, digits), 16, 10).cast("int") for i in range(BLOCKS)])
    own, other = [f"l{i}" for i in range(LANES)], [f"o{i}" for i in range(LANES)]

    a = all_.groupBy("fingerprint").agg(F.count("*").alias("_rows")).select(*lanes, "_rows", F.posexplode(blocks).alias("_table", "_key"))
    a = a.select(*[F.col(x).alias(y) for x, y in zip(own, other)], "_rows", "_table", "_key")
    # keys that a family of near copies shares are cut by a hash of the row
    hot = a.groupBy(F.col("_table").alias("_t"), F.col("_key").alias("_k")).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_KEY)
    hot = stored(hot.select("_t", "_k", F.ceil(F.col("_n") / HOT_KEY).cast("int").alias("_parts")), "hot")
    a = a.join(hot, (F.col("_table") == F.col("_t")) & (F.col("_key") == F.col("_k")), "left").drop("_t", "_k")
    a = a.withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*other), F.col("_parts"))).cast("int")).drop("_parts")
    q = queries.select("fingerprint").distinct().select(*lanes, F.posexplode(blocks).alias("_at", "_block"))
    q = q.withColumn("_mask", F.explode(F.array(*map(F.lit, masks)))).withColumn("_probe", F.col("_block").bitwiseXOR(F.col("_mask")))
    q = q.drop("_block", "_mask").join(hot, (F.col("_at") == F.col("_t")) & (F.col("_probe") == F.col("_k")), "left").drop("_t", "_k")
    q = q.withColumn("_of", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")

    differ = [F.col(x).bitwiseXOR(F.col(y)) for x, y in zip(own, other)]
    distance = sum((F.bit_count(x) for x in differ), F.lit(0))
    within = F.array(*[F.bit_count(F.shiftrightunsigned(x, 64 - size - at).bitwiseAND(F.lit((1 << size) - 1))) <= flips
                       for x in differ for at in range(0, 64, size)])
    d = q.join(a, (F.col("_at") == F.col("_table")) & (F.col("_probe") == F.col("_key")) & (F.col("_of") == F.col("_part"))
               & (distance <= radius) & (F.array_position(within, True) == F.col("_at") + 1))
    text = lambda c: F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in c]))
    return d.groupBy(*own).agg(F.sum("_rows").alias("n_near"), F.array_sort(F.collect_list(text(other))).alias("near")).select(
        text(own).alias("fingerprint"), "n_near", "near")
