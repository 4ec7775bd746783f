"""Hard negatives by exact integer scores (the method of the Four Russians).

A candidate's integer components are stored as bit planes: for each plane and each
group of eight dimensions one byte.  For a group, an anchor's 256 subset sums are
computed once; a candidate's byte looks one up, and the planes are added with their
shifts (the top plane, the sign of two's complement, is subtracted).  The sums are
the full inner products.

Anchors and candidates are cut into blocks; every pair of blocks is one group of a
co-grouped task, which returns only the best of its own pairs, and the best of the
blocks are merged by rank.  Positives are taken from rows of the anchor's label,
negatives from all other rows, so each pair is scored once.

Defined cases.  Rows with a null label, a null vector, or a null or non-finite
component take no part, nor do rows with a component beyond LARGEST (their products
may not fit 64 bits).  Vectors of different lengths: missing components count as 0;
a vector without components scores 0.  Repeated rows are rows of their own: each is
an anchor, positive or negative by itself, and "other rows" leaves out only the row
itself.  A null vec_id is no anchor and follows all others among equal scores.
Columns beside the three named ones are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import small_batches, stored, temporary_tables

GROUP = 8
#: components floor(scale * x) may be as large as this, up or down
LARGEST = 1 << 25
#: anchors of a block, and of one set of tables (which stay in a core's cache)
ANCHOR_BLOCK, ANCHOR_SLICE = 4096, 128
#: candidates of a block: at least, and at most
LEAST_BLOCK, MOST_BLOCK = 8192, 65536
SLICE = 1024
LAST_ID = np.iinfo(np.int64).max


def _pad(values: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``lengths`` values as a matrix, filled up with zeros."""
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def to_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of integer ``vectors`` (rows, dimensions), the
    sign's plane last; dimensions are a multiple of GROUP."""
    bits = (vectors[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def from_planes(packed: np.ndarray) -> np.ndarray:
    """The integer vectors of ``to_planes``."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weight = 1 << np.arange(packed.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.tensordot(bits, weight, axes=(1, 0))


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of an anchor's components at
    the byte's set bits."""
    groups = anchors.shape[1] // GROUP
    out = np.zeros((groups, 1 << GROUP, len(anchors)), kind)
    for bit in range(GROUP):
        out[:, 1 << bit:2 << bit] = out[:, :1 << bit] + anchors.T[bit::GROUP][:groups, None, :]
    return out


def scores(packed: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products by lookups, shifts and additions."""
    n, planes, groups = packed.shape
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    found = np.empty((min(n, SLICE), tables.shape[2]), tables.dtype)
    for at in range(0, n, SLICE):
        acc, some = out[at:at + SLICE], packed[at:at + SLICE].astype(np.intp)
        tmp = found[:len(acc)]
        for plane in reversed(range(planes)):
            if plane < planes - 1:
                np.left_shift(acc, 1, out=acc)
            for g in range(groups):
                np.take(tables[g], some[:, plane, g], axis=0, out=tmp, mode="clip")
                (np.subtract if plane == planes - 1 else np.add)(acc, tmp, out=acc)
    return out


def first(score: np.ndarray, ids: np.ndarray, absent: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, best first: higher scores, then smaller ids, null last."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], absent[at], -score[at]))[:k]]


class _Side:
    """One side of a pair of blocks, as arrays ordered by label."""

    def __init__(self, table: pa.Table, planes: int, groups: int):
        table = table.combine_chunks()
        order = np.argsort(table.column("label").to_numpy(), kind="stable")
        self.label, self.rid = (table.column(c).to_numpy()[order] for c in ("label", "rid"))
        ids = table.column("vec_id")
        self.absent = ids.is_null().to_numpy(zero_copy_only=False)[order]
        self.ids = ids.fill_null(LAST_ID).to_numpy()[order]
        packed = table.column("planes")
        joined = b"".join(packed.to_pylist())
        self.packed = np.frombuffer(joined, np.uint8).reshape(len(order), planes, groups)[order]
        self.order = order

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))


def _id_array(ids: list, absent: list) -> pa.Array:
    return pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64),
                    mask=np.concatenate(absent) if absent else np.zeros(0, bool))


def _joined(parts: list, kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


def packed_vectors(vectors: DataFrame, scale: int = 256) -> tuple[DataFrame, int, int]:
    """``vectors`` (vec_id long, label int, embedding array of numbers) as rows of
    bit planes (rid, vec_id, label, planes), with the number of planes and groups."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) <= F.lit(LARGEST / scale)))
    d = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
         .filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
         .select("vec_id", "label", whole.alias("ints")))
    seen = d.agg(F.max(F.size("ints")).alias("size"), F.min(F.array_min("ints")).alias("low"),
                 F.max(F.array_max("ints")).alias("high")).first()
    groups = max(1, -(-(seen["size"] or 0) // GROUP))
    planes = 1 + max(int(max(seen["high"] or 0, 0)).bit_length(), int(~min(seen["low"] or 0, 0) if (seen["low"] or 0) < 0 else 0).bit_length())

    def pack(batches):
        for b in batches:
            ints = b.column("ints")
            lengths = np.diff(ints.offsets.to_numpy())
            rows = to_planes(_pad(ints.flatten().to_numpy(), lengths, groups * GROUP), planes)
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), packed], names=["vec_id", "label", "planes"])

    packed = d.mapInArrow(pack, "vec_id long, label int, planes binary")
    return packed.withColumn("rid", F.monotonically_increasing_id()), planes, groups


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _pairs(candidates: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both sides co-grouped by (candidate block, anchor block)."""
    size = min(MOST_BLOCK, max(LEAST_BLOCK, n_rows // 64))
    right, left = _blocks(n_rows, size), _blocks(n_anchors, ANCHOR_BLOCK)
    place = lambda blocks: F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    c = candidates.withColumn("_block", place(right)).withColumn("_ablock", every(left))
    a = anchors.withColumn("_ablock", place(left)).withColumn("_block", every(right))
    return c.groupBy("_block", "_ablock").cogroup(a.groupBy("_block", "_ablock"))


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """For every anchor and each of its ``positives`` best other rows of the same
    label: the ``negatives`` best rows of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's.

    ``anchors``: condition on vec_id and label.  Returns anchor_id, positive_id,
    positive_rank, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    small_batches(spark)
    with temporary_tables(spark):
        packed, planes, groups = packed_vectors(vectors, scale)
        rows = stored(packed, "planes")
        asked = rows.filter(anchors)
        n, n_asked = rows.count(), asked.count()
        small = 2 * GROUP * groups * (1 << 2 * (planes - 1)) < 1 << 31
        kind = np.int32 if small else np.int64

        def slices(side: _Side):
            """Anchors of one label, a few at a time, with their tables."""
            for label in np.unique(side.label):
                of = side.of_label(label)
                for at in range(of.start, of.stop, ANCHOR_SLICE):
                    some = np.arange(at, min(at + ANCHOR_SLICE, of.stop))
                    yield int(label), some, subset_sums(from_planes(side.packed[some]), kind)

        def nearest(cand: pa.Table, anch: pa.Table) -> pa.Table:
            out = [[], [], [], [], []]
            if cand.num_rows and anch.num_rows:
                c, a = _Side(cand, planes, groups), _Side(anch, planes, groups)
                for label, some, tables in slices(a):
                    of = c.of_label(label)
                    if of.start == of.stop:
                        continue
                    got = scores(c.packed[of], tables)
                    for i, anchor in enumerate(some):
                        other = np.flatnonzero(c.rid[of] != a.rid[anchor])
                        best = other[first(got[other, i], c.ids[of][other], c.absent[of][other], positives)]
                        for o, x in zip(out, ([a.rid[anchor]] * len(best), c.rid[of][best], c.ids[of][best], c.absent[of][best], got[best, i])):
                            o.append(np.asarray(x))
            return pa.table([pa.array(_joined(out[0], np.int64)), pa.array(_joined(out[1], np.int64)), _id_array(out[2], out[3]),
                             pa.array(_joined(out[4], np.int64))], names=["anchor", "other", "positive_id", "positive_score"])

        found = _pairs(rows, asked, n, n_asked).applyInArrow(nearest, "anchor long, other long, positive_id long, positive_score long")
        best = W.partitionBy("anchor").orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last(), "other")
        found = found.withColumn("positive_rank", F.row_number().over(best)).filter(F.col("positive_rank") <= positives)
        # at most ``positives`` entries a list
        lists = found.groupBy("anchor").agg(F.array_sort(F.collect_list(
            F.struct("positive_rank", "positive_id", "positive_score"))).alias("positives"))
        asked = stored(asked.join(lists, asked["rid"] == lists["anchor"]).drop("anchor"), "positives")

        def between(cand: pa.Table, anch: pa.Table) -> pa.Table:
            out = [[], [], [], [], [], [], []]
            if cand.num_rows and anch.num_rows:
                c, a = _Side(cand, planes, groups), _Side(anch, planes, groups)
                lists = anch.column("positives").combine_chunks().take(pa.array(a.order)).to_pylist()
                for label, some, tables in slices(a):
                    of = c.of_label(label)
                    for part in (slice(0, of.start), slice(of.stop, len(c.label))):
                        if part.start == part.stop:
                            continue
                        got = scores(c.packed[part], tables)
                        ids, absent, rid = c.ids[part], c.absent[part], c.rid[part]
                        for i, anchor in enumerate(some):
                            score = got[:, i].astype(np.int64)
                            for p in lists[anchor]:
                                wanted = p["positive_score"]
                                at = np.flatnonzero((score >= -(-low * wanted // 100)) & (score <= high * wanted // 100))
                                at = at[first(score[at], ids[at], absent[at], negatives)]
                                k = len(at)
                                for o, x in zip(out, (np.full(k, a.rid[anchor]), np.full(k, p["positive_rank"]), rid[at], ids[at],
                                                      absent[at], score[at])):
                                    o.append(x)
            return pa.table([pa.array(_joined(out[0], np.int64)), pa.array(_joined(out[1], np.int32)), pa.array(_joined(out[2], np.int64)),
                             _id_array(out[3], out[4]), pa.array(_joined(out[5], np.int64))],
                            names=["anchor", "positive_rank", "other", "negative_id", "negative_score"])

        mined = _pairs(rows, asked, n, n_asked).applyInArrow(
            between, "anchor long, positive_rank int, other long, negative_id long, negative_score long")
        best = W.partitionBy("anchor", "positive_rank").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "other")
        mined = mined.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
        told = asked.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p"))
        told = told.select("anchor", "anchor_id", "p.*")
        out = mined.join(told, ["anchor", "positive_rank"])
        return stored(out.select("anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"),
                      "negatives", outlives=True)
