"""Grouped prefix join: documents whose shingle sets have a Jaccard similarity
of at least a threshold, and their connected components.

Shingles are hashed and put in one order for all documents: by the power of two of
their frequency (frequent ones last), then by hash.  Two similar sets share a shingle within their prefixes, the first
|x| - ceil(t |x|) + 1 ones.  Sets with the same prefix and size form a group;
groups that share prefix shingles and pass the size and overlap bounds are
expanded, and members are verified on the words themselves.

Only components are asked for, so a pair is verified only while its ends are
not yet known to be connected: first each group is held against its most
central neighbour and its own first member, then all remaining candidates
across the components found so far are verified.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import per_text, small_batches, stored, temporary_tables
from procura.llm.components import connected_components

WORDS_HELD = 50_000
#: shingles in more sets than this go behind the others, by the power of two of their frequency
FREQUENT = 8
#: so many of them at most (the most frequent); the order of the rest is by
#: hash, and any common order gives the same result
MAX_FREQUENT = 500_000
#: open shingles before a shared one by which a pair that is made elsewhere is told
BEHIND = 3
#: bits of a parity, 64 a long
PARITY = 512
#: shingles of more open rows than this are joined on the whole parities; the
#: others, which make at most so many pairs a row, on 128 bits
COMMON = 32
#: key tables of at most so many rows (16 bytes each) are broadcast
MAX_KEYS = 500_000
#: rows of a shingle that meet in one task when all links are asked for
BLOCK = 1_000


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased: both methods of bytes know ASCII
    letters and ASCII white space only."""
    return (text or b"").lower().split()


def shingle_set(text: bytes | None, width: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


class _Hashes(dict):
    """Hashes of words; the first WORDS_HELD are held."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORDS_HELD:
            self[word] = h
        return h


def hasher(width: int):
    """A function of a text: its distinct shingles' 64-bit hashes, ascending."""
    known = _Hashes()
    factor = np.uint64(0x9E3779B97F4A7C15)

    def hashes(text: bytes | None) -> np.ndarray:
        w = words(text)
        if not w:
            return np.empty(0, np.int64)
        h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
        k = min(width, len(w))
        out = h[:len(w) - k + 1] + np.uint64(k)
        for i in range(1, k):
            out *= factor
            out += h[i:len(w) - k + 1 + i]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        out = np.sort(out.view(np.int64))
        return out[np.concatenate([[True], out[1:] != out[:-1]])]

    return hashes


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest()


def parity(hashes: np.ndarray) -> np.ndarray:
    """PARITY bits in longs: bit i is the parity of the hashes that fall on i.
    Two sets differ in at least as many elements as their parities in bits."""
    bits = np.bincount(hashes & (PARITY - 1), minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def stored_length(n: int, percent: int) -> int:
    """So much of the order by hash is stored: half as much again as the
    prefix, so that most prefixes without frequent shingles come from it."""
    return min(n, prefix_length(n, percent) * 3 // 2)


def _prefix(hashes: np.ndarray, n: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray | None:
    """Prefix of a set of n shingles of which the first ``hashes`` are given;
    None where they do not tell.  ``frequent``: hashes, ascending, and levels."""
    known, levels = frequent
    p = prefix_length(n, percent)
    if not len(known):
        return hashes[:p]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    level = np.where(known[at] == hashes, levels[at], 0)
    first = hashes[level == 0]
    if len(first) >= p:
        return first[:p]
    return hashes[np.argsort(level, kind="stable")[:p]] if len(hashes) == n else None


def _group(prefix: np.ndarray, n: int) -> bytes:
    return _digest(np.ascontiguousarray(prefix).tobytes(), str(n).encode())


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, hash of the text, size, digest and parity of its set, and
    the first of its shingles in the order by hash."""
    def start():
        hashes = hasher(width)

        def run(texts):
            sets = [hashes(t) for t in texts]
            return ([len(s) for s in sets], [_digest(s.tobytes()) for s in sets],
                    [s[:stored_length(len(s), percent)] if len(s) else s for s in sets], [parity(s) for s in sets])
        return run

    d = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("_th"))
    return per_text(d, ["doc_id", "_th"], {"_n": "int", "_set": "binary", "_first": "array<long>",
                                      "_parity": "array<long>"}, start)


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """_id, _n and text (UTF-8) of the rows of ``docs`` that ``keys`` (_id, _n,
    doc_id, _th) names.  The keys are broadcast after counting at most MAX_KEYS."""
    k = keys.select("_id", "_n", F.col("doc_id").alias("_doc"), F.col("_th").alias("_key"))
    if k.limit(MAX_KEYS + 1).count() <= MAX_KEYS:
        k = F.broadcast(k)
    d = docs.select("doc_id", "text")
    d = d.join(k, (F.xxhash64("text") == F.col("_key")) & d["doc_id"].eqNullSafe(k["_doc"]))
    return d.select("_id", "_n", F.col("text").cast("binary").alias("text"))


def _frequent(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the frequent ones among all stored shingles, and their levels."""
    found = nodes.select(F.explode("_first").alias("_token")).groupBy("_token").agg(F.count("*").alias("_df"))
    rows = stored(found.filter(F.col("_df") > FREQUENT), "frequent").orderBy(F.desc("_df"), "_token").limit(MAX_FREQUENT)
    rows = rows.select("_token", F.floor(F.log2("_df")).cast("int").alias("_level")).toArrow()
    token, level = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(token)
    return token[order], level[order].astype(np.int8)


def _with_prefixes(docs: DataFrame, nodes: DataFrame, frequent: tuple, width: int, percent: int) -> DataFrame:
    """The nodes with their prefixes, frequent shingles last, and groups.  Where
    what is stored does not hold the prefix, the text is read again."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def made(lists, sizes):
        prefixes = [_prefix(f, n, percent, shared.value) for f, n in zip(lists, sizes)]
        return prefixes, [None if p is None else _group(p, n) for p, n in zip(prefixes, sizes)]

    out = {"_prefix": "array<long>", "_group": "binary"}
    known = stored(_from_stored(nodes, made), "prefixes")

    def start():
        hashes = hasher(width)

        def run(texts):
            sets = [hashes(t) for t in texts]
            return made(sets, [len(s) for s in sets])
        return run

    rest = known.filter("_group IS NULL").drop("_prefix", "_group")
    if rest.isEmpty():
        return known
    again = stored(per_text(_texts(docs, rest), ["_id"], out, start), "prefixes").dropDuplicates(["_id"])
    again = rest.join(again, "_id").select(*known.columns)
    return stored(known.filter("_group IS NOT NULL").unionByName(again), "nodes")


def _from_stored(nodes: DataFrame, made) -> DataFrame:
    keep = ["_id", "_n", "doc_id", "_th", "_parity"]

    def run(batches):
        for batch in batches:
            first, sizes = batch.column("_first"), batch.column("_n").to_pylist()
            values, at = first.flatten().to_numpy(), np.concatenate([[0], np.cumsum(first.value_lengths().to_numpy())])
            prefixes, groups = made([values[a:b] for a, b in zip(at, at[1:])], sizes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(prefixes, pa.list_(pa.int64())), pa.array(groups, pa.binary())],
                names=[*keep, "_prefix", "_group"])

    kind = nodes.schema["doc_id"].dataType.simpleString()
    return nodes.select(*keep, "_first").mapInArrow(
        run, f"_id long, _n int, doc_id {kind}, _th long, _parity array<long>, _prefix array<long>, _group binary")


def _entries(nodes: DataFrame) -> DataFrame:
    return nodes.select("_id", "_n", F.posexplode("_prefix").alias("_pos", "_token"))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar, on the words themselves."""
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()
    texts = stored(_texts(docs, nodes.select("_id", "_n", "doc_id", "_th").join(ids, "_id", "left_semi")), "texts")
    texts = texts.dropDuplicates(["_id"])
    d = pairs.join(texts.select(F.col("_id").alias("a"), F.col("text").alias("_left")), "a")
    d = d.join(texts.select(F.col("_id").alias("b"), F.col("text").alias("_right")), "b")

    small_batches(docs.sparkSession)

    def check(batches):
        for batch in batches:
            keep, last, left = [], None, set()
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("_left"), batch.column("_right")):
                if a != last:
                    last, left = a, shingle_set(x.as_py(), width)
                right = shingle_set(y.as_py(), width)
                both = len(left & right)
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(d.mapInArrow(check, "a long, b long"), "links")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _star_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """One pair for each group: with the group that is the most central one of
    most of its shared shingles.  Central: its prefix is shared by many."""
    share = entries.groupBy("_id").agg((F.sum(F.log("_df")) / F.first("_p")).alias("_share"))
    e = stored(entries.join(share, "_id"), "central")
    top = e.groupBy("_token").agg(F.max(F.struct("_share", "_id", "_n")).alias("_top"))
    d = e.join(top, "_token").filter((F.col("_id") != F.col("_top._id")) & _sizes_fit(F.col("_n"), F.col("_top._n"), percent))
    d = d.groupBy("_id", F.col("_top._id").alias("_with")).agg(F.count("*").alias("_c"))
    return d.groupBy(F.col("_id").alias("a")).agg(F.max_by("_with", F.struct("_c", "_with")).alias("b"))


def _bits(p: Column, q: Column) -> Column:
    """Bits in which two parities differ."""
    return sum((F.bit_count(p[i].bitwiseXOR(q[i])) for i in range(PARITY // 64)), F.lit(0))


def _folded(p: Column) -> list[Column]:
    """A parity of 128 bits, two longs: each bit is that of some of the bits of ``p``."""
    longs = [p[i] for i in range(PARITY // 64)]
    half = len(longs) // 2
    return [reduce(Column.bitwiseXOR, part) for part in (longs[:half], longs[half:])]


def _may_be_similar(percent: int, differ: Column) -> Column:
    """Whether sets of sizes _n and _n2 that differ in at least ``differ`` elements
    may have the overlap of similar sets."""
    need = F.ceil(percent * (F.col("_n") + F.col("_n2")) / F.lit(100 + percent))
    return _sizes_fit(F.col("_n"), F.col("_n2"), percent) & (F.col("_n") + F.col("_n2") - differ >= 2 * need)


def _open_pairs(entries: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """Pairs of units (members of a group in one component) of different
    components that share a shingle at the fronts of their orders and whose parities allow
    a link: of 128 bits (``_sketch`` and ``_other``, no member's is farther than ``_radius``),
    where more than COMMON rows meet whole ones (``_center`` and ``_far``).  A family of near
    copies meets at a few shingles, and 128 bits hardly tell its pairs from links.

    A pair that shares one of the BEHIND open shingles before a shingle in either
    order is made at that one, so most pairs are made once or twice, not at each
    shingle that they share."""
    # size, place and the unit's radius in one number: rows stay narrow
    packed = (F.shiftleft(F.col("_n").cast("long"), 36) + F.shiftleft(F.col("_pos").cast("long"), 8) + F.col("_radius")).alias("_k")
    e = entries.select("_token", "_id", "_n", "_pos").join(
        units.select(F.col("_rep").alias("_id"), "_unit", "_component", "_sketch", "_other", "_radius"), "_id")
    e = e.select("_token", "_unit", "_component", "_sketch", "_other", packed)
    many = e.groupBy("_token").agg(F.min("_component").alias("_lo"), F.max("_component").alias("_hi"), F.count("*").alias("_rows"))
    e = e.join(many.filter("_lo <> _hi").select("_token", (F.col("_rows") > COMMON).alias("_common")), "_token")
    order = W.partitionBy("_unit").orderBy("_k")
    e = stored(e.withColumns({f"_b{i}": F.lag("_token", i).over(order) for i in range(1, BEHIND + 1)}), "open")
    n, n2 = F.shiftright("_k", 36), F.shiftright("_k2", 36)
    place, radius = (lambda k: F.shiftright(k, 8).bitwiseAND((1 << 28) - 1)), (lambda k: F.col(k).bitwiseAND(255))
    # a similar pair shares a shingle within these fronts of its two orders
    need = F.ceil(percent * (n + n2) / F.lit(100 + percent))
    made = reduce(or_, (F.col(f"_b{i}") == F.col(f"_b{j}2") for i in range(1, BEHIND + 1) for j in range(1, BEHIND + 1)))

    def met(e: DataFrame, differ: Column) -> DataFrame:
        o = e.select("_token", *[F.col(c).alias(c + "2") for c in e.columns if c != "_token"])
        d = e.join(o, (e["_token"] == o["_token"]) & (F.col("_unit") < F.col("_unit2")) & (F.col("_component") != F.col("_component2"))
                   & _sizes_fit(n, n2, percent) & (place("_k") <= n - need) & (place("_k2") <= n2 - need)
                   & (n + n2 - differ >= 2 * need) & ~F.coalesce(made, F.lit(False)))
        return d.select("_unit", "_unit2")

    few = met(e.filter("NOT _common").drop("_common"),
              F.bit_count(F.col("_sketch").bitwiseXOR(F.col("_sketch2"))) + F.bit_count(F.col("_other").bitwiseXOR(F.col("_other2")))
              - radius("_k") - radius("_k2"))
    common = e.filter("_common").drop("_common", "_sketch", "_other").join(units.select("_unit", "_center", "_far"), "_unit")
    common = met(common, _bits(F.col("_center"), F.col("_center2")) - F.col("_far") - F.col("_far2"))
    return few.unionByName(common).distinct()


def _named(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, _th, n_shingles, _id and its component _c."""
    with temporary_tables(docs.sparkSession):
        return stored(_components(docs, width, percent), "named", outlives=True)


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    rows = stored(_sets(docs, width, percent).withColumn("_id", F.monotonically_increasing_id()), "sets")
    some = rows.filter("_n > 0")
    # equal sets: one node, the row with the least id
    first = some.groupBy("_set").agg(F.min("_id").alias("_node"), F.count("*").alias("_copies"))
    copies = some.join(first.filter("_copies > 1"), "_set").select("_id", "_node")
    copies = stored(copies.filter("_id <> _node"), "copies")
    nodes = some.join(copies, "_id", "left_anti").drop("_set")
    nodes = _with_prefixes(docs, nodes, _frequent(nodes), width, percent)
    # groups: equal prefix and size
    first = nodes.groupBy("_group").agg(F.min("_id").alias("_rep"), F.count("*").alias("_members"))
    members = nodes.select("_id", "_group").join(first.filter("_members > 1"), "_group")
    members = stored(members.filter("_id <> _rep").select("_id", "_rep"), "members")
    reps = nodes.join(members.select("_id"), "_id", "left_anti")
    by_token = W.partitionBy("_token")
    entries = _entries(reps).withColumn("_df", F.count("*").over(by_token)).filter("_df > 1")
    entries = entries.withColumn("_p", (F.col("_n") - F.ceil(F.lit(percent) * F.col("_n") / 100) + 1).cast("int"))
    entries = stored(entries, "entries")

    pairs = _star_pairs(entries, percent).unionByName(members.select(F.col("_id").alias("a"), F.col("_rep").alias("b")))
    links = _verified(docs, nodes, pairs, width, percent)
    found = stored(connected_components(links), "components")
    # every group's members by component; a unit is named by its least member
    of = nodes.select("_id", "_n", "_parity").join(members, "_id", "left").withColumn("_rep", F.coalesce("_rep", "_id"))
    of = of.join(found.withColumnRenamed("node", "_id"), "_id", "left")
    of = stored(of.select("_id", "_rep", "_n", "_parity", F.coalesce("component", "_id").alias("_component")), "units")
    units = of.groupBy("_rep", "_component").agg(F.min(F.struct("_id", "_parity")).alias("_first"))
    units = units.select("_rep", "_component", F.col("_first._id").alias("_unit"), F.col("_first._parity").alias("_center"))
    of = stored(of.join(units, ["_rep", "_component"]), "members")
    # no member's parity is farther from the first one's than the radius
    sketch, other = _folded(F.col("_center"))
    moved = sum((F.bit_count(p.bitwiseXOR(q)) for p, q in zip(_folded(F.col("_parity")), (sketch, other))), F.lit(0))
    balls = stored(of.groupBy("_rep", "_component", "_unit", "_n", "_center").agg(
        F.max(_bits(F.col("_parity"), F.col("_center"))).alias("_far"),
        F.max(moved).alias("_radius")), "balls")
    open_ = _open_pairs(entries, balls.withColumns({"_sketch": sketch, "_other": other}), percent)
    open_ = open_.join(balls.select("_unit", "_n", "_center", "_far").toDF("_unit2", "_n2", "_center2", "_radius2"), "_unit2")
    left = of.select(F.col("_unit").alias("_of"), F.col("_id").alias("a"), "_n", "_parity")
    near = _bits(F.col("_parity"), F.col("_center2")) - F.col("_radius2")
    open_ = open_.join(left, (open_["_unit"] == left["_of"]) & _may_be_similar(percent, near)).select("_unit2", "a", "_n", "_parity")
    right = of.select(*[F.col(c).alias(d) for c, d in (("_unit", "_of"), ("_id", "b"), ("_n", "_n2"), ("_parity", "_parity2"))])
    differ = _bits(F.col("_parity"), F.col("_parity2"))
    across = open_.join(right, (open_["_unit2"] == right["_of"]) & _may_be_similar(percent, differ))
    within = of.groupBy("_rep").agg(F.min("_component").alias("_lo"), F.max("_component").alias("_hi")).filter("_lo <> _hi")
    apart = of.join(within, "_rep").select("_rep", F.col("_id").alias("a"), "_component", "_n", "_parity")
    other = apart.select(*[F.col(c).alias(d) for c, d in (("_rep", "_rep2"), ("a", "b"), ("_component", "_component2"),
                                                          ("_n", "_n2"), ("_parity", "_parity2"))])
    same = apart.join(other, (F.col("_rep") == F.col("_rep2")) & (F.col("a") < F.col("b"))
                      & (F.col("_component") != F.col("_component2")) & _may_be_similar(percent, differ))
    pairs = across.select("a", "b").unionByName(same.select("a", "b"))
    links = links.unionByName(_verified(docs, nodes, pairs, width, percent))
    found = stored(connected_components(links), "components")

    d = rows.select("doc_id", "_th", F.col("_n").cast("long").alias("n_shingles"), "_id").join(copies, "_id", "left")
    d = d.withColumn("node", F.coalesce("_node", "_id")).join(found, "node", "left")
    return d.select("doc_id", "_th", "n_shingles", "_id", F.coalesce("component", "node").alias("_c"))


def _classes(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, _th, n_shingles, _id, class_id) and nodes, one for each
    distinct set, with prefixes and groups."""
    rows = stored(_sets(docs, width, percent).withColumn("_id", F.monotonically_increasing_id()), "sets")
    some = rows.filter("_n > 0")
    first = some.groupBy("_set").agg(F.min("_id").alias("_node"), F.count("*").alias("_copies"))
    copies = some.join(first.filter("_copies > 1"), "_set").select("_id", "_node")
    copies = stored(copies.filter("_id <> _node"), "copies")
    nodes = some.join(copies, "_id", "left_anti").drop("_set")
    nodes = _with_prefixes(docs, nodes, _frequent(nodes), width, percent)
    rows = rows.select("doc_id", "_th", F.col("_n").cast("long").alias("n_shingles"), "_id").join(copies, "_id", "left")
    return rows.withColumn("class_id", F.coalesce("_node", "_id")).drop("_node"), nodes


def jaccard_links(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links, not only those that connect.  Members: per row of ``docs``
    doc_id, n_shingles, class_id (rows with equal sets share one) and n_links, the
    number of other rows with a similarity of at least percent / 100.  Pairs:
    class_a < class_b of all similar classes.  Rows without words have no links.

    Every pair of groups that shares a prefix shingle is expanded and verified
    unless a bound excludes it; groups with the same prefix and size are paired
    among themselves.  Tokens of many sets are joined in blocks."""
    with temporary_tables(docs.sparkSession):
        rows, nodes = _classes(docs, width, percent)
        rows = stored(rows, "members", outlives=True)
        e = _entries(nodes).join(nodes.select("_id", "_parity"), "_id")
        e = e.withColumn("_p", (F.col("_n") - F.ceil(F.lit(percent) * F.col("_n") / 100) + 1).cast("int"))
        # blocks of a token: each row meets the rows of its own and of all later blocks
        df = e.groupBy("_token").agg(F.count("*").alias("_df")).filter("_df > 1")
        e = e.join(df.select("_token", F.ceil(F.col("_df") / BLOCK).cast("int").alias("_blocks")), "_token")
        e = stored(e.withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")), "entries")
        o = e.select("_token", F.col("_block").alias("_block2"),
                     *[F.col(c).alias(c + "2") for c in ("_id", "_parity", "_n", "_p", "_pos")])
        e = e.withColumn("_block2", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        need = F.ceil(percent * (F.col("_n") + F.col("_n2")) / F.lit(100 + percent))
        differ = _bits(F.col("_parity"), F.col("_parity2"))
        d = e.join(o, ["_token", "_block2"]).filter(
            (F.col("_id") < F.col("_id2")) & _sizes_fit(F.col("_n"), F.col("_n2"), percent)
            & (F.col("_n") + F.col("_n2") - differ >= 2 * need))
        links = _verified(docs, nodes, d.select(F.col("_id").alias("a"), F.col("_id2").alias("b")), width, percent)
        links = stored(links, "pairs", outlives=True)
        sizes = rows.filter("n_shingles > 0").groupBy("class_id").agg(F.count("*").alias("_rows"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        far = both.join(sizes.select(F.col("class_id").alias("b"), "_rows"), "b").groupBy("a").agg(F.sum("_rows").alias("_far"))
        n = sizes.join(far, F.col("class_id") == F.col("a"), "left").select(
            F.col("class_id").alias("_class"), (F.col("_rows") - 1 + F.coalesce("_far", F.lit(0))).alias("_links"))
        n = stored(n, "counts", outlives=True)
    members = rows.join(n, F.col("class_id") == F.col("_class"), "left")
    members = members.select("doc_id", "n_shingles", "class_id", F.coalesce("_links", F.lit(0)).alias("n_links"))
    return members, links.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles (distinct shingles of ``width``
    words; fewer words: the whole sequence as one) and component_id, the least
    doc_id that links reach: pairs with 100 x intersection >= percent x union.

    Null and empty text: no shingles, component_id is the doc_id.  Null doc_id:
    a row like any other; component_id is null only where the whole component
    has none.  Repeated rows link to each other.  Other columns are ignored.
    Empty input gives no rows.

    Text is read again, by key, for verification, so no set is ever stored or
    shuffled whole."""
    d = _named(docs, width, percent)
    names = d.groupBy(F.col("_c").alias("_of")).agg(F.min("doc_id").alias("component_id"))
    return d.join(names, F.col("_c") == F.col("_of")).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row
    with the least doc_id stays (null last; of equal rows one).  Texts without
    words are in no group and stay."""
    d = _named(docs, width, percent).filter("n_shingles > 0")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_th"))
    first = d.groupBy(F.col("_c").alias("_of")).agg(F.min(rank).alias("_first"))
    d = d.join(first, F.col("_c") == F.col("_of")).withColumn("_stays", F.col("_first").eqNullSafe(rank))
    gone = stored(d.filter("NOT _stays").select(F.col("doc_id").alias("_doc"), F.col("_th").alias("_key")).distinct(), "gone")
    if gone.limit(MAX_KEYS + 1).count() <= MAX_KEYS:
        gone = F.broadcast(gone)
    out = docs.join(gone, (F.xxhash64("text") == F.col("_key")) & docs["doc_id"].eqNullSafe(F.col("_doc")), "left_anti")
    again = d.filter("_stays").groupBy("doc_id", "_th").agg(F.count("*").alias("_n")).filter("_n > 1")
    if again.isEmpty():
        return out
    # rows equal in doc_id and text: one stays, where there are words
    return out.filter(~_has_words()).unionByName(out.filter(_has_words()).dropDuplicates(["doc_id", "text"]))


def _has_words() -> Column:
    return F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
