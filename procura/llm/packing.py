"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so an instance of any number of
pieces is a histogram of at most ``capacity`` counts.  The reduction fixes bins
that dominate every alternative for their largest piece, many equal bins at a
time; best-fit decreasing packs the rest the same way.  The result is a short
list of bin patterns with multiplicities; Spark ranks the pieces of each length
and gives each rank its place in a pattern.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import running_before, small_batches, stored

CAPACITY = 2048
END_ID = 0
ROWS = 512


def encoder(ranks_path: str):
    """A function of a text: the ids of its tokens and the end id."""
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array([*e.encode_ordinary(text or ""), END_ID], dtype="<u4")


def default_ranks() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but the first, which
    holds what is over."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length,
    ids_crc32 and, with ``keep_ids``, the ids themselves."""
    ranks_path = ranks_path or default_ranks()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int32())))

    def cut(batches):
        token_ids = encoder(ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, source = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = token_ids(text)
                    for k, (start, n) in enumerate(cut_points(len(ids), capacity)):
                        own = ids[start:start + n]
                        rows.append((k, start, n, zlib.crc32(own.tobytes()), *([own.astype("i4")] if keep_ids else [])))
                        source.append(i)
                columns = list(zip(*rows)) if rows else [[]] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(source, pa.int64())),
                     *[pa.array(c, t) for c, (_, t) in zip(columns, fields)]], names=["doc_id", *[n for n, _ in fields]])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _best_pair(sizes: list[int], count: list[int], room: int) -> int:
    """Largest sum of two pieces that fit into ``room``; sizes ascending."""
    best, lo, hi = 0, 0, len(sizes) - 1
    while lo <= hi:
        s = sizes[lo] + sizes[hi]
        if s > room:
            hi -= 1
        else:
            if lo < hi or count[sizes[lo]] >= 2:
                best = max(best, s)
            lo += 1
    return best


def _smallest(sizes: list[int], count: list[int], k: int) -> list[int]:
    out: list[int] = []
    for s in sizes:
        out += [s] * min(k - len(out), count[s])
        if len(out) == k:
            break
    return out


def reduce_histogram(count: list[int], capacity: int) -> Counter:
    """Takes dominating bins out of ``count`` (pieces by length) and returns
    them.  For the largest piece j with room r beside it:
    nothing fits: {j}; one piece l fills r, or no two pieces fit together:
    {j, l} with the largest l; at most two fit and l is as large as the best
    pair: {j, l}.  Each such bin dominates all bins that hold j, since what they
    hold besides j can be exchanged for l.  Repeated until nothing more is fixed."""
    fixed: Counter = Counter()
    changed = True
    while changed:
        changed = False
        j = capacity
        while j > 0:
            if not count[j]:
                j -= 1
                continue
            room = capacity - j
            count[j] -= 1
            sizes = [s for s in range(1, min(room, capacity) + 1) if count[s]]
            low = _smallest(sizes, count, 3)
            l = sizes[-1] if sizes else 0  # noqa: E741
            alone = not sizes
            pair = bool(sizes) and (l == room or len(low) < 2 or low[0] + low[1] > room
                                    or (len(low) < 3 or sum(low) > room) and l >= _best_pair(sizes, count, room))
            count[j] += 1
            if alone:
                fixed[(j,)] += count[j]
                count[j] = 0
            elif pair:
                n = count[j] // 2 if l == j else min(count[j], count[l])
                fixed[(j, l)] += n
                count[j] -= n
                count[l] -= n
            else:
                j -= 1
                continue
            changed = True
    return fixed


def best_fit(count: list[int], capacity: int) -> Counter:
    """Best-fit decreasing over a histogram: pieces go to the fullest bin that
    takes them; equal bins are filled together."""
    bins: dict[int, Counter] = defaultdict(Counter)
    for w in range(capacity, 0, -1):
        n = count[w]
        for room in [r for r in sorted(bins) if r >= w]:
            if not n:
                break
            each = room // w
            for pattern, m in list(bins[room].items()):
                full = min(m, n // each)
                rest = n - full * each if m > full and n < (full + 1) * each else 0
                for k, q in ((full, each), (1 if rest else 0, rest)):
                    if k:
                        bins[room][pattern] -= k
                        bins[room - q * w][pattern + (w,) * q] += k
                        n -= k * q
                if not bins[room][pattern]:
                    del bins[room][pattern]
        each = capacity // w
        if n // each:
            bins[capacity - each * w][(w,) * each] += n // each
        if n % each:
            bins[capacity - n % each * w][(w,) * (n % each)] += 1
    out: Counter = Counter()
    for by_pattern in bins.values():
        out.update(by_pattern)
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, each, sequence, offset): the pieces of a
    length with ranks first..last lie ``each`` to a sequence, one behind the
    other from ``offset``, in sequences numbered from ``sequence``."""
    count = [0] * (capacity + 1)
    for length, n in histogram.items():
        count[length] = n
    patterns = reduce_histogram(count, capacity)
    patterns.update(best_fit(count, capacity))
    rows, used, sequence = [], Counter(), 0
    for pattern, m in sorted(patterns.items()):
        offset = 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((length, used[length], used[length] + m * each - 1, each, sequence, offset))
            used[length] += m * each
            offset += length * each
        sequence += m
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents with sequence_id and offset.

    Null text: the end id alone.  Repeated rows, null doc_ids: separate
    documents.  Columns other than doc_id and text are ignored; empty input
    gives no rows.  The driver holds one count per length, at most ``capacity``."""
    digest = F.md5(F.concat_ws("|", "doc_id", "piece", "ids_crc32"))
    p = stored(pieces(docs, capacity, ranks_path, keep_ids).withColumn("_digest", digest), "pieces")
    histogram = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = p.sparkSession.createDataFrame(
        plan(histogram, capacity), "_length long, _first long, _last long, _each long, _sequence long, _offset long")
    p = running_before(p, "length", "_digest", F.lit(1), "_rank", sum(histogram.values()), 20_000)
    # the plan's size depends on the capacity, not on the data
    p = p.join(F.broadcast(places), (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last")))
    k = F.col("_rank") - F.col("_first")
    return p.select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("_sequence") + F.floor(k / F.col("_each"))).alias("sequence_id"),
                    (F.col("_offset") + k % F.col("_each") * F.col("length")).alias("offset"),
                    *(["ids"] if keep_ids else []))
