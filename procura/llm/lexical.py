"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through its normaliser m, a whole number;
documents with equal m form a stratum.  Within a stratum the postings of a term are
ordered by tf, so they fall into runs with one impact each, computed once a run, and
the first run bounds what the term can add to any document of the stratum.

The index is a table of pieces: one row holds (part of) one stratum of one segment,
with its documents, terms, runs and postings.  A search reads it once per block of
queries, without a shuffle: each task bounds every stratum it holds for every query,
visits the strata from the highest bound down, and stops at the first bound below the
query's k-th score.  The best of the tasks are merged by rank.  Strata and order
decide the work only, never a result.

Score of a document for a query: the sum over the query's terms, repeats included, of
w * ((10**9 * tf) div (1000 * tf + 12 * m)), with w = floor(1000 ln((2N + 2) / (2df + 1)))
and m = 75 + (25 * n * N) div L; N documents have a term, L is their length in terms, n
the document's, df the number of documents with the term.

Defined cases.  Terms are runs of ASCII letters and digits (A-Z lower-cased) and of all
characters beyond ASCII.  Null, empty and term-less texts are in no stratum and match
nothing; such queries return no rows, as do terms that no document holds.  Repeated
documents are ranked each; equal scores follow doc_id, null last.  A query repeated with
the same id and text is asked once; the same id with another text is a query of its own.
Columns beside the id and the text are not read.  Texts of any length are read whole; a
document's distinct terms stay in one task.
"""

from __future__ import annotations

from array import array
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import shared_path, small_batches, stored, temporary_tables

#: postings of a segment, and of a piece, at most (but for a single document's)
SEGMENT, PIECE = 1_000_000, 100_000
#: what a search task holds at once: postings (and documents), and strata
HELD, HELD_STRATA = 1_500_000, 256
#: pieces that are read from the index, and handed to Python, at once; bytes of a row group of the index
READ, ROW_GROUP = 8, 16 << 20
#: entries (query, term) of one block of queries, at most (but for a single query's)
BLOCK_ENTRIES = 20_000
LAST_ID = np.iinfo(np.int64).max

#: every byte that is no term's becomes a space, A-Z become a-z
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECES = ("m long, doc_ids array<long>, terms array<string>, n_docs array<int>, n_runs array<int>, "
          "run_tf array<long>, run_docs array<int>, docs array<int>")
_PIECES = pa.schema([("m", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())),
                     ("n_docs", pa.list_(pa.int32())), ("n_runs", pa.list_(pa.int32())), ("run_tf", pa.list_(pa.int64())),
                     ("run_docs", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32()))])


def terms_of(text: str | None) -> list[bytes]:
    """A text's terms, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


@dataclass
class Index:
    """``pieces`` and ``vocabulary`` (term, df) as stored tables; N and L."""
    pieces: DataFrame
    vocabulary: DataFrame
    n_docs: int
    n_terms: int


def _lengths(batches):
    for b in batches:
        n = [len(terms_of(t)) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], names=["docs", "terms"])


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(lengths)]


def _changes(*keys: np.ndarray) -> np.ndarray:
    """First places of the runs of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])


class _Segment:
    """Documents gathered until they are turned into pieces."""

    def __init__(self):
        self.words, self.ids, self.m, self.n = {}, [], [], []
        self.term, self.tf = array("i"), array("i")

    def add(self, doc_id, m: int, counts: Counter) -> None:
        words = self.words
        self.term.extend([words.setdefault(t, len(words)) for t in counts])
        self.tf.extend(counts.values())
        self.n.append(len(counts))
        self.ids.append(doc_id)
        self.m.append(m)

    def pieces(self):
        """Strata in order of m; a stratum beyond PIECE postings in several pieces.  They are
        made and given out in groups of about PIECE postings, so that what is sorted, and
        sent, at once does not grow with the segment."""
        text = pa.array([t.decode("utf-8", "replace") for t in self.words], pa.string())
        m, n = np.array(self.m, np.int64), np.array(self.n, np.int64)
        by_m = np.argsort(m, kind="stable")
        m, n, begin = m[by_m], n[by_m], (np.cumsum(n) - n)[by_m]
        before = np.cumsum(n) - n
        # a stratum's documents are numbered from its first posting on: every PIECE postings begin a piece
        first = _changes(m)
        inside = before - np.repeat(before[first], np.diff(np.r_[first, len(m)]))
        cut = _changes(m, inside // PIECE)
        groups = np.r_[_changes(before[cut] // PIECE), len(cut)]
        ends = np.r_[cut, len(m)]
        for a, b in zip(groups[:-1], groups[1:]):
            docs = slice(ends[a], ends[b])
            yield self._batch(text, by_m[docs], m[docs], n[docs], begin[docs], cut[a:b] - ends[a])

    def _batch(self, text: pa.Array, numbers: np.ndarray, m: np.ndarray, n: np.ndarray, begin: np.ndarray, cut: np.ndarray):
        """Pieces of the documents ``numbers``, in this order; ``cut``: where the pieces begin."""
        n_docs = np.diff(np.r_[cut, len(m)])
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        term, tf = np.frombuffer(self.term, np.int32)[at], np.frombuffer(self.tf, np.int32)[at]
        piece = np.repeat(np.repeat(np.arange(len(cut), dtype=np.int32), n_docs), n)
        doc = np.repeat(np.arange(len(m), dtype=np.int32) - np.repeat(cut, n_docs).astype(np.int32), n)
        # the sort is stable: equal tf stay in the documents' order
        order = np.lexsort((-tf, term, piece))
        piece, term, tf, doc = piece[order], term[order], tf[order], doc[order]
        runs = _changes(piece, term, tf)
        words = _changes(piece, term)
        run_piece, word_piece = piece[runs], piece[words]
        count = lambda x: np.bincount(x, minlength=len(cut))
        lists = lambda values, sizes: pa.ListArray.from_arrays(pa.array(_starts(sizes), pa.int32()), values)
        per_word = np.diff(np.r_[words, len(term)])
        runs_per_word = np.diff(np.r_[np.searchsorted(runs, words), len(runs)])
        return pa.RecordBatch.from_arrays([
            pa.array(m[cut]), lists(pa.array([self.ids[i] for i in numbers], pa.int64()), n_docs),
            lists(text.take(pa.array(term[words])), count(word_piece)),
            lists(pa.array(per_word, pa.int32()), count(word_piece)), lists(pa.array(runs_per_word, pa.int32()), count(word_piece)),
            lists(pa.array(tf[runs], pa.int64()), count(run_piece)), lists(pa.array(np.diff(np.r_[runs, len(term)]), pa.int32()), count(run_piece)),
            lists(pa.array(doc, pa.int32()), count(piece))], schema=_PIECES)


@contextmanager
def _few_pieces(spark: SparkSession):
    """Pieces are wide rows: inside, few of them are read, and handed to Python, at once."""
    keys = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(key) for key in keys]
    for key in keys:
        spark.conf.set(key, str(READ))
    try:
        yield
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


def build_index(docs: DataFrame) -> Index:
    """The index of ``docs`` (doc_id long, text string), stored in the shared folder.

    Texts are read twice: for N and L, then for the postings."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = docs.select("text").mapInArrow(_lengths, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = int(seen[0] or 0), int(seen[1] or 0)

    def segments(batches):
        segment = _Segment()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                terms = terms_of(text)
                if terms:
                    segment.add(doc_id, 75 + 25 * len(terms) * n_docs // n_terms, Counter(terms))
                    if len(segment.term) >= SEGMENT:
                        yield from segment.pieces()
                        segment = _Segment()
        if segment.m:
            yield from segment.pieces()
        pa.default_memory_pool().release_unused()

    # a row group is checked after every row: rows are wide, and both its writing and its reading hold it whole
    pieces = stored(docs.mapInArrow(segments, PIECES), "index", outlives=True,
                    **{"parquet.block.size": ROW_GROUP, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": READ})
    each = pieces.select(F.explode(F.arrays_zip("terms", "n_docs")).alias("x"))
    vocabulary = each.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.n_docs").alias("df"))
    with _few_pieces(spark):
        vocabulary = stored(vocabulary, "vocabulary", outlives=True)
    return Index(pieces, vocabulary, n_docs, n_terms)


def weighted_queries(index: Index, items: DataFrame) -> DataFrame:
    """(query, item_id, term, weight): ``weight`` is w times the term's repeats, for
    terms of the vocabulary; ``query`` numbers the distinct (item_id, text)."""
    def counted(batches):
        for b in batches:
            got = [Counter(terms_of(t)) for t in b.column("text").to_pylist()]
            size = [len(c) for c in got]
            yield pa.RecordBatch.from_arrays([
                b.column("query").take(pa.array(np.repeat(np.arange(len(size)), size))),
                b.column("item_id").take(pa.array(np.repeat(np.arange(len(size)), size))),
                pa.array([t.decode("utf-8", "replace") for c in got for t in c], pa.string()),
                pa.array([n for c in got for n in c.values()], pa.int64())], names=["query", "item_id", "term", "repeats"])

    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    terms = asked.mapInArrow(counted, "query long, item_id long, term string, repeats long")
    w = F.floor(1000 * F.log((2.0 * index.n_docs + 2) / (2.0 * F.col("df") + 1)))
    return stored(terms.join(index.vocabulary, "term").select("query", "item_id", "term", (w * F.col("repeats")).alias("weight")), "weights")


def _blocks(weights: DataFrame):
    """Queries in blocks of at most BLOCK_ENTRIES entries (or one query): lists of
    (query, item_id, term, weight); one block at a time is at the driver."""
    block, last, held = [], None, 0
    for r in weights.orderBy("query", "term").toLocalIterator(prefetchPartitions=False):
        if r["query"] != last:
            if held >= BLOCK_ENTRIES:
                yield block
                block, held = [], 0
            last = r["query"]
        block.append((r["query"], r["item_id"], r["term"], r["weight"]))
        held += 1
    if block:
        yield block


class _Strata:
    """Pieces in memory, cut down to the terms of a block of queries: postings with
    their impacts, and where each (piece, term) begins and ends.  Every number but a
    score, an id and a bound is below 2^31."""

    def __init__(self, words: pa.Array):
        self.words = words
        self.start, self.end, self.top = (np.zeros((HELD_STRATA, len(words)), np.int32) for _ in range(3))
        self.docs, self.impacts, self.ids, self.absent = [], [], [], []
        self.strata = self.held = self.documents = 0

    def full(self) -> bool:
        return self.strata >= HELD_STRATA or max(self.held, self.documents) >= HELD

    def add(self, row: dict) -> None:
        at = pc.index_in(row["terms"], value_set=self.words)
        here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        ids = row["doc_ids"]
        if not len(here):
            return
        word = at.drop_null().to_numpy()
        n_docs, n_runs, run_tf, run_docs, docs = (row[c].to_numpy() for c in ("n_docs", "n_runs", "run_tf", "run_docs", "docs"))
        # one impact for each run, then one for each posting
        per_run = 1_000_000_000 * run_tf // (1000 * run_tf + 12 * row["m"])
        first_run = _starts(n_runs)
        keep = np.zeros(len(n_docs), bool)
        keep[here] = True
        of_runs, of_docs = np.repeat(keep, n_runs), np.repeat(keep, n_docs)
        begin = self.held + _starts(n_docs[here])
        self.top[self.strata, word] = per_run[first_run[:-1][here]]
        self.start[self.strata, word], self.end[self.strata, word] = begin[:-1], begin[1:]
        self.docs.append(docs[of_docs] + np.int32(self.documents))
        self.impacts.append(np.repeat(per_run[of_runs].astype(np.int32), run_docs[of_runs]))
        self.absent.append(ids.is_null().to_numpy(zero_copy_only=False))
        # a copy: a view would keep the whole batch in memory
        self.ids.append(ids.fill_null(LAST_ID).to_numpy().copy())
        self.strata += 1
        self.documents += len(ids)
        self.held = int(begin[-1])

    def done(self) -> None:
        self.top, self.start, self.end = (x[:self.strata] for x in (self.top, self.start, self.end))
        self.docs, self.impacts, self.ids, self.absent = (np.concatenate(x) for x in (self.docs, self.impacts, self.ids, self.absent))
        self.total = np.zeros(len(self.ids), np.int64)

    def score(self, strata: np.ndarray, words: np.ndarray, weights: np.ndarray):
        """Documents of ``strata`` with a score, and the scores."""
        touched = []
        for w, weight in zip(words, weights):
            begin, stop = self.start[strata, w], self.end[strata, w]
            size = stop - begin
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            docs = self.docs[at]
            self.total[docs] += weight * self.impacts[at]
            touched.append(docs)
        docs = np.unique(np.concatenate(touched))
        found = self.total[docs]
        self.total[docs] = 0
        some = found > 0
        return docs[some], found[some]


def _best(score: np.ndarray, ids: np.ndarray, absent: np.ndarray, k: int):
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        score, ids, absent = score[at], ids[at], absent[at]
    order = np.lexsort((ids, absent, -score))[:k]
    return score[order], ids[order], absent[order]


def search_block(pieces: DataFrame, block: list, k: int) -> DataFrame:
    """The k best (query, doc_id, score) of each task, for one block of queries."""
    words = sorted({t for _, _, t, _ in block})
    number = {t: i for i, t in enumerate(words)}
    queries: dict[int, tuple[list, list]] = {}
    for query, _, term, weight in block:
        entry = queries.setdefault(query, ([], []))
        entry[0].append(number[term])
        entry[1].append(weight)
    plan = [(q, np.array(t), np.array(w, np.int64)) for q, (t, w) in queries.items()]

    def visit(strata: _Strata, best: dict) -> None:
        strata.done()
        for query, terms, weights in plan:
            bounds = strata.top[:, terms] @ weights
            order = np.argsort(-bounds, kind="stable")
            bounds, at, step = bounds[order], 0, 1
            while at < len(order):
                held = best.get(query)
                least = held[0][-1] if held is not None and len(held[0]) == k else 1
                to = min(at + step, int(np.searchsorted(-bounds, -least, side="right")))
                if to <= at:
                    break
                docs, found = strata.score(order[at:to], terms, weights)
                if len(docs):
                    new = (found, strata.ids[docs], strata.absent[docs])
                    best[query] = _best(*(new if held is None else [np.concatenate(p) for p in zip(held, new)]), k)
                at, step = to, 2 * step

    def search(batches):
        value_set = pa.array(words, pa.string())
        best: dict = {}
        strata = _Strata(value_set)
        for b in batches:
            columns = {c: b.column(c) for c in b.schema.names}
            for i in range(b.num_rows):
                strata.add({c: x[i].as_py() if c == "m" else x[i].values for c, x in columns.items()})
                if strata.full():
                    visit(strata, best)
                    strata = _Strata(value_set)
        if strata.strata:
            visit(strata, best)
        for query, (score, ids, absent) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query)), pa.array(ids, mask=absent), pa.array(score)],
                                             names=["query", "doc_id", "score"])
        pa.default_memory_pool().release_unused()

    return pieces.mapInArrow(search, "query long, doc_id long, score long")


def search(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """The k highest-scoring documents with a score above 0 for each of ``items``
    (item_id, text): item_id, rank, doc_id, score."""
    spark = items.sparkSession
    with temporary_tables(spark):
        weights = weighted_queries(index, items)
        out = shared_path(spark, "ranked")
        for block in _blocks(weights):
            with _few_pieces(spark):
                search_block(index.pieces, block, k).write.mode("append").parquet(out)
        names = weights.select("query", "item_id").distinct()
        schema = "query long, doc_id long, score long"
        # folder not written: no query has a term
        spark.createDataFrame([], schema).write.mode("append").parquet(out)
        found = spark.read.schema(schema).parquet(out)
        order = W.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return stored(found.join(names, "query").select("item_id", "rank", "doc_id", "score"), "ranked", outlives=True)
