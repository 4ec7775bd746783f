import math
import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq

from procura.llm import lexical


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def _walk(docs, items, k):
    bags = [(doc, Counter(_terms(text)), len(_terms(text))) for doc, text in docs if _terms(text)]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in sorted(set(items), key=str):
        asked = _terms(text)
        scored = []
        for doc, c, size in bags:
            m = 75 + 25 * size * n // length
            s = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def _ranked(spark, docs, items, k=20):
    d = spark.createDataFrame([(*r, 7, 0) for r in docs], "doc_id long, text string, term int, m int").repartition(3)
    i = spark.createDataFrame([(*r, 7, 0) for r in items], "item_id long, text string, query int, score int")
    got = lexical.search(lexical.build_index(d), i, k)
    return sorted([tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def _rows(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "日本", "B2b", "x"]
    text = lambda size: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=size))
    docs = [(i, text(rng.choice([1, 2, 5, 9, 30, 200]))) for i in range(n)]
    docs += [(900 + i, docs[0][1]) for i in range(40)] + [(5, "w3 w4"), (5, "w3 w4"), (None, "w3 w4"), (None, None), (1000, None), (1001, ""),
                                                          (1002, "-- !"), (1003, "W3-w4_W3"), (1004, "w59 " * 20_000)]
    items = [(i, text(12)) for i in range(25)] + [(50, "w3 w3 w4"), (50, "w3 w3 w4"), (50, "w4"), (51, None), (52, ""), (53, "absent"),
                                                  (54, "é É w59 absent"), (None, "w1")]
    return docs, items


def test_against_all_documents(spark):
    docs, items = _rows(3, 300)
    assert _ranked(spark, docs, items) == _walk(docs, items, 20)


def test_small_segments_pieces_and_blocks(spark, monkeypatch):
    docs, items = _rows(4, 200)
    want = _walk(docs, items, 3)
    for name, value in (("SEGMENT", 500), ("PIECE", 60), ("HELD", 200), ("HELD_STRATA", 3), ("BLOCK_ENTRIES", 100)):
        monkeypatch.setattr(lexical, name, value)
    assert _ranked(spark, docs, items, 3) == want


def test_index_rows_are_strata(spark):
    docs, _ = _rows(5, 120)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    index = lexical.build_index(d)
    bags = [Counter(_terms(t)) for _, t in docs if _terms(t)]
    assert index.n_docs == len(bags) and index.n_terms == sum(sum(b.values()) for b in bags)
    assert {r["term"]: r["df"] for r in index.vocabulary.collect()} == Counter(t for b in bags for t in b)
    seen = Counter()
    for r in index.pieces.collect():
        runs, at, run = list(zip(r["run_tf"], r["run_docs"])), 0, 0
        for term, n_docs, n_runs in zip(r["terms"], r["n_docs"], r["n_runs"]):
            tfs = [tf for tf, _ in runs[run:run + n_runs]]
            assert tfs == sorted(set(tfs), reverse=True) and sum(n for _, n in runs[run:run + n_runs]) == n_docs
            for tf, n in runs[run:run + n_runs]:
                for doc in r["docs"][at:at + n]:
                    seen[r["doc_ids"][doc], term, tf] += 1
                at += n
            run += n_runs
    assert seen == Counter((doc, t, n) for doc, text in docs for t, n in Counter(_terms(text)).items())


def test_no_rows(spark):
    assert _ranked(spark, [], [(1, "a")]) == []
    assert _ranked(spark, [(1, "a b")], []) == []
    assert _ranked(spark, [(1, None), (2, " ")], [(1, "a")]) == []


def _segment(n_docs, n_terms, seed=8):
    rng = random.Random(seed)
    segment = lexical._Segment()
    for i in range(n_docs):
        words = [f"w{rng.randrange(5_000)}".encode() for _ in range(n_terms)]
        segment.add(i, 75 + i % 40, Counter(words))
    return segment


def test_segment_is_turned_into_pieces_bit_by_bit(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 5_000)
    list(_segment(2, 5).pieces())  # modules imported at the first use do not count
    segment = _segment(800, 500)
    postings = len(segment.term)
    tracemalloc.start()
    try:
        rows = sum(1 for b in segment.pieces() for _ in range(b.num_rows if hasattr(b, "num_rows") else 1))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # the sort of all postings at once took 89 bytes a posting
    assert peak < 20 * postings and rows >= 40
    sizes = [len(b.column("docs").flatten()) for b in segment.pieces()]
    assert sum(sizes) == postings and max(sizes) <= 2 * 5_000 + 500


def test_index_has_small_row_groups(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ROW_GROUP", 50_000, raising=False)
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{rng.randrange(3_000)}" for _ in range(60 + i))) for i in range(200)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    (path,) = index.pieces.inputFiles()
    meta = pq.ParquetFile(path.removeprefix("file:").replace("///", "/")).metadata
    sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert len(sizes) > 5 and max(sizes) < 150_000


def test_few_pieces_are_read_at_once(spark, monkeypatch):
    keys = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []

    def search_block(pieces, block, k, f=lexical.search_block):
        seen.append([int(spark.conf.get(key)) for key in keys])
        return f(pieces, block, k)

    monkeypatch.setattr(lexical, "search_block", search_block)
    docs, items = [(i, f"a b{i % 7}") for i in range(50)], [(1, "a b3")]
    before = [spark.conf.get(keys[0])]
    assert _ranked(spark, docs, items) == _walk(docs, items, 20)
    assert seen == [[8, 8]] and [spark.conf.get(keys[0])] == before


def test_strata_hold_nothing_but_their_own():
    batch = next(iter(_segment(60, 20).pieces()))
    strata = lexical._Strata(pa.array(["w1", "w2", "w3"]))
    for i in range(batch.num_rows):
        strata.add({c: batch.column(c)[i].as_py() if c == "m" else batch.column(c)[i].values for c in batch.schema.names})
    assert strata.ids and all(x.base is None for x in strata.ids)


def test_documents_without_a_query_term_count_as_held(monkeypatch):
    monkeypatch.setattr(lexical, "HELD", 30)
    segment = lexical._Segment()
    for i in range(40):
        segment.add(i, 100, Counter([b"w1" if i == 0 else b"x"]))
    (batch,) = segment.pieces()
    strata = lexical._Strata(pa.array(["w1"]))
    strata.add({c: batch.column(c)[0].as_py() if c == "m" else batch.column(c)[0].values for c in batch.schema.names})
    assert strata.held == 1 and strata.full()
