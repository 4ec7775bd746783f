import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from procura.llm import packing
from procura.llm.common import table

SF = "/root/testdata/sf0.001"


def _hf():
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return t


def test_ids_equal_those_of_the_tokenizers_file(spark):
    hf = _hf()
    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()][:400]
    texts += ["", " ", "<|endoftext|>", "a<|endoftext|>b", "\x00\x85  \n\n\t x", "日本語 😀‍", "x" * 5000, "it's I'LL 12345"]
    for text, e in zip(texts, hf.encode_batch(texts, add_special_tokens=False)):
        assert list(_IDS(text)) == [*e.ids, 0]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_on_any_text(text):
    assert list(_IDS(text)) == [*_HF.encode(text, add_special_tokens=False).ids, 0]


_HF = _hf()
_IDS = packing.encoder(packing.default_ranks())


def test_pack_round_trip(spark):
    docs = table(spark, SF, "documents")
    rows = packing.pack(docs, capacity=256).collect()
    hf, texts = _hf(), {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids = np.array([*hf.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [(r["start"], r["length"]) for r in own] == packing.cut_points(len(ids), 256)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own)
        assert all(r["length"] == 256 for r in own[1:])
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256


def _bins(histogram, capacity):
    rows = packing.plan(histogram, capacity)
    used = Counter()
    for length, first, last, each, _, _ in rows:
        used[length] += last - first + 1
    assert used == Counter(histogram)
    return max((s + (b - a) // e + 1 for _, a, b, e, s, _ in rows), default=0)


def _optimum(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 17, 30])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        count = [0] * (capacity + 1)
        for i in items:
            count[i] += 1
        fixed = packing.reduce_histogram(count, capacity)
        rest = [s for s in range(capacity, 0, -1) for _ in range(count[s])]
        assert all(sum(p) <= capacity for p in fixed)
        assert sum(fixed.values()) + _optimum(rest, capacity) == _optimum(items, capacity)
        assert _optimum(items, capacity) <= _bins(Counter(items), capacity)


def test_large_histogram_is_near_its_bound():
    rng = np.random.default_rng(1)
    sizes = np.clip(rng.lognormal(6, 1, 200_000).astype(int) + 1, 1, 2048)
    n = _bins({int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True))}, 2048)
    big = (sizes > 1024).sum()
    assert n <= max(-(-sizes.sum() // 2048), big) * 1.01


def test_edge_rows(spark):
    schema = "doc_id long, text string, piece string, _rank int"
    docs = spark.createDataFrame([(None, None, "x", 1), (1, "", "x", 1), (1, "", "x", 1), (2, "ab " * 900, "x", 1)], schema)
    rows = packing.pack(docs, capacity=16, keep_ids=True).collect()
    assert sum(r["length"] == 1 for r in rows if r["doc_id"] != 2) == 3
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0
