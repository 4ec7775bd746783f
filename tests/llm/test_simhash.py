import hashlib
import random

import numpy as np

from procura.llm import simhash
from procura.llm.common import table


def _walk(rows):
    f = simhash.fingerprinter()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        a, b, c = f(text), f(edited), f(after)
        out.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
                    simhash.likeness(a, b), simhash.likeness(a, c)))
    return sorted(out, key=str)


def test_documents_in_order(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    rows += [(10_000, None), (10_001, ""), (-5, "é ß 日本 " * 50), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for parts in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sorted([tuple(r) for r in simhash.fingerprint_edits(docs).collect()], key=str)
        assert got == _walk(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_small_and_equal_rows(spark):
    schema = "doc_id long, text string, _part int, fingerprint string"
    one = simhash.fingerprint_edits(spark.createDataFrame([(1, "a b c d e", 1, "x")], schema)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert simhash.fingerprint_edits(spark.createDataFrame([], schema)).count() == 0
    same = simhash.fingerprint_edits(spark.createDataFrame([(1, "a b c d e", 1, "x")] * 5 + [(None, "q", 1, "x")] * 3, schema)).collect()
    assert len(same) == 8 and len({r["fingerprint"] for r in same}) == 2


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(simhash.BITS) for _ in range(12)]
    prints = [b for b in base for _ in range(2)]
    for b in base:
        for _ in range(25):
            x = b
            for i in rng.sample(range(simhash.BITS), rng.randrange(12)):
                x ^= 1 << i
            prints.append(x)
    text = [f"{p:0{simhash.BITS // 4}x}" for p in prints]
    d = spark.createDataFrame([(t,) for t in text], "fingerprint string")
    got = {r["fingerprint"]: r["n_near"] for r in simhash.near_fingerprints(d.limit(40), d).collect()}
    for t in got:
        assert got[t] == sum(bin(int(t, 16) ^ p).count("1") <= simhash.RADIUS for p in prints)
    assert len(got) >= 12


def test_likeness_follows_similarity():
    rng = random.Random(1)
    words = [rng.choices("abcdefghij", k=5) for _ in range(400)]
    a = [" ".join("".join(w) for w in words[:200]), " ".join("".join(w) for w in words[200:])]
    f = simhash.fingerprinter()
    half = a[0][:600] + a[1][:600]
    assert simhash.likeness(f(a[0]), f(a[0])) == 1.0
    assert simhash.likeness(f(a[0]), f(half)) > simhash.likeness(f(a[0]), f(a[1])) + 0.05
    assert not np.any(f("")) and not np.any(f(None))


def test_planted_near_copies_are_listed(spark):
    """Copies with a few changed words (3-word Jaccard 0.8 and more) are found,
    and the list names all fingerprints within the radius and no other."""
    rng = random.Random(7)
    f = simhash.fingerprinter()
    texts, pairs = [], []
    for n, k in [(300, 3), (200, 2), (100, 1), (300, 8), (200, 5)] * 12:
        a = [f"w{rng.randrange(30_000)}" for _ in range(n)]
        b = list(a)
        for i in rng.sample(range(n), k):
            b[i] = f"x{rng.randrange(10 ** 6)}"
        sets = [{tuple(w[i:i + 3]) for i in range(n - 2)} for w in (a, b)]
        assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= simhash.SIMILARITY
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(a), " ".join(b)]
    prints = [f(t).tobytes().hex() for t in texts]
    d = spark.createDataFrame([(p,) for p in prints + prints[:1]], "fingerprint string")
    rows = {r["fingerprint"]: r for r in simhash.near_fingerprints(d.filter(d["fingerprint"].isin(prints[::2])), d).collect()}
    found = [prints[b] in rows[prints[a]]["near"] for a, b in pairs]
    assert sum(found) >= 0.95 * len(found)
    for p, r in rows.items():
        assert r["near"] == sorted({q for q in prints if (int(p, 16) ^ int(q, 16)).bit_count() <= simhash.RADIUS})
    assert rows[prints[0]]["n_near"] == len(rows[prints[0]]["near"]) + 1


def test_hot_keys_and_other_radii(spark, monkeypatch):
    """A family that shares most blocks, cut into parts, is still found whole."""
    monkeypatch.setattr(simhash, "HOT_KEY", 10)
    rng = random.Random(5)
    base = rng.getrandbits(simhash.BITS)
    prints = {base}
    for _ in range(120):
        x = base
        for i in rng.sample(range(simhash.BITS), rng.randrange(60)):
            x ^= 1 << i
        prints.add(x)
    text = {f"{p:0{simhash.BITS // 4}x}": p for p in prints}
    d = spark.createDataFrame([(t,) for t in text], "fingerprint string")
    for radius in (5, 20, 40):
        got = {r["fingerprint"]: r["near"] for r in simhash.near_fingerprints(d.limit(30), d, radius).collect()}
        for t, near in got.items():
            assert near == sorted(o for o, p in text.items() if (p ^ text[t]).bit_count() <= radius)
        assert len(got) == 30
