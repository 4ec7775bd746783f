import random

from procura.llm import jaccard
from procura.llm.common import table


def brute(rows, width, percent):
    sets = [jaccard.shingle_set(t and t.encode(), width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common: dict = {}
        for x in s:
            for j in holders[x]:
                if j > i:
                    common[j] = common.get(j, 0) + 1
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups: dict = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=str)


def got(spark, rows, width, percent, schema="doc_id long, text string"):
    d = jaccard.jaccard_components(spark.createDataFrame(rows, schema), width, percent)
    return sorted([tuple(r) for r in d.collect()], key=str)


def _edited(rng, base, k):
    w = list(base)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return w


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    assert got(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_families_around_the_threshold(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for f in range(12):
        base = rng.choices(vocabulary, k=rng.choice([8, 40, 150]))
        rows += [_edited(rng, base, rng.randrange(6)) for _ in range(rng.choice([2, 5, 25]))]
    rows += [rng.choices(vocabulary, k=rng.randrange(1, 80)) + passage for _ in range(60)]
    rows = [(i * 7 % 1009, " ".join(w)) for i, w in enumerate(rows)]
    monkeypatch.setattr(jaccard, "FREQUENT", 6)
    assert got(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_family_below_the_threshold(spark, monkeypatch):
    """Copies with two edits each of a text that is not there: all share shingles
    at their fronts, few are linked, and the bounds leave few of the pairs open."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w, at = list(base), rng.randrange(5, 70)
        w[at], w[at + rng.randrange(6, 70)] = f"e{i}", f"f{i}"
        rows.append((i, " ".join(w)))
    opened, pairs = [], jaccard._open_pairs

    def counted(*args):
        opened.append((d := pairs(*args)).count())
        return d

    monkeypatch.setattr(jaccard, "_open_pairs", counted)
    assert got(spark, rows, 5, 80) == brute(rows, 5, 80)
    assert opened[0] < 120 * 119 / 2 / 3, opened


def test_edge_rows(spark):
    rows = [(5, "a b c d"), (3, "A  b\\tc d"), (4, None), (9, ""), (2, " \\n"), (7, "a b c"), (8, "a b"), (6, "a b c"), (None, "q r s t u"),
            (None, "q r s t u"), (11, "a b c d"), (11, "a b c d"), (12, "x " * 30_000)]
    rows = [(i, t and t.replace("\\t", "\t").replace("\\n", "\n")) for i, t in rows]
    assert got(spark, rows, 4, 85) == brute(rows, 4, 85)
    wide = [(i, t, 1, "x", 2) for i, t in rows]
    assert got(spark, wide, 4, 85, "doc_id long, text string, _id int, _token string, node int") == brute(rows, 4, 85)
    assert got(spark, [], 4, 85) == []


def test_all_links(spark, monkeypatch):
    """Every similar pair is returned, also between texts already connected."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for n in (8, 90, 150, 300):
        base = rng.choices(vocabulary, k=n)
        family = [" ".join(_edited(rng, base, rng.randrange(3))) for _ in range(15)]
        texts += family + family[:3]
    texts += [" ".join(rng.choices(vocabulary, k=30)) for _ in range(20)] + ["", None, "a b", "A  b"]
    rows = [(None if i == 4 else i, t) for i, t in enumerate(texts)]
    sets = [jaccard.shingle_set(t and t.encode(), 4) for t in texts]
    like = {(i, j) for i in range(len(sets)) for j in range(i) if sets[i]
            and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "FREQUENT", 6)
    members, pairs = jaccard.jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    members, pairs = members.collect(), [tuple(r) for r in pairs.collect()]
    want = sorted((str(rows[i][0]), sum(i in p for p in like)) for i in range(len(rows)))
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in members) == want
    of = {4 if r["doc_id"] is None else r["doc_id"]: r["class_id"] for r in members}
    named = {tuple(sorted((of[i], of[j]))) for i, j in like if sets[i] != sets[j]}
    assert len(pairs) == len(set(pairs)) and set(pairs) == named and len(named) > 100
