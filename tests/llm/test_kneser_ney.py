import math
import random
from collections import Counter

from procura.llm import kneser_ney as kn
from procura.llm.queries import op9_kneser_ney_toxicity


def test_models_are_distributions():
    """Summed over all characters, each class's probabilities are 1."""
    words = {"abba": (3, 1), "abc": (1, 2), "cab": (4, 0), "bad": (0, 5)}
    counts: dict = {}
    for w, (a, b) in words.items():
        for g in kn.grams(w, 3):
            x, y = counts.get(g, (0, 0))
            counts[g] = (x + a, y + b)
    ratios, histories = kn.log_ratios(counts, 3, 0.75)
    # the two classes' probabilities differ by the ratio, so their means against each other bound 0
    for h in {g[:-1] for g in counts}:
        own = [ratios[g] for g in counts if g[:-1] == h]
        assert min([*own, histories[h]]) <= 1e-9 <= 1e-9 + max([*own, histories[h]])
    assert all(math.isfinite(v) for v in [*ratios.values(), *histories.values()])


def test_equal_classes_give_zero():
    counts = {g: (2, 2) for w in ("hello", "help", "yelp") for g in kn.grams(w, 4)}
    ratios, histories = kn.log_ratios(counts, 4, 0.75)
    assert max(map(abs, [*ratios.values(), *histories.values()])) < 1e-12


def test_counts_are_those_of_a_loop(spark):
    rows = [("ab Ab cd", 0, 0), ("ab x", 1, 0), (None, 1, 1), ("", 0, 0), ("cd cd 12 cd", 1, 1)]
    got = {r["gram"]: (r["n0"], r["n1"], r["n2"], r["n3"])
           for r in kn.count_ngrams(spark.createDataFrame(rows, "text string, label int, aside int"), 3).collect()}
    want: dict = {}
    for text, label, aside in rows:
        for w in set(kn.words(text)):
            for g in kn.grams(w, 3):
                want.setdefault(g, Counter())[label + 2 * aside] += 1
    assert got == {g: tuple(c[k] for k in range(4)) for g, c in want.items()}


def test_held_out_accuracy(spark):
    d = op9_kneser_ney_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = d.join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert right > 0.95 and sum(clean) < 0.03 * len(clean) and sum(caught) > 0.6 * len(caught)


def test_edge_rows(spark):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choices(["aaa", "bbb", "ccc", "ddd"], k=30)) + (" vile" * 3 if i % 4 == 0 else ""), 5) for i in range(200)]
    texts += [(None, None, 1), (900, "", 1), (901, "vile " * 200_000, 1), (902, "aaa bbb", 1), (902, "aaa bbb", 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (901, None)], "doc_id long, toxic int")
    rows = kn.score(docs, kn.fit(docs, labels), ["doc_id", "label"]).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 205 and score[901] > 0.9 and score[902] < 0.1 and 0 <= score[None] == score[900] <= 1
    none = kn.fit(docs, labels.limit(0))
    assert {r["score"] for r in kn.score(docs, none, ["doc_id"]).collect()} == {0.0}
    assert kn.score(docs.limit(0), none, ["doc_id"]).count() == 0


def test_more_ngrams_than_are_broadcast(spark, monkeypatch):
    """Beyond the bound the tables are joined: the same scores, no error."""
    monkeypatch.setattr(kn, "HOT_KEY", 40)
    rng = random.Random(3)
    known = ["".join(rng.choices("abcdeé日", k=rng.randrange(1, 9))) for _ in range(60)]
    texts = [(i, " ".join(rng.choices(known, k=25)) + (" vile vilest" if i % 3 == 0 else ""), "x") for i in range(150)]
    texts += [(None, None, "x"), (900, "", "x"), (901, "vile unseen words 12", "x"), (902, "aaa", "x"), (902, "aaa", "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    small = kn.fit(docs, labels)
    large = kn.fit(docs, labels, max_ngrams=10)
    assert {r["_gram"]: r["_ratio"] for r in large["ratios"].collect()}.keys() == small["ratios"].keys()
    for r in large["ratios"].collect():
        assert math.isclose(r["_ratio"], small["ratios"][r["_gram"]], abs_tol=1e-9)
    assert all(math.isclose(r["_other"], small["histories"][r["_history"]], abs_tol=1e-9) for r in large["histories"].collect())
    want, got = ([(str(r["doc_id"]), r["text"] or "", r["score"]) for r in kn.score(docs, m, ["doc_id", "text"]).collect()]
                 for m in (small, large))
    assert len(want) == len(got) == len(texts)
    for a, b in zip(sorted(want), sorted(got)):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-6)
