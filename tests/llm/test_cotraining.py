import numpy as np

from procura.llm import cotraining
from procura.llm.queries import op4_cotrained_quality


def test_pseudo_labels_help_with_few_labels():
    rng = np.random.default_rng(0)

    def draw(n):
        y = rng.integers(0, 2, n)
        return y, [rng.normal(y[:, None] * 1.6, 1, (n, 5)), rng.normal(y[:, None] * 1.6, 1, (n, 4))]

    (y, views), (_, pools), (t, tests) = draw(12), draw(1500), draw(2000)
    right = []
    for rounds in (0, 6):
        w = cotraining.co_train(views, y, pools, rounds=rounds)
        odds = sum(v @ x[:-1] + x[-1] for v, x in zip(tests, w))
        right.append(np.mean((odds > 0) == t))
    assert right[1] >= right[0] and right[1] > 0.95


def test_held_out_accuracy(spark):
    d = op4_cotrained_quality(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = d.join(labels, "doc_id").filter("held_out").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.1 * len(bad)


def test_edge_rows(spark):
    good = [(i, f"a quiet line of words number {i % 7}\nand more of it {i}", "en", 1) for i in range(80)]
    bad = [(100 + i, "BUY!!! $$$ " * (5 + i % 4), "en", 1) for i in range(80)]
    odd = [(None, None, None, 1), (300, "", "xx", 1), (301, "w " * 300_000, "en", 1), (302, "BUY!!! $$$ " * 6, None, 1), (302, "BUY!!! $$$ " * 6, None, 1)]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, lang string, _y int")
    labels = spark.createDataFrame([(r[0], int(r[0] < 100)) for r in good + bad] + [(None, 1), (300, None)], "doc_id long, quality int")
    rows = cotraining.score(docs, cotraining.fit(docs, labels), ["doc_id", "_y"]).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 165 and all(0 <= r["score"] <= 1 for r in rows)
    assert score[5] > 0.5 > score[105] and score[302] < 0.5
    none = cotraining.fit(docs, labels.limit(0))
    assert {r["score"] for r in cotraining.score(docs, none, ["doc_id"]).collect()} == {1.0}
    assert cotraining.score(docs.limit(0), none, ["doc_id"]).count() == 0
