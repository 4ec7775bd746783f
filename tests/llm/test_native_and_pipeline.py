import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from procura.llm import jaccard, kdtree, linefreq, mixing
from procura.llm.common import stored, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows():
    return [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", "a", 4), (2, "x y z " * 40, "en", None, 240),
            (3, "x y z " * 40, "en", "b", 240), (3, "x y z " * 40, "en", "b", 240), (4, "long " * 60_000, "fr", "é", 300_000),
            (5, "one two\tthree\x0bfour", None, "b", 18)]


def test_targets_by_repeated_dealing(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 40_000]) for i in range(rng.randrange(1, 9))}
        names = sorted(sizes)
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
        target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
        while left > 1e-6:
            free = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
            per = left / sum(weight[s] for s in free)
            left = 0.0
            for s in free:
                target[s] += weight[s] * per
                left += max(0.0, target[s] - 2 * sizes[s])
                target[s] = min(target[s], 2.0 * sizes[s])
        d = spark.createDataFrame([(s, float(n), 1) for s, n in sizes.items()], "source string, source_size double, _rows int")
        got = {r["source"]: r["target"] for r in mixing.source_targets(d).collect()}
        assert got == pytest.approx(target, abs=1e-3)


def test_schedules_integrate_to_one_and_invert(spark):
    for knots in mixing.SCHEDULES:
        assert mixing.integral(knots) == pytest.approx(1)
        d = spark.range(101).selectExpr("id / 100.0D AS y").select("y", mixing.inverse_demand(__import__("pyspark").sql.functions.col("y"), knots).alias("u"))
        for r in d.collect():
            demand = sum((m0 + (m1 - m0) * t / 2) * t * (u1 - u0) if (t := min(1, max(0, (r["u"] - u0) / (u1 - u0)))) else 0
                         for u0, u1, m0, m1, _ in mixing._segments(knots))
            assert demand == pytest.approx(r["y"], abs=1e-9)


def test_mix_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    rows = mixing.curriculum(docs).collect()
    assert len(rows) == len(odd_rows())
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r["take_1"] + r["take_2"] <= 2 * r["n_words"]
        taken[r["source"]] += r["take_1"] + r["take_2"]
    assert all(abs(taken[r["source"]] - r["target"]) <= 1 for r in rows)
    mixed = mixing.training_rows(docs).collect()
    got = Counter()
    for r in mixed:
        got[r["source"]] += len(WORD.findall(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(got)
    assert mixing.training_rows(docs.limit(0)).count() == 0 and mixing.curriculum(docs.limit(0)).count() == 0
    # columns named like the operator's own: outputs count, the mix returns the given ones
    clash = ["rank", "target", "source_size", "_digest", "_size", "_kept", "take_1", "position_1", "_pass", "n_words", "_before", "Level x"]
    wide = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    plain = lambda d, cols: sorted(map(str, d.select(*cols).collect()))
    cols = ["doc_id", "n_words", "source_size", "target", "take_1", "take_2", "position_1"]
    assert plain(mixing.curriculum(wide), cols) == plain(mixing.curriculum(docs), cols)
    mixed_wide = mixing.training_rows(wide)
    assert mixed_wide.columns == wide.columns
    assert plain(mixed_wide, docs.columns) == plain(mixing.training_rows(docs), docs.columns)
    assert mixed_wide.select(*[f"`{c}`" for c in clash]).distinct().collect() == [tuple(range(len(clash)))]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_kd_shards(spark, shards):
    docs = table(spark, SF, "documents")
    rows = kdtree.kd_shards(docs, shards=shards, rows_per_bucket=20).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == docs.count() and set(sizes) == set(range(shards))
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2.5 * largest
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_kd_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS).selectExpr("*", "1 AS size", "2 AS shard")
    rows = kdtree.kd_shards(docs, target_bytes=200).collect()
    assert len(rows) == len(odd_rows()) and {r["size"] for r in rows if r["doc_id"] in (None, 1)} == {1}
    assert kdtree.kd_shards(docs.limit(0), shards=8).count() == 0
    same = spark.createDataFrame([(7, "same", "en", "a", 4)] * 40, DOCS)
    assert kdtree.kd_shards(same, shards=4).count() == 40


def _rules(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_line_rules(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choices(["Common  line 1 of host", f"own {i} x", "b c b c b c", "# * <a>", "", " "], k=rng.randrange(9))), "en", rng.choice(["h", None]), 0)
            for i in range(120)] + odd_rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS h", "2 AS x", "3 AS n")
    got = [tuple(r) for r in linefreq.line_rules(docs, "source", min_words=1, max_holders=10).collect()]
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[1-9]", "0", x.lower())).strip(" ")
    held = Counter()
    lines = [[x for x in (r[1] or "").split("\n") if WORD.search(x)] for r in rows]
    for r, own in zip(rows, lines):
        held.update({(r[3], norm(x)) for x in own})
    want = []
    for r, own in zip(rows, lines):
        m = _rules(r[1])
        gone = sum(len(WORD.findall(x)) for x in own if held[r[3], norm(x)] > 10)
        failed = m[0] < 1 or 100 * m[4] > 50 * m[0]
        want.append((r[0], *m, failed, m[0] - gone, not failed and m[0] - gone >= 1 and m[0] - gone >= 0.3 * m[0]))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert linefreq.line_rules(docs.limit(0), "source").count() == 0


def test_line_in_a_hot_and_a_cold_host(spark):
    """As many holders, the same verdict, whatever the host's size."""
    spelt = lambda i, c: c + str(i).translate(str.maketrans("0123456789", "abcdefghij"))  # noqa: E731  (digits are alike in a line)
    own = lambda i, n=20, c="w": " ".join(spelt(i, c) + spelt(k, "x") for k in range(n))
    planted = " ".join(f"p{k}" for k in range(60))
    rows = [(i, planted + "\n" + own(i) if i < 30 else own(i) + "\n" + own(i, 40, "v"), "en", "hot", 0) for i in range(1_500)]
    rows += [(10_000 + i, planted + "\n" + own(10_000 + i), "en", "cold", 0) for i in range(30)]
    got = {r["doc_id"]: (r["kept"], r["n_left_words"]) for r in linefreq.line_rules(spark.createDataFrame(rows, DOCS), "source", max_holders=25).collect()}
    assert {got[i] for i in range(30)} == {got[10_000 + i] for i in range(30)} == {(False, 20)}
    assert all(got[i] == (True, 60) for i in range(30, 1_500))
    kept = linefreq.line_rules(spark.createDataFrame(rows, DOCS), "source", max_holders=30)
    assert kept.filter("kept").count() == len(rows)


def _plain_tree(rows, k, first=0, root=None):
    """Shards of (x0, x1, x2, x3, tie, size, key) by the exact weighted quantile."""
    if k == 1 or not rows:
        return {r[6]: first for r in rows}
    extent = [max(r[i] for r in rows) - min(r[i] for r in rows) for i in range(4)]
    root = root or [max(1, e) for e in extent]
    dim = max(range(4), key=lambda i: (extent[i] / root[i], -i))
    weight = sum(r[5] for r in rows)
    goal = weight * (k // 2) // k

    def cut(of, below):
        """The first value whose running weight reaches the goal, or the one behind it where that is nearer."""
        upto = below
        for v in sorted({x for x, _ in of}):
            w = sum(s for x, s in of if x == v)
            upto += w
            if upto >= goal:
                return v, w, upto
    v, w, upto = cut([(r[dim], r[5]) for r in rows], 0)
    t, tw, tu = cut([(r[4], r[5]) for r in rows if r[dim] == v], upto - w)
    end = t + 1 if tu - goal <= tw / 2 else t
    left = [r for r in rows if (r[dim], r[4]) < (v, end)]
    gone = {r[6] for r in left}
    return _plain_tree(left, k // 2, first, root) | _plain_tree([r for r in rows if r[6] not in gone], k - k // 2, first + k // 2, root)


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_kd_against_a_plain_tree(spark, shards):
    rng = random.Random(shards)
    sources = [None, "https://a.org", "https://b.org", "https:/", "é", "z" * 40, "z" * 39 + "y"]
    rows = [(i * 3 % 211, "w" * rng.choice([5, 9, 50, 120]) + str(i), rng.choice(["en", "de", None]), rng.choice(sources), 0) for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS)
    meta = kdtree.metadata(docs).collect()
    order = {s: i for i, s in enumerate(sorted((s for s in sources if s), key=str.encode))}
    assert {r["_x1"] for r in meta} <= {-1, *order.values()} and len({r["_x1"] for r in meta}) == len({r[3] for r in rows})
    want = _plain_tree([(*[r[f"_x{i}"] for i in range(4)], r["_tie"], r["size"], (r["doc_id"], r["text_crc32"])) for r in meta], shards)
    got = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in kdtree.kd_shards(docs, shards=shards, rows_per_bucket=30).collect()}
    assert got == want


def test_ranks_over_many_parts(spark):
    values = [None, "", "a", "a", "b", "https://a.org/x", "https://a.org/y", "é", "日本"] + [f"s{i}" for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    got = {r["value"]: r["rank"] for r in kdtree.ranks(spark.createDataFrame([(v,) for v in values], "s string")).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {v: i for i, v in enumerate(sorted({v for v in values if v is not None}, key=str.encode))}


def test_filter_stages_take_any_columns(spark):
    sf = SF
    docs = table(spark, sf, "documents")
    clash = ["score", "_one", "_two", "content", "page", "label", "aside", "_mean", "_strong", "_digest", "_kept", "gram", "quality", "toxic", "_score", "odd name"]
    wide = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    for stage in (corpus_pipeline.quality, corpus_pipeline.toxicity):
        got = stage(spark, wide, sf)
        assert got.columns == wide.columns
        assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in stage(spark, docs, sf).collect()}
        assert stage(spark, wide.limit(0), sf).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    first = docs.columns
    labels = {r["doc_id"]: r for r in table(spark, sf, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        if name != "pack":
            assert docs.columns == first
        after = {r["doc_id"] for r in docs.collect()}
        assert after <= set(before)
        if name == "quality":
            good = [d for d in before if d in labels and labels[d]["quality"] == 1]
            assert sum(d in after for d in good) > 0.97 * len(good)
            bad = [d for d in before if d in labels and labels[d]["quality"] == 0]
            assert bad and sum(d not in after for d in bad) > 0.8 * len(bad)
        if name == "toxicity":
            clean = [d for d in before if d in labels and labels[d]["toxic"] == 0]
            assert sum(d in after for d in clean) > 0.97 * len(clean)
            toxic = [d for d in before if d in labels and labels[d]["toxic"] == 1]
            assert toxic and sum(d not in after for d in toxic) > 0.8 * len(toxic)
        if name == "near_duplicates":
            comps = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(
                spark.createDataFrame([(d, r["text"]) for d, r in before.items()], "doc_id long, text string")).collect()}
            assert after == {d for d in before if comps[d] == d}
        if name == "mix":
            size = Counter()
            for r in before.values():
                size[r["source"]] += len(WORD.findall(r["text"]))
            assert sum(len(WORD.findall(r["text"])) for r in docs.collect()) == pytest.approx(1.5 * sum(size.values()), abs=len(size))
    assert docs.count() >= len(after) > 0


def test_one_of_each(spark):
    rows = [(None, "a b c d e f", "en", "s", 1), (4, "a b c d e f", "en", "s", 1), (4, "a b c d e f", "en", "s", 1), (6, "a b c d e f", "en", "s", 1),
            (7, None, "en", "s", 0), (7, None, "en", "s", 0), (8, "q", "en", "s", 1)]
    got = sorted((r["doc_id"], r["text"] or "") for r in jaccard.one_of_each(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(4, "a b c d e f"), (7, ""), (7, ""), (8, "q")]
