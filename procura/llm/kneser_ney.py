"""Toxicity by class-conditional Kneser-Ney models of expressions.

A word is an expression whose likelihood is the product over its characters,
each given the characters before it (up to ``order`` - 1, from the word's
start).  The highest order is counted apart for toxic and ordinary documents;
all lower orders are continuation counts that both classes share, so that where
a class has seen little its model falls back to what the other falls back to,
and the log-likelihood ratio to zero.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.llm.common import fit_logistic, held_out, join_small, per_text, sealed, small_batches, stored, unsealed

LETTERS = re.compile(r"[^\W\d_]+")
ORDER = 5
DISCOUNT = 0.75
#: nats of evidence that a single word must exceed to count by itself
MARGIN = 2.0
#: the n-gram table is broadcast up to this many; beyond, it stays a table that
#: texts are joined with, which gives the same scores
MAX_NGRAMS = 1_000_000
#: in these joins, a key of more rows than this is cut into parts
HOT_KEY = 20_000
#: labelled documents used to calibrate scores (the n-gram counts use all)
CALIBRATION_ROWS = 20_000
#: one labelled document in so many is set aside for that
ASIDE = 4
WORDS_HELD = 120_000
START, END = "\x02", "\x03"


def words(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def grams(word: str, order: int):
    s = START + word + END
    return (s[max(0, i - order + 1):i + 1] for i in range(1, len(s)))


def count_ngrams(train: DataFrame, order: int) -> DataFrame:
    """gram and n0..n3: in how many (document, word) pairs it occurs, by label
    and, from n2, for documents set aside for calibration; ``train`` has text,
    label and aside."""
    names = ["gram", "n0", "n1", "n2", "n3"]

    def run(batches):
        counts: dict[str, list[int]] = defaultdict(lambda: [0] * 4)

        def flush():
            sums: dict[str, list[int]] = defaultdict(lambda: [0] * 4)
            for word, own in counts.items():
                for g in grams(word, order):
                    total = sums[g]
                    for k, n in enumerate(own):
                        total[k] += n
            counts.clear()
            columns = zip(*sums.values()) if sums else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=names)

        for batch in batches:
            kinds = zip(batch.column("label").to_pylist(), batch.column("aside").to_pylist())
            for text, (label, aside) in zip(batch.column("text"), kinds):
                for w in set(words(text.as_py())):
                    counts[w][label + 2 * aside] += 1
                if len(counts) > WORDS_HELD:
                    yield flush()
        yield flush()

    small_batches(train.sparkSession)
    made = train.select("text", "label", "aside").mapInArrow(run, "gram string, n0 long, n1 long, n2 long, n3 long")
    return made.groupBy("gram").agg(*[F.sum(n).alias(n) for n in names[1:]])


def log_ratios(counts: dict[str, tuple[int, int]], order: int, discount: float) -> tuple[dict, dict]:
    """log P(character | history, toxic) / P(... | ordinary) of each counted
    gram, and of any other character after each history."""
    def backoff(grams_):
        total, types = Counter(), Counter()
        for g, n in grams_.items():
            total[g[:-1]] += n
            types[g[:-1]] += 1
        return grams_, total, types

    # shared lower orders: in how many different grams one longer it ends
    levels, longer = {}, {g for g in counts if len(g) == order}
    for n in range(order - 1, 0, -1):
        below = Counter(g[1:] for g in longer)
        below.update(g for g in counts if len(g) == n)
        levels[n] = backoff(below)
        longer = set(below)
    flat = 1 / (len({g[-1] for g in counts}) + 1)
    memo: dict[str, float] = {}

    def shared(g: str) -> float:
        if not g:
            return flat
        if g not in memo:
            seen, total, types = levels[len(g)]
            n = total.get(g[:-1], 0)
            low = shared(g[1:])
            memo[g] = (max(seen.get(g, 0) - discount, 0) + discount * types[g[:-1]] * low) / n if n else low
        return memo[g]

    total, held = [Counter(), Counter()], [Counter(), Counter()]
    for g, pair in counts.items():
        for k in (0, 1):
            if pair[k]:
                total[k][g[:-1]] += pair[k]
                held[k][g[:-1]] += 1

    def left(k: int, history: str) -> float:
        return discount * held[k][history] / total[k][history] if total[k][history] else 1.0

    def seen(k: int, g: str, n: int) -> float:
        top = max(n - discount, 0) / total[k][g[:-1]] if n else 0.0
        return top + left(k, g[:-1]) * shared(g[1:])

    histories = {h: math.log(left(1, h) / left(0, h)) for h in {*total[0], *total[1]}}
    return {g: math.log(seen(1, g, b) / seen(0, g, a)) for g, (a, b) in counts.items()}, histories


def _model(counts: pa.Table, order: int, discount: float) -> tuple[dict, dict]:
    """``log_ratios`` of the columns gram, ordinary and toxic count; rows of no count are left out."""
    gram, a, b = (c.to_pylist() for c in counts.columns)
    return log_ratios({g: (x, y) for g, x, y in zip(gram, a, b) if x + y}, order, discount)


def measures(ratios: dict, histories: dict, order: int, margin: float):
    """A function of texts: per text the mean log-likelihood ratio of its words,
    and the mean of what single words have above the margin (no words: 0)."""
    class Ratios(dict):
        def __missing__(self, w: str) -> float:
            v = sum(ratios[g] if g in ratios else histories.get(g[:-1], 0.0) for g in grams(w, order))
            if len(self) < WORDS_HELD:
                self[w] = v
            return v

    known = Ratios()

    def measure(texts):
        mean, strong = [], []
        for text in texts:
            own = words(text)
            v = np.fromiter(map(known.__getitem__, own), np.float64, len(own))
            mean.append(float(v.mean()) if len(v) else 0.0)
            strong.append(float(np.maximum(v - margin, 0).mean()) if len(v) else 0.0)
        return mean, strong

    return measure


def _head(gram: Column) -> Column:
    return F.substring(gram, F.lit(1), F.char_length(gram) - 1)


def _tail(gram: Column) -> Column:
    return F.substring(gram, F.lit(2), F.char_length(gram))


def ratio_tables(counts: DataFrame, order: int, discount: float) -> tuple[DataFrame, DataFrame]:
    """``log_ratios`` of a table gram, a, b: tables (_gram, _ratio) and (_history,
    _other).  No key has more rows than there are characters."""
    counts = counts.filter("a + b > 0")
    flat = 1 / (counts.select(F.right("gram", F.lit(1))).distinct().count() + 1)
    longer, levels = counts.filter(F.char_length("gram") == order).select("gram"), []
    for n in range(order - 1, 0, -1):
        below = longer.select(_tail(F.col("gram")).alias("gram")).unionByName(
            counts.filter(F.char_length("gram") == n).select("gram"))
        levels.insert(0, stored(below.groupBy("gram").agg(F.count("*").alias("n")), "level"))
        longer = levels[0].select("gram")
    shared = None
    for level in levels:
        d = level.withColumn("_history", _head(F.col("gram")))
        sums = d.groupBy("_history").agg(F.sum("n").alias("_total"), F.count("*").alias("_types"))
        d = d.join(sums, "_history")
        if shared is None:
            d = d.withColumn("_low", F.lit(flat))
        else:
            low = shared.select(F.col("gram").alias("_of"), F.col("_shared").alias("_low"))
            d = d.join(low, _tail(F.col("gram")) == F.col("_of"))
        own = (F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("_types") * F.col("_low")) / F.col("_total")
        shared = stored(d.select("gram", own.alias("_shared")), "shared") if shared is None else shared.unionByName(
            stored(d.select("gram", own.alias("_shared")), "shared"))
    d = counts.withColumn("_history", _head(F.col("gram")))
    left = lambda c: F.when(F.sum(c) > 0, discount * F.count_if(F.col(c) > 0) / F.sum(c)).otherwise(1.0)
    sums = stored(d.groupBy("_history").agg(F.sum("a").alias("_ta"), F.sum("b").alias("_tb"),
                                            left("a").alias("_la"), left("b").alias("_lb")), "histories")
    d = d.join(sums, "_history").join(shared.withColumnRenamed("gram", "_of"), _tail(F.col("gram")) == F.col("_of"))
    seen = lambda n, total, rest: F.when(F.col(n) > 0, F.greatest(F.col(n) - discount, F.lit(0.0)) / F.col(total)).otherwise(
        0.0) + F.col(rest) * F.col("_shared")
    ratios = d.select(F.col("gram").alias("_gram"), F.log(seen("b", "_tb", "_lb") / seen("a", "_ta", "_la")).alias("_ratio"))
    return stored(ratios, "ratios"), stored(sums.select("_history", F.log(F.col("_lb") / F.col("_la")).alias("_other")), "others")


def _spread_join(left: DataFrame, right: DataFrame, key: str, by: Column) -> DataFrame:
    """Left join on ``key``, of which ``right`` has one row each; keys with more
    than HOT_KEY rows of ``left`` are cut into parts by a hash of ``by``."""
    hot = left.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_KEY)
    hot = stored(hot.select("_hot", F.ceil(F.col("_n") / HOT_KEY).cast("int").alias("_parts")), "hot")
    parts = F.coalesce("_parts", F.lit(1))

    def named(d):
        # one key for at least HOT_KEY rows
        return d.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")

    left = named(left).withColumn("_part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("_hot", "_parts")
    right = named(right).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_hot", "_parts")
    return left.join(right, [key, "_part"], "left").drop("_part")


def measures_by_join(docs: DataFrame, keep: list[str], ratios: DataFrame, histories: DataFrame, order: int,
                     margin: float) -> DataFrame:
    """The columns ``keep`` of ``docs`` with _mean and _strong, as ``measures``
    has them.  Texts are named by a digest: equal ones have equal measures."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)

    def run(batches):
        for batch in batches:
            ids, found, times = [], [], []
            for i, text in zip(batch.column("_digest").to_pylist(), batch.column("text")):
                for w, n in Counter(words(text.as_py())).items():
                    ids.append(i)
                    found.append(w)
                    times.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.string()), pa.array(times, pa.int64())],
                                             names=["_digest", "_word", "_times"])

    small_batches(docs.sparkSession)
    held = stored(docs.select(digest.alias("_digest"), "text").mapInArrow(run, "_digest string, _word string, _times long"), "words")
    s = F.concat(F.lit(START), F.col("_word"), F.lit(END))
    each = F.transform(F.sequence(F.lit(1), F.char_length(s) - 1), lambda i: F.substring(
        s, F.greatest(i - (order - 1), F.lit(0)) + 1, F.least(i + 1, F.lit(order))))
    g = held.select("_word").distinct().select("_word", F.explode(each).alias("_gram"))
    g = g.groupBy("_word", "_gram").agg(F.count("*").alias("_k")).withColumn("_history", _head(F.col("_gram")))
    g = stored(_spread_join(stored(g, "grams"), ratios, "_gram", F.col("_word")), "grams")
    unseen = _spread_join(g.filter("_ratio IS NULL").drop("_ratio"), histories, "_history", F.col("_word"))
    g = g.filter("_ratio IS NOT NULL").select("_word", (F.col("_k") * F.col("_ratio")).alias("_v")).unionByName(
        unseen.select("_word", (F.col("_k") * F.coalesce("_other", F.lit(0.0))).alias("_v")))
    values = stored(g.groupBy("_word").agg(F.sum("_v").alias("_v")), "values")
    d = _spread_join(held, values, "_word", F.col("_digest"))
    share = lambda v: F.sum(F.col("_times") * v) / F.sum("_times")
    d = stored(d.groupBy("_digest").agg(share(F.col("_v")).alias("_mean"),
                                        share(F.greatest(F.col("_v") - margin, F.lit(0.0))).alias("_strong")), "measures")
    out = _spread_join(docs.select(*keep, digest.alias("_digest")), d, "_digest", F.monotonically_increasing_id())
    return out.select(*keep, F.coalesce("_mean", F.lit(0.0)).alias("_mean"), F.coalesce("_strong", F.lit(0.0)).alias("_strong"))


def fit(docs: DataFrame, labels: DataFrame, order: int = ORDER, discount: float = DISCOUNT, margin: float = MARGIN,
        max_ngrams: int = MAX_NGRAMS, calibration_rows: int = CALIBRATION_ROWS) -> dict:
    """The model: n-gram counts of all labelled documents that are not held out,
    and a calibration on at most about ``calibration_rows`` of them.  More than
    ``max_ngrams`` n-grams stay tables: they are never gathered.

    ``labels``: doc_id, toxic; null labels are ignored.  Without documents of
    both classes the model is the share of toxic ones (0 without any)."""
    use = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    use = use.select("doc_id", F.col("toxic").cast("int").alias("label"),
                     (F.pmod(F.xxhash64("doc_id"), F.lit(ASIDE)) == 0).cast("int").alias("aside")).distinct()
    train = join_small(docs.select("doc_id", "text"), use, "doc_id")
    table = stored(count_ngrams(train, order), "ngrams")
    small = table.count() <= max_ngrams
    by_class = {r["label"]: r["n"] for r in use.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(by_class.values())
    if len(by_class) < 2:
        return {"share": by_class.get(1, 0) / max(n, 1)}
    # scores are calibrated on documents that the counts behind them have not seen
    rate = min(1.0, calibration_rows / (n / ASIDE)) * (1 << 20)
    part = (F.col("aside") == 1) & (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(1 << 20)) < rate)
    if small:
        counts = table.toArrow()  # columns: far less memory than a row object each
        first = _model(counts.select(["gram", "n0", "n1"]), order, discount)
        rows = per_text(train.filter(part), ["label"], {"_mean": "double", "_strong": "double"},
                        lambda: measures(*first, order, margin)).collect()
        first = None  # one model at a time
        both = [counts["gram"], pc.add(counts["n0"], counts["n2"]), pc.add(counts["n1"], counts["n3"])]
        ratios, histories = _model(pa.table(both, ["gram", "a", "b"]), order, discount)
    else:
        first = ratio_tables(table.selectExpr("gram", "n0 a", "n1 b"), order, discount)
        rows = measures_by_join(train.filter(part), ["label"], *first, order, margin).collect()
        ratios, histories = ratio_tables(table.selectExpr("gram", "n0 + n2 a", "n1 + n3 b"), order, discount)
    x, y = np.array([(r["_mean"], r["_strong"]) for r in rows]).reshape(-1, 2), np.array([r["label"] for r in rows])
    return {"ratios": ratios, "histories": histories, "order": order, "margin": margin,
            "weights": fit_logistic(x, y, penalty=1e-3).tolist()}


def score(docs: DataFrame, model: dict, keep: list[str], out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``out`` (0..1, higher: toxic likelier).  A
    kept column named ``out`` gives way; other names do not matter.

    Null and empty text have no words, so only the intercept.  Each row is
    scored by its text alone; repeated rows score alike."""
    if "share" in model:
        return sealed(docs, keep).select(*unsealed(keep, (out,)), F.lit(float(model["share"])).alias(out))
    docs = sealed(docs, keep, "text")
    if isinstance(model["ratios"], DataFrame):
        d = measures_by_join(docs, ["_kept"], model["ratios"], model["histories"], model["order"], model["margin"])
        a, b, c = model["weights"]
        z = F.greatest(F.least(a * F.col("_mean") + b * F.col("_strong") + c, F.lit(30.0)), F.lit(-30.0))
        return d.select(*unsealed(keep, (out,)), (1 / (1 + F.exp(-z))).alias(out))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        measure, (a, b, c) = measures(m["ratios"], m["histories"], m["order"], m["margin"]), m["weights"]

        def run(texts):
            mean, strong = measure(texts)
            return [[1 / (1 + math.exp(-max(-30.0, min(30.0, a * u + b * v + c)))) for u, v in zip(mean, strong)]]
        return run

    d = per_text(docs, ["_kept"], {"_score": "double"}, start)
    return d.select(*unsealed(keep, (out,)), F.col("_score").alias(out))
