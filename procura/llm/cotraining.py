"""Quality classifier by co-training of two views.

One classifier sees the text's content (hashed byte trigrams), the other what
can be told of the page without reading it (language, length, layout).  In each
round both label the unlabelled documents of a bounded pool, and what one is
most sure of is added to what the other learns from.  Both are then calibrated
on labelled documents that neither has learned from, and their log-odds are
added up to score every document.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import fit_logistic, held_out, join_small, per_text, sealed, unsealed

#: bounds of the sample that the classifiers are fitted on
LABELLED_ROWS, POOL_ROWS = 4000, 4000
BUCKETS = 512
LANGUAGES = ("de", "en", "es", "fr")
ROUNDS = 4
#: share of the pool that a view labels in a round, and how sure it must be
GROWTH, SURE = 0.05, 0.95
PAGE = 15


def content_view(text: str | None) -> np.ndarray:
    """Square roots of the frequencies of hashed byte trigrams of the text."""
    b = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.float32)
    t = (b[:-2] * 65537 + b[1:-1] * 257 + b[2:]) * np.uint32(2654435761) >> np.uint32(23)
    return np.sqrt(np.bincount(t, minlength=BUCKETS) / len(t)).astype(np.float32)


def page_view(text: str | None, lang: str | None) -> np.ndarray:
    """Language, length and layout: lines, words, repeats, kinds of characters."""
    text = text or ""
    n, words, lines = max(1, len(text)), text.split(), text.split("\n")
    raw = text.encode("utf-8", "replace")
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = sum(map(text.count, "#*$%&|<>!?_=+~^@"))
    digits = sum(map(text.count, "0123456789"))
    count = max(1, len(words))
    return np.array([*(lang == x for x in LANGUAGES), math.log1p(len(text)) / 10, math.log1p(len(lines)) / 5,
                     math.log1p(n / len(lines)) / 10, len(set(lines)) / len(lines), len(set(words)) / count,
                     len(text) / count / 20, upper / n * 5, marks / n * 5, digits / n * 5,
                     len(zlib.compress(raw, 1)) / max(20, len(raw)), not words], np.float32)


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """content and page of each row; ``docs``: text and lang."""
    def start():
        def run(texts):
            return [[content_view(t) for t in texts], [page_view(t, None) for t in texts]]
        return run

    d = per_text(docs, [*keep, "lang"], {"content": "array<float>", "page": "array<float>"}, start)
    return d


def _with_language(page: np.ndarray, langs) -> np.ndarray:
    page = page.copy()
    for i, x in enumerate(LANGUAGES):
        page[:, i] = [lang == x for lang in langs]
    return page


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _predict(w, x):
    return _sigmoid(x @ w[:-1] + w[-1])


def co_train(views: list[np.ndarray], y: np.ndarray, pools: list[np.ndarray], rounds: int = ROUNDS,
             growth: float = GROWTH, sure: float = SURE, penalty: float = 0.05) -> list[np.ndarray]:
    """Weights of the two classifiers; ``views``: rows of each view with labels
    ``y``, ``pools``: unlabelled rows of each view."""
    pseudo = [np.full(len(pools[0]), -1) for _ in views]
    balance = np.bincount(y, minlength=2) / len(y)
    for turn in range(rounds + 1):
        weights = []
        for k in (0, 1):
            more = pseudo[k] >= 0
            x = np.concatenate([views[k], pools[k][more]])
            t = np.concatenate([y, pseudo[k][more]])
            weights.append(fit_logistic(x, t, penalty=penalty))
        if turn == rounds or not len(pools[0]):
            break
        for k in (0, 1):
            p = _predict(weights[k], pools[k])
            for label in (0, 1):
                own = p if label else 1 - p
                take = math.ceil(growth * balance[label] * len(p))
                free = np.flatnonzero((pseudo[1 - k] < 0) & (own >= sure))
                pseudo[1 - k][free[np.argsort(-own[free], kind="stable")[:take]]] = label
    return weights


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS) -> dict:
    """The model, fitted on a sample of about ``labelled_rows`` labelled and
    ``pool_rows`` unlabelled documents, chosen by a hash of doc_id.

    ``labels``: doc_id, quality (0 or 1; others and held-out rows are ignored).
    Without both classes the model is the share of quality 1 (1 without any)."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.select("doc_id", F.col("quality").cast("int").alias("_y")).distinct()
    use = known.filter(~held_out())
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / F.lit(1 << 30)
    by_class = {r["_y"]: r["n"] for r in use.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    n = sum(by_class.values())
    if len(by_class) < 2:
        return {"share": by_class.get(1, 0) / n if n else 1.0}
    total = docs.count()
    sample = use.filter(place < labelled_rows / n)
    pool = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & (place < pool_rows / max(1, total - n)))
    pool = pool.join(known, "doc_id", "left_anti").withColumn("_y", F.lit(-1))
    chosen = sample.unionByName(pool).distinct()
    d = join_small(docs.select("doc_id", "text", "lang"), chosen, "doc_id")
    rows = features(d, ["doc_id", "_y"]).toArrow().sort_by("doc_id")
    y = rows.column("_y").to_numpy()
    flat = lambda c, width: rows.column(c).combine_chunks().flatten().to_numpy().reshape(-1, width)
    content = flat("content", BUCKETS)
    page = _with_language(flat("page", PAGE), rows.column("lang").to_pylist())
    del rows
    pa.default_memory_pool().release_unused()
    labelled = np.flatnonzero(y >= 0)
    aside = labelled[np.arange(len(labelled)) % 4 == 0]  # for the calibration
    learn = np.setdiff1d(labelled, aside)
    if len(set(y[learn])) < 2 or len(set(y[aside])) < 2:
        aside = learn = labelled
    views = [content, page]
    weights = co_train([v[learn] for v in views], y[learn], [v[y < 0] for v in views])
    odds = np.stack([v[aside] @ w[:-1] + w[-1] for v, w in zip(views, weights)], axis=1)
    platt = [fit_logistic(odds[:, [k]], y[aside], penalty=0.1) for k in (0, 1)]
    return {"weights": weights, "platt": platt}


def score(docs: DataFrame, model: dict, keep: list[str], out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``out`` (0..1, higher: better quality),
    the mean of the two calibrated views' log-odds.  A kept column named ``out``
    gives way; other names do not matter.

    Null text: as empty.  Null or other lang: none of the known ones.  Repeated
    rows score alike; empty input gives no rows."""
    if "share" in model:
        return sealed(docs, keep).select(*unsealed(keep, (out,)), F.lit(float(model["share"])).alias(out))
    (a, b), (pa_, pb) = model["weights"], model["platt"]
    # the language's part of the page view is added outside of the text's
    shift = {x: float(b[i]) for i, x in enumerate(LANGUAGES)}

    def start():
        def run(texts):
            one = np.array([content_view(t) for t in texts]).reshape(-1, BUCKETS) @ a[:-1] + a[-1]
            two = np.array([page_view(t, None) for t in texts]).reshape(-1, PAGE) @ b[:-1] + b[-1]
            return [pa_[0] * one + pa_[1], two]
        return run

    d = per_text(sealed(docs, keep, "lang", "text"), ["_kept", "lang"], {"_one": "double", "_two": "double"}, start)
    lang = F.lit(0.0)
    for x, v in shift.items():
        lang = F.when(F.col("lang") == x, F.lit(v)).otherwise(lang)
    odds = (F.col("_one") + F.lit(float(pb[0])) * (F.col("_two") + lang) + F.lit(float(pb[1]))) / 2
    return d.select(*unsealed(keep, (out,)), (1 / (1 + F.exp(-odds))).alias(out))
