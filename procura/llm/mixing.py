"""Time-varying curriculum: mix sources to target word counts.

Each source has a weight and a schedule, a piecewise linear multiplier over
training time u in [0, 1].  The schedule's integral up to u is the source's
cumulative demand; a document's place in its source's demand (the words taken
before it) is put through the inverse of that integral and gives its training
position.  Rows are then range-sorted by position.

Native: DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.llm.common import running_before, sealed, stored, unsealed, word_count

#: weights given to the sources in code point order, repeating
WEIGHTS = (3, 1, 2)
#: schedules given out like the weights: knots (u, multiplier); each integrates to 1
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
             ((0.0, 1.75), (0.5, 0.75), (1.0, 0.75)))
SHARE = 1.5
MAX_REPEAT = 2


def _segments(knots) -> list[tuple[float, float, float, float, float]]:
    """(u0, u1, m0, m1, integral up to u0) of each linear piece."""
    out, total = [], 0.0
    for (u0, m0), (u1, m1) in zip(knots, knots[1:]):
        out.append((u0, u1, m0, m1, total))
        total += (m0 + m1) / 2 * (u1 - u0)
    return out


def integral(knots) -> float:
    u0, u1, m0, m1, before = _segments(knots)[-1]
    return before + (m0 + m1) / 2 * (u1 - u0)


def inverse_demand(share: Column, knots) -> Column:
    """Training time at which the demand reaches ``share`` (0..1) of its total:
    the positive root of the quadratic of the piece that holds it."""
    total = integral(knots)
    out = None
    for u0, u1, m0, m1, before in reversed(_segments(knots)):
        slope = (m1 - m0) / (u1 - u0)
        r = share * F.lit(total) - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(m0 * m0) + F.lit(2 * slope) * r, F.lit(0.0)))
        t = F.lit(u0) + F.lit(2.0) * r / (F.lit(m0) + root)
        piece = F.when(r <= 0, F.lit(u0)).otherwise(F.least(t, F.lit(u1)))
        out = piece if out is None else F.when(share * F.lit(total) < F.lit(nxt), piece).otherwise(out)
        nxt = before
    return out


def source_targets(sizes: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``sizes``: source, source_size (one row per source).  Adds rank (from 0),
    weight and target: ``share`` of all words dealt by weight, each target at
    most ``max_repeat`` times its source, the excess dealt again by weight.

    The fixed point of that dealing has a closed form: in the order of
    cap / weight the capped sources come first, and the level of the others is
    what is left over the weight that is left.  One row per source, so the
    windows here hold the list of sources only."""
    n = len(weights)
    w = [float(a) * integral(schedules[i % len(schedules)]) for i, a in enumerate(weights)]
    by_name = W.orderBy(F.asc_nulls_last("source"))
    s = (sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
         .withColumn("weight", F.element_at(F.array(*map(F.lit, w)), (F.col("rank") % n + 1).cast("int")))
         .withColumn("_cap", F.lit(float(max_repeat)) * F.col("source_size")))
    order = W.orderBy(F.col("_cap") / F.col("weight"), "rank")
    level = ((F.lit(float(share)) * F.sum("source_size").over(W.partitionBy())
              - F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
    s = s.withColumn("_level", level).withColumn("_pos", F.row_number().over(order))
    free = F.when(F.col("_cap") > F.col("weight") * F.col("_level"), F.struct("_pos", "_level"))
    s = s.withColumn("_level", F.min(free).over(W.partitionBy())["_level"])
    return s.withColumn("target", F.coalesce(F.least(F.col("_cap"), F.col("weight") * F.col("_level")),
                                             F.col("_cap"))).drop("_cap", "_level", "_pos")


def curriculum(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
               max_repeat: float = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """Per document: the columns of ``docs`` except text (n_words in its place),
    source_size, target, and for each pass over the source the words taken
    (take_1, take_2, ...) and the training position (position_1, ...; null
    where nothing is taken).

    Within a source documents go in the order of a seeded MD5 of doc_id and
    text.  A pass takes whole documents; the last one is cut, so that a
    source's taken words are its target rounded down.  Null text: size 0, no
    words taken.  Null source: a source of its own, last.  Repeated rows are
    separate documents.  A column of ``docs`` named like one of the results gives
    way.  Empty input: no rows."""
    keep = [c for c in docs.columns if c != "text"]
    d = sealed(docs, keep, "source", word_count(F.col("text")).alias("_size"),
               F.md5(F.concat_ws("|", F.lit(seed), "doc_id", "text")).alias("_digest"))
    d = places(stored(d, "mix"), weights, schedules, share, max_repeat)
    d = d.withColumnRenamed("_size", "n_words")
    made = [c for c in d.columns if c not in ("_kept", "_digest", "source")]
    return d.select(*unsealed(keep, tuple(made)), *made)


def places(d: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
           max_repeat: float = MAX_REPEAT, narrow: DataFrame | None = None) -> DataFrame:
    """``curriculum`` for a table with source, _size and _digest; ``narrow``: these
    columns of it, stored."""
    narrow = d if narrow is None else narrow
    sizes = narrow.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_rows"))
    targets = stored(source_targets(sizes, weights, schedules, share, max_repeat), "mix_targets")
    rows = targets.agg(F.sum("_rows")).first()[0] or 0
    t = targets.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    # one row per source: Spark broadcasts it below its size limit, else joins by shuffle
    def ranked(x):
        return x.join(t, x["source"].eqNullSafe(t["_source"])).drop("_source")

    d = running_before(ranked(d), "rank", "_digest", F.col("_size"), "_before", rows, narrow=ranked(narrow))
    goal = F.floor(F.col("target"))
    for p in range(math.ceil(max_repeat)):
        begin = F.col("_before") + F.lit(p) * F.col("source_size")
        take = F.greatest(F.least(goal - begin, F.col("_size")), F.lit(0)).cast("long")
        d = d.withColumn(f"take_{p + 1}", take)
        taken = F.col(f"take_{p + 1}")
        where = (begin + taken / F.lit(2.0)) / F.col("target")
        place = None
        for i, knots in reversed(list(enumerate(schedules))):
            at = inverse_demand(where, knots)
            place = at if place is None else F.when(F.col("rank") % len(schedules) == i, at).otherwise(place)
        d = d.withColumn(f"position_{p + 1}", F.when(taken > 0, place))
    return d.drop("_before", "rank")


def cut_words(text: Column, words: Column) -> Column:
    """The text up to the end of its word number ``words``."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def training_rows(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: one row per document and pass that takes it, columns of
    ``docs`` (of any names), range-sorted by training position.  A document that
    is cut keeps its first words (n_chars follows, where the column is there)."""
    max_repeat = params.get("max_repeat", MAX_REPEAT)
    seed = params.pop("seed", "mix")
    names = [c for c in docs.columns if c not in ("text", "n_chars")]
    length = [F.col("n_chars").alias("_chars")] if "n_chars" in docs.columns else []
    made = {"_size": word_count(F.col("text")), "_digest": F.md5(F.concat_ws("|", F.lit(seed), "doc_id", "text"))}
    narrow = stored(docs.select("source", *[c.alias(n) for n, c in made.items()]), "mix")
    d = sealed(docs, names, "source", "text", *length, *[c.alias(n) for n, c in made.items()])
    d = places(d, narrow=narrow, **params)
    passes = F.array(*[F.struct(F.col(f"take_{p}").alias("take"), F.col(f"position_{p}").alias("position"))
                       for p in range(1, math.ceil(max_repeat) + 1)])
    d = d.withColumn("_pass", F.explode(F.filter(passes, lambda x: x["take"] > 0)))
    cut = F.col("_pass.take") < F.col("_size")
    d = d.withColumn("text", F.when(cut, cut_words(F.col("text"), F.col("_pass.take"))).otherwise(F.col("text")))
    if length:
        d = d.withColumn("_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_chars")))
    back = dict(zip(names, unsealed(names))) | {"text": F.col("text")} | ({"n_chars": F.col("_chars").alias("n_chars")} if length else {})
    return d.orderBy("_pass.position", "_digest").select(*[back[c] for c in docs.columns])
