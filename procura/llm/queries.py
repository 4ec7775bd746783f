"""The queries of this subpackage: ``QUERIES`` and their DuckDB ``ORACLE``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm import cotraining, hardneg, jaccard, kdtree, kneser_ney, lexical, lineblock, linefreq, mixing, notices, packing, simhash, warc
from procura.llm.common import held_out, shared_path, stored, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from each document, in the order of its first training position."""
    d = mixing.curriculum(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("n_words").alias("size"), "source_size", "target",
                    (F.col("take_1") + F.col("take_2")).alias("taken"),
                    "position_1", "position_2").orderBy("position_1", "doc_id")


ORACLE["op2_curriculum_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws('|', 'mix', doc_id, text)) AS digest FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             2.0::DOUBLE * source_size AS cap FROM r),
l AS (SELECT *, row_number() OVER o AS pos,
             (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
f AS (SELECT arg_min(level, pos) AS level FROM l WHERE cap > weight * level),
t AS (SELECT source, rank, source_size, coalesce(least(cap, weight * (SELECT level FROM f)), cap) AS target FROM l),
b AS (SELECT d.doc_id, d.size, t.rank, t.source_size, t.target, floor(t.target) AS goal,
             coalesce(sum(d.size) OVER (PARTITION BY t.rank ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(least(goal - before, size), 0) AS take_1,
             greatest(least(goal - (before + source_size), size), 0) AS take_2 FROM b),
p AS (SELECT *, CASE WHEN take_1 > 0 THEN (before + take_1 / 2.0::DOUBLE) / target END AS y1,
             CASE WHEN take_2 > 0 THEN (before + source_size + take_2 / 2.0::DOUBLE) / target END AS y2 FROM k)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, (take_1 + take_2)::BIGINT AS taken,
       {p1} AS position_1, {p2} AS position_2 FROM p
"""


def _oracle_position(y: str) -> str:
    """The inverse demand of each schedule as SQL."""
    out = "CASE"
    for i, knots in enumerate(mixing.SCHEDULES):
        total, segments = mixing.integral(knots), mixing._segments(knots)
        for k, (u0, u1, m0, m1, before) in enumerate(segments):
            bound = f" AND {y} * {total}::DOUBLE < {segments[k + 1][4]}::DOUBLE" if k + 1 < len(segments) else ""
            r = f"({y} * {total}::DOUBLE - {before}::DOUBLE)"
            root = f"sqrt(greatest({m0 * m0}::DOUBLE + {2 * (m1 - m0) / (u1 - u0)}::DOUBLE * {r}, 0.0::DOUBLE))"
            out += (f" WHEN {y} IS NOT NULL AND rank % {len(mixing.SCHEDULES)} = {i}{bound} THEN CASE WHEN {r} <= 0 THEN {u0}::DOUBLE "
                    f"ELSE least({u0}::DOUBLE + 2.0::DOUBLE * {r} / ({m0}::DOUBLE + {root}), {u1}::DOUBLE) END")
    return out + " END"


ORACLE["op2_curriculum_mix"] = ORACLE["op2_curriculum_mix"].replace("{p1}", _oracle_position("y1")).replace("{p2}", _oracle_position("y2"))


@query
def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes."""
    d = kdtree.kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with line frequencies per source as the host."""
    d = linefreq.line_rules(table(spark, sf_dir, "documents"), host="source")
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_left_words")


ORACLE["op7_line_frequency"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
      FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM d WHERE len(words) >= 3)),
r AS (SELECT id, i, count(*) OVER (PARTITION BY id, w) AS n FROM g),
c AS (SELECT id, count(DISTINCT i + k) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY id),
l AS (SELECT id, source, trim(regexp_replace(translate(lower(x), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT id, source, unnest(lines) AS x FROM d)),
o AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT id) > 100),
m AS (SELECT l.id, sum(l.n) AS removed FROM l JOIN o ON l.line = o.line AND l.source IS NOT DISTINCT FROM o.source GROUP BY l.id),
f AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(words) - coalesce(removed, 0) AS n_left_words
      FROM d LEFT JOIN c USING (id) LEFT JOIN m USING (id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       n_left_words::BIGINT AS n_left_words,
       NOT base_failed AND n_left_words >= 50 AND n_left_words >= 0.3 * n_words AS kept FROM b
"""


@query
def op1_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path, min_revisit=0)
    r = warc.read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, r"urn:page:(-?\d+)", 1).try_cast("long")
    revisit = F.col("type") == "revisit"
    claimed = F.regexp_replace("digest", "^sha1:", "")
    return r.select(number("id").alias("page_id"),
                    F.when(revisit, F.col("claimed_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                    F.when(revisit, claimed).otherwise(F.col("payload_digest")).alias("payload_digest"),
                    F.col("type").alias("record_type"), F.when(revisit, number("refers")).alias("refers_to"))


ORACLE["op1_warc_chain"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, """ + " || ".join(
    f"translate(lower(to_base(('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT, 32, 4)), '0123456789abcdefghijklmnopqrstuv', "
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in range(8)) + r""" AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM d
"""


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


@query
def op9_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = kneser_ney.fit(docs, table(spark, sf_dir, "labels"))
    d = kneser_ney.score(docs, model, ["doc_id"])
    return d.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are at least 85 % similar."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; for documents with
    a doc_id divisible by 100, how many others lie within the Hamming radius and
    the fingerprints these have (their documents: the rows with them)."""
    d = stored(simhash.fingerprint_edits(table(spark, sf_dir, "documents")), "fingerprints")
    asked = F.col("doc_id") % 100 == 0
    near = simhash.near_fingerprints(d.filter(asked), d.select("fingerprint"))
    near = near.select(F.col("fingerprint").alias("_of"), (F.col("n_near") - 1).alias("n_near"), "near")
    return d.join(stored(near, "near"), asked & (F.col("fingerprint") == F.col("_of")), "left").drop("_of")


@query
def op4_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    d = cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return d.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).alias("kept"))


@query
def op5_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and fuzzy license notices of every document."""
    d = notices.license_notices(table(spark, sf_dir, "documents"))
    place = F.transform("exact", lambda x: x["word"])
    label = lambda c: F.array_distinct(F.transform(c, lambda x: x["label"]))
    sure = F.transform("fuzzy", lambda x: 1.0 - x["errors"] / F.greatest(F.char_length(x["text"]), F.lit(1)))
    return d.select("doc_id", "n_words", F.size("exact").cast("long").alias("n_base"),
                    F.array_min(place).alias("first_word"), F.array_max(place).alias("last_word"),
                    F.array_join(F.array_sort(label("exact")), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(label("exact"), label("fuzzy"))), ",").alias("labels"),
                    F.greatest(F.coalesce(F.array_max(sure), F.lit(0.0)), F.lit(0.0)).alias("score"), "fuzzy")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to packed sequences."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor row for each of its positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    d = hardneg.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)
    return d.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS ints
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             list_sum(list_transform(range(1, len(a.ints) + 1), lambda i: a.ints[i] * c.ints[i]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
             other_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
       AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=20)


ORACLE["op12_lexical_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, t, len(t) AS n FROM (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents) WHERE len(t) > 0),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d),
p AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM d) GROUP BY id, term),
v AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, nn),
m AS (SELECT id, doc_id, 75 + (25 * n * nn) // ll AS m FROM d, s),
q AS (SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
r AS (SELECT item_id, doc_id, id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN v USING (term) JOIN p USING (term) JOIN m USING (id) GROUP BY item_id, doc_id, id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""


@query
def op13_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return lineblock.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


# Every page of the given tables names its article and holds no notices inside it, so
# plain SQL can take it apart; tests hold other pages to given texts.
ORACLE["op13_line_blocks"] = r"""
WITH a AS (SELECT page_id, url, list_transform(
             regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h1|p)>'),
             lambda x: trim(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'),
                                                           '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))) AS blocks FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM a)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
