"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from procura.session import checkpoint_dir

#: Words: maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the cluster names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables stored inside are deleted at the end, but for those stored with
    ``outlives``: results must be stored before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str, outlives: bool = False, **options) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage,
    survives lost executors, and gives later joins a known size.  ``options`` are the
    writer's."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    scopes = _scopes[:-1] if outlives else _scopes
    if scopes:
        scopes[-1].append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python in Arrow batches of at most ``rows`` rows, so
    that a task's memory does not depend on the session's larger default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_bucket(hex_digest: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a hexadecimal digest, in the digests' order."""
    top = F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("long")
    return F.floor(top * F.lit(buckets) / F.lit(1 << 32)).cast("int")


def running_before(df: DataFrame, group: str, digest: str, value: Column, out: str, rows: int,
                   per_bucket: int = 20_000, narrow: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group with a
    smaller ``digest`` (rows with equal digests in any order among themselves).

    Each group is cut into buckets along the digest, so that a group holding
    most rows is summed by many tasks; bucket sums are added up per group.
    ``rows``: number of rows of ``df``; a bucket of a group has about
    ``per_bucket`` rows at most.  ``narrow``: the same rows without the columns
    that only pass through."""
    buckets = max(1, -(-rows // per_bucket))

    def cut(x):
        return x.withColumn("_bucket", hash_bucket(F.col(digest), buckets)).withColumn("_value", value)

    d = cut(df)
    sums = cut(df if narrow is None else narrow).groupBy(group, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(group, "_bucket").orderBy(digest).rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = d.join(sums, d[group].eqNullSafe(sums["_g"]) & (d["_bucket"] == sums["_b"]))
    return joined.withColumn(out, F.col("_start") + F.col("_inside")).drop(
        "_bucket", "_value", "_g", "_b", "_start", "_inside")


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
          "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
          "array<struct<label:string,word:long>>": pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])),
          "array<struct<label:string,word:long,errors:int,text:string>>": pa.list_(pa.struct(
              [("label", pa.string()), ("word", pa.int64()), ("errors", pa.int32()), ("text", pa.string())]))}


def per_text(docs: DataFrame, keep: list[str], out: dict[str, str], start, rows: int = 512) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``out`` (name: Spark type), which a
    function makes from slices of ``rows`` texts: ``start()``, called once in a
    task, returns it; it takes a list of texts (null: None) and returns the
    columns in order."""
    types = [_ARROW[t] for t in out.values()]
    small_batches(docs.sparkSession)

    def run(batches):
        f = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = f(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), *(pa.array(c, t) for c, t in zip(made, types))],
                    names=[*keep, *out])
        pa.default_memory_pool().release_unused()

    kept = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep]
    schema = ", ".join([*kept, *(f"`{n}` {t}" for n, t in out.items())])
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def sealed(docs: DataFrame, keep: list[str], *needed: str | Column) -> DataFrame:
    """The columns ``keep`` as one column ``_kept``, so that none of their names
    meets an operator's own, and the ``needed`` ones."""
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)] or [F.lit(0).alias("k0")]
    return docs.select(F.struct(*kept).alias("_kept"), *needed)


def unsealed(keep: list[str], but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``_kept`` by their names, but for those named in ``but``."""
    return [F.col(f"_kept.k{i}").alias(c) for i, c in enumerate(keep) if c.lower() not in {b.lower() for b in but}]


def held_out() -> Column:
    """Whether a row's label is never learned from: crc32 of doc_id as text,
    mod 5, is 0 (null doc_id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def join_small(left: DataFrame, right: DataFrame, on: str, max_rows: int = 500_000) -> DataFrame:
    """Inner join that broadcasts ``right`` (a few numbers a row) only after
    counting at most ``max_rows`` rows; otherwise both sides are shuffled."""
    if right.limit(max_rows + 1).count() <= max_rows:
        right = F.broadcast(right)
    return left.join(right, on)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, weight: np.ndarray | None = None,
                 rounds: int = 30, rows: int = 1024) -> np.ndarray:
    """Coefficients and intercept (last) of a logistic regression with an L2
    penalty on the coefficients; Newton's method, its sums made in blocks of
    ``rows`` rows."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    weight = np.ones(len(x)) if weight is None else weight
    for _ in range(rounds):
        grad, second = ridge @ w, ridge.copy()
        for at in range(0, len(x), rows):
            part = slice(at, at + rows)
            a = np.c_[x[part], np.ones(len(x[part]))].astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            grad += a.T @ (weight[part] * (p - y[part]))
            second += (a * (weight[part] * p * (1 - p))[:, None]).T @ a
        step = np.linalg.solve(second, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w
