"""SparkSession helpers shared by tests, bench and the driver entry."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: folders written by ``materialize``, until ``release``
_STORED: list[str] = []

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # parsing costs far more per byte than reading: small shuffles keep their parallelism
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # lineage cuts of finished stages are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "procura") -> SparkSession:
    """Local session for tests / bench.  On a cluster use the provided session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("PROCURA_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables: ``spark.checkpoint.dir``
    (registered with the context if needed).  Only a local session without the
    setting gets a scratch folder; a cluster without it is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if re.match(r"local(\[|$)", sc.master) is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="procura-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one write, inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer files than there are cores is dealt out to all of them
    (before expensive parsing); any other is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def materialize(df: DataFrame) -> DataFrame:
    """Write a finished stage once as Parquet to the shared folder and read it
    back: cuts the lineage, survives executor loss, and later filters and
    projections reach the scan (pushed filters, narrow read schema)."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, but: int = 0) -> None:
    """Delete the folders ``materialize`` wrote in this session, but for the first
    ``but`` ones; to be called when the results built on them are written."""
    jvm = spark.sparkContext._jvm
    while len(_STORED) > but:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_stages(spark: SparkSession):
    """Stages stored inside are deleted at the end: what is built on them is to be
    written before."""
    before = len(_STORED)
    try:
        yield
    finally:
        release(spark, before)
