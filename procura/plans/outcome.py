"""Per-source outcome of a load (F11, A2): ok, no_new_data or failed with a reason.

Sources are loaded one after the other, each by its own job; whatever one raises,
in planning or in a task, ends that source only.  Row counts are observed while the rows
are written, so no source is read for its count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from procura.session import materialize, temporary_stages

SCHEMA = "objednavatel string, rows long, rows_with_errors long, status string, reason string"


class DataNotAvailable(Exception):
    """To be raised by a loader that finds nothing new."""


def reason_of(error: BaseException) -> str:
    """Class and first line of an error; of Spark's errors the condition."""
    condition = getattr(error, "getCondition", lambda: None)()
    text = (str(error).strip().splitlines() or [""])[0]
    return f"{type(error).__name__}: {condition or text}"[:300]


def run_sources(spark: SparkSession, sources: Iterable[str], load: Callable[[str], DataFrame],
                sink: Callable[[DataFrame], object]) -> DataFrame:
    """For each source: ``load(source)``, then ``sink`` of its rows if there are any.
    The rows are staged before the sink sees them, so a source that fails on the way
    leaves nothing in the sink.  Returns one row a source (SCHEMA); the sources are a
    configured list."""
    out = []
    for source in sources:
        try:
            with temporary_stages(spark):
                seen = Observation()
                rows = load(source)
                errors = F.sum((F.size("_errors") > 0).cast("int")) if "_errors" in rows.columns else F.lit(0)
                staged = materialize(rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(errors, F.lit(0)).cast("long").alias("errors")))
                found = seen.get
                if found["rows"]:
                    sink(staged)
            out.append((source, found["rows"], found["errors"], "ok" if found["rows"] else "no_new_data", None))
        except DataNotAvailable:
            out.append((source, 0, 0, "no_new_data", None))
        except Exception as e:  # noqa: BLE001  a source's error is its outcome
            out.append((source, 0, 0, "failed", reason_of(e)))
    return spark.createDataFrame(out, SCHEMA)
