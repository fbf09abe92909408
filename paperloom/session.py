"""Session defaults and lineage cuts."""

from __future__ import annotations

import atexit
import itertools
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library relies on; anything the caller has set wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "paperloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (tests on one machine) a local folder stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = os.path.join(tempfile.gettempdir(), "paperloom-checkpoints")
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` reliably and return the written copy, partition by partition the same."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


_serial = itertools.count()
_cleaned: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder; deleted with the application's others by ``release`` or when its
    driver ends."""
    home = f"{shared_folder(spark)}/paperloom-tables-{spark.sparkContext.applicationId}"
    if home not in _cleaned:
        _cleaned.add(home)
        atexit.register(_delete, spark, home)
    return f"{home}/{os.getpid()}-{next(_serial)}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and return that table.

    For results that several later steps read: the plan behind them is not run or planned
    again, and a lost executor costs no recomputation. The job runs when this is called. Tables
    stay until ``release`` is called or the driver ends, since the result built on them reads them.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables and files written for queries so far. For long sessions, once the results
    have been read or stored; frames built on them can't be read afterwards."""
    home = f"{shared_folder(spark)}/paperloom-tables-{spark.sparkContext.applicationId}"
    _delete(spark, home)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone already
        pass
