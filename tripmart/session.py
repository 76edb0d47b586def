"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every job in this package relies on. Applied with ``setIfMissing``
# semantics: an existing value (cluster defaults, spark-submit --conf) wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps in the trip data are zone-less; pin the session zone so
    # that nothing shifts when a value is rendered or compared.
    "spark.sql.session.timeZone": "UTC",
    # Integer casts must fail on overflow, like the reference's ::integer.
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "tripmart",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a master on
    this machine (``local``, ``local[n]``) may do without: it gets a private
    temporary folder. Anywhere else executors would each write a disk of their
    own, so an unset folder is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of "
                               f"{master} share")
        configured = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a named intermediate."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name.strip("/")


_cuts: ContextVar[list[str] | None] = ContextVar("tripmart_cuts", default=None)


@contextmanager
def removing_cuts(spark: SparkSession):
    """Delete the tables that ``cut_lineage`` writes inside the block when it
    ends. For jobs that publish their result before that; a block inside
    another leaves its tables to the outer one."""
    if _cuts.get() is not None:
        yield
        return
    made: list[str] = []
    token = _cuts.set(made)
    try:
        yield
    finally:
        _cuts.reset(token)
        jvm = spark.sparkContext._jvm
        for made_path in made:
            path = jvm.org.apache.hadoop.fs.Path(made_path)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str = "intermediate") -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder and
    continue from the written copy: later actions neither recompute nor
    re-plan its lineage, and a lost executor costs a re-read, not a re-run.

    A plain reliable ``checkpoint()`` would compute the plan twice (once to
    count, once to write); a local checkpoint would not survive a lost
    executor, so neither is used. The table lives as long as the checkpoint
    folder, or until the end of a ``removing_cuts`` block.
    """
    return cut_observed(df, name, [])[0]


def cut_observed(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, dict]:
    """``cut_lineage``, with aggregates over the rows (by name) that are gathered
    while they are written."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    if _cuts.get() is not None:
        _cuts.get().append(path)
    seen = Observation(name) if metrics else None
    if seen is not None:
        df = df.observe(seen, *metrics)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), seen.get if seen is not None else {}
