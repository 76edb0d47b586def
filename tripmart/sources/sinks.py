"""K1-K7: sinks. Tables are directories of immutable snapshots.

A table root holds ``snapshot=<n>/`` directories; a snapshot is complete when
our own ``_COMPLETE`` marker is in it, written last (Spark's ``_SUCCESS`` depends
on the committer and its settings), and readers take the highest complete
one. A root with snapshots of which none is complete is an error, never an
empty table. Writing a new snapshot never touches the one being read, so a full
refresh is atomic for readers (the reference's TRUNCATE + INSERT in one
transaction), and a failed or repeated job leaves the previous snapshot as
the current one. The filesystem is reached through Spark's Hadoop
configuration, so the same code serves local paths and cluster stores.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.sources import versioned

SNAPSHOT_PREFIX = "snapshot="
COMPLETE_MARKER = "_COMPLETE"


class SnapshotError(RuntimeError):
    """A table root holds snapshots, but none that is complete."""


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _snapshots(spark: SparkSession, root: str) -> dict[int, bool]:
    """Ids of the snapshots under ``root``, each with whether it is complete."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return {}
    jvm = spark.sparkContext._jvm
    found = {}
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(SNAPSHOT_PREFIX):
            try:
                n = int(name[len(SNAPSHOT_PREFIX):])
            except ValueError:
                continue
            found[n] = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), COMPLETE_MARKER))
    return found


def list_snapshots(spark: SparkSession, root: str) -> list[int]:
    """Ids of complete snapshots under ``root``, ascending. Raises if there are
    snapshots but no complete one."""
    if versioned.is_versioned(spark, root):
        return versioned.VersionedTable.at(spark, root).versions()
    found = _snapshots(spark, root)
    complete = sorted(n for n, whole in found.items() if whole)
    if found and not complete:
        raise SnapshotError(f"{root} holds {len(found)} snapshots without {COMPLETE_MARKER}; "
                            "restore one, or remove them to start anew")
    return complete


def snapshot_path(root: str, snapshot_id: int) -> str:
    return f"{root.rstrip('/')}/{SNAPSHOT_PREFIX}{snapshot_id}"


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    ids = list_snapshots(spark, root)
    return snapshot_path(root, ids[-1]) if ids else None


def read_latest(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The newest snapshot of a table (versioned ones too); None without any."""
    if versioned.is_versioned(spark, root):
        return versioned.VersionedTable.at(spark, root, schema).read()
    path = latest_snapshot(spark, root)
    if path is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def publish_snapshot(df: DataFrame, root: str, count_rows: bool = True) -> tuple[str, int | None]:
    """K3: write ``df`` as the next snapshot of ``root``; returns (path, rows).

    The row count (K6) is gathered by an observation during the same write,
    not by a second job over the data.
    """
    path, seen = publish_observed(df, root, [F.count(F.lit(1)).alias("rows")] if count_rows else [])
    return path, seen.get("rows")


def publish_observed(df: DataFrame, root: str, metrics: list[Column]) -> tuple[str, dict]:
    """``publish_snapshot`` with aggregates over the rows, by name, that are
    gathered while the rows are written."""
    spark = df.sparkSession
    # Ids left behind by failed writes are not used again.
    path = snapshot_path(root, max(_snapshots(spark, root), default=0) + 1)
    seen = {}
    if metrics:
        obs = Observation("published_rows")
        df = df.observe(obs, *metrics)
    df.write.mode("errorifexists").parquet(path)
    if metrics:
        seen = obs.get
    fs, _ = _fs(spark, root)
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, COMPLETE_MARKER)).close()
    return path, seen


RUN_PREFIX = "run="


def append_rows(df: DataFrame, path: str, run_id: str) -> None:
    """K4: add a run's rows to a log. Each run is a snapshot table of its own, so
    a failed append shows nothing and a repeated run replaces its own rows."""
    publish_snapshot(df, f"{path.rstrip('/')}/{RUN_PREFIX}{quote(run_id, safe='')}",
                     count_rows=False)


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of a log: of every run, its newest complete snapshot."""
    fs, root = _fs(spark, path.rstrip("/"))
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    runs = [latest_snapshot(spark, f"{path.rstrip('/')}/{n}") for n in sorted(names)
            if n.startswith(RUN_PREFIX)]
    runs = [r for r in runs if r]
    return spark.read.schema(schema).parquet(*runs) if runs else spark.createDataFrame([], schema)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """K5: fill columns the writer did not give (missing or NULL) with a
    default column, such as ``current_timestamp()`` or ``current_user()``."""
    cols = {}
    for name, default in defaults.items():
        cols[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(cols)


def write_jdbc_truncate_load(df: DataFrame, url: str, table: str,
                             properties: dict[str, str]) -> None:
    """K1 + K2 on a JDBC target, in one write: ``truncate=true`` keeps the
    table definition (types, defaults) and replaces the rows. Not run here:
    no database is available to the tests."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
       .option("truncate", "true").options(**properties).mode("overwrite").save())
