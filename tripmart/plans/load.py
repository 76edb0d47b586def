"""L1: load curated trip files into the staging table.

S1 read, by layout of the files -> P1 renames -> P2 column check (schema only, fails before any job)
-> P3 canonical select -> cast to the staging types -> K5 load time -> K3 publish as one new snapshot,
with the row count (K6) observed during that single write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.functions import ntz
from tripmart.sources.curated import canonical_trips
from tripmart.sources.sinks import publish_snapshot, with_defaults


@dataclass
class LoadReport:
    rows: int
    target: str
    source: str

    def __str__(self) -> str:
        return f"Loaded {self.rows} rows into {self.target} from {self.source}"


def load_trips(spark: SparkSession, source_path: str, staging_root: str,
               loaded_at=None) -> LoadReport:
    """Replace the staging table's content with the curated files at
    ``source_path``; files may differ in names, order and types of columns. ``loaded_at`` defaults to the run clock."""
    df = canonical_trips(spark, source_path)
    stamp = ntz(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()
    df = with_defaults(df, {"loaded_at": stamp})
    path, rows = publish_snapshot(df, staging_root)
    return LoadReport(rows=rows, target=path, source=source_path)
