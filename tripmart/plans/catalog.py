"""SQL access to the tables: each table root's newest snapshot as a temp view,
so the queries a user runs against the reference's tables (for example the
latest test results, newest first) run unchanged through ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripmart.schemas import FCT_TRIPS, STAGING_TRIPS, TEST_RESULTS, ZONE_DIM
from tripmart.sources.sinks import read_latest, read_log

# View name -> schema of the table it exposes.
TABLES = {
    "stg_trips_enriched": STAGING_TRIPS,
    "fct_trips": FCT_TRIPS,
    "test_results": TEST_RESULTS,
    "zone_dim_scd2": ZONE_DIM,
}


def register_tables(spark: SparkSession, roots: dict[str, str]) -> list[str]:
    """Create or replace one temp view per given root; returns the names.

    ``roots`` maps a view name to a table root (snapshot directories) or, for
    the append-only results log, to its directory of runs.
    """
    names = []
    for name, root in roots.items():
        if name == "test_results":
            df = read_log(spark, root, TABLES[name])
        else:
            df = read_latest(spark, root, TABLES[name])
        if df is None:
            continue
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
