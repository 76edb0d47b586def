"""tripmart: trip fact, data-quality tests and a governed SCD2 zone dimension
on Spark DataFrames."""

from tripmart.operators.checks import dim_checks  # noqa: F401
from tripmart.operators.pit import zone_as_of  # noqa: F401
from tripmart.operators.quality import dq_metrics, dq_tests  # noqa: F401
from tripmart.operators.scd2 import (  # noqa: F401
    approve_versions,
    rollback_versions,
    seed_zone_dim,
    upsert_zone_scd2,
    version_history,
)
from tripmart.plans.fact import build_fct_trips  # noqa: F401
from tripmart.plans.load import load_trips  # noqa: F401
from tripmart.plans.pipeline import apply_governed_batch, run_pipeline  # noqa: F401
