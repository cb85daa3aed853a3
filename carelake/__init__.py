"""carelake: hospital-operations analytics on Spark DataFrames.

The package answers the twenty analytical questions of a hospital
workload (staffing, admissions, billing, wards) plus data-rule checks
and a bed-status change stream.  Every operator is a function from
DataFrames to a DataFrame; nothing is collected to the driver.

Layout
------
sources/    schemas, the sample fixture, the role mapping onto the
            driver's TPC-H-like tables (Spark and DuckDB forms)
functions/  column-expression helpers (dates, rounding, JSON)
operators/  reusable scale-safe operators (distributed rank, exact
            percentiles, next-event lookups, bounded hierarchy, ...)
plans/      the twenty queries, composed from the operators
checks/     schema rules as batch validation jobs
streaming/  bed status from admission change records (batch + stream)
"""

from carelake.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
