"""Land the fifteen hospital tables as Parquet (a one-off ETL step).

usage: python scripts/land_tables.py SF_DIR [OUT] [--buckets N --database DB]

Derives the tables from the driver's tables under SF_DIR and writes them to
OUT (default: a fresh folder under ``spark.checkpoint.dir``), admissions
range-clustered by date.  With ``--buckets``, Admission and BillingStatement
are bucketed on ``admission_id`` as tables of DB.  Prints the output path.
"""

import argparse
import sys

sys.path.insert(0, ".")

from carelake.session import get_session  # noqa: E402
from carelake.sources.catalog import land  # noqa: E402
from carelake.sources.roles import from_driver_tables  # noqa: E402

if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir")
    ap.add_argument("out", nargs="?")
    ap.add_argument("--buckets", type=int)
    ap.add_argument("--database", default="carelake")
    args = ap.parse_args()
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    path = land(from_driver_tables(spark, args.sf_dir), args.out, buckets=args.buckets,
                database=args.database if args.buckets else None)
    print(path)
