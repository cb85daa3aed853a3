"""Stored hospital tables: land once as Parquet, query many times.

The role mapping derives the tables on the fly, which is what the oracle
needs; a deployment lands them once instead.  Landed tables keep every
plan's filters on real columns, so they reach the Parquet scan
(``PushedFilters``) and skip row groups by min/max statistics:

* ``admission`` is range-partitioned and sorted by ``admission_date``, so a
  time window (activity feed, recent admissions) reads only the files and
  row groups that overlap it;
* with ``weekly``, admissions, bills and payments are also cut into one folder a week of their date
  (column ``WEEK``).  A time filter that names the week too (``since``) reads the folders of its
  weeks and no others, and a join on the week with a filtered calendar prunes them at run time;
* with ``buckets=n``, Admission and BillingStatement are also bucketed on
  ``admission_id`` into the same n buckets (and sorted by date inside each
  bucket), so their join, the largest in the workload, runs without a
  shuffle; the tables are registered in a session database for that.
* the other tables are written as they come, one folder each.

Landing writes to the shared folder (``spark.checkpoint.dir`` by default),
never to a machine-local path on a cluster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit

from carelake.session import staging_path
from carelake.sources.roles import Hospital
from carelake.sources.schemas import DATE_DEFAULTS, DEFAULTS, SCHEMAS, WEEK

CLUSTER_BY = {"admission": "admission_date", "billingstatement": "discharge_date",
              "payment": "payment_date"}
BUCKET_BY = {"admission": "admission_id", "billingstatement": "admission_id"}

def week_of(c: Column) -> Column:
    """The Monday of a date's week, the value of ``WEEK``."""
    return F.to_date(F.date_trunc("week", c.cast("timestamp_ntz")))


def since(h: Hospital, table: str, day: Column) -> DataFrame:
    """Rows of ``table`` whose CLUSTER_BY date is at or after ``day``'s midnight; partitions of earlier weeks aren't read."""
    df, key = getattr(h, table), CLUSTER_BY[table]
    found = df.filter(F.col(key) >= day.cast(df.schema[key].dataType))
    return found.filter(F.col(WEEK) >= week_of(day)).drop(WEEK) if WEEK in df.columns else found


def land(h: Hospital, path: str | None = None, files_per_table: int | None = None,
         buckets: int | None = None, database: str | None = None, weekly: bool = False) -> str:
    """Write all fifteen tables under ``path`` (a fresh folder in the shared dir by default).

    With ``weekly``, the tables of CLUSTER_BY are partitioned by the week of their date.  With
    ``buckets``, the join-key tables are written as bucketed tables of
    ``database`` (created if missing) whose files live under ``path``.
    """
    path = path or staging_path(h.spark, "hospital-tables")
    if buckets:
        h.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in h.tables().items():
        key = CLUSTER_BY.get(name)
        if buckets and name in BUCKET_BY:
            (df.write.bucketBy(buckets, BUCKET_BY[name]).sortBy(key).mode("overwrite")
             .option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}"))
            continue
        if key:
            n = files_per_table or h.spark.conf.get("spark.sql.shuffle.partitions")
            df = df.repartitionByRange(int(n), key).sortWithinPartitions(key)
            if weekly:
                df.withColumn(WEEK, week_of(F.col(key))).write.mode("overwrite").partitionBy(WEEK).parquet(f"{path}/{name}")
                continue
        elif files_per_table:
            df = df.repartition(files_per_table)
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def completed(df: DataFrame, table: str, as_of) -> DataFrame:
    """``df`` with the columns that its files lack: declared defaults, dates that default to the
    day of the load (``as_of``), and the generated balance.  A stored value, NULL too, stays."""
    have = set(df.columns)
    for (t, c), value in DEFAULTS.items():
        if t == table and c not in have:
            df = df.withColumn(c, F.lit(value))
    for t, c in DATE_DEFAULTS:
        if t == table and c not in have:
            df = df.withColumn(c, as_of_lit(as_of))
    if table == "billingstatement":  # generated: always computed, whatever the files say
        df = df.withColumn("remaining_balance", (F.col("total_cost") - F.col("insurance_covered_amount"))
                           .cast("decimal(10,2)"))
    for f in SCHEMAS[table].fields:
        if f.name not in df.columns:
            if not f.nullable:
                raise ValueError(f"{table}.{f.name} is required and has no default")
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def from_parquet_tables(spark: SparkSession, path: str, database: str | None = None, as_of=None) -> Hospital:
    """A Hospital reading landed tables.

    Columns that the files lack are completed (``completed``); ``as_of`` is the day that
    date defaults take (default: today).  Tables landed as bucketed tables are read
    through ``database`` so the planner sees their bucketing.
    """
    day = as_of or dt.date.today()

    def builder(name):
        if database and spark.catalog.tableExists(f"{database}.{name}"):
            return lambda h: spark.table(f"{database}.{name}")
        return lambda h: completed(spark.read.parquet(f"{path}/{name}"), name, day)
    return Hospital({name: builder(name) for name in SCHEMAS}, spark)
