"""Literal table load (O-S1), for tests and small reference data.

``load_rows``: rows are dicts, absent fields take the declared default (O-S6; date
defaults take ``as_of``), ``remaining_balance`` is computed (O-S5), and serial ids are
numbered 1..n in insertion order.  ``hospital_from_rows`` makes a Hospital of them, with
bed status as the admission trigger leaves it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.sources.roles import Hospital
from carelake.sources.schemas import DATE_DEFAULTS, DEFAULTS, SCHEMAS

SERIAL_KEYS = {"ward": "ward_id", "bed": "bed_id", "staff": "staff_id", "patient": "patient_id",
               "admission": "admission_id", "billingstatement": "billing_id", "invoice": "invoice_id",
               "payment": "payment_id"}


def load_rows(spark: SparkSession, table: str, rows: list[dict], as_of=None) -> DataFrame:
    """Literal rows -> typed DataFrame: SERIAL ids, DDL defaults, generated column."""
    schema = SCHEMAS[table]
    serial = SERIAL_KEYS.get(table)
    out = []
    for i, row in enumerate(rows, start=1):
        r = dict(row)
        if serial and r.get(serial) is None:
            r[serial] = i
        for (t, c), v in DEFAULTS.items():
            if t == table and c not in r:
                r[c] = v
        for t, c in DATE_DEFAULTS:
            if t == table and c not in r:
                r[c] = dt.date.fromisoformat(str(as_of)) if as_of else None
        if table == "billingstatement":
            r["remaining_balance"] = r["total_cost"] - r["insurance_covered_amount"]
        out.append(tuple(r.get(f.name) for f in schema.fields))
    # Constraints are not enforced at load; the rules job reports violations.
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(out, loose)


def hospital_from_rows(spark: SparkSession, tables: dict[str, list[dict]], as_of=None,
                       apply_bed_trigger: bool = True) -> Hospital:
    """A Hospital over literal rows; bed status optionally as left by the admission trigger."""
    from carelake.streaming.bed_status import fold_bed_status

    def builder(name):
        return lambda h: load_rows(spark, name, tables.get(name, []), as_of)

    builders = {name: builder(name) for name in SCHEMAS}
    if apply_bed_trigger:
        def bed(h):
            raw = load_rows(spark, "bed", tables.get("bed", []), as_of)
            inserts = load_rows(spark, "admission", tables.get("admission", []), as_of).select(
                (F.col("admission_id") * 4).alias("event_id"), F.col("admission_date").alias("event_ts"),
                F.lit("INSERT").alias("op"), "admission_id", "bed_id",
                F.lit(None).cast("long").alias("old_bed_id"), "discharge_date")
            status = fold_bed_status(raw, inserts)
            return raw.drop("bed_status").join(status.select("bed_id", "bed_status"), "bed_id")
        builders["bed"] = bed
    return Hospital(builders, spark)
