"""The rule of one to five specialties a doctor (O-D8), kept current as a stream.

The workload checks it with a row trigger.  Here records say that a doctor is on the books, or
gained or lost a specialty.  Per doctor the stream's state holds, for every specialty it has
seen, the newest record; a doctor's count is the number of specialties whose newest record is a gain.
When a doctor crosses a bound of the rule, in either direction, or violates it with another count,
the stream emits rows: the violation that held so far is taken back (``change`` -1), the new one is
reported (+1).  The sum of the changes of all rows is therefore the list of current violations.

Newest is by (time, event id), so late records can't undo newer ones, repeated ones change
nothing, and any order or split of the records ends in the batch answer.  The state of a doctor
is bounded by the specialties there are, and doctors are dealt over tasks.  The state function
is Python (Spark has no built-in state of this form); rows reach it as Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from carelake.checks.rules import MAX_SPECIALTIES
from carelake.session import staging_path
from carelake.sources.roles import Hospital
from carelake.streaming.bed_status import rocksdb_state, stage_change_log

#: kind: 'doctor' (is on the books), 'gain', 'loss'
EVENT_SCHEMA = "event_id long, event_ts timestamp, kind string, doctor_id long, specialty_name string"
STATE = "names array<string>, ts array<long>, ids array<long>, held array<boolean>, listed boolean, reported long"
OUT = "doctor_id long, specialty_count long, change int"


def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take a doctor's records into its state; rows if what is reported of it changes."""
    names, ts, ids, held, listed, reported = state.get if state.exists else ([], [], [], [], False, None)
    newest = {n: (t, i, h) for n, t, i, h in zip(names, ts, ids, held, strict=True)}
    for part in parts:
        for i, t, kind, name in zip(part["event_id"], part["ts"], part["kind"], part["specialty_name"], strict=True):
            if kind == "doctor":
                listed = True
            elif name is not None:
                newest[name] = max(newest.get(name, (t, i, kind == "gain")), (t, i, kind == "gain"))
    count = sum(h for _, _, h in newest.values())
    violated = count if listed and not 1 <= count <= MAX_SPECIALTIES else None
    state.update(([*newest], [int(t) for t, _, _ in newest.values()], [int(i) for _, i, _ in newest.values()],
                  [bool(h) for _, _, h in newest.values()], bool(listed), violated))
    if violated != reported:
        rows = [(key[0], n, c) for n, c in ((reported, -1), (violated, 1)) if n is not None]
        yield pd.DataFrame(rows, columns=["doctor_id", "specialty_count", "change"])


def run_specialty_stream(spark: SparkSession, source: str, out: str | None = None, checkpoint: str | None = None,
                         files_per_trigger: int | None = None) -> str:
    """Follow the event files below ``source`` until caught up; returns the folder of emitted changes.

    Resumes with the ``out`` and ``checkpoint`` of an earlier run.
    """
    out = out or staging_path(spark, "specialty-changes")
    checkpoint = checkpoint or staging_path(spark, "specialty-ckpt")
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    events = reader.parquet(source).where("doctor_id IS NOT NULL").withColumn("ts", F.unix_micros("event_ts"))
    changes = events.groupBy("doctor_id").applyInPandasWithState(
        follow, OUT, STATE, "update", GroupStateTimeout.NoTimeout)
    with rocksdb_state(spark):
        q = (changes.writeStream.outputMode("update").foreachBatch(
                lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return out


def current_violations(spark: SparkSession, out: str) -> DataFrame:
    """``(doctor_id, specialty_count)`` of the violations that were reported and not taken back."""
    changes = spark.read.schema(OUT + ", batch_id long").parquet(out)
    return changes.groupBy("doctor_id", "specialty_count").agg(F.sum("change").alias("_c")).where("_c > 0").drop("_c")


def specialty_event_log(h: Hospital) -> DataFrame:
    """Doctors and their specialties as events; a third of the doctors also gain six more for a while."""
    at = lambda c, seconds=0: F.unix_micros(c.cast("timestamp")) + seconds * 1_000_000
    start = F.lit("1980-01-01").cast("date")
    doctors = h.doctor.select(at(start).alias("us"), F.lit("doctor").alias("kind"), "doctor_id",
                              F.lit(None).cast("string").alias("specialty_name"))
    gains = h.doctorspecialty.select(at(F.col("training_date")).alias("us"), F.lit("gain").alias("kind"), "doctor_id", "specialty_name")
    extra = h.doctor.where(F.col("doctor_id") % 3 == 0).select(
        "doctor_id", F.explode(F.array(*[F.lit(f"Locum {i}") for i in range(MAX_SPECIALTIES + 1)])).alias("specialty_name"))
    taken = extra.select(at(start, 1).alias("us"), F.lit("gain").alias("kind"), "doctor_id", "specialty_name")
    left = extra.select(at(start, 2).alias("us"), F.lit("loss").alias("kind"), "doctor_id", "specialty_name")
    events = doctors.unionByName(gains).unionByName(taken).unionByName(left)
    return events.select(F.xxhash64("us", "kind", "doctor_id", "specialty_name").alias("event_id"),
                         F.timestamp_micros("us").alias("event_ts"), "kind", "doctor_id", "specialty_name")


def specialty_rule_stream(h: Hospital) -> DataFrame:
    """O-D8 end to end: stage the events, stream them, read the violations."""
    spark = h.spark
    source = stage_change_log(spark, specialty_event_log(h), staging_path(spark, "specialty-events"))
    return current_violations(spark, run_specialty_stream(spark, source))
