"""Bed status from admission change records (O-T1 batch, O-T2 stream).

The workload keeps ``Bed.bed_status`` current with a row trigger on
Admission.  Per change record, in order:

1. bed set and no discharge          -> that bed becomes 'Occupied'
2. bed set and a discharge date      -> that bed becomes 'Available'
3. an UPDATE that moved the bed      -> the previous bed becomes 'Available'

Steps 1 and 2 exclude each other and step 3 touches a different bed, so
each record yields at most two ``(bed, status)`` effects.  A bed's current
status is the status of its latest effect in ``(event_ts, event_id,
step)`` order; beds never touched keep their stored status.  A discharge
frees its bed even if another open admission holds it (D18: as written).

Batch (``fold_bed_status``): explode records into effects, ``max_by`` per
bed (partial aggregation map-side, so a hot bed is pre-reduced), left join
onto Bed.

Stream (``run_bed_status_stream``): change files -> the same effects ->
a built-in stateful streaming aggregation per bed keeping
``max(struct(ts, event_id, step, status))``.  The state per bed is that
one struct (RocksDB state store); partial aggregation pre-reduces each
micro-batch map-side, so a hot bed costs one row per task.  A late record
with an older order than the state cannot win the max, so any split or
arrival order of a complete log ends in the batch answer.  Changed beds
are written per micro-batch by ``foreachBatch`` into a folder named after
the batch id (overwritten on retry, hence idempotent).  No Python runs in
the tasks.  A job that is stopped and started again with the same output
and checkpoint folders goes on from its last committed micro-batch.
Records are ordered to the microsecond.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.recursion import whole
from carelake.session import staging_path
from carelake.sources.roles import Hospital
from carelake.streaming.folders import counted

CHANGE_SCHEMA = ("event_id long, event_ts timestamp_ntz, op string, admission_id long, "
                 "bed_id long, old_bed_id long, discharge_date date")
UPDATE_SCHEMA = "bed_id long, ts long, event_id long, step int, status string"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def admission_change_log(h: Hospital, transfer_every: int = 7) -> DataFrame:
    """Change records implied by Admission: admit, an optional bed move, discharge.

    * INSERT at the admission time with the first bed, no discharge;
    * every ``transfer_every``-th admission with a bed moves to the next bed
      id 30 minutes later (an UPDATE with ``old_bed_id``);
    * discharged admissions get an UPDATE at 23:59:59 of the discharge day.
    """
    n_beds = h.bed.select(F.count(F.lit(1))).scalar()
    a = h.admission.select("admission_id", "admission_date", "bed_id", "discharge_date")
    moves = (F.col("bed_id").isNotNull()) & (F.col("admission_id") % transfer_every == 0)
    final_bed = F.when(moves, (F.col("bed_id") + 1) % n_beds).otherwise(F.col("bed_id"))
    insert = a.select((F.col("admission_id") * 4).alias("event_id"), F.col("admission_date").alias("event_ts"),
                      F.lit("INSERT").alias("op"), "admission_id", "bed_id",
                      F.lit(None).cast("long").alias("old_bed_id"), F.lit(None).cast("date").alias("discharge_date"))
    move = a.filter(moves).select(
        (F.col("admission_id") * 4 + 1).alias("event_id"),
        (F.col("admission_date") + F.expr("INTERVAL 30 MINUTES")).alias("event_ts"),
        F.lit("UPDATE").alias("op"), "admission_id", final_bed.alias("bed_id"),
        F.col("bed_id").alias("old_bed_id"), F.lit(None).cast("date").alias("discharge_date"))
    discharge = a.filter(F.col("discharge_date").isNotNull()).select(
        (F.col("admission_id") * 4 + 2).alias("event_id"),
        (F.col("discharge_date").cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND"))
        .alias("event_ts"),
        F.lit("UPDATE").alias("op"), "admission_id", final_bed.alias("bed_id"),
        final_bed.alias("old_bed_id"), "discharge_date")
    return insert.unionByName(move).unionByName(discharge)


def change_effects(changes: DataFrame) -> DataFrame:
    """One row per (record, bed touched): ``bed_id, status, ts, event_id, step``."""
    ts = F.unix_micros(F.col("event_ts").cast("timestamp"))
    main = F.struct(
        F.col("bed_id").alias("bed_id"),
        F.when(F.col("discharge_date").isNull(), F.lit("Occupied")).otherwise(F.lit("Available")).alias("status"),
        F.when(F.col("discharge_date").isNull(), F.lit(1)).otherwise(F.lit(2)).alias("step"))
    moved = F.struct(F.col("old_bed_id").alias("bed_id"), F.lit("Available").alias("status"), F.lit(3).alias("step"))
    moved_ok = ((F.col("op") == "UPDATE") & F.col("old_bed_id").isNotNull()
                & ~F.col("old_bed_id").eqNullSafe(F.col("bed_id")))
    effects = F.filter(F.array(F.when(F.col("bed_id").isNotNull(), main), F.when(moved_ok, moved)),
                       lambda e: e.isNotNull())
    return (changes.select(ts.alias("ts"), "event_id", F.explode(effects).alias("e"))
            .select("e.bed_id", "e.status", "ts", "event_id", "e.step"))


def fold_bed_status(bed: DataFrame, changes: DataFrame) -> DataFrame:
    """O-T1: every bed with its status after applying ``changes`` in order."""
    order = F.struct("ts", "event_id", "step")
    latest = change_effects(changes).groupBy("bed_id").agg(F.max_by("status", order).alias("_status"))
    return (bed.select("bed_id", "ward_id", "bed_status").join(latest, "bed_id", "left")
            .select("bed_id", "ward_id", F.coalesce("_status", "bed_status").alias("bed_status")))


def bed_status_batch(h: Hospital) -> DataFrame:
    return fold_bed_status(h.bed, admission_change_log(h))


# ---------------------------------------------------------------- stream

def stage_change_log(spark: SparkSession, changes: DataFrame, path: str | None = None,
                     records_per_file: int = 1_000_000) -> str:
    """Write the change log as a landing folder of parquet files (the stream's source).

    Write tasks follow the data: those of ``changes``, whose files are cut at ``records_per_file``.
    """
    path = path or staging_path(spark, "bed-changes")
    changes.write.mode("append").option("maxRecordsPerFile", records_per_file).parquet(path)
    return path


@contextmanager
def rocksdb_state(spark: SparkSession):
    """RocksDB as state store for the query that starts inside; the session's setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_bed_status_stream(spark: SparkSession, source_path: str, out: str | None = None,
                          checkpoint: str | None = None, files_per_trigger: int | None = None,
                          bytes_per_trigger: int = 64 << 30, replay_delay: str = "7 days") -> str:
    """O-T2: run the stateful stream over ``source_path`` until caught up.

    Returns the folder of emitted status updates (one sub-folder per micro-batch).  With the
    ``out`` and ``checkpoint`` of an earlier run it resumes from that run's last committed
    micro-batch; by default both are fresh folders below the shared folder.

    A micro-batch takes ``bytes_per_trigger`` of files (or a number of files, if given).  Records whose
    ``event_id`` arrives again within ``replay_delay`` are dropped before they reach the
    beds, so replays emit nothing; arrival is the time of the file, so no record is too late to count.
    """
    out = out or staging_path(spark, "bed-status-updates")
    checkpoint = checkpoint or staging_path(spark, "bed-status-ckpt")
    limit = ("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else ("maxBytesPerTrigger", bytes_per_trigger)
    changes = (spark.readStream.schema(CHANGE_SCHEMA).option(*limit).parquet(source_path)
               .withColumn("arrived", F.col("_metadata.file_modification_time"))
               .withWatermark("arrived", replay_delay).dropDuplicatesWithinWatermark(["event_id"]))
    latest = (change_effects(changes).groupBy("bed_id")
              .agg(F.max(F.struct("ts", "event_id", "step", "status")).alias("s"))
              .select("bed_id", "s.ts", "s.event_id", "s.step", "s.status"))

    def write_batch(updates: DataFrame, batch_id: int) -> None:
        updates.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    # One state row per bed: disk-backed, incremental checkpoints, not executor memory.
    with rocksdb_state(spark):
        q = (latest.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return out


def latest_updates(spark: SparkSession, updates_path: str) -> tuple[DataFrame | None, int]:
    """The newest emitted update of each bed that has one, and the last batch among them (None, -1: no batch yet)."""
    paths, last = counted(spark, updates_path, updates_path.rstrip("/") + "-snapshots")
    if not paths:
        return None, last
    upd = spark.read.schema(UPDATE_SCHEMA).parquet(*paths)
    newest = F.max(F.struct("ts", "event_id", "step", "status")).alias("s")
    return upd.groupBy("bed_id").agg(newest).select("bed_id", "s.*"), last


def compact_updates(spark: SparkSession, updates_path: str) -> int:
    """Fold the update folders into one snapshot with a row a bed; returns the last batch it counts.

    ``folders.drop_counted`` deletes the folders that it replaces.
    """
    latest, last = latest_updates(spark, updates_path)
    target = f"{updates_path.rstrip('/')}-snapshots/upto={last}"
    if latest is not None and not whole(spark, target):
        latest.write.mode("overwrite").parquet(target)
    return last


def current_status(spark: SparkSession, bed: DataFrame, updates_path: str) -> DataFrame:
    """Beds joined with the newest emitted update (stored status when none)."""
    latest, _ = latest_updates(spark, updates_path)
    if latest is None:
        return bed.select("bed_id", "ward_id", "bed_status")
    return (bed.select("bed_id", "ward_id", "bed_status").join(
                latest.select("bed_id", F.col("status").alias("_status")), "bed_id", "left")
            .select("bed_id", "ward_id", F.coalesce("_status", "bed_status").alias("bed_status")))


def bed_status_stream(h: Hospital) -> DataFrame:
    """O-T2 end to end on the driver tables: stage the change log, stream it, read the result."""
    spark = h.spark
    src = stage_change_log(spark, admission_change_log(h))
    return current_status(spark, h.bed, run_bed_status_stream(spark, src))
