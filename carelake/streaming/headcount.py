"""Staff headcount kept current from change records (O-S7, incremental).

The workload recounts every department (``UPDATE Department SET staff_headcount = (SELECT COUNT(*) ...)``).
Here a change record says that a staff member went from one department to another (NULL:
from or to nowhere), which is -1 for the old and +1 for the new one.  A micro-batch is reduced to one sum a
department and written to a folder named after its batch id, so a batch that is run again
replaces itself and counts once.  The headcount is the last snapshot plus the batches after it;
``compact`` folds batches into a new snapshot, which says up to which batch it counts, so
that readers see either the old state or the new one.

Records are told apart by ``change_id``: those that arrive again within ``delay`` are dropped by the
stream's state, which forgets them after that.  Arrival is the time of the file, not that of the change, so a record
is never too late to count.  Order doesn't matter, since sums don't depend on it.  The work of a batch follows its records and departments, not the staff table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.recursion import whole
from carelake.session import staging_path
from carelake.sources.roles import Hospital
from carelake.streaming.bed_status import rocksdb_state, stage_change_log
from carelake.streaming.folders import counted

CHANGE_SCHEMA = "change_id long, change_ts timestamp, staff_id long, old_dept string, new_dept string"
SUMS = "dept_name string, delta long"


def deltas(changes: DataFrame) -> DataFrame:
    """``(dept_name, delta)``: what the records add to each department; zero sums are left out."""
    effects = F.array(F.struct(F.col("old_dept").alias("dept_name"), F.lit(-1).alias("d")),
                      F.struct(F.col("new_dept").alias("dept_name"), F.lit(1).alias("d")))
    moved = changes.where("NOT (old_dept <=> new_dept)").select(F.explode(effects).alias("e")).select("e.*")
    return moved.where("dept_name IS NOT NULL").groupBy("dept_name").agg(F.sum("d").alias("delta")).where("delta <> 0")


def apply_batch(changes: DataFrame, store: str, batch_id: int) -> None:
    """Add the records of a batch; the same batch id again replaces what it wrote."""
    deltas(changes).coalesce(1).write.mode("overwrite").parquet(f"{store}/batches/batch_id={batch_id}")


def stored_sums(spark: SparkSession, store: str) -> tuple[DataFrame, int]:
    """The newest snapshot and the batches after it as one table of sums, and the last batch id in it (-1: none)."""
    paths, last = counted(spark, f"{store}/batches", f"{store}/snapshots")
    if not paths:
        return spark.createDataFrame([], SUMS), -1
    return spark.read.schema(SUMS).parquet(*paths), last


def compact(spark: SparkSession, store: str) -> int:
    """Fold all whole batches into a new snapshot; returns the last batch id it holds."""
    sums, upto = stored_sums(spark, store)
    if upto >= 0 and not whole(spark, f"{store}/snapshots/upto={upto}"):
        sums.groupBy("dept_name").agg(F.sum("delta").alias("delta")).coalesce(1).write.mode("overwrite").parquet(
            f"{store}/snapshots/upto={upto}")
    return upto


def headcount(department: DataFrame, store: str) -> DataFrame:
    """Departments with the stored headcount, as ``refresh_headcount`` gives them."""
    sums, _ = stored_sums(department.sparkSession, store)
    n = sums.groupBy("dept_name").agg(F.sum("delta").alias("_n"))
    return department.drop("staff_headcount").join(n, "dept_name", "left").select(
        "dept_name", "operating_hours", F.coalesce("_n", F.lit(0)).cast("bigint").alias("staff_headcount"))


def run_headcount_stream(spark: SparkSession, source: str, store: str | None = None, checkpoint: str | None = None,
                         delay: str = "7 days", files_per_trigger: int | None = None) -> str:
    """Fold the change files below ``source`` into ``store`` until caught up; returns ``store``.

    Resumes with the ``store`` and ``checkpoint`` of an earlier run.
    """
    store = store or staging_path(spark, "headcount")
    checkpoint = checkpoint or staging_path(spark, "headcount-ckpt")
    reader = spark.readStream.schema(CHANGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arrived = reader.parquet(source).withColumn("arrived", F.col("_metadata.file_modification_time"))
    once = arrived.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["change_id"])
    with rocksdb_state(spark):
        q = (once.writeStream.outputMode("append").foreachBatch(lambda df, i: apply_batch(df, store, i))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return store


def staff_change_log(h: Hospital) -> DataFrame:
    """Records that lead to today's staff: all start in an intake pool, and many leave for a while and come back."""
    s = h.staff.select("staff_id", "dept_name")
    pool, nowhere = F.lit("(intake)"), F.lit(None).cast("string")
    steps = F.array(
        F.struct(F.lit(0).alias("k"), nowhere.alias("old_dept"), pool.alias("new_dept")),
        F.struct(F.lit(1).alias("k"), pool.alias("old_dept"), F.col("dept_name").alias("new_dept")),
        F.struct(F.lit(2).alias("k"), F.col("dept_name").alias("old_dept"), nowhere.alias("new_dept")),
        F.struct(F.lit(3).alias("k"), nowhere.alias("old_dept"), F.col("dept_name").alias("new_dept")))
    taken = F.when(F.col("staff_id") % 3 == 0, steps).otherwise(F.slice(steps, 1, 2))
    return s.select("staff_id", F.explode(taken).alias("e")).select(
        (F.col("staff_id") * 4 + F.col("e.k")).alias("change_id"),
        (F.lit("2001-01-01").cast("timestamp") + F.make_dt_interval(F.col("e.k"))).alias("change_ts"),
        "staff_id", "e.old_dept", "e.new_dept")


def headcount_stream(h: Hospital) -> DataFrame:
    """O-S7 incremental, end to end: stage the change log, stream it, read the counts."""
    spark = h.spark
    source = stage_change_log(spark, staff_change_log(h), staging_path(spark, "staff-changes"))
    return headcount(h.department, run_headcount_stream(spark, source))
