"""Bed status: the stream over any split / arrival order equals the batch fold."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from carelake.streaming.bed_status import (CHANGE_SCHEMA, compact_updates, current_status, fold_bed_status,
                                           run_bed_status_stream, stage_change_log)
from carelake.streaming.folders import drop_counted

T0 = dt.datetime(2024, 3, 1, 8, 0)


def _beds(spark):
    return spark.createDataFrame([(b, 1, "Available") for b in range(1, 6)] + [(6, 1, "Maintenance")],
                                 "bed_id long, ward_id int, bed_status string")


# admit -> move bed -> discharge; two admissions on one bed; a record that
# arrives late (written in the last file) but is older than what it follows.
CHANGES = [
    (4, T0, "INSERT", 1, 1, None, None),                                     # bed 1 Occupied
    (5, T0 + dt.timedelta(hours=1), "UPDATE", 1, 2, 1, None),                # move 1 -> 2
    (6, T0 + dt.timedelta(days=2), "UPDATE", 1, 2, 2, dt.date(2024, 3, 3)),  # discharge from 2
    (8, T0 + dt.timedelta(hours=2), "INSERT", 2, 3, None, None),             # bed 3 Occupied
    (12, T0 + dt.timedelta(hours=3), "INSERT", 3, 3, None, None),            # second admission on bed 3
    (14, T0 + dt.timedelta(days=1), "UPDATE", 3, 3, 3, dt.date(2024, 3, 2)),  # D18: frees bed 3
    (16, T0 + dt.timedelta(hours=5), "INSERT", 4, 4, None, None),            # bed 4 Occupied
]
LATE = (15, T0 + dt.timedelta(hours=4), "INSERT", 5, 4, None, None)          # older than nothing on 4 -> applies
STALE = (13, T0 + dt.timedelta(hours=3, minutes=30), "INSERT", 6, 3, None, None)  # older than bed 3's discharge


def test_batch_fold(spark):
    changes = spark.createDataFrame(CHANGES + [LATE, STALE], CHANGE_SCHEMA)
    got = {r.bed_id: r.bed_status for r in fold_bed_status(_beds(spark), changes).collect()}
    assert got == {1: "Available", 2: "Available", 3: "Available", 4: "Occupied", 5: "Available",
                   6: "Maintenance"}


def test_stream_equals_batch_with_late_and_split_input(spark):
    all_rows = CHANGES + [LATE, STALE]
    expected = {r.bed_id: r.bed_status for r in
                fold_bed_status(_beds(spark), spark.createDataFrame(all_rows, CHANGE_SCHEMA)).collect()}
    src = tempfile.mkdtemp(prefix="bed-src-", dir=spark.conf.get("spark.checkpoint.dir"))
    # newest records first, the stale one last: arrival order differs from event order
    order = [CHANGES[2], CHANGES[5], CHANGES[6], CHANGES[0], CHANGES[3], CHANGES[1], CHANGES[4], LATE, STALE]
    for i in range(0, len(order), 2):
        spark.createDataFrame(order[i:i + 2], CHANGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = run_bed_status_stream(spark, src, files_per_trigger=1)
    got = {r.bed_id: r.bed_status for r in current_status(spark, _beds(spark), out).collect()}
    assert got == expected
    # more than one micro-batch really ran
    assert spark.read.parquet(out).select(F.countDistinct("bed_id")).first()[0] >= 4


def test_sub_second_order_beats_event_ids(spark):
    """Taken at .1 s with the higher event id, freed at .9 s: the later time wins."""
    rows = [(9, T0 + dt.timedelta(milliseconds=100), "INSERT", 1, 1, None, None),
            (3, T0 + dt.timedelta(milliseconds=900), "UPDATE", 1, 1, 1, dt.date(2024, 3, 1))]
    got = {r.bed_id: r.bed_status for r in fold_bed_status(_beds(spark), spark.createDataFrame(rows, CHANGE_SCHEMA)).collect()}
    assert got[1] == "Available"


def test_stopped_stream_goes_on_in_the_same_folders(spark):
    base = tempfile.mkdtemp(prefix="bed-resume-", dir=spark.conf.get("spark.checkpoint.dir"))
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    everything = spark.createDataFrame(CHANGES, CHANGE_SCHEMA)
    stage_change_log(spark, spark.createDataFrame(CHANGES[:3], CHANGE_SCHEMA).coalesce(1), src)
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    run_bed_status_stream(spark, src, out, ckpt)
    first = len(os.listdir(out))
    stage_change_log(spark, spark.createDataFrame(CHANGES[3:], CHANGE_SCHEMA).coalesce(1), src)
    run_bed_status_stream(spark, src, out, ckpt)
    assert len(os.listdir(out)) > first  # new batches, the old ones stay
    got = sorted(map(tuple, current_status(spark, _beds(spark), out).collect()))
    assert got == sorted(map(tuple, fold_bed_status(_beds(spark), everything).collect()))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == store


def test_replayed_records_emit_nothing_and_snapshots_agree(spark):
    base = tempfile.mkdtemp(prefix="bed-replay-", dir=spark.conf.get("spark.checkpoint.dir"))
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    everything = spark.createDataFrame(CHANGES, CHANGE_SCHEMA)
    want = sorted(map(tuple, fold_bed_status(_beds(spark), everything).collect()))

    def status():
        return sorted(map(tuple, current_status(spark, _beds(spark), out).collect()))

    assert compact_updates(spark, out) == -1
    assert status() == sorted(map(tuple, _beds(spark).collect()))
    stage_change_log(spark, everything.coalesce(1), src)
    run_bed_status_stream(spark, src, out, ckpt)
    assert status() == want
    emitted = spark.read.parquet(out).count()
    stage_change_log(spark, everything.coalesce(1), src)  # the same records in another file
    run_bed_status_stream(spark, src, out, ckpt)
    assert spark.read.parquet(out).count() == emitted
    last = compact_updates(spark, out)
    assert last == compact_updates(spark, out) and status() == want
    assert drop_counted(spark, out, out + "-snapshots") > 0 and status() == want
    stage_change_log(spark, spark.createDataFrame([LATE], CHANGE_SCHEMA).coalesce(1), src)
    run_bed_status_stream(spark, src, out, ckpt)
    assert status() == sorted(map(tuple, fold_bed_status(
        _beds(spark), spark.createDataFrame([*CHANGES, LATE], CHANGE_SCHEMA)).collect()))
