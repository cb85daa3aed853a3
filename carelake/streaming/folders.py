"""Folders that a stream writes, one a micro-batch, and the snapshots that count them.

A folder counts once its ``_SUCCESS`` marker is there.  Snapshots say in their name up to which batch they
count, so readers take the newest one and the batches after it: they see the old state or the new
one, and a batch that is run again after a snapshot isn't counted twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from carelake.operators.recursion import whole


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers in the names ``name=<number>`` of the whole folders below ``path``, ascending."""
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = [int(f.split("=", 1)[1]) for f in found if f.startswith(name + "=")]
    return sorted(n for n in numbers if whole(spark, f"{path}/{name}={n}"))


def counted(spark: SparkSession, batches: str, snapshots: str) -> tuple[list[str], int]:
    """Paths of the newest snapshot and of the batches after it, and the last batch id among them (-1: none)."""
    done = numbered_folders(spark, snapshots, "upto")
    upto = done[-1] if done else -1
    later = [b for b in numbered_folders(spark, batches, "batch_id") if b > upto]
    paths = [f"{snapshots}/upto={upto}"] * bool(done) + [f"{batches}/batch_id={b}" for b in later]
    return paths, later[-1] if later else upto


def drop_counted(spark: SparkSession, batches: str, snapshots: str) -> int:
    """Delete what the newest snapshot counts: earlier batches and snapshots.  Returns how many folders went.

    Only for folders that no running stream or reader still uses up to that batch.
    """
    done = numbered_folders(spark, snapshots, "upto")
    if not done:
        return 0
    old = [f"{batches}/batch_id={b}" for b in numbered_folders(spark, batches, "batch_id") if b <= done[-1]]
    old += [f"{snapshots}/upto={n}" for n in done[:-1]]
    for path in old:
        p, fs = _at(spark, path)
        fs.delete(p, True)
    return len(old)
