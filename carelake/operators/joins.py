"""Join helpers for skew-prone keys (NULL keys on the preserved side of a left join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_salted_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           buckets: int = 256) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` in one pass, NULL keys spread by a salt.

    The join key becomes ``(key, salt)``: salt 0 for every right row and every
    left row with a key, and 1..``buckets`` (a hash of the row, so retries see
    the same value) for left rows whose key is NULL.  Those rows still match
    nothing (NULL never equals), but they hash to ``buckets`` different shuffle
    partitions instead of one.  The left side is read once.
    """
    salt = F.when(F.col(left_key).isNull(),
                  F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets)) + 1).otherwise(F.lit(0))
    salted = left.withColumn("_salt", salt.cast("int"))
    target = right.withColumn("_rsalt", F.lit(0))
    cond = (salted[left_key] == target[right_key]) & (salted["_salt"] == target["_rsalt"])
    return salted.join(target, cond, "left").drop("_salt", "_rsalt")
