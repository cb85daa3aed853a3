"""Next-event lookups per key without pairing events.

``first_after`` answers: for each anchor (key, t), what is the earliest
event of the same key with ``t < event_t <= t + horizon``?  The textbook
SQL form is a self range join followed by ROW_NUMBER, which emits every
(anchor, event) pair of a key inside the horizon: quadratic for a hot key.

Instead anchors and events go into one stream, cut into time blocks of
``horizon`` width.  Every event is copied into its own block and the block
before it, so an anchor in block b sees all events of blocks b and b+1,
which cover ``(t, t + horizon]``.  Inside a ``(key, block)`` window ordered
by time descending, a running MIN over the rows already passed is the
nearest later event.  A hot key is thus split by time, each event is read at
most twice, and the window frame grows incrementally (no O(n^2) frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_after(anchors: DataFrame, events: DataFrame, key: str, anchor_t: str, event_t: str,
                horizon_seconds: int) -> DataFrame:
    """Anchors plus ``next_t``: earliest event time in ``(anchor_t, anchor_t + horizon]`` or NULL.

    ``anchor_t`` / ``event_t`` are timestamp columns, compared to the microsecond;
    anchors keep all their columns.
    """
    width = int(horizon_seconds) * 1_000_000
    a_us = F.unix_micros(F.col(anchor_t).cast("timestamp"))
    e_us = F.unix_micros(F.col(event_t).cast("timestamp"))
    # A NULL key never equals anything: such anchors get no next event (and stay out of the
    # windows, where they would be one group) and such events are never anyone's next event.
    a = anchors.filter(F.col(key).isNotNull()).select(
        F.struct(*[F.col(c) for c in anchors.columns]).alias("_anchor"),
        F.col(key).alias("_key"), a_us.alias("_t"), F.lit(0).alias("_kind"),
        F.floor(a_us / width).alias("_block"))
    e_block = F.floor(e_us / width)
    e = events.filter(F.col(key).isNotNull()).select(
        F.lit(None).cast(a.schema["_anchor"].dataType).alias("_anchor"),
        F.col(key).alias("_key"), e_us.alias("_t"), F.lit(1).alias("_kind"),
        F.explode(F.array(e_block, e_block - 1)).alias("_block"))
    # Same-time events sort after the anchor, so "strictly later" holds.
    w = (Window.partitionBy("_key", "_block")
         .orderBy(F.col("_t").desc(), F.col("_kind").asc())
         .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.min(F.when(F.col("_kind") == 1, F.col("_t"))).over(w)
    stream = a.unionByName(e).select("_anchor", "_kind", "_t", nxt.alias("_next"))
    within: Column = F.col("_next") <= F.col("_t") + F.lit(width)
    found = (stream.filter(F.col("_kind") == 0)
            .select("_anchor.*",
                    F.when(within, F.timestamp_micros(F.col("_next")).cast("timestamp_ntz"))
                    .alias("next_t")))
    alone = anchors.filter(F.col(key).isNull()).withColumn("next_t", F.lit(None).cast("timestamp_ntz"))
    return found.unionByName(alone)
