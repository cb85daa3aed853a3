"""Ordered aggregation of groups of any size.

An ordered list of a group (``JSON_AGG(x ORDER BY t)``) must hold the group in one task, which a hot key
does not allow.  ``ordered_chunks`` sorts the rows by (key, order) over all tasks, numbers them within
their key, and aggregates every ``size`` of them into one row: what a task holds
is a chunk, however many rows a key has.  Reading a key's chunks in their order gives the list.
``assembled`` puts them together where one value a key is asked for; by then the rows are the text
of chunks, and the value itself is all that has to fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.json import to_json_text
from carelake.operators.frames import numbered


def ordered_chunks(df: DataFrame, key: str, order: Sequence[str], item: Column, size: int,
                   extra: Sequence[Column] = ()) -> DataFrame:
    """``(key, chunk, n_items, extra..., items)``: the items of each ``size`` consecutive rows of a key as JSON text.

    ``order`` must be total within a key and is ascending; ``extra`` are aggregates over the rows of a
    chunk.  A NULL key is a key.
    """
    rows = numbered(df, order, [key])
    first = rows.groupBy(F.col(key).alias("_key")).agg(F.min("place").alias("_first"))
    place = F.col("place") - F.col("_first")
    entry = F.struct(place.alias("at"), item.alias("v"))
    return (rows.join(first, F.col(key).eqNullSafe(F.col("_key")))
            .groupBy(key, F.floor(place / size).cast("bigint").alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n_items"), *extra,
                 to_json_text(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"])).alias("items")))


def assembled(chunks: DataFrame, key: str, chunk: str = "chunk", items: str = "items", descending: bool = False) -> DataFrame:
    """``(key, items)``: the JSON arrays of a key's chunks as one array, in the order of ``chunk``."""
    return chunks.groupBy(key).agg(joined_arrays(chunk, items, descending).alias(items))


def joined_arrays(order: str, items: str, descending: bool = False) -> Column:
    """Aggregate: JSON arrays (texts) joined to one array, in the order of a column."""
    inside = F.substring(F.col(items), F.lit(2), F.length(items) - 2)
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("c"), inside.alias("t"))), asc=not descending)
    return F.concat(F.lit("["), F.array_join(F.transform(parts, lambda p: p["t"]), ","), F.lit("]"))
