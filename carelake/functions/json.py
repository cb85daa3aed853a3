"""JSON result helpers.

Results that the workload returns as JSON are built as typed structs and
serialised once, keeping keys whose value is NULL (``"email": null``)
like a JSON builder does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_object(**fields: Column) -> Column:
    """``JSON_BUILD_OBJECT(k1, v1, ...)`` as a struct (key order kept)."""
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def to_json_text(c: Column) -> Column:
    """Serialise a struct/array column to compact JSON text, nulls kept."""
    return F.to_json(c, _KEEP_NULLS)


def iso_timestamp(ts: Column) -> Column:
    """Timestamp as ``yyyy-MM-ddTHH:mm:ss[.ffffff]`` text, the fraction without closing zeros."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
