"""Distributed ranking and exact percentiles.

A window ``RANK() OVER (ORDER BY x)`` with no partition, or one
partitioned by a handful of departments, sends every row of a partition
to one task.  Here the work is split instead:

1. collapse rows to distinct ``(group, value)`` with a multiplicity
   (map-side partial aggregation, so a hot value costs one row);
2. cut each group's distinct values into ``n_buckets`` value ranges with
   ``percentile_approx`` (a bounded sketch per group);
3. per-bucket totals -> exclusive prefix sums over buckets (a tiny table);
4. inside each ``(group, bucket)`` window, an exclusive running sum.

``before`` is then the total multiplicity of values strictly ahead of a
value in the ordering and ``distinct_before`` the number of distinct values
ahead, which give RANK, DENSE_RANK and cumulative positions for exact
percentiles.  Bucket boundaries only need to be monotone, not exact, so the
approximate sketch never affects the result, only the balance of the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column | None:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def bucket_of(bounds: str, o: str, n_bounds: int) -> Column:
    """Number of bounds strictly below ``o`` (columns; monotone in ``o``), by binary search in the sorted array.

    Each step of the literal list, a power of two, is taken if the bound there is still below.
    """
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n_bounds).bit_length()))])
    # past the end there is no bound, and nothing is below it
    below = lambda at, step: F.coalesce(F.get(F.col(bounds), at + step - 1) < F.col(o), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(below(at, step), step).otherwise(F.lit(0)))


def default_buckets(df: DataFrame) -> int:
    """As many value ranges as the session has shuffle partitions, which are sized for the data."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False,
                n_buckets: int | None = None, accuracy: int | None = None,
                few_groups: bool = False, weight: str | None = None) -> DataFrame:
    """Distinct ``(by..., value)`` with ``n``, ``before``, ``distinct_before`` and ``group_n``.

    ``value`` must be numeric; NULL values are left out.  ``by`` columns may
    be NULL (a NULL group is one group, like PARTITION BY).  A row counts
    ``weight`` times (once by default).  By default AQE picks the joins with
    the per-group bucket tables (groups x ``n_buckets`` rows); ``few_groups``
    is the caller's statement that the groups are a fixed handful (a value
    domain of the schema), and those tables are then broadcast.
    With no ``by`` the bounds are one uncorrelated scalar subquery.

    ``n_buckets`` sets the parallelism of the final window: each (group,
    bucket) holds about distinct-values / n_buckets rows.  It follows the
    session's shuffle partitions.  The sketch only has to separate buckets,
    so its accuracy is a small multiple of ``n_buckets``.
    """
    by = list(by)
    n_buckets = n_buckets or default_buckets(df)
    accuracy = accuracy or max(100, 20 * n_buckets)
    small = F.broadcast if few_groups else (lambda d: d)
    vals = (df.filter(F.col(value).isNotNull())
            .groupBy(*by, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")))
    sign = -1.0 if descending else 1.0
    keyed = vals.withColumn("_o", F.col(value).cast("double") * F.lit(sign))
    fractions = [i / n_buckets for i in range(1, n_buckets)]
    sketch = F.percentile_approx("_o", fractions, accuracy)
    if n_buckets <= 1:
        bucketed = keyed.withColumn("_bucket", F.lit(0))
    elif by:
        bounds = small(keyed.groupBy(*by).agg(sketch.alias("_bounds")))
        keyed = keyed.join(bounds, _null_safe_on(keyed, bounds, by), "inner").select(keyed["*"], bounds["_bounds"])
        bucketed = keyed.withColumn("_bucket", bucket_of("_bounds", "_o", len(fractions))).drop("_bounds")
    else:
        bucketed = keyed.withColumn("_bounds", keyed.select(sketch).scalar()).withColumn(
            "_bucket", bucket_of("_bounds", "_o", len(fractions))).drop("_bounds")

    totals = bucketed.groupBy(*by, "_bucket").agg(
        F.sum("_n").alias("_bn"), F.count(F.lit(1)).alias("_bd"))
    # groups x buckets rows: a small table, so an unpartitioned window is fine here
    w_off = (Window.partitionBy(*by).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = small(totals.select(
        *by, "_bucket",
        F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off_n"),
        F.coalesce(F.sum("_bd").over(w_off), F.lit(0)).alias("_off_d"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("_group_n")))  # same window stage

    cond = _null_safe_on(bucketed, offsets, by + ["_bucket"])
    joined = bucketed.join(offsets, cond, "inner").select(
        bucketed["*"], offsets["_off_n"], offsets["_off_d"], offsets["_group_n"])
    order = F.col(value).desc() if descending else F.col(value).asc()
    w_in = Window.partitionBy(*by, "_bucket").orderBy(order)
    w_prev = w_in.rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(
        *by, value,
        F.col("_n").alias("n"),
        (F.col("_off_n") + F.coalesce(F.sum("_n").over(w_prev), F.lit(0))).alias("before"),
        (F.col("_off_d") + F.row_number().over(w_in) - 1).alias("distinct_before"),
        F.col("_group_n").alias("group_n"))


def rank_table(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = True,
               rank: str | None = None, dense_rank: str | None = None,
               n_buckets: int | None = None, few_groups: bool = False) -> DataFrame:
    """One row per distinct ``(by, value)`` with the requested RANK / DENSE_RANK columns."""
    by = list(by)
    r = value_ranks(df, value, by, descending, n_buckets, few_groups=few_groups)
    out = []
    if rank:
        out.append((r["before"] + 1).cast("bigint").alias(rank))
    if dense_rank:
        out.append((r["distinct_before"] + 1).cast("bigint").alias(dense_rank))
    return r.select(*[r[c] for c in by + [value]], *out)


def percentile_cont(df: DataFrame, value: str, by: Sequence[str],
                    fractions: dict[str, float], n_buckets: int | None = None,
                    few_groups: bool = False, weight: str | None = None) -> DataFrame:
    """Exact ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` per group, as DOUBLE.

    The value distribution is reduced to distinct values with counts and
    cumulative positions (``value_ranks``); each fraction's two neighbouring
    order statistics are then picked by position and interpolated.  Nothing
    per group is held in one task beyond those few values.
    """
    by = list(by)
    r = (value_ranks(df, value, by, descending=False, n_buckets=n_buckets, few_groups=few_groups,
                     weight=weight)
         .withColumnRenamed("group_n", "_total"))
    v = F.col(value).cast("double")
    aggs = []
    for name, p in fractions.items():
        pos = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        covers = lambda q: (F.col("before") <= q) & (q < F.col("before") + F.col("n"))
        aggs += [F.max(F.when(covers(lo), v)).alias(f"_lo_{name}"),
                 F.max(F.when(covers(hi), v)).alias(f"_hi_{name}"),
                 F.max(pos - lo).alias(f"_fr_{name}")]
    picked = r.groupBy(*by).agg(*aggs)
    return picked.select(*by, *[
        (F.col(f"_lo_{n}") + F.col(f"_fr_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n in fractions])
