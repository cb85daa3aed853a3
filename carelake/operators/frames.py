"""Row frames over a whole ordered table, without a window that holds it.

``SUM(x) OVER (ORDER BY t ROWS ...)`` or ``LAG(x) OVER (ORDER BY t)`` sends every row to one task, and a
PARTITION BY with a hot key sends that key there.  Here the order is cut up:

1. ``numbered``: rows are range-partitioned by (by, order) and written with their range; a row's place is
   its place in its range plus the rows of the ranges before it.
2. Blocks of ``BLOCK`` consecutive places are the windows.  A frame that looks k rows back needs
   the last k rows of the block before, so these are copied to it as a halo and dropped afterwards.
3. What a running total needs from earlier blocks is one row of sums a block.  Their
   prefix sums are taken in two levels (within a group of blocks, and over the groups), so
   that they need no unpartitioned window either.

Every block holds the same number of rows, whatever the order key's distribution or the hot keys are.
The order must be total (end it with a unique column); ties of it would make places arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import staging_path

BLOCK = 100_000
#: blocks whose sums meet in one window
GROUP = 1024


def _written(df: DataFrame, name: str) -> DataFrame:
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sums(sums: DataFrame, at: str, values: Sequence[str], last: int, group: int = GROUP) -> DataFrame:
    """One row per ``at`` (0..``last``): the sums of ``values`` over all smaller ones, 0 for none."""
    zero = {v: F.lit(0).cast(sums.schema[v].dataType) for v in values}
    upto = Window.partitionBy("_group").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    grouped = sums.withColumn("_group", F.floor(F.col(at) / group).cast("int"))
    within = grouped.select(at, "_group", *[F.coalesce(F.sum(v).over(upto), zero[v]).alias(v) for v in values])
    before = grouped.where(F.col("_group") < last // group).groupBy("_group").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    before = before.withColumn("_group", F.explode(F.sequence(F.col("_group") + 1, F.lit(last // group)))).groupBy(
        "_group").agg(*[F.sum(f"_{v}").alias(f"_{v}") for v in values])
    return within.join(before, "_group", "left").select(
        at, *[(F.col(v) + F.coalesce(f"_{v}", zero[v])).cast(sums.schema[v].dataType).alias(v) for v in values])


def numbered(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), place: str = "place",
             group: int = GROUP) -> DataFrame:
    """``df`` with ``place``, its row's number (from 1) in the order of (by, order) over the whole table.

    NULLs come first.  The result is a written table.
    """
    keys = [*by, *order]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _written(df.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    before = prefix_sums(dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")), "_range", ["_n"], ranges, group)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)).cast("bigint")
    placed = dealt.withColumn("_inside", inside).join(before, "_range").select(
        *df.columns, (F.col("_inside") + F.col("_n")).alias(place))
    return _written(placed, "numbered")


class Frames:
    """Frames over a ``numbered`` table; collect columns with its methods, then take ``result()``."""

    def __init__(self, rows: DataFrame, by: Sequence[str] = (), place: str = "place", block: int = BLOCK,
                 group: int = GROUP):
        self.rows, self.by, self.place, self.block, self.group = rows, list(by), place, block, group
        self.back = 0
        self.columns: dict[str, Column] = {}
        self.totals: dict[str, tuple[str, str]] = {}

    def _window(self, back: int):
        """The last ``back`` rows and the row itself; blocks hold a halo as long as the widest frame."""
        if back > self.block:
            raise ValueError("a frame can't be wider than a block")
        self.back = max(self.back, back)
        return Window.partitionBy(*self.by, "_block").orderBy(self.place)

    def moving(self, name: str, aggregate: Column, preceding: int) -> Frames:
        """``aggregate OVER (ROWS BETWEEN preceding PRECEDING AND CURRENT ROW)``."""
        self.columns[name] = aggregate.over(self._window(preceding).rowsBetween(-preceding, 0))
        return self

    def lag(self, name: str, column: str, offset: int = 1) -> Frames:
        """``LAG(column, offset)``."""
        self.columns[name] = F.lag(column, offset).over(self._window(offset))
        return self

    def running_sum(self, name: str, column: str) -> Frames:
        """``SUM(column) OVER (ROWS UNBOUNDED PRECEDING)``: NULL until a value has come."""
        self.totals[name] = (column, "sum")
        return self

    def running_count(self, name: str, column: str) -> Frames:
        """``COUNT(column) OVER (ROWS UNBOUNDED PRECEDING)``."""
        self.totals[name] = (column, "count")
        return self

    def result(self) -> DataFrame:
        """The rows with the collected columns."""
        own = F.floor((F.col(self.place) - 1) / self.block)
        inside = F.pmod(F.col(self.place) - 1, F.lit(self.block))
        reaches = (inside >= self.block - self.back) if self.back else F.lit(False)
        copies = F.when(reaches, F.array(F.struct(own.alias("b"), F.lit(True).alias("own")),
                                         F.struct((own + 1).alias("b"), F.lit(False).alias("own")))).otherwise(
            F.array(F.struct(own.alias("b"), F.lit(True).alias("own"))))
        spread = self.rows.withColumn("_copy", F.explode(copies)).withColumn("_block", F.col("_copy.b"))
        running = Window.partitionBy(*self.by, "_block").orderBy(self.place).rowsBetween(Window.unboundedPreceding, 0)
        of_own = lambda c: F.when(F.col("_copy.own"), F.col(c))  # noqa: E731  the halo is no part of a block's sums
        parts = {}
        for name, (column, _) in self.totals.items():
            parts[f"_sum_{name}"] = F.sum(of_own(column)).over(running)
            parts[f"_count_{name}"] = F.count(of_own(column)).over(running)
        out = spread.withColumns(self.columns | parts).where("_copy.own").drop("_copy")
        if not self.totals:
            return out.drop("_block")
        out = out.join(self._before(own), [F.col("_block") == F.col("_at"),
                                           *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in self.by]])
        final = []
        for name, (_, kind) in self.totals.items():
            seen = F.col(f"_count_{name}") + F.col(f"_before_count_{name}")
            zero = F.lit(0).cast(out.schema[f"_sum_{name}"].dataType)
            total = F.coalesce(f"_sum_{name}", zero) + F.col(f"_before_sum_{name}")
            final.append((seen.cast("bigint") if kind == "count" else F.when(seen > 0, total)).alias(name))
        return out.select(*self.rows.columns, *self.columns, *final)

    def _before(self, own: Column) -> DataFrame:
        """(_at, _by_..., _before_sum_..., _before_count_...): sums of the key's rows in earlier blocks, 0 for none."""
        aggregates, values = [], []
        for name, (column, _) in self.totals.items():
            kind = self.rows.agg(F.sum(column).alias("s")).schema["s"].dataType
            aggregates += [F.coalesce(F.sum(column), F.lit(0).cast(kind)).alias(f"_before_sum_{name}"),
                           F.count(column).alias(f"_before_count_{name}")]
            values += [f"_before_sum_{name}", f"_before_count_{name}"]
        keys = [F.col(c).alias(f"_by_{c}") for c in self.by]
        sums = self.rows.groupBy(*keys, own.alias("_at")).agg(*aggregates)
        if not self.by:
            last = self.rows.agg(F.max(self.place)).first()[0] or 1
            return prefix_sums(sums, "_at", values, (last - 1) // self.block, self.group)
        # the sums of a key: one row a block, a BLOCK-th of its rows
        earlier = Window.partitionBy(*[f"_by_{c}" for c in self.by]).orderBy("_at").rowsBetween(
            Window.unboundedPreceding, -1)
        return sums.select("_at", *[f"_by_{c}" for c in self.by], *[
            F.coalesce(F.sum(v).over(earlier), F.lit(0)).cast(sums.schema[v].dataType).alias(v) for v in values])
