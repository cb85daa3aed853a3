"""Helpers shared by the training-data operators.

Scratch tables go to the folder that the cluster names in ``spark.checkpoint.dir``;
they are plain Parquet written by Spark, so any executor can be lost and its tasks
run again from them.  Python work runs on Arrow batches inside Spark's tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: rows of a batch that are Python objects at one time
SLICE = 1000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``; Spark's writers create it.

    Where the setting is absent, a local session (tests) gets a temporary folder; a
    cluster without it is an error, because its machines would not see the files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        # the setting itself can't be changed in a running session; the context remembers the folder
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="carelake-llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses neither
    recompute it nor depend on the executors that made it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_text(df: DataFrame, text_col: str, result: T.StructType,
             start: Callable[[], Callable[[list], Sequence[Sequence]]],
             carry: Sequence[str]) -> DataFrame:
    """Append to the ``carry`` columns what a Python function makes of each text.

    ``start()`` runs once per task and returns ``f(texts) -> one list per result
    field``; null texts arrive as None.  The result has the carried columns as
    ``c0, c1, ...`` and the result fields as ``r_<name>``, so that no column of the
    input can clash with them; ``restore`` gives the carried ones their names back.
    Spark bounds a batch by bytes (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    n = len(carry)
    at = carry.index(text_col) if text_col in carry and df.schema[text_col].dataType == T.StringType() else n
    src = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(carry)],
                    *([col(text_col).cast("string").alias("t")] if at == n else []))
    schema = T.StructType([T.StructField(f"c{i}", src.schema[f"c{i}"].dataType) for i in range(n)]
                          + [T.StructField(f"r_{f.name}", f.dataType) for f in result])
    types = [arrow_type(f.dataType) for f in result]
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = start()
        for b in batches:
            for part in (b.slice(i, SLICE) for i in range(0, max(1, b.num_rows), SLICE)):
                out = f(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + [pa.array(v, t) for v, t in zip(out, types, strict=True)],
                    names=names)

    return src.mapInArrow(run, schema)


def arrow_type(t: T.DataType) -> pa.DataType:
    simple = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
              T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(t, T.ArrayType):
        return pa.list_(arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in t])
    return simple[type(t)]


def restore(df: DataFrame, carry: Sequence[str]) -> list:
    """The columns ``c0, c1, ...`` of ``map_text`` under their own names."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(carry)]


def scale_count(df: DataFrame, chars, per_task: int) -> int:
    """How many tasks an input of ``sum(chars)`` needs at ``per_task`` each (one at least)."""
    total = df.agg(F.sum(chars)).first()[0] or 0
    return max(1, -(-int(total) // per_task))
