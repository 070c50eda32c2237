"""Helpers shared by the operators of this package."""
from __future__ import annotations

import builtins
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sponsorlens.session import new_dir


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts have some kilobytes each, so Spark's default of 10,000 rows in an
    Arrow batch is lowered; a setting made by the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder and read back: the
    lineage ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    small_batches(spark)
    path = new_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod5(col: str) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 5


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_outputs(df: DataFrame, schema: str | T.StructType) -> tuple[T.StructType, list[str]]:
    """Schema of ``df`` followed by the fields of ``schema``. An input column
    with the name of an output column is replaced by it (Spark compares names
    without case); returned too: the input columns that stay."""
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    new = {f.name.lower() for f in out}
    kept = [f for f in df.schema if f.name.lower() not in new]
    return T.StructType([*kept, *out]), [f.name for f in kept]


def add_columns(df: DataFrame, source: str, fn: Callable[[list, object], dict], schema: str,
                make: Callable[[], object] = lambda: None, batch_rows: int = 2000) -> DataFrame:
    """``df`` with columns computed from ``source`` in Arrow batches.

    ``fn(values, state)`` gets a slice of at most ``batch_rows`` values and
    returns lists by output column; ``state`` is made once per task.
    """
    full, kept = with_outputs(df, schema)
    out_fields = [f.name for f in T.StructType.fromDDL(schema)]
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make()
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                b = whole.slice(at, batch_rows)
                made = fn(b.column(source).to_pylist(), state)
                cols = [b.column(c).cast(arrow.field(c).type) for c in kept]
                cols += [pa.array(made[c], type=arrow.field(c).type) for c in out_fields]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, full)


def quiet_gc(state: object) -> object:
    """``state``, with the cycle collector off in this worker: it would walk the
    millions of table entries again and again, and the tables hold no cycles."""
    import gc

    gc.disable()
    return state


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """A value kept for the life of a Python worker, shared by its tasks."""
    held = builtins.__dict__.setdefault("_llm_worker_cache", {})
    if key not in held:
        held[key] = make()
    return held[key]


class Shared:
    """A broadcast value of any class: ``sparkContext.broadcast`` pickles objects by the name of their
    class, which workers without the repository on their path can't import, so its bytes are pickled by value."""

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        if "got" not in self.__dict__:
            self.got = pickle.loads(self.held.value)
        return self.got

    def __getstate__(self) -> dict:
        return {"held": self.held}

    def unpersist(self) -> None:
        self.held.unpersist()


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of [0-9a-z] and non-ASCII, after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
