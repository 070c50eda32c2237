"""Dense surrogate keys without a single-partition window (D3)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_dense_ids(new_rows: DataFrame, key_cols: list[str], id_col: str, start: int,
                     buckets: int | None = None) -> DataFrame:
    """Give the rows of ``new_rows`` (distinct natural keys, best read from a
    written table since it is scanned twice) the ids ``start+1 .. start+n``.

    Each key falls into a hash bucket; inside a bucket keys are numbered by
    a window over that bucket only (keys are distinct, so buckets are even
    and no bucket is hot). The driver receives one count per bucket — a list
    bounded by the bucket count, not by the data — and turns the counts into
    running offsets. Bucket and position are pure functions of the keys, so
    a recomputed task (after an executor loss) gives the same ids.
    """
    spark = new_rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    b = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(buckets)).cast("int")
    tagged = new_rows.withColumn("_bucket", b)                       # new_rows is a written table
    counts = dict(tagged.groupBy("_bucket").count().collect())     # <= buckets rows
    offsets, running = [], start
    for k in range(buckets):
        offsets.append(running)
        running += counts.get(k, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_bucket") + 1)
    w = Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_first(c) for c in key_cols])
    return (tagged.withColumn(id_col, offset + F.row_number().over(w).cast("long"))
                  .drop("_bucket"))
