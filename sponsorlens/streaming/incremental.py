"""Incremental load: newly landed raw files are picked up by a Structured
Streaming file source and each micro-batch of files runs the batch load.

The stream watches file arrivals only (a binary-file source with just the
path selected, so file contents are not read by the stream); each
micro-batch hands its file list (bounded by ``maxFilesPerTrigger``) to the
batch loader, which reads the files as split CSV scans. The load is an
idempotent upsert, and the stream's checkpoint records which files were
handed over, so a restarted query neither skips nor double-counts a file.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.warehouse import Warehouse, load_batch
from ..sources.raw import is_perm_file, read_raw_csv, read_raw_perm_csv

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _load_batch(wh: Warehouse, spark: SparkSession):
    def run(batch: DataFrame, epoch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())   # <= maxFilesPerTrigger
        if not paths:
            return
        names = [p.rsplit("/", 1)[-1] for p in paths]
        lca = [p for p, n in zip(paths, names) if not is_perm_file(n)]
        perm = [p for p, n in zip(paths, names) if is_perm_file(n)]
        load_batch(wh, read_raw_csv(spark, lca) if lca else None,
                   read_raw_perm_csv(spark, perm) if perm else None, names)
    return run


def start_incremental_load(spark: SparkSession, wh: Warehouse, landing_dir: str, checkpoint_dir: str,
                           glob: str = "*.csv", max_files_per_trigger: int = 16,
                           available_now: bool = True) -> StreamingQuery:
    """Start the file-arrival stream. With ``available_now`` it processes
    every file present and stops (a scheduled refresh); otherwise it keeps
    running and loads files as they land."""
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
             .option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .load(landing_dir)
             .select("path"))
    writer = files.writeStream.foreachBatch(_load_batch(wh, spark)).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
