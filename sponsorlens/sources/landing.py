"""Landing checks (A8, A9, A17) and the landing report (M1), re-aimed from
an HTTP downloader to Spark scans of what has landed: a metadata-only file
listing, the download log as text, and the expected-file list."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_dir
from .raw import places

MIN_MB = 2.0   # smaller files are error pages, not disclosure workbooks


def landed_files(spark: SparkSession, root: str, glob: str = "*", min_mb: float = MIN_MB) -> DataFrame:
    """Landed files with size and the too-small gate. The binary-file
    scan selects metadata only, so file contents are never read."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(root)
          .select("path", "length"))
    name = F.element_at(F.split("path", "/"), -1)
    return df.select(name.alias("file_name"), F.col("length").alias("size_bytes"),
                     (F.col("length") < F.lit(min_mb * 1e6)).alias("too_small"),
                     F.when(F.upper(name).contains("PERM"), "perm").otherwise("lca").alias("route"))


def parse_download_log(spark: SparkSession, path: str) -> DataFrame:
    """``OK   <file> <mb>MB via <route>`` / ``FAIL <file>`` lines with the log they are in and their
    line number there. Logs are read in splits; a split's byte offset and the place in it give a
    line's order, and the counts of the splits before it its number."""
    word = lambda k: F.regexp_extract("value", r"^(OK|FAIL)\s+(\S+)", k)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("log"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), word(1).alias("status"), word(2).alias("file_name"),
        F.regexp_extract("value", r"\s([0-9.]+)MB\b", 1).try_cast("double").alias("size_mb"),
        F.when(F.col("value").contains(" via "), F.regexp_extract("value", r" via (.*)$", 1)).alias("via"))
    out = new_dir(spark, "log")
    lines.write.parquet(out)
    numbered = places(spark.read.schema(lines.schema).parquet(out), ["log"], "block", "pos")
    return (numbered.where(F.col("status") != "")
            .select("log", F.col("place").alias("line_no"), "status", "file_name", "size_mb", "via"))


def last_outcome(log: DataFrame) -> DataFrame:
    """Per file, the outcome of its last log line (logs in name order)."""
    return (log.groupBy("file_name")
               .agg(F.max_by(F.struct("status", "size_mb", "via"), F.struct("log", "line_no")).alias("_l"),
                    F.count("*").alias("attempts"))
               .select("file_name", "_l.status", "_l.size_mb", "_l.via", "attempts"))


def expected_files(spark: SparkSession, sources: dict[str, dict]) -> DataFrame:
    """``{source: {base_url, files}}`` as (source, file_name, url)."""
    rows = [(src, f, f"{cfg.get('base_url', '').rstrip('/')}/{f}")
            for src, cfg in sources.items() for f in (cfg or {}).get("files", [])]
    return spark.createDataFrame(rows, "source string, file_name string, url string")


def landing_report(expected: DataFrame, landed: DataFrame, log: DataFrame,
                   rows: DataFrame | None = None) -> DataFrame:
    """M1: one row per file that was expected, landed or logged: whether it
    landed, its size, the too-small flag, the last logged outcome and the
    rows loaded from it."""
    keys = (expected.select("file_name").unionByName(landed.select("file_name"))
            .unionByName(log.select("file_name")).distinct())
    out = (keys.join(expected.select("file_name", F.lit(True).alias("expected")), "file_name", "left")
               .join(landed.select("file_name", "size_bytes", "too_small", "route"), "file_name", "left")
               .join(last_outcome(log), "file_name", "left"))
    if rows is not None:
        out = out.join(rows.groupBy("file_name").agg(F.sum("rows_loaded").alias("rows_loaded")),
                       "file_name", "left")
    return out.select("file_name", F.coalesce("expected", F.lit(False)).alias("expected"),
                      F.col("size_bytes").isNotNull().alias("landed"), "size_bytes", "too_small", "route",
                      F.col("status").alias("last_status"), "via", "attempts",
                      *(["rows_loaded"] if rows is not None else []))


def not_landed(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files that have not landed (anti join)."""
    return expected.join(landed.where(~F.col("too_small")), "file_name", "left_anti")
