"""Sinks: dashboard extracts (A12, A13) and the filtered CSV download."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.topk import leading_rows
from ..session import new_dir
from .raw import places

CSV_DOWNLOAD_CAP = 100_000


def write_extract(v1: DataFrame, out: str, together: bool = False) -> str:
    """The 13-column flat LCA extract, Parquet with ZSTD (A12). Partitioned
    by fiscal year so year filters prune files. ``together`` tells that ``v1`` is read
    from few files a year already (the serving table), so its rows aren't shuffled again."""
    rows = v1.select(*S.EXTRACT_COLUMNS)
    # A few files for each year, also for a large year.
    ((rows if together else rows.hint("rebalance", "fiscal_year"))
       .write.mode("errorifexists").option("compression", "zstd")
       .partitionBy("fiscal_year").parquet(out))
    return out


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """The extract with its columns in their order."""
    fields = [S.WAREHOUSE_TABLES["sponsorships_serving"][c] for c in S.EXTRACT_COLUMNS]
    return spark.read.schema(T.StructType(fields)).parquet(path).select(*S.EXTRACT_COLUMNS)


def write_perm_extract(v3: DataFrame, out: str) -> str | None:
    """The PERM extract, only when PERM rows exist."""
    if v3.isEmpty():
        return None
    v3.write.mode("errorifexists").option("compression", "zstd").parquet(out)
    return out


def write_csv_download(df: DataFrame, out: str, order: list | None = None,
                       cap: int = CSV_DOWNLOAD_CAP) -> str:
    """Quoted CSV with byte-order mark and header, at most ``cap`` rows in the
    given order (A15). ``cap`` is the feature (the download limit). Rows are dealt by ranges
    of the order and each range is a file, a whole CSV with its header: the files in order of
    their names are the download. Without ``order`` the rows are taken as they come."""
    rows = leading_rows(df, order, cap) if order else df.limit(cap)
    first, *rest = df.columns
    (rows.select(F.col(f"`{first}`").alias("\ufeff" + first), *[F.col(f"`{c}`") for c in rest])
       .write.mode("errorifexists")
       .option("header", True).option("quote", '"').option("escape", '"')
       .option("quoteAll", False).option("lineSep", "\r\n")
       .csv(out))
    return out


def read_csv_download(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a written download with ``place``, their number in it. Cells may hold line breaks, so
    a file is read in one piece; a download has a file for each range."""
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path)
            .select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_pos")))
    kept = new_dir(spark, "download")
    rows.write.parquet(kept)
    return places(spark.read.schema(rows.schema).parquet(kept), [], "_file", "_pos").select(*schema.fieldNames(), "place")


def register_extracts(spark, sponsorships_path: str, green_cards_path: str | None = None) -> bool:
    """Register the extracts as ``sponsorships`` / ``green_cards`` (A14);
    returns whether PERM data is present."""
    read_extract(spark, sponsorships_path).createOrReplaceTempView("sponsorships")
    if green_cards_path:
        spark.read.parquet(green_cards_path).createOrReplaceTempView("green_cards")
        return True
    return False

