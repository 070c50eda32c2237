"""Raw disclosure files: all-string scans with tolerant headers."""
from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalars import na_to_null


def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip and upper-case every header (A2)."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def column_or_null(df: DataFrame, name: str) -> Column:
    """The named column, or a NULL string column when the file lacks it (A4)."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def first_present(df: DataFrame, candidates: list[str]) -> Column:
    """Plan-time choice of the first candidate header present (A5)."""
    for cand in candidates:
        if cand in df.columns:
            return F.col(f"`{cand}`")
    return F.lit(None).cast("string")


def is_perm_file(name: str) -> bool:
    """File routing by name."""
    return "PERM" in name.upper()


def route_of(name: str | Column) -> Column:
    """The kind of file that a name tells, as a column."""
    return F.when(F.upper(name).contains("PERM"), "perm").otherwise("lca")


def _csv_reader(spark: SparkSession, multiline: bool):
    return (spark.read
            .option("header", True)
            .option("inferSchema", False)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multiline)
            .option("mode", "PERMISSIVE"))


def _read_group(spark: SparkSession, paths: list[str], needed: list[str], multiline: bool) -> DataFrame:
    """One scan over all files that share a header layout."""
    df = _csv_reader(spark, multiline).csv(paths)
    norm = [c.strip().upper() for c in df.columns]
    keep = []
    for name in needed:
        if name in norm:
            keep.append(na_to_null(F.col(f"`{df.columns[norm.index(name)]}`")).alias(name))      # A3
        else:
            keep.append(F.lit(None).cast("string").alias(name))         # A4
    # Row order inside a file, as one number (so that grouped maxima stay in a hash aggregate): the
    # split's byte offset, then the row's place among the rows of its task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row_seq = (F.col("_metadata.file_block_start").cast("decimal(20,0)") * F.lit(1 << 33).cast("decimal(11,0)") + place.cast("decimal(11,0)"))
    return df.select(*keep,
                     F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_path").alias("source_path"),
                     row_seq.cast("decimal(38,0)").alias("row_seq"))


def _file_heads(spark: SparkSession, paths: list[str], known: list[str]) -> dict[str, tuple[str | None, bool]]:
    """Per file, by path: its header line and whether a quoted cell goes on in the next line (some line
    has an odd number of quotes). One pass over the lines, in splits; the driver gets a row a file.

    The header is the first line of the file's first split. Only lines there that name a known column
    are sent on, so the aggregate holds next to nothing; a file whose first line names none has no header (None)."""
    quote = F.lit('"')
    quotes = F.when(F.contains("value", quote), F.length("value") - F.length(F.replace(F.col("value"), quote, F.lit("")))).otherwise(0)
    # A line that names a column names any shorter one inside that, too. Known here, before the aggregate, whose
    # list would evaluate it without generated code.
    names = [n for n in sorted(set(known)) if not any(m != n and m in n for m in known)]
    named = reduce(Column.__or__, [F.contains("line", F.lit(n)) for n in names], F.lit(False))
    # Within a split, and so within a file's first one, later lines have larger numbers.
    lines = spark.read.text(paths).select(
        "value", (quotes % 2 == 1).alias("odd"), F.col("_metadata.file_path").alias("path"), F.upper("value").alias("line"),
        (F.col("_metadata.file_block_start") == 0).alias("head"), F.monotonically_increasing_id().alias("pos"))
    lines = lines.withColumn("named", F.col("head") & named)
    heads = lines.groupBy("path").agg(
        F.max("odd").alias("broken"), F.min(F.when(F.col("head"), F.col("pos"))).alias("first"),
        F.collect_list(F.when(F.col("named"), F.struct("pos", "value"))).alias("named"))
    least = F.array_min("named")
    found = heads.select("path", "broken", F.when(least["pos"] == F.col("first"), least["value"]).alias("header")).collect()
    return {unquote(r["path"]): (r["header"], r["broken"]) for r in found}


def read_raw_csv(spark: SparkSession, paths: list[str], needed: list[str] | None = None,
                 multiline: bool | None = None) -> DataFrame:
    """All-string scan of one or more CSV files with header normalisation,
    pruning to the needed columns, NA tokens as NULL, and a source-file tag
    and row-order column (A1-A4, A6).

    Headers differ between fiscal years, and a multi-file CSV scan maps
    columns by position using one header. So one pass over the lines finds
    every file's header line, files are grouped by it, and each layout is one
    scan, whose columns come from the header of one of its files; the scans
    are unioned by name. Files whose cells hold line breaks are scanned whole,
    the others in splits; ``multiline`` says which it is instead of the look at the
    lines. A file without any of the needed headers gives NULLs.
    """
    needed = needed or S.LCA_NEEDED_COLS
    groups: dict[tuple, list[str]] = {}
    for path, (header, broken) in sorted(_file_heads(spark, paths, needed).items()):
        groups.setdefault((header, broken if multiline is None else multiline), []).append(path)
    parts = [_read_group(spark, files, needed, lines) for (_, lines), files in groups.items()]
    if not parts:                                                        # files without a line
        parts = [_read_group(spark, paths, needed, False)]
    return reduce(DataFrame.unionByName, parts)


def read_raw_perm_csv(spark: SparkSession, paths: list[str], multiline: bool | None = None) -> DataFrame:
    """PERM scan: keep every candidate header (A5 resolves them later)."""
    return read_raw_csv(spark, paths, S.PERM_COLS, multiline)


def places(rows: DataFrame, group: list[str], block: str, pos: str) -> DataFrame:
    """``rows`` (a written table) with ``place``, their 0-based number in their group: blocks in their
    order, and ``pos``, consecutive numbers, inside a block. Only one count a block is ranked."""
    counts = rows.groupBy(*group, block).agg(F.count("*").alias("_n"), F.min(pos).alias("_first"))
    before = (Window.partitionBy(*(group or [F.lit(0)])).orderBy(block).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    joined = rows.join(counts.drop("_n", "_first"), [*group, block])
    return joined.select(*rows.columns, (F.col(pos) + F.col("_shift")).alias("place"))


def list_raw_files(spark: SparkSession, root: str, suffixes=(".csv",)) -> DataFrame:
    """Landed raw files under ``root`` with LCA/PERM routing (A6, A7), as a
    DataFrame from a metadata-only binary-file scan."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", True)
          .load(root)
          .select("path", "length", "modificationTime"))
    name = F.element_at(F.split("path", "/"), -1)
    cond = None
    for suf in suffixes:
        c = F.lower(name).endswith(suf)
        cond = c if cond is None else (cond | c)
    return (df.where(cond)
            .withColumn("file_name", name)
            .withColumn("route", route_of(name)))
