"""Parquet star-schema warehouse: create-if-absent (A11), dimension
insert-if-new (D2) with dense surrogate keys (D3), fact upsert (D4), run log
(D6), the LCA and PERM load pipelines (D7, D8) and the load stamp (D9).

Storage: every table is a series of immutable Parquet snapshots
``<root>/<table>/v=<n>-<attempt>``; a small append-only manifest (itself
Parquet) records which snapshot is current. A load never overwrites a path, so
a failed or interrupted load leaves the previous snapshots in place and can be
tried again. Dimensions, facts and the run log of a load are committed together.

A batch of files is loaded in one Spark job that gives the same result as
loading the files one at a time in name order:
  * facts: per case number, the last row of the last file wins;
  * dimensions: a natural key takes its attributes from the first file that
    introduced it, and is never updated afterwards.
"""
from __future__ import annotations

import contextlib
import datetime as _dt
import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schemas as S
from ..session import ADVISORY, SPLIT, fit_methods, fit_partitions, small_tasks
from ..sources.raw import is_perm_file
from . import transform as TR
from .keys import assign_dense_ids

log = logging.getLogger("sponsorlens.load")


@contextlib.contextmanager
def _step(name: str):
    t = time.time()
    yield
    log.info("%s: %.2fs", name, time.time() - t)


MANIFEST_SCHEMA = "table string, version long, path string, parts array<string>, committed_at timestamp"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
BUCKET = "case_bucket"

# Load order of source kinds inside one batch: all LCA files, then all PERM files.
KIND_RANK = {"lca": 0, "perm": 1}


def case_bucket(case: str = "case_number") -> F.Column:
    """The part of its year that a case belongs to."""
    return F.pmod(F.xxhash64(case), F.lit(S.CASE_BUCKETS)).cast("int")


def by_part(rows: DataFrame) -> DataFrame:
    """Rows of a part together, for few files; Spark splits a part that is too large for a task. They move packed."""
    keys = ["fiscal_year", BUCKET, "case_number"]
    return TR.unpacked(TR.packed(rows, keys).hint("rebalance", "fiscal_year", BUCKET), rows, keys)


def _key_of(part: str) -> tuple:
    """(fiscal year, bucket) of a folder ``v=N/fiscal_year=Y/case_bucket=B`` (None for a NULL year)."""
    year, bucket = (x.split("=", 1)[1] for x in part.rsplit("/", 2)[1:])
    return None if year == NULL_PARTITION else int(year), int(bucket)


def _in_parts(parts: list[tuple]) -> F.Column:
    """Rows of the given (fiscal year, bucket) pairs, as a partition filter."""
    cond = F.lit(False)
    for year in {y for y, _ in parts}:
        same = F.col("fiscal_year").isNull() if year is None else F.col("fiscal_year") == year
        cond = cond | (same & F.col(BUCKET).isin([b for y, b in parts if y == year]))
    return cond


class Warehouse:
    """Handle on a warehouse root folder (on the shared file system).

    ``publish`` writes a snapshot and makes it visible to this handle at
    once; ``commit`` records all snapshots published since the last commit
    in the manifest with one small append, so a load becomes visible to
    other readers atomically. ``rollback`` forgets uncommitted snapshots.

    Tables partitioned by fiscal year are versioned per partition: a write
    produces folders ``<table>/v=N-A/fiscal_year=Y/case_bucket=B`` only for the
    years and hash buckets of case numbers it rewrites, and the manifest lists
    the current folder of each, so an upsert leaves all others where they are.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._committed: dict[str, tuple] | None = None
        self._pending: dict[str, tuple] = {}
        self.written: dict[str, str] = {}      # name -> path of intermediate tables

    # -- manifest ---------------------------------------------------------
    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest"

    def _load_manifest(self) -> dict[str, tuple]:
        try:
            m = self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest_path)
            latest = (m.groupBy("table")
                       .agg(F.max_by(F.struct("version", "path", "parts"), "version").alias("v"))
                       .collect())                  # one row per table
        except AnalysisException:
            return {}
        return {r["table"]: (r["v"]["version"], r["v"]["path"], r["v"]["parts"]) for r in latest}

    def current(self) -> dict[str, tuple]:
        if self._committed is None:
            self._committed = self._load_manifest()
        return {**self._committed, **self._pending}

    def commit(self, tables: list[str] | None = None) -> None:
        todo = {t: v for t, v in self._pending.items() if tables is None or t in tables}
        if not todo:
            return
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = [(t, v, p, parts, now) for t, (v, p, parts) in sorted(todo.items())]
        (self.spark.createDataFrame(rows, MANIFEST_SCHEMA)
             .coalesce(1).write.mode("append").parquet(self.manifest_path))
        self.current()
        self._committed.update(todo)
        for t in todo:
            self._pending.pop(t, None)

    def rollback(self) -> None:
        self._pending.clear()

    # -- tables -----------------------------------------------------------
    def create_if_absent(self) -> "Warehouse":
        """Create every missing table as an empty snapshot (A11). Tables
        that were never written also read as empty, so this is optional."""
        for name, schema in S.WAREHOUSE_TABLES.items():
            if name not in self.current():
                self.publish(name, self.spark.createDataFrame([], schema))
        self.commit()
        return self

    def table_root(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, bucket: bool = False) -> DataFrame:
        """The current rows of ``table``; with ``bucket``, the case bucket of year-partitioned rows too."""
        schema = S.WAREHOUSE_TABLES[table]
        cur = self.current().get(table)
        if cur is None:
            return self.spark.createDataFrame([], schema)
        if table not in S.PARTITIONED_BY_YEAR and table not in S.APPEND_ONLY:
            return self.spark.read.schema(schema).parquet(cur[1]).select(*schema.fieldNames())
        parts = cur[2] or []
        if not parts:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(BUCKET, F.lit(0)) if bucket else empty
        if table in S.APPEND_ONLY:
            read_schema = T.StructType(list(schema.fields) + [T.StructField("v", T.StringType())])
        else:
            data = [f for f in schema.fields if f.name != "fiscal_year"]
            read_schema = T.StructType(data + [T.StructField("v", T.StringType()),
                                               T.StructField("fiscal_year", T.IntegerType()),
                                               T.StructField(BUCKET, T.IntegerType())])
        base = self.table_root(table)
        df = (self.spark.read.schema(read_schema).option("basePath", base)
              .parquet(*[f"{base}/{p}" for p in parts]))
        return df.select(*schema.fieldNames(), *([BUCKET] if bucket else []))

    def publish(self, table: str, df: DataFrame, replaced: list[tuple] | None = None, replace: bool = False,
                together: bool = False, more: tuple[str, ...] = ()) -> str:
        """Write ``df`` as the next snapshot of ``table`` (uncommitted).

        For a year-partitioned table, ``replaced`` names the (fiscal year, bucket)
        parts that ``df`` replaces (``df`` must hold all their rows); the others
        keep their current folders. ``None`` replaces the whole table.
        For an append-only table (dimensions, run log), ``df`` holds only the
        new rows, which become one more folder of the table, unless
        ``replace`` makes ``df`` the whole table. ``together`` tells that the rows
        of a part are read from few files already, so they aren't shuffled again. ``more`` names
        columns of ``df`` that the snapshot's files hold besides the table's."""
        version = self.current().get(table, (0, None, None))[0] + 1
        # A name of its own for every attempt: what a failed load left behind is never in the way.
        folder = f"v={version:06d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.table_root(table)}/{folder}"
        schema = S.WAREHOUSE_TABLES[table]
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *more)
        parts = None
        if table in S.PARTITIONED_BY_YEAR:
            out = out.withColumn(BUCKET, case_bucket())
            out = out if together else by_part(out)
        w = out.write.mode("errorifexists").option("compression", "zstd")
        if table in S.PARTITIONED_BY_YEAR:
            w.partitionBy("fiscal_year", BUCKET).parquet(path)
            # The folders just written, from the file index (a listing, no job).
            files = self.spark.read.schema(schema).parquet(path).inputFiles()
            written = sorted({"/".join(f.rsplit("/", 4)[1:4]) for f in files})
            old = (self.current().get(table) or (0, None, None))[2] or []
            kept = [] if replaced is None else [p for p in old if _key_of(p) not in set(replaced)]
            parts = sorted(kept + written)
        elif table in S.APPEND_ONLY:
            w.parquet(path)
            old = [] if replace else ((self.current().get(table) or (0, None, None))[2] or [])
            parts = old + [folder]
        else:
            w.parquet(path)
        self._pending[table] = (version, path, parts)
        return path

    def compact(self, tables: list[str] | None = None) -> None:
        """Rewrite tables as one snapshot each (all partitions, one folder of
        rows for insert-only tables) and commit; readers switch atomically.
        Loads leave one folder per load behind; compaction keeps file counts
        down. Old folders stay until removed by a retention job."""
        for table in tables or sorted(self.current()):
            if table in S.WAREHOUSE_TABLES:
                self.publish(table, self.read(table), replace=True)
        self.commit()

    def append_runs(self, runs: DataFrame) -> None:
        """Append run-log rows (one per loaded file) as a new folder."""
        self.publish("etl_runs", runs)

    def scratch(self, name: str) -> str:
        return f"{self.root}/_scratch/{name}-{uuid.uuid4().hex[:8]}"

    def materialise(self, df: DataFrame, name: str, parted: bool = False) -> DataFrame:
        """Write an intermediate result once and read it back (cuts lineage;
        survives executor loss without recomputation); ``parted``, in the parts
        of a year-partitioned table."""
        path = self.scratch(name)
        if parted:
            df = by_part(df.withColumn(BUCKET, case_bucket()))
        w = df.write.mode("errorifexists").option("compression", "zstd")
        (w.partitionBy("fiscal_year", BUCKET) if parted else w).parquet(path)
        self.written[name] = path
        return self.spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# Dimensions (D2 + D3)
# ---------------------------------------------------------------------------
def _first_file_min(order, value):
    """Within the first file (by load order), the smallest non-NULL value."""
    return F.min(F.struct(order.alias("o"), value.isNull().alias("n"), value.alias("v")))["v"]


def employer_candidates(staged: DataFrame, order) -> DataFrame:
    return (staged.groupBy("employer_name_clean")
                  .agg(_first_file_min(order, F.col("employer_name")).alias("employer_name"),
                       F.max("is_university").alias("is_university"),
                       _first_file_min(order, F.col("received_date")).alias("first_seen_date")))


def location_candidates(staged: DataFrame) -> DataFrame:
    return (staged.select(F.col("worksite_city").alias("city"),
                          F.col("worksite_state").alias("state"),
                          F.col("worksite_postal_code").alias("postal_code"))
                  .distinct())


def occupation_candidates(staged: DataFrame, order) -> DataFrame:
    return (staged.where(F.col("soc_code").isNotNull())
                  .groupBy("soc_code")
                  .agg(_first_file_min(order, F.col("soc_title")).alias("soc_title"),
                       _first_file_min(order, F.col("job_category")).alias("job_category")))


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def insert_if_new(wh: Warehouse, table: str, candidates: DataFrame) -> DataFrame:
    """Insert candidate rows whose natural key is not yet present (E11 anti
    join), numbering them after the current maximum id (D3); publish the new
    dimension snapshot and return it."""
    keys = S.NATURAL_KEYS[table]
    id_col = S.SURROGATE_KEYS[table]
    existing = wh.read(table)
    new = wh.materialise(candidates.join(existing, _null_safe_on(candidates, existing, keys), "left_anti"),
                         f"new_{table}")
    if table in wh.current():
        start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    else:
        start = 0                          # first load: no snapshot, nothing to scan
    with_ids = assign_dense_ids(new, keys, id_col, int(start))
    fields = S.WAREHOUSE_TABLES[table].fieldNames()
    filled = with_ids.select(*[F.col(f) if f in with_ids.columns else F.lit(None).alias(f) for f in fields])
    wh.publish(table, filled)                 # insert-only: the new rows become one more folder
    return wh.read(table)


# ---------------------------------------------------------------------------
# Facts (D4, D9)
# ---------------------------------------------------------------------------
def resolve_fact_keys(latest: DataFrame, employers: DataFrame, locations: DataFrame,
                      occupations: DataFrame, columns: list[str]) -> DataFrame:
    """Star-join the staged rows to the dimensions, for the given ``columns`` of the facts: null-safe
    left on the three location columns (E2), left on the SOC code (E3), inner on the clean employer
    name (E1). Employers, the largest, come last: only what is needed then is moved, packed. Columns that the views take from
    employers come along as ``_v_*``, so that the serving rows need no join with these; occupations, a
    short code list, and locations, bounded by geography, are joined there again. Join strategies are left to AQE, which turns
    a join into a broadcast only when the runtime size of a side is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``."""
    e = employers.select("employer_name_clean", "employer_id", F.col("employer_name").alias("_v_employer_name"),
                         F.col("is_university").alias("_v_is_university"))
    l = locations.select("location_id", "city", "state", "postal_code")
    o = occupations.select(F.col("soc_code").alias("_soc_code"), "occupation_id")
    j = latest.join(l, latest.worksite_city.eqNullSafe(l.city) & latest.worksite_state.eqNullSafe(l.state)
                    & latest.worksite_postal_code.eqNullSafe(l.postal_code), "left")
    j = j.join(o, j.soc_code == o._soc_code, "left")
    j = j.withColumnRenamed("location_id", "worksite_location_id")
    key = "employer_name_clean"
    rows = j.select(key, *[c for c in (*columns, *VIEW_COLUMNS) if c not in e.columns])
    return TR.unpacked(TR.packed(rows, [key]).join(e, key, "inner"), rows, [key]).select(*columns, *VIEW_COLUMNS)


VIEW_COLUMNS = ("_v_employer_name", "_v_is_university")


def upsert_fact(wh: Warehouse, table: str, batch: DataFrame) -> tuple[list[tuple] | None, DataFrame]:
    """Replace-on-primary-key (D4): existing rows whose case number is not in
    the batch, plus the batch (facts with the views' columns), stamped with the load time (D9).

    The batch is written once, in parts: a table's first snapshot is the batch itself (its files hold the
    views' columns too); a later batch is written beside the table, for several looks.

    Only the parts (fiscal year and case bucket) the batch touches are rewritten: those of the
    batch rows, and those where a replaced case number used to be, which lie in the batch's
    buckets. The pairs are the only thing the driver collects (at most years x buckets); they are
    returned (None when the whole table was written), with the written batch."""
    fields = S.WAREHOUSE_TABLES[table].fieldNames()
    stamp = F.current_timestamp()
    if table not in wh.current():
        path = wh.publish(table, batch.withColumn("loaded_at", stamp), more=VIEW_COLUMNS)
        return None, wh.spark.read.schema(batch.schema).parquet(path)
    rows = wh.materialise(batch, f"batch_{table}", parted=True)
    stamped = rows.withColumn("loaded_at", stamp).select(*fields)
    if table not in S.PARTITIONED_BY_YEAR:
        keep = wh.read(table).join(rows.select("case_number"), "case_number", "left_anti")
        wh.publish(table, keep.select(*fields).unionByName(stamped))
        return None, rows
    came = [tuple(r) for r in rows.select("fiscal_year", case_bucket().alias(BUCKET)).distinct().collect()]
    existing = wh.read(table, bucket=True).where(F.col(BUCKET).isin(sorted({b for _, b in came})))
    moved = existing.select("case_number", "fiscal_year", BUCKET).join(rows.select("case_number"), "case_number", "left_semi")
    parts = sorted(set(came) | {tuple(r) for r in moved.select("fiscal_year", BUCKET).distinct().collect()}, key=str)
    wh.publish(table, _others(wh, table, rows, parts).select(*fields).unionByName(stamped), parts)
    return parts, rows


def _others(wh: Warehouse, table: str, rows: DataFrame, parts: list[tuple]) -> DataFrame:
    """Existing rows of some parts whose case is not in the batch."""
    return wh.read(table, bucket=True).where(_in_parts(parts)).join(rows.select("case_number"), "case_number", "left_anti")


def refresh_serving(wh: Warehouse, fact_table: str, parts: list[tuple] | None, rows: DataFrame) -> None:
    """The serving table after an upsert of ``rows`` (with the views' columns) into ``parts`` of the
    facts: the batch's view rows and, in those parts, the rows of other cases as they were (dimensions
    never change, so their view rows don't either)."""
    table = SERVING[fact_table]
    fields = S.WAREHOUSE_TABLES[table].fieldNames()
    seen = {c.removeprefix("_v_"): c for c in VIEW_COLUMNS}
    occupations = wh.read("occupations").select("occupation_id", "soc_code", "soc_title", "job_category")
    locations = wh.read("locations").select(F.col("location_id").alias("worksite_location_id"), F.col("city").alias("worksite_city"),
                                            F.col("state").alias("worksite_state"))
    served = rows.join(occupations, "occupation_id", "left").join(locations, "worksite_location_id", "left").select(*[F.col(seen.get(f, f)).alias(f) for f in fields])
    if parts is not None:
        served = _others(wh, table, rows, parts).select(*fields).unionByName(served)
    wh.publish(table, served, parts, together=parts is None)


# ---------------------------------------------------------------------------
# Load pipelines
# ---------------------------------------------------------------------------
def _run_rows(spark: SparkSession, per_file: DataFrame, kind: str, started: _dt.datetime,
              status: str, error: str | None) -> DataFrame:
    return per_file.select(
        F.expr("uuid()").alias("run_id"),
        F.lit(kind).alias("source"),
        F.col("source_file").alias("file_name"),
        F.lit(started).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("finished_at"),
        F.col("n").cast("long").alias("rows_loaded"),
        F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error"),
    )


SERVING = {"lca_filings": "sponsorships_serving", "perm_filings": "perm_serving"}
_DIM_COLUMNS = ["source_file", "employer_name_clean", "employer_name", "is_university", "received_date",
                "worksite_city", "worksite_state", "worksite_postal_code", "soc_code", "soc_title", "job_category"]


def load_batch(wh: Warehouse, lca_raw: DataFrame | None = None, perm_raw: DataFrame | None = None,
               file_names: list[str] | None = None) -> dict[str, DataFrame]:
    """Load LCA and PERM files in one batch (D7, D8) and return the staged tables by kind.

    If the batch fails, nothing of it is committed. A pass over its files, in groups,
    names those that can't be read and typed: they are logged ``failed`` with their kind and
    whole error text, the others are loaded as one batch and logged ``success``, and the
    first error is raised at the end (D6). If no file is at fault alone, all are logged
    ``failed`` and the batch's error is raised, so that it can be tried again.
    ``file_names`` names the files for the log if they can't be read.
    """
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    kinds = {k: v for k, v in (("lca", lca_raw), ("perm", perm_raw)) if v is not None}
    try:
        fit_partitions(wh.spark, *kinds.values())
        fit_methods(wh.spark)
        with small_tasks(wh.spark, SPLIT):           # rows of a split are sorted for a shuffle or by their parts
            return _load(wh, kinds, started)
    except Exception as exc:
        wh.rollback()
        files = _files(kinds, file_names)
        bad = _bad_files(kinds, files) if len(files) > 1 else {}
        good = {k: [n for f, n in files if f == k and (f, n) not in bad] for k in kinds}
        log.warning("load failed; files at fault: %s", sorted(bad) or "none alone")
        if not bad:                       # one file, or a fault that no file shows by itself
            _log_failure(wh, {f: exc for f in files or [(next(iter(kinds), "lca"), "<batch>")]}, started)
            raise
        _log_failure(wh, bad, started)
        if any(good.values()):
            load_batch(wh, *(kinds[k].where(F.col("source_file").isin(good[k])) if good.get(k) else None for k in ("lca", "perm")),
                       [n for k in good for n in good[k]])
        raise bad[min(bad, key=lambda f: (KIND_RANK[f[0]], f[1]))]


PROBES = 8


def _bad_files(kinds: dict[str, DataFrame], files: list[tuple[str, str]]) -> dict[tuple[str, str], Exception]:
    """The files whose rows can't be read and typed, and why.

    Groups of files are evaluated by themselves, ``PROBES`` at a time and nothing of them kept; only a
    group that fails is split further. All files are so read about once, and the bad ones'
    neighbours a few times, in about PROBES * log(files) small jobs for each bad file."""
    def probe(group: list[tuple[str, str]]) -> Exception | None:
        try:
            for kind in {k for k, _ in group}:
                raw = kinds[kind].where(F.col("source_file").isin([n for k, n in group if k == kind]))
                TR.typed_rows(raw, kind).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # reported with the file's run row
            return exc
        return None

    bad: dict[tuple[str, str], Exception] = {}
    groups = [files[i::PROBES] for i in range(min(PROBES, len(files)))]
    with ThreadPoolExecutor(PROBES) as pool:
        while groups:
            failed = [(g, x) for g, x in zip(groups, pool.map(probe, groups)) if x is not None]
            bad.update({g[0]: x for g, x in failed if len(g) == 1})
            groups = [part for g, _ in failed if len(g) > 1 for part in (g[i::PROBES] for i in range(min(PROBES, len(g))))]
    return bad


def _files(kinds: dict[str, DataFrame], file_names: list[str] | None) -> list[tuple[str, str]]:
    """(kind, file name) of a batch in load order: from the data, or by the
    given names, whose kind is that of the batch or told by the name."""
    if file_names is None:
        try:
            return [(k, r[0]) for k in sorted(kinds, key=KIND_RANK.get)
                    for r in kinds[k].select("source_file").distinct().orderBy("source_file").collect()]
        except Exception:  # not even the names can be read
            return []
    kind = (lambda n: next(iter(kinds))) if len(kinds) == 1 else (lambda n: "perm" if is_perm_file(n) else "lca")
    return sorted(((kind(n), n) for n in file_names), key=lambda x: (KIND_RANK[x[0]], x[1]))


def _log_failure(wh: Warehouse, failed: dict[tuple[str, str], Exception], started: _dt.datetime) -> None:
    """One failed run row a file, with its kind and whole error text, committed together."""
    runs = None
    for (kind, name), exc in failed.items():
        per_file = wh.spark.createDataFrame([(name, 0)], "source_file string, n long")
        r = _run_rows(wh.spark, per_file, kind, started, "failed", str(exc))
        runs = r if runs is None else runs.unionByName(r)
    wh.append_runs(runs)
    wh.commit(["etl_runs"])


def _together(spark: SparkSession, *jobs: Callable) -> list:
    """Results of jobs that don't need each other's. They run at the same time, so that the last tasks of one leave
    no core idle; when all have ended, the error of the first that failed, in their order, is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [f.result() for f in futures]


def _load(wh: Warehouse, kinds: dict[str, DataFrame], started: _dt.datetime) -> dict[str, DataFrame]:
    """Load the given kinds and commit.

    Both staged tables feed the dimensions in one pass each, ordered as the
    original loads them (all LCA files in name order, then PERM files), so
    the result equals loading every file on its own. Kinds are staged together, then the
    dimensions inserted, then the facts of both kinds. The run log gets one
    row per file; dimensions, facts, serving tables and the run log are
    committed together.
    """
    spark = wh.spark
    spec = {"lca": ("lca_filings", LCA_FACT_COLUMNS), "perm": ("perm_filings", PERM_FACT_COLUMNS)}
    wh.current()

    def stage(kind: str) -> DataFrame:
        with _step(f"{kind} staged"):
            return wh.materialise(TR.keyed_rows(kinds[kind], kind), f"staged_{kind}")

    with small_tasks(spark, ADVISORY):               # typed rows are wide, and sorted by their keys
        keyed = dict(zip(kinds, _together(spark, *[partial(stage, kind) for kind in kinds])))
    staged = {kind: TR.with_rows(rows) for kind, rows in keyed.items()}
    src = None
    for kind, st in staged.items():
        part = st.select(*[F.col(c) if c in st.columns else F.lit(None).alias(c) for c in _DIM_COLUMNS],
                         F.lit(KIND_RANK[kind]).alias("_rank"))
        src = part if src is None else src.unionByName(part)
    order = F.struct(F.col("_rank"), F.col("source_file"))
    with _step("dimensions"):
        employers, locations, occupations = _together(
            spark,
            lambda: insert_if_new(wh, "employers", employer_candidates(src, order)),
            lambda: insert_if_new(wh, "locations", location_candidates(src)),
            lambda: insert_if_new(wh, "occupations", occupation_candidates(src, order)))

    def upsert(kind: str) -> None:
        fact_table, fact_cols = spec[kind]
        with _step(f"{kind} star join"):
            facts = resolve_fact_keys(TR.of_last_file(keyed[kind], wh.materialise), employers, locations, occupations, fact_cols)
        with _step(f"{kind} fact"):
            parts, facts = upsert_fact(wh, fact_table, facts)
        with _step(f"{kind} serving"):
            refresh_serving(wh, fact_table, parts, facts)

    _together(spark, *[partial(upsert, kind) for kind in staged])
    runs = None
    for kind, st in staged.items():
        per_file = st.groupBy("source_file").agg(F.count("*").alias("n"))
        r = _run_rows(spark, per_file, kind, started, "success", None)
        runs = r if runs is None else runs.unionByName(r)
    with _step("run log + commit"):
        wh.append_runs(runs)
        wh.commit()                   # dimensions, facts and run log become visible together
    return staged


LCA_FACT_COLUMNS = [
    "case_number", "case_status", "visa_class", "received_date", "decision_date",
    "fiscal_year", "employer_id", "worksite_location_id", "occupation_id",
    "job_title", "full_time", "annual_wage", "prevailing_wage", "wage_unit_raw",
    "total_worker_positions", "source_file",
]
PERM_FACT_COLUMNS = [
    "case_number", "case_status", "received_date", "decision_date", "fiscal_year",
    "employer_id", "worksite_location_id", "occupation_id", "job_title",
    "annual_wage", "source_file",
]


def load_lca(wh: Warehouse, raw: DataFrame, file_names: list[str] | None = None) -> DataFrame:
    """LCA load (D7): raw -> staged -> dimensions -> fact -> run log.
    Returns the staged table (one row per file and case number)."""
    return load_batch(wh, lca_raw=raw, file_names=file_names)["lca"]


def load_perm(wh: Warehouse, raw: DataFrame, file_names: list[str] | None = None) -> DataFrame:
    """PERM load (D8): candidate headers -> staged -> dimensions -> fact."""
    return load_batch(wh, perm_raw=raw, file_names=file_names)["perm"]
