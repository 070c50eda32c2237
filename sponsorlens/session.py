"""Spark session helpers: one place for the engine's session settings and for
the shared folder that holds the warehouse and checkpoints."""
from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# Settings the engine relies on. Shuffle partitions follow the cores in local
# mode; on a cluster set SPONSORLENS_SHUFFLE_PARTITIONS (or the Spark conf)
# so each shuffle partition stays around 128-256 MB at the target scale.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(app: str = "sponsorlens", cpus: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. Local master unless SPARK_MASTER is set."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = os.environ.get("SPARK_MASTER", f"local[{cpus}]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = os.environ.get("SPONSORLENS_SHUFFLE_PARTITIONS", str(cpus))
    if master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of (compressed) input files for each partition that a shuffle starts with, and the most of them.
INPUT_BYTES = 4 << 20
MOST_PARTITIONS = 2000
#: Bytes of a file split, or of shuffled rows, whose rows a task can sort in memory when they are wide.
TASK_BYTES = 16 << 20


def fit_partitions(spark: SparkSession, *inputs: DataFrame) -> int:
    """Let shuffles start with partitions in proportion to the files that ``inputs`` read, so that a task's
    rows don't grow with the data and its sorts stay in memory. AQE joins small ones again. The session's
    number is a floor: smaller inputs change nothing, nor does a session that set more. Returns the number."""
    files = sorted({f for df in inputs for f in df.inputFiles()})
    size = 0
    if files:
        with contextlib.suppress(AnalysisException):        # names that can't be listed: as the session has it
            size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
    now = int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-size // INPUT_BYTES), MOST_PARTITIONS)
    if wanted > now:
        spark.conf.set(INITIAL, str(wanted))
    return max(wanted, now)


def _bytes(size: str) -> int:
    """A size setting (``64MB``, ``16m``, ``134217728b``) in bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextlib.contextmanager
def small_tasks(spark: SparkSession, *keys: str):
    """For a while, tasks of at most ``TASK_BYTES`` by these settings (file splits, shuffled rows)."""
    kept = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            if _bytes(spark.conf.get(k)) > TASK_BYTES:
                spark.conf.set(k, str(TASK_BYTES))
        yield
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of a generated method up to which the JVM compiles it; larger ones are interpreted, many times slower.
JIT_BYTES = 8000


def fit_methods(spark: SparkSession) -> None:
    """Let stages whose generated code has a method that the JVM wouldn't compile run operator by operator,
    whose expressions are generated as small methods each. For the session; a lower limit stays."""
    if int(spark.conf.get(METHOD_LIMIT, None) or JIT_BYTES + 1) > JIT_BYTES:
        spark.conf.set(METHOD_LIMIT, str(JIT_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables and checkpoints.

    Taken from the session's checkpoint directory (``spark.checkpoint.dir``).
    Only a local session without one gets a private folder (tests, laptops);
    a cluster session without one is a configuration error, because a
    machine-local folder would not be visible to the other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="sponsorlens-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def new_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return "/".join([shared_dir(spark), *parts, uuid.uuid4().hex[:12]])
