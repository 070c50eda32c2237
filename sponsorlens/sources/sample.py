"""Synthetic raw LCA filings (A10) for tests and demos.

Built on ``spark.range``: every value is drawn from a hash of (row id,
seed, draw number), so the output is the same under any partitioning and
needs no driver-side loop. The value lists and weights are this library's own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

_SCALE = 1 << 30


def _u(seed: int, k: int) -> Column:
    """A uniform integer in [0, 2^30) for draw ``k`` of the current row."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(k)), F.lit(_SCALE))


def _frac(seed: int, k: int) -> Column:
    return _u(seed, k).cast("double") / F.lit(float(_SCALE))


def _choice(values: list, seed: int, k: int) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(_u(seed, k), F.lit(len(values))) + 1).cast("int"))


def _weighted(pairs: list[tuple], seed: int, k: int) -> Column:
    total = sum(w for _, w in pairs)
    u = F.pmod(_u(seed, k), F.lit(total))
    expr, acc = None, 0
    for value, w in pairs:
        acc += w
        expr = F.when(u < acc, F.lit(value)) if expr is None else expr.when(u < acc, F.lit(value))
    return expr


def make_rows(spark: SparkSession, n: int, seed: int = 42, source_file: str = "sample.csv") -> DataFrame:
    """``n`` raw rows shaped like a disclosure file (all strings), plus
    ``source_file`` and ``row_seq`` (= row number)."""
    emp = F.element_at(F.array(*[F.struct(F.lit(a).alias("n"), F.lit(b).alias("s")) for a, b in S.SAMPLE_EMPLOYERS]),
                       (F.pmod(_u(seed, 1), F.lit(len(S.SAMPLE_EMPLOYERS))) + 1).cast("int"))
    occ = F.element_at(F.array(*[F.struct(F.lit(a).alias("soc"), F.lit(b).alias("soc_title"), F.lit(c).alias("title"),
                                          F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
                                 for a, b, c, lo, hi in S.SAMPLE_OCCUPATIONS]),
                       (F.pmod(_u(seed, 2), F.lit(len(S.SAMPLE_OCCUPATIONS))) + 1).cast("int"))
    city = F.element_at(F.array(*[F.struct(F.lit(a).alias("c"), F.lit(b).alias("s")) for a, b in S.SAMPLE_CITIES]),
                        (F.pmod(_u(seed, 3), F.lit(len(S.SAMPLE_CITIES))) + 1).cast("int"))
    base = (spark.range(n)
            .select("id", emp.alias("emp"), occ.alias("occ"), city.alias("city"),
                    _choice(S.SAMPLE_FISCAL_YEARS, seed, 4).alias("fy"),
                    _weighted(S.SAMPLE_UNIT_WEIGHTS, seed, 5).alias("unit"),
                    _u(seed, 6).alias("u6"), _frac(seed, 7).alias("f7"), _frac(seed, 8).alias("f8"),
                    _u(seed, 9).alias("u9"), _u(seed, 10).alias("u10"), _u(seed, 11).alias("u11")))
    received = F.date_add(F.make_date(F.col("fy") - 1, F.lit(10), F.lit(1)), F.pmod("u6", F.lit(361)).cast("int"))
    wage = F.round(F.col("occ.lo") + F.col("f7") * (F.col("occ.hi") - F.col("occ.lo")), -3)
    yearly = F.col("unit") == "Year"
    pw = F.when(yearly, F.round(wage * (F.lit(0.8) + F.col("f8") * 0.18), -3)).otherwise(F.round(wage / 2080 * 0.9, 2))
    return base.select(
        F.format_string("I-200-%d%05d-%d", F.col("fy"), F.col("id"), F.pmod("u9", F.lit(900000)) + 100000)
         .alias("CASE_NUMBER"),
        _weighted(S.SAMPLE_STATUS_WEIGHTS, seed, 12).alias("CASE_STATUS"),
        received.cast("string").alias("RECEIVED_DATE"),
        F.date_add(received, (F.pmod("u10", F.lit(58)) + 3).cast("int")).cast("string").alias("DECISION_DATE"),
        _weighted(S.SAMPLE_VISA_WEIGHTS, seed, 13).alias("VISA_CLASS"),
        F.col("occ.title").alias("JOB_TITLE"),
        F.col("occ.soc").alias("SOC_CODE"),
        F.col("occ.soc_title").alias("SOC_TITLE"),
        _weighted(S.SAMPLE_FULL_TIME_WEIGHTS, seed, 14).alias("FULL_TIME_POSITION"),
        F.col("emp.n").alias("EMPLOYER_NAME"),
        F.col("emp.s").alias("EMPLOYER_STATE"),
        F.col("city.c").alias("WORKSITE_CITY"),
        F.col("city.s").alias("WORKSITE_STATE"),
        (F.pmod("u11", F.lit(90000)) + 10000).cast("string").alias("WORKSITE_POSTAL_CODE"),
        F.when(yearly, wage).otherwise(F.round(wage / 2080, 2)).cast("string").alias("WAGE_RATE_OF_PAY_FROM"),
        F.col("unit").alias("WAGE_UNIT_OF_PAY"),
        pw.cast("string").alias("PREVAILING_WAGE"),
        F.col("unit").alias("PW_UNIT_OF_PAY"),
        _weighted(S.SAMPLE_POSITION_WEIGHTS, seed, 15).cast("string").alias("TOTAL_WORKER_POSITIONS"),
        F.lit(source_file).alias("source_file"),
        F.col("id").alias("row_seq"),
    )


def write_csv(df: DataFrame, out: str) -> str:
    """Write raw rows as a headed CSV folder (the shape of a landed file)."""
    (df.drop("source_file", "row_seq").write.mode("errorifexists")
       .option("header", True).option("quote", '"').option("escape", '"').csv(out))
    return out
