"""Constraint audits for the Parquet warehouse (C1-C3): Parquet does not
enforce keys, so they are checked with aggregates and anti joins."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .warehouse import Warehouse

REFERENCES = {
    "employer_id": ("employers", "employer_id"),
    "worksite_location_id": ("locations", "location_id"),
    "occupation_id": ("occupations", "occupation_id"),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_uniqueness(wh: Warehouse, tables: list[str], natural: bool = True) -> DataFrame:
    """Number of key values held by more than one row, per table (the
    natural key, or the surrogate key when ``natural`` is false)."""
    out = []
    for t in tables:
        keys = S.NATURAL_KEYS[t] if natural or t not in S.SURROGATE_KEYS else [S.SURROGATE_KEYS[t]]
        out.append(duplicate_keys(wh.read(t), t, keys))
    return _union(out)


def duplicate_keys(rows: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """How many key values of ``rows`` have more than one row."""
    dups = (rows.groupBy(*keys).count().where(F.col("count") > 1)
                .agg(F.count("*").alias("duplicate_keys")))
    return dups.select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "duplicate_keys")


def orphans(rows: DataFrame, name: str, column: str, known: DataFrame) -> DataFrame:
    """How many non-NULL references of ``rows`` aren't in ``known`` (one column of that name)."""
    found = rows.select(column).where(F.col(column).isNotNull()).join(known, column, "left_anti")
    return (found.agg(F.count("*").alias("orphan_rows"))
                 .select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "orphan_rows"))


def foreign_keys(wh: Warehouse, pairs: list[tuple[str, str]]) -> DataFrame:
    """Fact rows whose non-NULL reference has no dimension row."""
    out = []
    for table, column in pairs:
        dim, dim_key = REFERENCES[column]
        out.append(orphans(wh.read(table), table, column, wh.read(dim).select(F.col(dim_key).alias(column))))
    return _union(out)


def lca_quality(fact: DataFrame) -> DataFrame:
    """Required values and wage bounds, in one pass over the fact."""
    def out_of_bounds(c):
        return F.count_if(F.col(c).isNotNull() & ~F.col(c).between(S.WAGE_MIN, S.WAGE_MAX))
    return fact.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("case_number").isNull()).alias("null_case_number"),
        F.count_if(F.col("fiscal_year").isNull()).alias("null_fiscal_year"),
        F.count_if(F.col("annual_wage").isNull()).alias("null_annual_wage"),
        F.count_if(F.col("prevailing_wage").isNull()).alias("null_prevailing_wage"),
        out_of_bounds("annual_wage").alias("annual_wage_out_of_bounds"),
        out_of_bounds("prevailing_wage").alias("prevailing_wage_out_of_bounds"),
    )
