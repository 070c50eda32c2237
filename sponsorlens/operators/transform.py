"""Raw -> staged transforms (B1-B4) and keep-last dedup.

The input is a raw scan: upper-case string columns plus ``source_file`` and
``row_seq`` (any orderable column giving row order inside a file; a number keeps
the grouped maximum in a hash aggregate).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from ..session import new_dir
from ..sources.raw import column_or_null, first_present

LCA_STAGED_COLUMNS = [
    "case_number", "case_status", "visa_class", "received_date", "decision_date",
    "job_title", "soc_code", "soc_title", "employer_name", "worksite_city",
    "worksite_state", "worksite_postal_code", "full_time", "total_worker_positions",
    "annual_wage", "prevailing_wage", "wage_unit_raw", "employer_name_clean",
    "is_university", "job_category", "fiscal_year", "source_file",
]
PERM_STAGED_COLUMNS = [
    "case_number", "case_status", "received_date", "decision_date", "job_title",
    "soc_code", "soc_title", "employer_name", "worksite_city", "worksite_state",
    "worksite_postal_code", "annual_wage", "employer_name_clean", "is_university",
    "job_category", "fiscal_year", "source_file",
]


def _derive(typed: DataFrame, columns: list[str]) -> DataFrame:
    """Later projections: columns computed from already-typed columns.

    Kept as separate projections (Catalyst does not merge projections that
    would repeat a non-trivial expression), so each regex and each wage
    product runs once per row and every generated method stays small enough
    for whole-stage codegen."""
    step = typed.select("*", X.category_text("job_title", "soc_title").alias("_text")).select(
        "*",
        X.clean_employer("employer_name").alias("employer_name_clean"),
        X.category_of("_text").alias("job_category"),
        X.fiscal_year("received_date").alias("fiscal_year"),
        *[X.bounded(f"_{w}").alias(w) for w in WAGES if f"_{w}" in typed.columns])
    step = step.withColumn("is_university", X.is_university("employer_name_clean"))
    return step.select(*columns)


WAGES = ("annual_wage", "prevailing_wage")


def _wages(typed: DataFrame) -> DataFrame:
    """Each wage as one column: its number times the factor of its unit."""
    parts = [f"_{w}_{x}" for w in WAGES for x in ("num", "factor")]
    return typed.select(*[c for c in typed.columns if c not in parts],
                        *[(F.col(f"_{w}_num") * F.col(f"_{w}_factor")).alias(f"_{w}") for w in WAGES if f"_{w}_num" in typed.columns])


def _wage_parts(name: str, wage: Column, unit: Column) -> dict[str, Column]:
    return {f"_{name}_num": X.wage_number(wage), f"_{name}_factor": X.unit_factor(unit)}


def _typed_lca(raw: DataFrame) -> DataFrame:
    col = lambda n: column_or_null(raw, n)
    cols = {
        "case_number": col("CASE_NUMBER"),
        "case_status": col("CASE_STATUS"),
        "visa_class": col("VISA_CLASS"),
        "received_date": X.parse_date(col("RECEIVED_DATE")),
        "decision_date": X.parse_date(col("DECISION_DATE")),
        "job_title": X.upper_strip(col("JOB_TITLE")),
        "soc_code": X.soc_code(col("SOC_CODE")),
        "soc_title": X.strip(col("SOC_TITLE")),
        "employer_name": X.strip(col("EMPLOYER_NAME")),
        "worksite_city": X.upper_strip(col("WORKSITE_CITY")),
        "worksite_state": X.upper_strip(col("WORKSITE_STATE")),
        "worksite_postal_code": X.strip(col("WORKSITE_POSTAL_CODE")),
        "full_time": X.yes_flag(col("FULL_TIME_POSITION")),
        "total_worker_positions": X.int_or_one(col("TOTAL_WORKER_POSITIONS")),
        **_wage_parts("annual_wage", col("WAGE_RATE_OF_PAY_FROM"), col("WAGE_UNIT_OF_PAY")),
        **_wage_parts("prevailing_wage", col("PREVAILING_WAGE"), col("PW_UNIT_OF_PAY")),
        "wage_unit_raw": col("WAGE_UNIT_OF_PAY"),
        "source_file": F.col("source_file"),
    }
    return raw.select(*[e.alias(c) for c, e in cols.items()], F.col("row_seq"))


def _typed_perm(raw: DataFrame) -> DataFrame:
    col = lambda f: first_present(raw, S.PERM_CANDIDATES[f])
    cols = {
        "case_number": col("case_number"),
        "case_status": col("case_status"),
        "received_date": X.parse_date(col("received")),
        "decision_date": X.parse_date(col("decision")),
        "job_title": X.upper_strip(col("job_title")),
        "soc_code": X.soc_code(col("soc_code")),
        "soc_title": X.strip(col("soc_title")),
        "employer_name": X.strip(col("employer")),
        "worksite_city": X.upper_strip(col("ws_city")),
        "worksite_state": X.upper_strip(col("ws_state")),
        "worksite_postal_code": X.strip(col("ws_postal")),
        **_wage_parts("annual_wage", col("wage"), col("wage_unit")),
        "source_file": F.col("source_file"),
    }
    return raw.select(*[e.alias(c) for c, e in cols.items()], F.col("row_seq"))


def validate(raw: DataFrame, kind: str) -> DataFrame:
    """Required keys present (B3) and case number longer than five (B4). Typing trims an employer but makes
    none NULL, so the raw columns tell it; a filter on typed ones would be moved below and type them twice."""
    case, employer = ((column_or_null(raw, "CASE_NUMBER"), column_or_null(raw, "EMPLOYER_NAME")) if kind == "lca"
                      else (first_present(raw, S.PERM_CANDIDATES[f]) for f in ("case_number", "employer")))
    keys = {"_case": case, "_employer": employer}
    return raw.withColumns(keys).dropna(subset=list(keys)).where(F.length("_case") > 5).drop(*keys)


ROW = "_row"
PACKED = "_packed"
VALUES = "_values"
#: Between the values of packed columns; ESCAPE with a digit stands for ESCAPE (0), SEPARATOR (1), NULL (2).
SEPARATOR, ESCAPE = "\x1f", "\x1e"


def packed(rows: DataFrame, but: list[str] = ()) -> DataFrame:
    """``rows`` with their string columns, ``but`` some, as the one column ``PACKED``, for a shuffle of whole
    rows. A row gives each string a word with its place and pads it, and as the places differ from row to
    row that compresses badly: a third of the bytes of staged rows is saved. ``unpacked`` undoes it."""
    names = _strings(rows, but)
    if not names:
        return rows
    code = lambda c, to: F.replace(c, F.lit(to[0]), F.lit(to[1]))

    def value(c: Column) -> Column:
        coded = code(code(c, (ESCAPE, f"{ESCAPE}0")), (SEPARATOR, f"{ESCAPE}1"))
        return F.coalesce(F.when(F.contains(c, F.lit(ESCAPE)) | F.contains(c, F.lit(SEPARATOR)), coded).otherwise(c), F.lit(f"{ESCAPE}2"))

    values = [value(F.col(c)) for c in names]
    return rows.select(*[c for c in rows.columns if c not in names], F.concat_ws(SEPARATOR, *values).alias(PACKED))


def unpacked(moved: DataFrame, rows: DataFrame, but: list[str] = ()) -> DataFrame:
    """The columns of ``rows``, which were ``packed``, and then those that came to ``moved`` besides."""
    names = _strings(rows, but)

    def value(i: int) -> Column:
        v = F.col(VALUES)[i]
        text = F.replace(F.replace(v, F.lit(f"{ESCAPE}1"), F.lit(SEPARATOR)), F.lit(f"{ESCAPE}0"), F.lit(ESCAPE))
        return F.when(~F.contains(v, F.lit(ESCAPE)), v).when(v != f"{ESCAPE}2", text)

    # A column, as every value reads it. A split would not keep bytes that are no UTF-8: such texts are cut one by one.
    cut = F.array(*[F.substring_index(F.substring_index(PACKED, SEPARATOR, i + 1), SEPARATOR, -1) for i in range(len(names))])
    split = moved.withColumn(VALUES, F.when(F.is_valid_utf8(PACKED), F.split(PACKED, SEPARATOR)).otherwise(cut)) if names else moved
    return split.select(*[value(names.index(c)).alias(c) if c in names else F.col(c) for c in rows.columns],
                        *[c for c in moved.columns if c not in (*rows.columns, PACKED)])


def _strings(rows: DataFrame, but: list[str]) -> list[str]:
    return [f.name for f in rows.schema if f.dataType.typeName() == "string" and f.name not in but]


Write = Callable[[DataFrame, str], DataFrame]


def _shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = new_dir(df.sparkSession, "staging", name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def keep_last(df: DataFrame, keys: list[str], order: Column, columns: list[str], write: Write = _shared) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    Rows are written with a number each. The winners are a grouped ``max_by`` of that number, so the
    aggregate holds two narrow values per key, is partial (a hot key, even a third of all rows, is
    reduced by the map tasks), and sorts no payload; a semi join on the number, which spreads evenly,
    fetches the winners' columns.
    """
    rows = write(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    winners = rows.groupBy(*keys).agg(F.max_by(ROW, order).alias(ROW))
    return rows.join(winners.select(ROW), ROW, "left_semi").select(*columns)


_TYPED = {"lca": _typed_lca, "perm": _typed_perm}
_STAGED_COLUMNS = {"lca": LCA_STAGED_COLUMNS, "perm": PERM_STAGED_COLUMNS}


def typed_rows(raw: DataFrame, kind: str) -> DataFrame:
    """Typed columns (B1, B2) of the rows with their keys."""
    return _derive(_wages(_TYPED[kind](validate(raw, kind))), [*_STAGED_COLUMNS[kind], "row_seq"])


def keyed_rows(raw: DataFrame, kind: str) -> DataFrame:
    """Typed, validated rows of one kind of file, the last of each (source_file, case_number), as when
    files are loaded one at a time.

    Whole rows are shuffled once, packed and before the derived columns widen them, and land in order of their
    file, so that they are alike where they move on: the grouped ``max_by`` of the row is partial, so a hot key is reduced by the map tasks. A key whose rows all lack their order has
    no last row, but is one of its case's files: it stays, without an employer (``with_rows`` drops it)."""
    typed = _wages(_TYPED[kind](validate(raw, kind)))
    keys = ["case_number", "source_file"]
    small = packed(typed, keys)
    row = F.struct(*[c for c in small.columns if c not in (*keys, "row_seq")])
    last = small.groupBy(*reversed(keys)).agg(F.max_by(row, "row_seq").alias(ROW)).select(*keys, f"{ROW}.*")
    return _derive(unpacked(last, typed.drop("row_seq"), keys), _STAGED_COLUMNS[kind])


def with_rows(keyed: DataFrame) -> DataFrame:
    """The staged rows: those of keys with a last row."""
    return keyed.where(F.col("employer_name").isNotNull())


def of_last_file(keyed: DataFrame, write: Write = _shared) -> DataFrame:
    """The staged rows of written ``keyed_rows`` that are of their case's last file (by name), which replaces
    the others (D4). Only cases of several files are looked up: they are written first, so that Spark
    knows how many there are and shuffles the rows only if they are too many to broadcast."""
    files = keyed.groupBy("case_number").agg(F.max("source_file").alias("_last"), F.count("*").alias("_n"))
    several = write(files.where("_n > 1").drop("_n"), "several_files")
    return (with_rows(keyed).join(several, "case_number", "left")
            .where(F.col("source_file") == F.coalesce("_last", "source_file")).drop("_last"))


def stage_lca(raw: DataFrame) -> DataFrame:
    """LCA transform (B1): typed columns, validation, keep-last per (source_file, case_number)."""
    return with_rows(keyed_rows(raw, "lca"))


def stage_perm(raw: DataFrame) -> DataFrame:
    """PERM transform (B2) through candidate headers (A5)."""
    return with_rows(keyed_rows(raw, "perm"))


def latest_per_case(staged: DataFrame, columns: list[str]) -> DataFrame:
    """Across files, the later file (name order) replaces the earlier row."""
    return keep_last(staged, ["case_number"], F.col("source_file"), columns)
