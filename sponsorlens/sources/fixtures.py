"""Raw LCA and PERM filings derived from the driver's TPC-H-style tables.

One raw LCA row per ``lineitem`` row; one raw PERM row per order, filed by the
customer or, in two market segments, by an agency named after its nation, so
that some employers have no PERM filing. The output has the shape of a freshly scanned raw file: all
columns are strings under upper-case headers, plus ``source_file`` and
``row_seq`` (row order inside a file). The same mapping is written in SQL in
``plans/oracle.py`` for the DuckDB check.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import na_to_null
from ..operators.transform import packed, unpacked
from ..session import new_dir

# Own mapping tables of the fixture: title, SOC code and SOC title by l_partkey % 10.
FIXTURE_JOBS = [
    ("Platform Software Engineer", "15-1252", "Software Developers"),
    (" staff software engineer ", "15-1252", "Software Developers"),
    ("APPLIED DATA SCIENTIST", "15-2051", "Data Scientists"),
    ("Streaming Data Engineer", "15-1243", "Database Architects"),
    ("MACHINE LEARNING RESEARCHER", "15-2051", "Data Scientists"),
    ("Hardware Test Engineer", "17-2061", "Computer Hardware Engineers"),
    ("NETWORK ANALYST", "15-1244", "Network and Computer Systems Administrators"),
    ("TAX ACCOUNTANT", "13-2011", "Accountants and Auditors"),
    ("CLOUD SECURITY ENGINEER", "15-1212", "Information Security Analysts"),
    ("STRUCTURAL ENGINEER", "17-2051", "Civil Engineers"),
]
FIXTURE_NAME_SUFFIXES = [" LLC", ", Inc.", " CORP", ""]          # by l_linenumber % 4
FIXTURE_STATES = [                                                # by s_nationkey
    "CA", "WA", "TX", "NY", "OH", "NJ", "VA", "AR", "IL", "PA", "MA", "GA", "FL",
    "NC", "MI", "CO", "AZ", "OR", "MN", "MO", "TN", "MD", "WI", "UT", "CT",
]
PERM_SOC_CODES = ["15-1252", "15-2051", "15-1243"]                # o_orderkey % 10 = 0, 1, 2; else 13-2011
PERM_SOC_DEFAULT = "13-2011"
#: Customers of these segments leave PERM filings to an agency of their nation.
AGENCY_SEGMENTS = ["HOUSEHOLD", "MACHINERY"]


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _date_str(c: Column) -> Column:
    return c.cast("date").cast("string")


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def raw_lca(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                          "l_quantity", "l_extendedprice", "l_returnflag",
                                          "l_linestatus", "l_shipdate"])
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    s = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    # Orders with their customers are written first: the lines, the largest table, are then shuffled for one
    # join only, and not for one with the customers too. Read back, they are as small to Spark as their files.
    kept = new_dir(spark, "fixture")
    oc = o.join(c, c.c_custkey == o.o_custkey)
    oc.write.option("compression", "zstd").parquet(kept)
    oc = spark.read.schema(oc.schema).parquet(kept)
    # Lines move with what the rows need of them: the day they were shipped, and one number for their two flags.
    flags = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 0)
             .when(F.col("l_returnflag") == "R", 1)
             .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), 2)
             .otherwise(3))
    l = (l.withColumns({"l_shipdate": F.col("l_shipdate").cast("date"), "_status": flags})
          .drop("l_returnflag", "l_linestatus"))
    j = (l.join(oc, l.l_orderkey == oc.o_orderkey)
          .join(s, s.s_suppkey == l.l_suppkey))

    pk10 = F.col("l_partkey") % 10
    hourly = F.col("l_linenumber") == 7
    status = _pick(F.col("_status"), ["Denied", "Withdrawn", "Certified - Withdrawn", "Certified"])
    visa = (F.when(F.col("o_orderpriority") == "1-URGENT", "E-3 Australian")
            .when(F.col("o_orderpriority") == "5-LOW", "H-1B1 Singapore")
            .otherwise("H-1B"))
    employer = F.concat(F.when(F.col("c_custkey") % 10 == 0, "University of ").otherwise(""),
                        F.col("c_name"),
                        _pick(F.col("l_linenumber") % 4, FIXTURE_NAME_SUFFIXES))
    price = F.col("l_extendedprice")
    wage = (F.when(F.col("l_partkey") % 97 == 0, "N/A")
            .when(hourly, F.floor(price / 1000).cast("bigint").cast("string"))
            .otherwise(F.concat(F.lit("$"), F.floor(price * 3).cast("bigint").cast("string"), F.lit(".00"))))
    prevailing = (F.when(hourly, F.floor(price / 1100).cast("bigint").cast("string"))
                  .otherwise(F.floor(price * 2.7).cast("bigint").cast("string")))
    unit = F.when(hourly, "Hour").otherwise("Year")
    raw = j.select(
        F.concat(F.lit("I-200-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("CASE_NUMBER"),
        status.alias("CASE_STATUS"),
        _date_str(F.col("o_orderdate")).alias("RECEIVED_DATE"),
        _date_str(F.col("l_shipdate")).alias("DECISION_DATE"),
        visa.alias("VISA_CLASS"),
        _pick(pk10, [t for t, _, _ in FIXTURE_JOBS]).alias("JOB_TITLE"),
        F.concat(_pick(pk10, [c for _, c, _ in FIXTURE_JOBS]),
                 F.when(F.col("l_partkey") % 3 == 0, ".00").otherwise("")).alias("SOC_CODE"),
        _pick(pk10, [t for _, _, t in FIXTURE_JOBS]).alias("SOC_TITLE"),
        F.when(F.col("l_quantity") >= 3, "Y").otherwise("N").alias("FULL_TIME_POSITION"),
        employer.alias("EMPLOYER_NAME"),
        F.concat(F.lit("City "), F.col("s_suppkey").cast("string")).alias("WORKSITE_CITY"),
        _pick(F.col("s_nationkey"), FIXTURE_STATES).alias("WORKSITE_STATE"),
        (F.lit(10000) + F.col("s_suppkey")).cast("string").alias("WORKSITE_POSTAL_CODE"),
        wage.alias("WAGE_RATE_OF_PAY_FROM"),
        unit.alias("WAGE_UNIT_OF_PAY"),
        prevailing.alias("PREVAILING_WAGE"),
        unit.alias("PW_UNIT_OF_PAY"),
        F.col("l_quantity").cast("bigint").cast("string").alias("TOTAL_WORKER_POSITIONS"),
        _line_order().alias("row_seq"),
        F.concat(F.lit("lca_fy_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("source_file"),
    )
    # The raw files pass through the CSV reader's missing-value tokens.
    return raw.select(*[na_to_null(c).alias(c) if c not in ("row_seq", "source_file") else F.col(c)
                        for c in raw.columns])


def _line_order() -> Column:
    """Ship date, part and supplier as one number."""
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("decimal(17,0)")
    low = F.col("l_partkey").cast("decimal(20,0)") * F.lit(Decimal(10) ** 10) + F.col("l_suppkey")
    return (day * F.lit(Decimal(10) ** 20) + low).cast("decimal(38,0)")


def raw_perm(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                        "o_totalprice", "o_orderdate"])
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    j = o.join(c, c.c_custkey == o.o_custkey).join(n, n.n_nationkey == c.c_nationkey)
    own = F.concat(F.when(F.col("c_custkey") % 10 == 0, "University of ").otherwise(""), F.col("c_name"))
    agency = F.concat(F.col("n_name"), F.lit(" Mobility"))
    soc = (F.when(F.col("o_orderkey") % 10 == 0, PERM_SOC_CODES[0])
           .when(F.col("o_orderkey") % 10 == 1, PERM_SOC_CODES[1])
           .when(F.col("o_orderkey") % 10 == 2, PERM_SOC_CODES[2])
           .otherwise(PERM_SOC_DEFAULT))
    raw = j.select(
        F.concat(F.lit("A-100-"), F.col("o_orderkey").cast("string")).alias("CASE_NO"),
        F.floor("o_totalprice").cast("bigint").cast("string").alias("OFFERED_WAGE"),
        F.lit("Year").alias("OFFERED_WAGE_UNIT"),
        _date_str(F.col("o_orderdate")).alias("CASE_RECEIVED_DATE"),
        F.concat(F.when(F.col("c_mktsegment").isin(AGENCY_SEGMENTS), agency).otherwise(own),
                 F.when(F.col("o_orderkey") % 2 == 0, " LLC").otherwise("")).alias("EMPLOYER_NAME_9089"),
        F.when(F.col("o_orderstatus") == "F", "Denied").otherwise("Certified").alias("CASE_STATUS"),
        soc.alias("PW_SOC_CODE_9089"),
        F.col("o_orderkey").alias("row_seq"),
        F.lit("perm_fixture.csv").alias("source_file"),
    )
    return raw.select(*[na_to_null(c).alias(c) if c not in ("row_seq", "source_file") else F.col(c)
                        for c in raw.columns])


def raw_lca_by_ship_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The LCA rows as filings of whole orders, in files by ship year: the lines
    of an order that ship in different years are one case in several files."""
    raw = raw_lca(spark, sf_dir)
    return raw.withColumns({
        "CASE_NUMBER": F.regexp_replace("CASE_NUMBER", r"-\d+$", ""),
        "source_file": F.concat(F.lit("lca_ship_"), F.substring("DECISION_DATE", 1, 4), F.lit(".csv"))})


#: Columns that files of odd years lack, and how all files name the others there.
ODD_YEAR_LACKS = ["PREVAILING_WAGE", "PW_UNIT_OF_PAY"]


def raw_lca_as_files(raw: DataFrame, root: str) -> list[str]:
    """``raw`` as CSV files, one folder per source file, with what real files
    differ in: files of odd years have lower-case headers with spaces around
    them, other column order, fewer columns and month-first dates; line 2 of an
    order has a line break in its title, line 3 a non-ASCII employer, line 5 of
    some parts none, line 6 of some a short case number. A large source file comes in
    parts: all rows of a case are in the same one, in their order. Rows are dealt to parts packed, and
    parts are compressed, as files with line breaks in cells are scanned whole anyway. Returns the files."""
    spark = raw.sparkSession
    dealt = lambda some: unpacked(
        packed(some, ["source_file", "CASE_NUMBER"]).repartition(F.coalesce("CASE_NUMBER", F.col("row_seq").cast("string")))
        .sortWithinPartitions("source_file", "row_seq"), some, ["source_file", "CASE_NUMBER"])
    line = F.regexp_extract("CASE_NUMBER", r"-(\d+)$", 1)
    third = F.col("JOB_TITLE").startswith("TAX")
    us = lambda c: F.date_format(F.to_date(c), "MM/dd/yyyy")
    odd = F.substring("source_file", 8, 4).cast("int") % 2 == 1
    changed = lambda rows: rows.withColumns({
        "JOB_TITLE": F.when(line == "2", F.concat("JOB_TITLE", F.lit("\nGrade 2"))).otherwise(F.col("JOB_TITLE")),
        "EMPLOYER_NAME": F.when((line == "5") & third, None).when(line == "3", F.concat(F.lit("Société "), "EMPLOYER_NAME"))
                          .otherwise(F.col("EMPLOYER_NAME")),
        "CASE_NUMBER": F.when((line == "6") & third, F.lit("I-6")).otherwise(F.col("CASE_NUMBER"))})
    columns = [c for c in raw.columns if c not in ("source_file", "row_seq")]
    out = []
    for name, some, cols, rename in (
            ("even", changed(dealt(raw.where(~odd))), columns, str),
            ("odd", changed(dealt(raw.where(odd))).withColumns({c: us(F.col(c)) for c in ("RECEIVED_DATE", "DECISION_DATE")}),
             sorted(set(columns) - set(ODD_YEAR_LACKS)), lambda c: f" {c.lower()} ")):
        path = f"{root}/{name}"
        (some.select(*[F.col(c).alias(rename(c)) for c in cols], "source_file")
             .write.partitionBy("source_file").option("header", True).option("escape", '"').option("compression", "gzip")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        out += spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").option("recursiveFileLookup", True).load(path).inputFiles()
    return out


def download_log(spark: SparkSession, sf_dir: str, root: str) -> str:
    """``events`` as download logs in event order: an error is a failed attempt (and its cause in the
    next line), anything else a landed file; views name no route. One log for each range of events."""
    e = _read(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    file = F.concat(F.lit("LCA_"), F.col("user_id").cast("string"), F.lit(".xlsx"))
    lines = (F.when(F.col("event_type") == "error", F.concat(F.lit("FAIL "), file, F.lit("\n     attempt 1: HTTPError: 404")))
             .when(F.col("event_type") == "view", F.concat(F.lit("OK   "), file, F.lit(" "), F.col("value").cast("string"), F.lit("MB")))
             .otherwise(F.concat(F.lit("OK   "), file, F.lit(" "), F.col("value").cast("string"), F.lit("MB via "), F.col("event_type"), F.lit(" mirror"))))
    e.repartitionByRange("event_id").sortWithinPartitions("event_id").select(lines.alias("line")).write.text(root)
    return root
