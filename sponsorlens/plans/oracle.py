"""DuckDB SQL for the correctness check.

The same raw fixture, cleaning, dedup, first-file dimensions and views are
written here independently in DuckDB SQL as one CTE prefix; each query's
oracle is that prefix plus its own SELECT. DuckDB's regex engine (RE2) has
ASCII classes; where the fixture has other letters, patterns name them.
"""
from __future__ import annotations

from .. import schemas as S
from ..sources import fixtures as FX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_mod(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def na(x: str) -> str:
    return f"CASE WHEN {x} IN ({', '.join(_q(t) for t in S.NA_TOKENS)}) THEN NULL ELSE {x} END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean(x: str) -> str:
    s = f"upper({x})"
    letters = S.PUNCT_PATTERN.replace(r"\w", r"\p{L}\p{N}_")      # RE2's own class is ASCII
    s = f"regexp_replace({s}, {_q(letters)}, ' ', 'g')"
    s = f"regexp_replace({s}, {_q(S.SUFFIX_PATTERN)}, ' ', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return strip(s)


def category(title: str, soc_title: str) -> str:
    text = f"upper(concat_ws(' ', {title}, {soc_title}))"
    whens = " ".join(f"WHEN regexp_matches({text}, {_q(p)}) THEN {_q(label)}"
                     for p, label in S.JOB_CATEGORY_RULES)
    return f"CASE {whens} ELSE {_q(S.JOB_CATEGORY_DEFAULT)} END"


_PY_FLOAT = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
_PLAIN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def annualize(w: str, u: str) -> str:
    num = strip(f"replace(replace({w}, '$', ''), ',', '')")
    val = f"CASE WHEN regexp_matches({num}, {_q(_PY_FLOAT)}) THEN TRY_CAST(replace({num}, '_', '') AS DOUBLE) END"
    unit = f"lower({strip(u)})"
    factor = "COALESCE(CASE " + " ".join(f"WHEN {unit} = {_q(k)} THEN {v}" for k, v in S.WAGE_UNIT_FACTORS.items()) + " END, 1)"
    prod = f"(({val}) * {factor})"
    return f"CASE WHEN {prod} BETWEEN {S.WAGE_MIN} AND {S.WAGE_MAX} THEN {prod} END"


def parse_date(x: str) -> str:
    t = strip(x)
    return (f"COALESCE(TRY_STRPTIME({t}, '%Y-%m-%d')::DATE, TRY_STRPTIME({t}, '%m/%d/%Y')::DATE, "
            f"TRY_CAST({t} AS DATE))")


def int_or_one(x: str) -> str:
    t = strip(x)
    return (f"COALESCE(TRY_CAST(trunc(CASE WHEN regexp_matches({t}, {_q(_PLAIN)}) "
            f"THEN TRY_CAST({t} AS DOUBLE) END) AS INTEGER), 1)")


def fiscal_year(d: str) -> str:
    return f"CAST(year({d}) + CASE WHEN month({d}) >= 10 THEN 1 ELSE 0 END AS INTEGER)"


def soc(x: str) -> str:
    return f"regexp_replace({strip(x)}, '\\.\\d+$', '')"


def round_half_up(x: str, d: int) -> str:
    scale = 10 ** d
    return f"(floor(({x}) * {scale} + 0.5) / {scale}.0)"


RAW_LCA = f"""
raw_lca0 AS (
  SELECT
    concat('I-200-', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS CASE_NUMBER,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Denied'
         WHEN l.l_returnflag = 'R' THEN 'Withdrawn'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'Certified - Withdrawn'
         ELSE 'Certified' END AS CASE_STATUS,
    CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS RECEIVED_DATE,
    CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS DECISION_DATE,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'E-3 Australian' WHEN '5-LOW' THEN 'H-1B1 Singapore' ELSE 'H-1B' END AS VISA_CLASS,
    {_case_mod('l.l_partkey % 10', [t for t, _, _ in FX.FIXTURE_JOBS])} AS JOB_TITLE,
    concat({_case_mod('l.l_partkey % 10', [c for _, c, _ in FX.FIXTURE_JOBS])},
           CASE WHEN l.l_partkey % 3 = 0 THEN '.00' ELSE '' END) AS SOC_CODE,
    {_case_mod('l.l_partkey % 10', [t for _, _, t in FX.FIXTURE_JOBS])} AS SOC_TITLE,
    CASE WHEN l.l_quantity >= 3 THEN 'Y' ELSE 'N' END AS FULL_TIME_POSITION,
    concat(CASE WHEN c.c_custkey % 10 = 0 THEN 'University of ' ELSE '' END, c.c_name,
           {_case_mod('l.l_linenumber % 4', FX.FIXTURE_NAME_SUFFIXES)}) AS EMPLOYER_NAME,
    concat('City ', CAST(s.s_suppkey AS VARCHAR)) AS WORKSITE_CITY,
    {_case_mod('s.s_nationkey', FX.FIXTURE_STATES)} AS WORKSITE_STATE,
    CAST(10000 + s.s_suppkey AS VARCHAR) AS WORKSITE_POSTAL_CODE,
    CASE WHEN l.l_partkey % 97 = 0 THEN 'N/A'
         WHEN l.l_linenumber = 7 THEN CAST(CAST(floor(l.l_extendedprice / 1000) AS BIGINT) AS VARCHAR)
         ELSE concat('$', CAST(CAST(floor(l.l_extendedprice * 3) AS BIGINT) AS VARCHAR), '.00') END AS WAGE_RATE_OF_PAY_FROM,
    CASE WHEN l.l_linenumber = 7 THEN 'Hour' ELSE 'Year' END AS WAGE_UNIT_OF_PAY,
    CASE WHEN l.l_linenumber = 7 THEN CAST(CAST(floor(l.l_extendedprice / 1100) AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(floor(l.l_extendedprice * 2.7) AS BIGINT) AS VARCHAR) END AS PREVAILING_WAGE,
    CASE WHEN l.l_linenumber = 7 THEN 'Hour' ELSE 'Year' END AS PW_UNIT_OF_PAY,
    CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR) AS TOTAL_WORKER_POSITIONS,
    concat(CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR), '-', lpad(CAST(l.l_partkey AS VARCHAR), 10, '0'), '-',
           lpad(CAST(l.l_suppkey AS VARCHAR), 10, '0')) AS ROW_SEQ,
    concat('lca_fy_', CAST(year(o.o_orderdate) AS VARCHAR), '.csv') AS SOURCE_FILE
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
),
raw_lca AS (
  SELECT {', '.join(f'{na(c)} AS {c}' for c in S.LCA_NEEDED_COLS if c != 'EMPLOYER_STATE')},
         ROW_SEQ, SOURCE_FILE
  FROM raw_lca0
),
lca_typed AS (
  SELECT CASE_NUMBER AS case_number, CASE_STATUS AS case_status, VISA_CLASS AS visa_class,
         {parse_date('RECEIVED_DATE')} AS received_date,
         {parse_date('DECISION_DATE')} AS decision_date,
         upper({strip('JOB_TITLE')}) AS job_title,
         {soc('SOC_CODE')} AS soc_code,
         {strip('SOC_TITLE')} AS soc_title,
         {strip('EMPLOYER_NAME')} AS employer_name,
         upper({strip('WORKSITE_CITY')}) AS worksite_city,
         upper({strip('WORKSITE_STATE')}) AS worksite_state,
         {strip('WORKSITE_POSTAL_CODE')} AS worksite_postal_code,
         COALESCE(upper(FULL_TIME_POSITION) = 'Y', false) AS full_time,
         {int_or_one('TOTAL_WORKER_POSITIONS')} AS total_worker_positions,
         {annualize('WAGE_RATE_OF_PAY_FROM', 'WAGE_UNIT_OF_PAY')} AS annual_wage,
         {annualize('PREVAILING_WAGE', 'PW_UNIT_OF_PAY')} AS prevailing_wage,
         WAGE_UNIT_OF_PAY AS wage_unit_raw,
         SOURCE_FILE AS source_file, ROW_SEQ AS row_seq
  FROM raw_lca
),
lca_typed2 AS (
  SELECT *, {clean('employer_name')} AS employer_name_clean,
         {category('job_title', 'soc_title')} AS job_category,
         {fiscal_year('received_date')} AS fiscal_year
  FROM lca_typed
  WHERE case_number IS NOT NULL AND employer_name IS NOT NULL AND length(case_number) > 5
),
lca_staged AS (
  SELECT * EXCLUDE (row_seq),
         COALESCE(regexp_matches(employer_name_clean, {_q(S.UNIVERSITY_PATTERN)}), false) AS is_university
  FROM lca_typed2
  QUALIFY row_number() OVER (PARTITION BY source_file, case_number ORDER BY row_seq DESC) = 1
),
lca_fact AS (
  SELECT * FROM lca_staged
  QUALIFY row_number() OVER (PARTITION BY case_number ORDER BY source_file DESC) = 1
),
raw_perm AS (
  SELECT {na("concat('A-100-', CAST(o_orderkey AS VARCHAR))")} AS CASE_NO,
         {na('CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)')} AS OFFERED_WAGE,
         'Year' AS OFFERED_WAGE_UNIT,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS CASE_RECEIVED_DATE,
         concat(CASE WHEN c.c_mktsegment IN ({', '.join(_q(x) for x in FX.AGENCY_SEGMENTS)}) THEN concat(n.n_name, ' Mobility')
                     ELSE concat(CASE WHEN c.c_custkey % 10 = 0 THEN 'University of ' ELSE '' END, c.c_name) END,
                CASE o.o_orderkey % 2 WHEN 0 THEN ' LLC' ELSE '' END) AS EMPLOYER_NAME_9089,
         CASE o_orderstatus WHEN 'F' THEN 'Denied' ELSE 'Certified' END AS CASE_STATUS,
         CASE o_orderkey % 10 WHEN 0 THEN '{FX.PERM_SOC_CODES[0]}' WHEN 1 THEN '{FX.PERM_SOC_CODES[1]}'
              WHEN 2 THEN '{FX.PERM_SOC_CODES[2]}' ELSE '{FX.PERM_SOC_DEFAULT}' END AS PW_SOC_CODE_9089,
         o_orderkey AS row_seq, 'perm_fixture.csv' AS source_file
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
),
perm_typed AS (
  SELECT CASE_NO AS case_number, CASE_STATUS AS case_status,
         {parse_date('CASE_RECEIVED_DATE')} AS received_date,
         CAST(NULL AS DATE) AS decision_date,
         CAST(NULL AS VARCHAR) AS job_title,
         {soc('PW_SOC_CODE_9089')} AS soc_code,
         CAST(NULL AS VARCHAR) AS soc_title,
         {strip('EMPLOYER_NAME_9089')} AS employer_name,
         CAST(NULL AS VARCHAR) AS worksite_city,
         CAST(NULL AS VARCHAR) AS worksite_state,
         CAST(NULL AS VARCHAR) AS worksite_postal_code,
         {annualize('OFFERED_WAGE', 'OFFERED_WAGE_UNIT')} AS annual_wage,
         source_file, row_seq
  FROM raw_perm
),
perm_staged AS (
  SELECT * EXCLUDE (row_seq),
         {clean('employer_name')} AS employer_name_clean,
         {category('job_title', 'soc_title')} AS job_category,
         {fiscal_year('received_date')} AS fiscal_year,
         COALESCE(regexp_matches({clean('employer_name')}, {_q(S.UNIVERSITY_PATTERN)}), false) AS is_university
  FROM perm_typed
  WHERE case_number IS NOT NULL AND employer_name IS NOT NULL AND length(case_number) > 5
  QUALIFY row_number() OVER (PARTITION BY source_file, case_number ORDER BY row_seq DESC) = 1
),
perm_fact AS (
  SELECT * FROM perm_staged
  QUALIFY row_number() OVER (PARTITION BY case_number ORDER BY source_file DESC) = 1
),
dim_src AS (
  SELECT 0 AS rk, source_file, employer_name_clean, employer_name, is_university, received_date,
         soc_code, soc_title, job_category FROM lca_staged
  UNION ALL
  SELECT 1 AS rk, source_file, employer_name_clean, employer_name, is_university, received_date,
         soc_code, soc_title, job_category FROM perm_staged
),
employers AS (
  SELECT employer_name_clean, min(employer_name) AS employer_name, bool_or(is_university) AS is_university,
         min(received_date) AS first_seen_date
  FROM (SELECT * FROM dim_src
        QUALIFY dense_rank() OVER (PARTITION BY employer_name_clean ORDER BY rk, source_file) = 1)
  GROUP BY employer_name_clean
),
occupations AS (
  SELECT soc_code, min(soc_title) AS soc_title, min(job_category) AS job_category
  FROM (SELECT * FROM dim_src WHERE soc_code IS NOT NULL
        QUALIFY dense_rank() OVER (PARTITION BY soc_code ORDER BY rk, source_file) = 1)
  GROUP BY soc_code
),
v1 AS (
  SELECT f.case_number, f.case_status, f.visa_class, f.fiscal_year, f.job_title, f.annual_wage,
         f.prevailing_wage, f.full_time, e.employer_name, e.is_university,
         o.soc_code, o.soc_title, o.job_category, f.worksite_city, f.worksite_state
  FROM lca_fact f
  JOIN employers e ON e.employer_name_clean = f.employer_name_clean
  LEFT JOIN occupations o ON o.soc_code = f.soc_code
),
v3 AS (
  SELECT f.case_number, f.case_status, f.fiscal_year, f.job_title, f.annual_wage,
         e.employer_name, e.is_university, o.soc_code, o.soc_title, o.job_category,
         f.worksite_city, f.worksite_state
  FROM perm_fact f
  JOIN employers e ON e.employer_name_clean = f.employer_name_clean
  LEFT JOIN occupations o ON o.soc_code = f.soc_code
),
v2 AS (
  SELECT e.employer_name, f.fiscal_year, COUNT(*) AS filings,
         COUNT(*) FILTER (WHERE f.case_status ILIKE 'Certified%') AS certified,
         ROUND(AVG(f.annual_wage), 0) AS avg_wage, ROUND(MEDIAN(f.annual_wage), 0) AS median_wage
  FROM lca_fact f JOIN employers e ON e.employer_name_clean = f.employer_name_clean
  GROUP BY 1, 2
),
sponsorships AS (SELECT {', '.join(S.EXTRACT_COLUMNS)} FROM v1),
green_cards AS (SELECT * FROM v3)
"""


def _replaced(text: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        if text.count(old) != 1:
            raise ValueError(f"not once in the chain: {old}")
        text = text.replace(old, new)
    return text


_CASE = "concat('I-200-', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS CASE_NUMBER"
_FILE = "concat('lca_fy_', CAST(year(o.o_orderdate) AS VARCHAR), '.csv') AS SOURCE_FILE"
#: Whole orders as cases, in files by ship year.
BY_SHIP_YEAR = _replaced(
    RAW_LCA, (_CASE, "concat('I-200-', CAST(l.l_orderkey AS VARCHAR)) AS CASE_NUMBER"),
    (_FILE, "concat('lca_ship_', CAST(year(l.l_shipdate) AS VARCHAR), '.csv') AS SOURCE_FILE"))
#: What the CSV files differ in (fixtures.raw_lca_as_files).
AS_FILES = _replaced(
    RAW_LCA, ("FROM raw_lca0\n", """FROM (SELECT * REPLACE (
    CASE WHEN CASE_NUMBER LIKE '%-2' THEN concat(JOB_TITLE, chr(10), 'Grade 2') ELSE JOB_TITLE END AS JOB_TITLE,
    CASE WHEN CASE_NUMBER LIKE '%-5' AND JOB_TITLE LIKE 'TAX%' THEN NULL
         WHEN CASE_NUMBER LIKE '%-3' THEN concat('Société ', EMPLOYER_NAME) ELSE EMPLOYER_NAME END AS EMPLOYER_NAME,
    CASE WHEN CASE_NUMBER LIKE '%-6' AND JOB_TITLE LIKE 'TAX%' THEN 'I-6' ELSE CASE_NUMBER END AS CASE_NUMBER,
    CASE WHEN CAST(substr(SOURCE_FILE, 8, 4) AS INTEGER) % 2 = 1 THEN NULL ELSE PREVAILING_WAGE END AS PREVAILING_WAGE,
    CASE WHEN CAST(substr(SOURCE_FILE, 8, 4) AS INTEGER) % 2 = 1 THEN NULL ELSE PW_UNIT_OF_PAY END AS PW_UNIT_OF_PAY)
  FROM raw_lca0)
"""))


def with_views(select_sql: str, chain: str = RAW_LCA) -> str:
    """Prefix a SELECT over the views (``v1``, ``v3``, ``lca_fact``,
    ``lca_staged``, ``employers``, ...) with the full CTE chain."""
    return "WITH " + chain.strip() + "\n" + select_sql.strip()
