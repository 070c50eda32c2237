"""Scalar column functions (Column -> Column). All are native Spark
expressions, so they stay inside whole-stage codegen; no Python UDFs.

Java regex is ASCII by default; ``(?U)`` makes ``\\w``, ``\\s`` and ``\\b``
Unicode-aware so that names such as ``SOCIÉTÉ`` survive normalisation.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

U = "(?U)"

# Python float() grammar (digits with optional single underscores between
# them, optional fraction and exponent). Anything else is not a number.
_PY_FLOAT = (
    r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
)
# pandas.to_numeric accepts plain decimal numbers.
_PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.strip() removes (str.isspace()), derived by
# rule rather than listed.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _visible(char) -> Column:
    """True when text begins with a printable ASCII character that is no space."""
    return (char >= "!") & (char < "\x7f")


def strip(c) -> Column:
    """Trim leading/trailing whitespace of any kind (tabs, newlines, NBSP),
    as Python's ``str.strip()``; a character-set trim, no regex. The set has
    29 characters, each compared byte by byte, so it is only used on text whose
    first or last character is not a visible ASCII one."""
    c = _c(c)
    return F.when(_visible(c) & _visible(F.substring(c, -1, 1)), c).otherwise(F.btrim(c, F.lit(PY_WHITESPACE)))


def upper_strip(c) -> Column:
    return F.upper(strip(c))


LONGEST_NA = max(len(t) for t in S.NA_TOKENS)


def na_to_null(c) -> Column:
    """Missing-value tokens of the original CSV reader become NULL."""
    c = _c(c)
    return F.when((F.octet_length(c) > LONGEST_NA) | ~c.isin(*S.NA_TOKENS), c)


def has_non_ascii(c) -> Column:
    """True when some character needs more than one UTF-8 byte."""
    c = _c(c)
    return F.length(c) != F.octet_length(c)


def by_alphabet(c, make) -> Column:
    """``make(U)`` for text that has a non-ASCII character, else ``make("")``: the
    Unicode-aware classes are several times slower in Java, and for pure-ASCII text
    both agree."""
    return F.when(has_non_ascii(c), make(U)).otherwise(make(""))


def punct_to_space(c) -> Column:
    """Every character that is neither a word character nor whitespace
    becomes a space."""
    c = _c(c)
    return by_alphabet(c, lambda u: F.regexp_replace(c, u + S.PUNCT_PATTERN, " "))


def clean_employer(c) -> Column:
    """Upper case, punctuation to spaces, legal suffixes removed, spaces
    collapsed, trimmed. NULL stays NULL."""
    upper = F.upper(_c(c))

    def cleaned(u: str) -> Column:
        s = upper
        for pattern in (S.PUNCT_PATTERN, S.SUFFIX_PATTERN, r"\s+"):
            s = F.regexp_replace(s, u + pattern, " ")
        return s

    return F.trim(by_alphabet(upper, cleaned))      # whitespace of any kind is a space by now


def is_university(clean_name) -> Column:
    c = _c(clean_name)
    return F.coalesce(by_alphabet(c, lambda u: c.rlike(u + S.UNIVERSITY_PATTERN)), F.lit(False))


def category_text(title, soc_title) -> Column:
    """What the rules of ``category_of`` look at."""
    return F.upper(F.concat_ws(" ", _c(title), _c(soc_title)))


def category_of(text) -> Column:
    """First matching rule; ``text`` is best a column, as every rule reads it."""
    text = _c(text)

    def rules(u: str) -> Column:
        expr = F
        for pattern, label in S.JOB_CATEGORY_RULES:
            expr = expr.when(text.rlike(u + pattern), label)
        return expr.otherwise(S.JOB_CATEGORY_DEFAULT)

    return by_alphabet(text, rules)


def job_category(title, soc_title) -> Column:
    """First matching rule over upper(title + ' ' + soc_title)."""
    return category_of(category_text(title, soc_title))


def parse_float(c) -> Column:
    """Python float() on a string: NULL when the text is not a finite number."""
    t = strip(c)
    return F.when(t.rlike(_PY_FLOAT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def unit_factor(unit) -> Column:
    """Annualisation factor of a pay unit; unknown or missing units count 1.
    One lookup in a literal map (the unit text is evaluated once)."""
    table = F.create_map(*[x for k, v in S.WAGE_UNIT_FACTORS.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(table, F.lower(strip(_c(unit)))), F.lit(1.0))


def wage_number(wage) -> Column:
    """The wage text without ``$`` and ``,``, parsed as Python float()."""
    return parse_float(F.translate(_c(wage), "$,", ""))


def bounded(value) -> Column:
    """Keep values inside the inclusive sanity bounds, else NULL."""
    v = _c(value)
    return F.when(v.between(S.WAGE_MIN, S.WAGE_MAX), v)


def annualize(wage, unit) -> Column:
    """Strip ``$`` and ``,``, scale by the unit factor, keep values inside
    the inclusive sanity bounds, else NULL. (The staging transform computes
    the same in two projections, so the product is evaluated once.)"""
    return bounded(wage_number(wage) * unit_factor(unit))


def soc_code(c) -> Column:
    """Trim and drop a trailing ``.NN`` detail suffix."""
    s = strip(c)
    return F.when(F.contains(s, F.lit(".")), F.regexp_replace(s, U + r"\.\d+$", "")).otherwise(s)


def parse_date(c) -> Column:
    """ISO or US dates (or an ISO timestamp); failures become NULL. No text has
    two meanings here, so the cast, by far the fastest, comes first."""
    t = strip(c)
    return F.coalesce(t.try_cast("date"),
                      F.try_to_date(t, "yyyy-MM-dd"),
                      F.try_to_date(t, "M/d/yyyy"))


def fiscal_year(d) -> Column:
    """US federal fiscal year: October starts the next year."""
    d = _c(d)
    return (F.year(d) + (F.month(d) >= 10).cast("int")).cast("int")


def int_or_one(c) -> Column:
    """Numeric text truncated to an integer; anything else counts 1."""
    t = strip(c)
    n = F.when(t.rlike(_PLAIN_NUMBER), t.try_cast("double"))
    return F.coalesce(n.try_cast("int"), F.lit(1)).cast("int")


def yes_flag(c) -> Column:
    return F.coalesce(_c(c).isin("Y", "y"), F.lit(False))


def month_start(d) -> Column:
    """``date_trunc('month', d)`` as a timestamp without time zone (the
    wall-clock first of the month, whatever the session time zone)."""
    return F.date_trunc("month", _c(d).cast("timestamp")).cast("timestamp_ntz")


def round_half_up(c, digits: int) -> Column:
    """Round half away from zero for positive inputs, identical in Spark and
    DuckDB: ``floor(x * 10^d + 0.5) / 10^d``."""
    scale = float(10 ** digits)
    return F.floor(_c(c) * scale + F.lit(0.5)) / F.lit(scale)


def pct(part, whole, digits: int) -> Column:
    """``ROUND(100.0 * part / NULLIF(whole, 0), d)`` as a DOUBLE."""
    ratio = F.lit(100.0) * _c(part).cast("double") / F.nullif(_c(whole).cast("double"), F.lit(0.0))
    return round_half_up(ratio, digits) if digits > 0 else F.round(ratio, 0)


def like_literal(text: str) -> str:
    """Escape backslashes of user text placed inside a LIKE pattern; ``%``
    and ``_`` keep acting as wildcards, as in the original."""
    return text.replace("\\", "\\\\")


def contains_ci(c, text: str) -> Column:
    """``c ILIKE '%' || text || '%'``."""
    return _c(c).ilike("%" + like_literal(text) + "%")


def contains_cs(c, text: str) -> Column:
    """``c LIKE '%' || text || '%'``."""
    return _c(c).like("%" + like_literal(text) + "%")


def certified(status="case_status") -> Column:
    """``case_status ILIKE 'Certified%'`` (also counts Certified - Withdrawn)."""
    return F.coalesce(_c(status).ilike("Certified%"), F.lit(False))


def city_state(city="worksite_city", state="worksite_state") -> Column:
    """``city || ', ' || state`` (NULL if a part is NULL)."""
    return F.concat(_c(city), F.lit(", "), _c(state))
