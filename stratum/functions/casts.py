"""Lenient casts of bronze text.

Spark's ``try_cast`` accepts more text forms than the warehouse's TRY_TO_*
functions (``NaN``, ``Infinity``, ``1.0d``, a bare ``2024`` as a timestamp),
so every cast sits behind a regex guard.  The guards are our contract for
"parseable" text and are identical in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
NUMBER_PATTERN = r"^[ ]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ ]*$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
TRUE_ONE = "1"
TRUE_WORD = "true"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    """TRY_TO_DOUBLE: text -> double, NULL when not a plain decimal number."""
    c = _c(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def safe_number(c) -> Column:
    """TRY_TO_NUMBER: text -> decimal(38,0), rounding half away from zero
    (``2.5`` -> 3, ``-2.5`` -> -3); more than 38 digits become NULL."""
    c = _c(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("decimal(38,0)"))


def safe_timestamp(c, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """TRY_TO_TIMESTAMP without a format: ISO date/time text -> timestamp_ntz."""
    c = _c(c)
    return F.when(c.rlike(pattern), c.try_cast("timestamp_ntz"))


def flag_one(c) -> Column:
    """CASE WHEN c = '1' THEN TRUE ELSE FALSE END (NULL -> FALSE)."""
    return F.coalesce(_c(c) == F.lit(TRUE_ONE), F.lit(False))


def flag_true(c) -> Column:
    """CASE WHEN LOWER(c) = 'true' THEN TRUE ELSE FALSE END (NULL -> FALSE)."""
    return F.coalesce(F.lower(_c(c)) == F.lit(TRUE_WORD), F.lit(False))


def to_text(c) -> Column:
    """TO_VARCHAR: ``10.90`` -> ``10.9``, ``true`` -> ``true``."""
    return _c(c).cast("string")


# --- SQL twins for the oracle -------------------------------------------------

def safe_double_sql(e: str) -> str:
    return f"case when regexp_matches({e}, '{NUMBER_PATTERN}') then try_cast({e} as double) end"


def safe_number_sql(e: str, kind: str = "bigint") -> str:
    """As ``kind``: registered queries report whole numbers as bigint."""
    return (f"case when regexp_matches({e}, '{NUMBER_PATTERN}') "
            f"then try_cast(try_cast({e} as decimal(38,0)) as {kind}) end")


def safe_timestamp_sql(e: str) -> str:
    return f"case when regexp_matches({e}, '{TIMESTAMP_PATTERN}') then try_cast({e} as timestamp) end"


def flag_one_sql(e: str) -> str:
    return f"coalesce({e} = '1', false)"


def flag_true_sql(e: str) -> str:
    return f"coalesce(lower({e}) = 'true', false)"
