"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens the bronze loader turns into NULL, and the
# character class removed from matching platform names.
NULL_TOKENS = ("NULL", "null", "")
NON_ALNUM = "[^a-zA-Z0-9]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canon_market(c) -> Column:
    """UPPER(TRIM(market))."""
    return F.upper(F.trim(_c(c)))


def alnum_lower(c) -> Column:
    """LOWER(REGEXP_REPLACE(x, '[^a-zA-Z0-9]', '')) -- replaces all matches."""
    return F.lower(F.regexp_replace(_c(c), NON_ALNUM, ""))


def null_if_token(c, tokens=NULL_TOKENS) -> Column:
    """NULL_IF=(...): listed tokens become NULL."""
    c = _c(c)
    return F.when(~c.isin(*tokens) | c.isNull(), c)


def null_if_token_sql(e: str, tokens=NULL_TOKENS) -> str:
    """The same as SQL text, for many columns at once."""
    listed = ", ".join("'" + t + "'" for t in tokens)
    return f"case when {e} not in ({listed}) then {e} end"


def market_from_path(rel_path) -> Column:
    """SPLIT_PART(path, '/', 2): second path part; missing -> ''."""
    return F.split_part(_c(rel_path), F.lit("/"), F.lit(2))
