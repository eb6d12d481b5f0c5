"""Column-expression helpers; all are built-in Spark functions (JVM side)."""

from .casts import (flag_one, flag_true, safe_double, safe_number,  # noqa: F401
                    safe_timestamp, to_text)
from .keys import surrogate_key  # noqa: F401
from .text import alnum_lower, canon_market, market_from_path, null_if_token  # noqa: F401
