"""Text captured by a pattern to a typed value; anything malformed gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lognorm.functions.sql import literal

# Field types a mapping may declare, and the spellings read as true (fixed values).
FIELD_TYPES = ("str", "int", "float", "bool", "datetime")
TRUE_WORDS = ("true", "1", "yes")

# Java also reads "1d", "2f" and hex floats; this keeps to decimal spellings.
_FLOAT_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def coerce_sql(text: str, field_type: str) -> str:
    """SQL for ``text`` (a column or expression in SQL) as the declared type."""
    if field_type == "int":
        return f"try_cast({text} AS BIGINT)"
    if field_type == "float":
        return f"CASE WHEN rlike({text}, {literal(_FLOAT_TEXT)}) THEN try_cast({text} AS DOUBLE) END"
    if field_type == "bool":
        return f"lower({text}) IN ({', '.join(literal(w) for w in TRUE_WORDS)})"
    return text


def coerce(text: str, field_type: str) -> Column:
    return F.expr(coerce_sql(text, field_type))
