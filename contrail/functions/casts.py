"""Text to number casts that turn bad text into null, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECIMAL_TEXT = r"^\s*[+-]?\d*\.\d*\s*$"


def as_float(name: str) -> Column:
    return F.col(name).try_cast("float")


def as_int(name: str) -> Column:
    """Whole part of the text, cut at the point. Decimals are sent past the int cast: a cast that
    fails costs about a hundred times one that succeeds."""
    text = F.col(name)
    whole = F.trim(F.substring_index(text, ".", 1))
    whole = F.when(whole.rlike(r"^[+-]?$"), "0").otherwise(whole)
    truncated = F.when(text.rlike(_DECIMAL_TEXT), whole.try_cast("int"))
    return F.when(text.contains("."), truncated).otherwise(text.try_cast("int"))


def int_column(df: DataFrame, name: str) -> Column:
    """``name`` as int: parsed when it is text, cast when it already is a number."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return as_int(name)
    return F.col(name).try_cast("int")
