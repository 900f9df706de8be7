"""Lenient type coercion with pandas-compatible null and parse rules.

All helpers build Catalyst expressions (``try_cast``, regex guards) so they
stay inside whole-stage codegen; nothing is evaluated in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# pandas' default NA tokens for read_csv (keep_default_na=True),
# plus the empty string.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# A timestamp string must start with a full date; Spark would otherwise accept
# partial inputs such as "2026" or "2026-01" (or a bare time) as timestamps.
_DATE_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}"
# Decimal / scientific numbers and (signed) infinities, as pandas parses them;
# Spark's cast would also take "1d" and "3f", and NaN counts as missing.
_NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
# Whole numbers only: pandas' nullable Int64 rejects "1.0" and "1e3".
_INTEGER = r"^\s*[+-]?\d+\s*$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def na_to_null(col: str | Column, tokens=NA_TOKENS) -> Column:
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def coerce_timestamp(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """Unparseable -> null; naive values are taken as UTC (session zone)."""
    c = _c(col)
    if dtype is not None and isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    s = c.cast("string")
    return F.when(s.rlike(_DATE_PREFIX), _try_cast(F.trim(s), "timestamp"))


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def strict_double(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """pandas.to_numeric(errors='coerce') semantics; NaN counts as missing."""
    c = _c(col)
    if dtype is not None and isinstance(dtype, T.NumericType):
        d = c.cast("double")
    else:
        s = c.cast("string")
        d = F.when(s.rlike(_NUMBER), _try_cast(F.trim(s), "double"))
    return F.nanvl(d, F.lit(None).cast("double"))


def strict_long(col: str | Column, dtype: T.DataType | None = None) -> Column:
    c = _c(col)
    if dtype is not None and isinstance(dtype, T.IntegralType):
        return c.cast("long")
    s = c.cast("string")
    return F.when(s.rlike(_INTEGER), _try_cast(F.trim(s), "long"))


def try_cast_typed(col: str | Column, target: str, dtype: T.DataType | None = None) -> Column:
    """Cast to a declared type name: string, long, double, timestamp, date, boolean."""
    t = target.lower()
    c = _c(col)
    if t in ("string", "str", "object"):
        return c.cast("string")
    if t in ("long", "bigint", "int64", "int", "integer"):
        return strict_long(c, dtype)
    if t in ("double", "float", "float64"):
        return strict_double(c, dtype)
    if t in ("timestamp", "datetime", "datetime64[ns]"):
        return coerce_timestamp(c, dtype)
    if t == "date":
        return coerce_timestamp(c, dtype).cast("date")
    if t in ("boolean", "bool"):
        return _try_cast(c.cast("string"), "boolean")
    return _try_cast(c, t)


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """(later - earlier) in hours as double, exact to the microsecond."""
    a = F.unix_micros(_c(later).cast("timestamp"))
    b = F.unix_micros(_c(earlier).cast("timestamp"))
    return (a - b).cast("double") / F.lit(3600000000.0)
