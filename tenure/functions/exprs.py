"""Column expressions used across the pipeline.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampType, DataType, NumericType

from tenure.config import EARTH_RADIUS_METERS, NULL_TOKENS

# Plain decimal / scientific notation, optional sign; no trailing type letters.
_NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clean_string(col: Column) -> Column:
    """Trim and turn the reference's null tokens into SQL NULL."""
    trimmed = F.trim(col.cast("string"))
    return F.when(trimmed.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(trimmed)


def to_double(col: Column, dtype: DataType) -> Column:
    """Numeric coercion with pandas ``to_numeric(errors='coerce')`` semantics.

    Numbers stay numbers (NaN becomes NULL).  Strings must look like a plain
    number; ``'1d'`` or ``'NaN'`` become NULL instead of 1.0 / NaN.
    """
    if isinstance(dtype, NumericType):
        value = col.cast("double")
    else:
        text = col.cast("string")
        value = F.when(text.rlike(_NUMERIC_PATTERN), F.trim(text).try_cast("double"))
    return F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value)


def to_date(col: Column, dtype: DataType, pattern: str) -> Column:
    """Strict date parse of strings (bad -> NULL); typed dates pass through."""
    if isinstance(dtype, (DateType, TimestampType)) or dtype.typeName() == "timestamp_ntz":
        return col.cast("date")
    return F.to_date(F.try_to_timestamp(col.cast("string"), F.lit(pattern)))


def to_timestamp(col: Column, dtype: DataType, pattern: str) -> Column:
    """Strict timestamp parse of strings (bad -> NULL); typed values pass through."""
    if isinstance(dtype, (DateType, TimestampType)) or dtype.typeName() == "timestamp_ntz":
        return col.cast("timestamp")
    return F.try_to_timestamp(col.cast("string"), F.lit(pattern))


def month_start(col: Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(col.cast("date"), "month")


def month_diff(later: Column, earlier: Column) -> Column:
    """Integer calendar-month difference (year*12 + month), never fractional."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def haversine_radians(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle angle between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlng = F.radians(lng2) - F.radians(lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlng / 2), 2)
    return 2 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_meters(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    return haversine_radians(lat1, lng1, lat2, lng2) * F.lit(EARTH_RADIUS_METERS)


def sanitize_feature_name(raw: Column, prefix: str) -> Column:
    """``strip/lower``, ``&`` -> `` and ``, drop apostrophes, non ``[a-z0-9]``
    runs -> ``_``, trim ``_``, empty -> ``unknown``, then ``<prefix>_``."""
    s = F.lower(F.trim(raw.cast("string")))
    s = F.regexp_replace(s, "&", " and ")
    s = F.regexp_replace(s, "['’]", "")
    s = F.regexp_replace(s, "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    s = F.when(s == "", F.lit("unknown")).otherwise(s)
    return F.concat(F.lit(prefix + "_"), s)


def title_case(s: Column) -> Column:
    """Python ``str.title``: a letter is upper-cased after a non-letter (or at
    the start) and lower-cased after a letter."""
    chars = F.split(s, "(?!^)")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when((i == 0) | ~F.element_at(chars, i).rlike("[A-Za-z]"), F.upper(c)).otherwise(F.lower(c)),
        ),
        "",
    )


def prettify_feature_name(name: Column) -> Column:
    """Display label: drop ``_first12m_<agg>`` and one known prefix, ``_`` -> space, title case."""
    s = F.regexp_replace(name, "_first12m_(sum|mean|max|last|first)$", "")
    s = F.regexp_replace(s, "^(business_category_|complaint_type_)", "")
    return title_case(F.regexp_replace(s, "_", " "))


def feature_group(name: Column) -> Column:
    return (
        F.when(name.startswith("business_category_"), F.lit("category"))
        .when(name.startswith("complaint_type_"), F.lit("complaint"))
        .otherwise(F.lit("other"))
    )


def clamp(col: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col, F.lit(lo)), F.lit(hi))
