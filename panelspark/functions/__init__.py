"""Scalar column functions (P-family). All are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from panelspark.functions.scalars import (  # noqa: F401
    NULL_TOKENS,
    NUMERIC_PATTERN,
    DATE_FORMATS,
    blank,
    clip,
    extract_zip,
    is_positive,
    label_by,
    month_index,
    month_start,
    months_back,
    norm_key,
    norm_zip,
    null_tokens,
    safe_ratio,
    strict_number,
    title_case,
    to_month,
    to_number,
    wkt_point,
)
