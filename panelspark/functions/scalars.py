"""Lenient parsing, null-safe arithmetic and key normalisation as Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a header-CSV reader treats as missing, a strict
# decimal-number pattern, and the date formats tried in order.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column) -> Column:
    """Map the reader's missing-value spellings to NULL."""
    c = _col(c)
    return F.when(c.isin(*NULL_TOKENS), F.lit(None)).otherwise(c)


def blank(c: str | Column) -> Column:
    """Null or whitespace-only text."""
    c = _col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def to_number(c: str | Column, strip_commas: bool = False) -> Column:
    """Lenient numeric cast (P03): NULL unless the text is a plain decimal
    number. Guards `'12d'` and `'nan'`, which `try_cast` would accept."""
    c = _col(c).cast("string")
    if strip_commas:
        c = F.regexp_replace(c, ",", "")
    return F.when(c.rlike(NUMERIC_PATTERN), F.trim(c).try_cast("double"))


def strict_number(c: str | Column) -> Column:
    """ANSI cast that raises on bad input."""
    return _col(c).cast("string").cast("double")


def to_month(c: str | Column, formats: Sequence[str] = DATE_FORMATS, is_text: bool = True) -> Column:
    """Lenient date parse to the first day of its month (P05). Text columns
    try each format in order; date/timestamp columns are truncated."""
    c = _col(c)
    if not is_text:
        return F.trunc(c.cast("date"), "MM")
    text = F.trim(c.cast("string"))
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])
    return F.trunc(parsed.cast("date"), "MM")


def month_start(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def is_positive(c: str | Column) -> Column:
    """`x > 0`, NULL counted as false."""
    return F.coalesce(_col(c) > 0, F.lit(False))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b with a zero or NULL denominator giving NULL."""
    return F.try_divide(_col(a).cast("double"), F.nullif(_col(b).cast("double"), F.lit(0.0)))


def clip(c: str | Column, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (P10). `greatest`/`least` skip
    NULL arguments, so the guard is explicit."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def label_by(c: str | Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """`labels[i]` for the first cut the value is below; last label otherwise."""
    c = _col(c)
    expr = None
    for cut, label in zip(cuts, labels):
        expr = (F.when(c < cut, label) if expr is None else expr.when(c < cut, label))
    return expr.otherwise(labels[len(cuts)])


def months_back(c: str | Column, n: int) -> Column:
    """Month start `n` months earlier."""
    return F.add_months(_col(c), -n)


def month_index(c: str | Column, origin: str | Column) -> Column:
    """Whole months from `origin` to `c` (both month starts)."""
    c, origin = _col(c), _col(origin)
    return ((F.year(c) - F.year(origin)) * 12 + F.month(c) - F.month(origin)).cast("bigint")


def title_case(c: str | Column) -> Column:
    return F.initcap(F.lower(_col(c)))


def norm_key(c: str | Column) -> Column:
    """Trim + title case."""
    return F.initcap(F.lower(F.trim(_col(c).cast("string"))))


def norm_zip(c: str | Column) -> Column:
    """Zero-pad a ZIP to five characters; longer codes stay whole."""
    z = _col(c).cast("string")
    return F.when(F.length(z) < 5, F.lpad(z, 5, "0")).otherwise(z)


def extract_zip(c: str | Column) -> Column:
    """First run of five digits, NULL when absent; absorbs `98101.0`."""
    return F.nullif(F.regexp_extract(_col(c).cast("string"), r"(\d{5})", 1), F.lit(""))


def wkt_point(c: str | Column) -> tuple[Column, Column]:
    """(longitude, latitude) from `POINT (lon lat)` text, NULL on a miss."""
    pattern = r"POINT \((-?\d+\.?\d*) (-?\d+\.?\d*)\)"
    c = _col(c)
    lon = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("double")
    lat = F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).try_cast("double")
    return lon, lat
