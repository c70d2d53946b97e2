"""Strip, names, dates, masking, truncation and small numeric helpers."""

from __future__ import annotations

import mimetypes
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from ..schema import MAX_PAGE_SIZE

# All characters Python's str.strip() removes; SQL trim only knows U+0020 unless told.
_SPACE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ASCII_ONLY = r"\A[\x00-\x7F]*\z"
# How the service's date formats read a month and a day.
_MONTH, _DAY = r"(1[0-2]|0[1-9]|[1-9])", r"(3[0-1]|[1-2]\d|0[1-9]|[1-9])"
_COMPRESSED = r"(?i)\.(gz|z|bz2|xz|br)\z"


def strip(col: Column) -> Column:
    """Trim Unicode white space on both ends; NULL stays NULL, blanks become ''."""
    return F.btrim(col, F.lit(_SPACE))


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def truncate(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))


def _date_format_of(value: Column) -> Column:
    return (
        F.when(value.rlike(r"\A[0-9]{8}\z"), F.lit("yyyyMMdd"))
        .when(value.rlike(r"(?s)\A.{4}-.{2}-.{2}\z"), F.lit("yyyy-MM-dd"))
    )


def reception_date(col: Column) -> Column:
    """Filing date as an ISO instant.

    Blank gives NULL, ``YYYYMMDD`` and ``YYYY-MM-DD`` give midnight UTC, other
    text passes unchanged.  A date of the right shape that does not exist also
    gives NULL here; ``reception_date_error`` tells it apart.
    """
    value = strip(col)
    shape = _date_format_of(value)
    parsed = F.coalesce(
        F.when(shape == "yyyyMMdd", F.try_to_date(value, "yyyyMMdd")),
        F.when(shape == "yyyy-MM-dd", F.try_to_date(value, "yyyy-MM-dd")),
    )
    parsed = F.when(~value.startswith("0000"), parsed)  # Spark has a year 0, the service has not
    iso = F.date_format(parsed, "yyyy-MM-dd'T00:00:00Z'")
    return F.when(shape.isNotNull(), iso).otherwise(empty_to_null(value))


def reception_date_error(col: Column) -> Column:
    """The service's message for a date of the right shape that is no date, else NULL."""
    value = strip(col)
    shape = _date_format_of(value)
    bad = shape.isNotNull() & reception_date(col).isNull()
    plain = F.replace(value, F.lit("-"), F.lit(""))
    dashed = shape == "yyyy-MM-dd"
    rest = F.when(dashed, F.regexp_extract(value, rf"\A\d{{4}}-{_MONTH}-{_DAY}(.*)\z", 3)).otherwise(
        F.regexp_extract(value, rf"\A\d{{4}}{_MONTH}{_DAY}(.*)\z", 3)
    )
    read = F.when(dashed, value.rlike(rf"\A\d{{4}}-{_MONTH}-{_DAY}")).otherwise(value.rlike(rf"\A\d{{4}}{_MONTH}{_DAY}"))
    wanted = F.when(dashed, "%Y-%m-%d").otherwise("%Y%m%d")
    text = (
        F.when(~read, F.format_string("time data '%s' does not match format '%s'", value, wanted))
        .when(rest != "", F.concat(F.lit("unconverted data remains: "), rest))
        .when(plain.startswith("0000"), "year 0 is out of range")
        .otherwise("day is out of range for month")
    )
    return F.when(bad, text)


def mask_url(col: Column) -> Column:
    """Hide the password of ``scheme://user:password@host``; NULL becomes ''."""
    masked = F.regexp_replace(col, r"(?s)\A(.*?://)([^:]*):.*@([^@]*)\z", r"$1$2:***@$3")
    return F.coalesce(masked, F.lit(""))


def key_prefix(col: Column) -> Column:
    """First eight characters of a secret and an ellipsis; NULL when there is none."""
    return F.concat(F.left(empty_to_null(col), F.lit(8)), F.lit("..."))


def backoff_seconds(attempt: Column) -> Column:
    """Wait after the given zero-based attempt."""
    return F.pow(F.lit(2.0), attempt) * F.lit(0.5)


def page_count(total: Column, page_size: Column) -> Column:
    """Pages needed for ``total`` rows; the service caps the page size."""
    return F.ceil(total / F.least(page_size, F.lit(MAX_PAGE_SIZE))).cast("int")


# --- file names ------------------------------------------------------------

def plain_name(name: str) -> str:
    """Last path part of one name, trimmed and composed; ``base_name`` does the same for columns."""
    return unicodedata.normalize("NFC", name.rsplit("/", 1)[-1].strip())


def _normal_form(form: str):
    @F.pandas_udf(StringType())
    def normal(names: pd.Series) -> pd.Series:
        return names.map(lambda s: unicodedata.normalize(form, s), na_action="ignore")

    return normal


def _with_normal_form(col: Column, form: str) -> Column:
    """Unicode-normalise; ASCII names are left alone and never sent to Python."""
    foreign = F.when(~col.rlike(_ASCII_ONLY), col)
    return F.coalesce(_normal_form(form)(foreign), col)


def base_name(col: Column, ascii_only: bool = False) -> Column:
    """Last path part, stripped, without its extension.

    ``ascii_only`` skips the Python step for columns known to be ASCII.
    """
    last = strip(F.regexp_extract(col, r"([^/]*)\z", 1))
    if not ascii_only:
        last = _with_normal_form(last, "NFC")
    return F.regexp_replace(last, r"(?s)\A(.*[^.].*)\.[^.]*\z", "$1")


def safe_name(col: Column, ascii_only: bool = False) -> Column:
    """ASCII file name: other characters collapse to ``_``; never empty."""
    if not ascii_only:
        col = F.regexp_replace(_with_normal_form(col, "NFKD"), r"[^\x00-\x7F]+", "")
    joined = F.regexp_replace(col, r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(empty_to_null(F.regexp_replace(joined, r"\A[._-]+|[._-]+\z", "")), F.lit("document"))


def guess_content_type(name: Column) -> Column:
    """Content type by file extension, octet-stream when unknown.

    The lookup table is the Python standard library's own default table.
    """
    known = mimetypes.MimeTypes(filenames=()).types_map[True]
    pairs = ", ".join(f"'{ext}', '{kind}'" for ext, kind in sorted(known.items()))
    table = F.expr(f"map({pairs})")
    plain = F.regexp_replace(name, _COMPRESSED, "")
    ext = F.lower(F.regexp_extract(plain, r"(?s)[^/](\.[^./]*)\z", 1))
    return F.coalesce(F.try_element_at(table, ext), F.lit("application/octet-stream"))
