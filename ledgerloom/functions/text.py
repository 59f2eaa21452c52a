"""Cleaning of strings, numbers, dates and identifiers.

Every function takes a column (or its name) and returns a column; bad input becomes
null instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_FIELD_CHARS = 20_000
# Markers that mean "no value".
NOT_AVAILABLE = ("N/A", "NA", "NONE")
SUPPRESSED_MARKERS = ("*", "**", ".", "-", "na", "n/a", "suppressed", "")
YES_MARKERS = ("y", "yes", "1", "x", "true", "t", "ok")

BARE = r"^[0-9]+(\.[0-9]+)?$"
#: What may need cleaning: a sign that is not plain ASCII, blanks together or at an end.
UNCLEAN = r"[^!-~ ]|  |^ | $"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def clean_str(c: Column | str) -> Column:
    """Without control characters, white space collapsed, trimmed, cut at 20,000
    characters; empty becomes null."""
    x = F.regexp_replace(column(c).cast("string"), r"[\x00-\x08\x0b\x0c\x0e-\x1b\x7f]", "")
    x = F.trim(F.regexp_replace(x, r"(?U)[\s\x1c-\x1f]+", " "))
    return empty_to_null(F.trim(F.substring(x, 1, MAX_FIELD_CHARS)))


def clean_cell(c: Column) -> Column:
    """As ``clean_str``, for a plain reference to a cell, which it repeats: one look tells
    most cells, which need no cleaning."""
    return F.when(c.rlike(UNCLEAN) | (F.length(c) > MAX_FIELD_CHARS), clean_str(c)).otherwise(empty_to_null(c))


def clean_text(c: Column | str) -> Column:
    """As ``clean_str``; a marker such as N/A is null too."""
    x = clean_str(c)
    return F.when(~F.upper(x).isin(*NOT_AVAILABLE), x)


def to_double(c: Column | str) -> Column:
    """A plain number, else null: no suffixes, NaN or infinity."""
    x = clean_str(c)
    return F.when(x.rlike(NUMBER), x.try_cast("double"))


def to_decimal(c: Column | str, kind: str = "decimal(14,2)") -> Column:
    """A plain number, with or without ``$`` and ``,``, else null."""
    x = F.trim(F.translate(clean_str(c), "$,", ""))
    return F.when(x.rlike(NUMBER), x.try_cast(kind))


def cell_decimal(c: Column, kind: str = "decimal(14,2)") -> Column:
    """As ``to_decimal``, for a plain reference to a cell: most are empty or bare digits."""
    return F.when(c == "", None).when(c.rlike(BARE), c.try_cast(kind)).otherwise(to_decimal(c, kind))


def to_int(c: Column | str) -> Column:
    """Truncated toward zero; thousands separators are dropped."""
    return to_double(F.translate(column(c).cast("string"), ",", "")).try_cast("int")


def parse_date(c: Column | str) -> Column:
    """``yyyyMMdd``, ``yyyy-MM-dd`` or ``M/d/yyyy``; a time after T is dropped."""
    x = F.substring_index(clean_str(c), "T", 1)
    tried = [F.when(x.rlike(r), F.try_to_timestamp(x, F.lit(f))) for r, f in ((r"^\d{8}$", "yyyyMMdd"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))]
    return F.coalesce(*tried).cast("date")


def ccn(c: Column | str) -> Column:
    """Certification number: no spaces, upper case, short all-digit values zero-padded."""
    x = empty_to_null(F.upper(F.translate(clean_str(c), " ", "")))
    return F.when(x.rlike(r"^\d{1,5}$"), F.lpad(x, 6, "0")).otherwise(x)


def strict_ccn(c: Column | str) -> Column:
    """As ``ccn``, but null unless two digits and four digits or letters."""
    x = ccn(c)
    return F.when(x.rlike(r"^[0-9]{2}[0-9A-Z]{4}$"), x)


def ccn_cell(c: Column, strict: bool = False) -> Column:
    """As ``ccn`` or ``strict_ccn``, for a plain reference to a cell: most are as they are stored
    or lack leading zeros."""
    rest = strict_ccn(c) if strict else ccn(c)
    return F.when(c.rlike(r"^[0-9]{2}[0-9A-Z]{4}\z"), c).when(c.rlike(r"^[0-9]{1,5}\z"), F.lpad(c, 6, "0")).otherwise(rest)


def _digits(c: Column | str) -> Column:
    return empty_to_null(F.regexp_replace(clean_str(c), r"\D", ""))


def zip5(c: Column | str) -> Column:
    """First five digits, zero-padded."""
    x = _digits(c)
    return F.lpad(F.substring(x, 1, 5), 5, "0")


def strict_zip5(c: Column | str) -> Column:
    """Nine digits give five; other lengths above five are no ZIP; shorter are padded."""
    x = _digits(c)
    return F.when(F.length(x) == 9, F.substring(x, 1, 5)).when(F.length(x) <= 5, F.lpad(x, 5, "0"))


def zip_cell(c: Column) -> Column:
    """As ``strict_zip5``, for a plain reference to a cell."""
    return F.when(c.rlike(r"^[0-9]{5}\z"), c).when(c.rlike(r"^[0-9]{1,4}\z"), F.lpad(c, 5, "0")).otherwise(strict_zip5(c))


def phone(c: Column | str) -> Column:
    x = _digits(c)
    return F.when((F.length(x) == 11) & x.startswith("1"), F.substring(x, 2, 10)).otherwise(x)


def parse_count(c: Column | str) -> Column:
    """``struct(value, suppressed)``: a marker or an unreadable cell is suppressed, 0 is 0."""
    raw = F.trim(F.coalesce(column(c).cast("string"), F.lit("")))
    value = F.when(~F.lower(raw).isin(*SUPPRESSED_MARKERS), to_int(raw))
    return F.struct(value.alias("value"), value.isNull().alias("suppressed"))


def count_cell(c: Column) -> Column:
    """As ``parse_count``, for a plain reference to a cell: most are bare digits."""
    bare = c.rlike(r"^[0-9]{1,9}(\.[0-9]+)?\z")
    return F.when(bare, F.struct(c.try_cast("double").try_cast("int").alias("value"), F.lit(False).alias("suppressed"))).otherwise(parse_count(c))


def parse_amount(c: Column | str) -> Column:
    raw = F.trim(F.coalesce(column(c).cast("string"), F.lit("")))
    return F.when(~F.lower(raw).isin(*SUPPRESSED_MARKERS), to_decimal(raw, "decimal(16,2)"))


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage, 0 where the whole is 0."""
    return F.coalesce(F.round(F.try_divide(100 * part.cast("double"), whole.cast("double")), digits), F.lit(0.0))


def is_yes(c: Column | str) -> Column:
    return F.lower(F.trim(F.coalesce(column(c), F.lit("")))).isin(*YES_MARKERS)


def word_start(haystack: Column, pattern: str) -> Column:
    """Whether ``pattern`` occurs, in any case, where a word starts."""
    quoted = "".join("\\" + ch if not ch.isalnum() else ch for ch in pattern.strip().lower())
    return F.lower(haystack).rlike(f"(^|[^a-z0-9]){quoted}")


def round_half_up(x: Column, digits: int = 0) -> Column:
    """Halves go up, also below zero; the last bits of a double decide no half."""
    factor = float(10**digits)
    return F.floor(F.round(x * factor, 6) + 0.5) / factor


def coded(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Decode by a small fixed table."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(default))


def slug(c: Column | str, most: int = 60) -> Column:
    """Lower-case words joined by hyphens, at most ``most`` characters."""
    x = F.regexp_replace(F.lower(F.coalesce(column(c), F.lit(""))), r"[^a-z0-9]+", "-")
    return F.regexp_replace(F.substring(F.regexp_replace(x, r"^-+|-+$", ""), 1, most), r"-+$", "")
