"""Column-level helpers (pure ``Column -> Column`` builders, JVM-side only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens the panel uses for "no reading".
PEST_BAD_TOKENS = ("9..9", "56.o")
WEATHER_BAD_TOKENS = ("-",)

# A decimal number as pandas.to_numeric accepts it (no 'd'/'f' suffixes,
# no hex, no thousands separators, no NaN/inf text).
NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INT_RE = r"^\s*[+-]?\d+\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number(c, bad_tokens=()) -> Column:
    """Text -> double; sentinel tokens and non-numeric text become NULL.

    Spark's cast alone is too lenient ('1d' -> 1.0, 'NaN' -> NaN), so the text
    must look like a plain decimal first; the result is never NaN.
    """
    c = _c(c)
    s = c.cast("string")
    ok = s.rlike(NUMERIC_RE)
    if bad_tokens:
        ok = ok & ~s.isin(*bad_tokens)
    return F.when(ok, F.trim(s).try_cast("double"))


def clean_int(c) -> Column:
    """Text -> int when the text is a plain integer (Python ``int(tok)``), else NULL."""
    s = _c(c).cast("string")
    return F.when(s.rlike(INT_RE), F.trim(s).try_cast("int"))


def week_id(year="year", standard_week="standard_week") -> Column:
    """Continuous weekly axis: 52 weeks per year, week 53 folds onto next week 1."""
    return _c(year).cast("long") * 52 + _c(standard_week).cast("long") - 1


def year_of_week(w="week_id") -> Column:
    return F.floor(_c(w) / 52).cast("long")


def week_of_year(w="week_id") -> Column:
    return (F.pmod(_c(w), F.lit(52)) + 1).cast("int")


def week_date(year="year", standard_week="standard_week") -> Column:
    """Jan 1 of *year* plus 7 days per week after the first."""
    return F.date_add(F.make_date(_c(year), F.lit(1), F.lit(1)),
                      ((_c(standard_week) - 1) * 7).cast("int"))


def squash_spaces(c) -> Column:
    """Collapse runs of whitespace to one space and strip the ends."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def source_key(file_name) -> Column:
    """Photo source id: the file name before the first '.rf.' marker."""
    return F.split(_c(file_name), r"\.rf\.", 2).getItem(0)


def crop_of(class_name) -> Column:
    """Crop = class name text before the first underscore ('' when unknown)."""
    return F.coalesce(F.split(_c(class_name), "_", 2).getItem(0), F.lit(""))


def file_kind(path) -> Column:
    """image / txt / yaml / csv / other by case-insensitive extension."""
    p = F.lower(_c(path))
    return (F.when(p.rlike(r"\.(jpg|jpeg|png|bmp|tif|tiff|webp)$"), "image")
            .when(p.endswith(".txt"), "txt")
            .when(p.rlike(r"\.(yaml|yml)$"), "yaml")
            .when(p.endswith(".csv"), "csv")
            .otherwise("other"))


def folder_key(path, depth: int, shallow: str = "parent") -> Column:
    """First *depth* path components of *path*.

    ``shallow="parent"``: paths with <= depth parts fall back to their parent
    folder; ``shallow="drop"``: such paths give NULL (and drop out of counts).
    """
    parts = F.split(_c(path), "/")
    n = F.size(parts)
    deep = F.array_join(F.slice(parts, 1, depth), "/")
    if shallow == "drop":
        return F.when(n > depth, deep)
    parent = F.array_join(F.slice(parts, F.lit(1), n - 1), "/")
    return F.when(n > depth, deep).otherwise(parent)


def pretty_label(class_name) -> tuple[Column, Column]:
    """('crop_some disease' ->) ('Crop', 'some disease'); blank/'healthy' -> 'Healthy'."""
    c = _c(class_name)
    parts = F.split(c, "_", 2)
    head = parts.getItem(0)
    crop = F.concat(F.upper(F.substring(head, 1, 1)), F.lower(F.substring(head, 2, 1 << 30)))
    rest = F.when(F.size(parts) > 1, squash_spaces(F.regexp_replace(parts.getItem(1), "_", " ")))
    disease = F.when(rest.isNull() | (rest == "") | (rest == "healthy"), F.lit("Healthy")).otherwise(rest)
    return crop, disease


def all_of(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)


def sum_of(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def md5_order(seed, *keys) -> Column:
    """Deterministic pseudo-random order key: md5 of seed and the row key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_c(k).cast("string") for k in keys]))
