"""Column expressions for text, numbers and dates held as sheet display text.

Everything here returns a plain ``Column`` built from Spark's own functions, so it stays inside
whole-stage codegen: no Python UDF on any path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------------------------

#: Unicode White_Space characters: what a Unicode-aware ``strip()`` removes from both ends.
#: U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F,
#: U+205F, U+3000.
UNICODE_WHITESPACE = "".join(chr(cp) for cp in [
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x0085, 0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
])

#: What a plain Python ``str.strip()`` removes: the characters above plus U+001C..U+001F.
PYTHON_WHITESPACE = UNICODE_WHITESPACE + "".join(chr(cp) for cp in [0x001C, 0x001D, 0x001E, 0x001F])

#: Spanish month abbreviations, January first.
MONTH_ABBREVIATIONS = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]

#: Date formats tried in this priority order (first success wins), written as
#: %Y-%m-%d, %d/%m/%Y, %m/%d/%Y, %Y-%m-%d %H:%M:%S, %d-%m-%Y, %d.%m.%Y, %d/%m/%y.
#: Spark letters: single ``d``/``M`` so unpadded days and months parse; the time format loses its
#: blank because every whitespace run is removed before parsing.
DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyy-M-dHH:mm:ss", "d-M-yyyy", "d.M.yyyy", "d/M/yy"]

#: Two-digit years at or above this pivot belong to the 1900s (POSIX ``%y``: 69-99 → 1969-1999,
#: 00-68 → 2000-2068). Spark's ``yy`` alone would read every two-digit year as 20xx.
TWO_DIGIT_YEAR_PIVOT = 69

#: Text accepted by the non-strict numeric cast: optional sign, digits with an optional
#: fraction (or a bare fraction), optional exponent. Anything else is null.
NUMERIC_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# ---------------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` alone leaves NBSP, tab, ...)."""
    return F.btrim(_col(c), F.lit(UNICODE_WHITESPACE))


def strip_py(c) -> Column:
    """Strip as Python's ``str.strip()`` does (used where headers, error cells and workbook titles
    are stripped: it also removes the U+001C..U+001F separators)."""
    return F.btrim(_col(c), F.lit(PYTHON_WHITESPACE))


def upper(c) -> Column:
    return F.upper(_col(c))


def lower(c) -> Column:
    return F.lower(_col(c))


def is_blank(c) -> Column:
    """True when the stripped text is empty; null stays null (three-valued)."""
    return strip(c) == F.lit("")


def replace_first(c, old: str, new: str) -> Column:
    """Replace the first occurrence of a literal (Spark's ``replace`` replaces all).

    One anchored regex replace, so the input expression is referenced once (nested parsers stay
    linear in size and inside codegen limits)."""
    pattern = r"(?s)^(.*?)" + re.escape(old)
    replacement = "$1" + new.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_col(c), pattern, replacement)


def replace_all(c, old: str, new: str) -> Column:
    """Replace every occurrence of a literal."""
    return F.replace(_col(c), F.lit(old), F.lit(new))


def regex_replace_all(c, pattern: str, new: str) -> Column:
    return F.regexp_replace(_col(c), pattern, new)


def remove_literal(c, text: str) -> Column:
    """Drop every occurrence of ``text`` (e.g. a title prefix)."""
    return replace_all(c, text, "")


def starts_with(c, prefix: str) -> Column:
    return _col(c).startswith(prefix)


def contains(c, text: str) -> Column:
    return _col(c).contains(text)


def try_double(c) -> Column:
    """Non-strict cast to double: null unless the text has a plain numeric shape.

    The whole-string match is extracted ('' when the shape does not match, which casts to
    null), so the input expression is referenced once."""
    return F.regexp_extract(_col(c), "^(" + NUMERIC_SHAPE[1:-1] + ")$", 1).try_cast("double")


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """Regex group, null when there is no match (Spark itself returns '')."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


# ---- amounts --------------------------------------------------------------------------------

def amount_eu(c) -> Column:
    """European amount ``$ 1.234,56`` → 1234.56: keep digits, ',' and '.', drop every '.',
    first ',' becomes the decimal point. Signs and brackets are lost (``-500`` → 500)."""
    kept = F.regexp_replace(_col(c), r"[^0-9,.]", "")
    return try_double(replace_first(F.replace(kept, F.lit("."), F.lit("")), ",", "."))


def amount_eu_text(c) -> Column:
    """The cleaned text that :func:`amount_eu` casts (used by the 'non-empty' test)."""
    kept = F.regexp_replace(_col(c), r"[^0-9,.]", "")
    return replace_first(F.replace(kept, F.lit("."), F.lit("")), ",", ".")


def rate_budget(c) -> Column:
    """Budget rate: keep Unicode digits, '.' and ',', first ',' → '.', cast (``1.234,56`` → null)."""
    kept = F.regexp_replace(_col(c), r"(?U)[^\d.,]", "")
    return try_double(replace_first(kept, ",", "."))


def rate_timesheet(c) -> Column:
    """Timesheet rate: first ',' → '.', cast, unusable → 0.0 (``$12,5`` → 0.0)."""
    return F.coalesce(try_double(replace_first(c, ",", ".")), F.lit(0.0))


def hours(c) -> Column:
    """Hours in locale text: first ',' → '.', cast (``8,5`` → 8.5, ``x`` → null)."""
    return try_double(replace_first(c, ",", "."))


# ---- identifiers ----------------------------------------------------------------------------

def project_id(c) -> Column:
    """Leading run of digits and dashes, dashes → '_' (``2024-01 - X`` → ``2024_01``)."""
    return F.replace(extract_or_null(c, r"(?U)^([\d-]+)", 1), F.lit("-"), F.lit("_"))


def quote_digits(c) -> Column:
    """Prefix a quote to all-digit ids so a sheet keeps leading zeros (``0005`` → ``'0005``)."""
    c = _col(c)
    return F.when(c.isNotNull() & c.rlike(r"(?U)^\d+$"), F.concat(F.lit("'"), c)).otherwise(c)


def last_dash_part(c) -> Column:
    """Text after the last '-', stripped (``Timesheet 2026 - Ana-María`` → ``María``)."""
    return strip(F.element_at(F.split(_col(c), "-", -1), -1))


# ---- dates ----------------------------------------------------------------------------------

def _year_signed(shape: str, year_at_start: bool) -> list[str]:
    if year_at_start:
        return [shape, "-" + shape, "+" + shape]
    head, tail = shape.rsplit("9", 1)
    return [shape, head + "-9" + tail, head + "+9" + tail]


#: Digit-run shape (every run of ASCII digits → ``9``) each format can possibly parse; a year
#: may carry a sign. Used only to skip attempts that must fail: each list is a superset of what
#: Spark's parser accepts for that pattern, so results never change.
DATE_SHAPES = {
    "yyyy-M-d": _year_signed("9-9-9", True),
    "d/M/yyyy": _year_signed("9/9/9", False),
    "M/d/yyyy": _year_signed("9/9/9", False),
    "yyyy-M-dHH:mm:ss": _year_signed("9-9-9:9:9", True),
    "d-M-yyyy": _year_signed("9-9-9", False),
    "d.M.yyyy": _year_signed("9.9.9", False),
    "d/M/yy": ["9/9/9"],
}


def _attempt(squeezed: Column, fmt: str) -> Column:
    """One format's parse; a two-digit year at or above the pivot moves back a century."""
    d = F.try_to_date(squeezed, fmt)
    if "yyyy" not in fmt and "yy" in fmt:
        d = F.add_months(d, F.when(F.year(d) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.lit(-1200)).otherwise(F.lit(0)))
    return d


def squeeze_whitespace(c) -> Column:
    """Strip, then remove every whitespace run (the text the date formats are tried on)."""
    return F.regexp_replace(strip(c), r"(?U)\s+", "")


def parse_date_multi(c, formats: list[str] | None = None, squeezed: bool = False) -> Column:
    """First format (in priority order) that parses the text with all whitespace removed.

    A format is only attempted when the text's digit-run shape fits it (a failed parse is
    expensive; the shape test is one regex replace shared by all formats). Pass
    ``squeezed=True`` when ``c`` already went through :func:`squeeze_whitespace`.
    """
    sq = _col(c) if squeezed else squeeze_whitespace(c)
    shape = F.regexp_replace(sq, "[0-9]+", "9")
    tries = []
    for f in formats or DATE_FORMATS:
        shapes = DATE_SHAPES.get(f)
        attempt = _attempt(sq, f)
        tries.append(F.when(shape.isin(*shapes), attempt) if shapes else attempt)
    return F.coalesce(*tries)


def with_parsed_date(df, src: str, out: str):
    """``df`` plus ``out`` = :func:`parse_date_multi` of column ``src``; the squeezed text and its
    shape are computed once in their own projection instead of once per format."""
    df = df.withColumn("_date_sq", squeeze_whitespace(F.col(f"`{src}`")))
    df = df.withColumn("_date_shape", F.regexp_replace(F.col("_date_sq"), "[0-9]+", "9"))
    tries = [F.when(F.col("_date_shape").isin(*DATE_SHAPES[f]), _attempt(F.col("_date_sq"), f))
             for f in DATE_FORMATS]
    return df.withColumn(out, F.coalesce(*tries)).drop("_date_sq", "_date_shape")


def parse_iso_date(c) -> Column:
    """Single strict ``yyyy-MM-dd`` parse, null when it fails."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def month_label(d) -> Column:
    """``ene/2025`` style label of a date."""
    d = _col(d)
    months = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(months, F.month(d)), F.lit("/"), F.year(d).cast("string"))


def iso_or_text(d, text) -> Column:
    """``yyyy-MM-dd`` of the parsed date, else the original text."""
    return F.when(_col(d).isNotNull(), F.date_format(_col(d), "yyyy-MM-dd")).otherwise(_col(text))
