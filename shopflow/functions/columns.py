"""Column expressions on strings: trimming, blank tests, enum maps, numbers,
timestamps and ISO text.  All are JVM-side expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopflow.schemas import BLANK_TOKENS, BOOL_FALSE, BOOL_TRUE

# Whitespace as Python's str.strip() sees it (ASCII + Unicode separators).
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# The same set as characters, from Python's own rule, for a regex-free trim.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# The strings a CSV reader of the source system turns into a
# missing value (the pandas default ``na_values`` list), compared untrimmed.
CSV_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                 "n/a", "nan", "null"]

INT_TEXT = r"^" + WS + r"*[+-]?\d+" + WS + r"*$"
FLOAT_TEXT = (r"^" + WS + r"*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))"
               + WS + r"*$")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(mapping: dict, key: Column, default: Column | None = None) -> Column:
    """``mapping[key]`` as a CASE chain (NULL, or ``default``, when absent)."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(None) if default is None else default
    return expr if default is None else expr.otherwise(default)


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: removes all leading/trailing whitespace."""
    return F.trim(col_(c), F.lit(WS_CHARS))


def is_blank(c: Column | str) -> Column:
    """Blank test of event fields: NULL, '' or trimmed lower null/none/nan.

    A whitespace-only string is not blank (it later strips to '').
    """
    c = col_(c)
    return c.isNull() | (c == "") | F.lower(py_strip(c)).isin(*BLANK_TOKENS)


def csv_null(c: Column | str) -> Column:
    """CSV cell -> NULL when it is one of the reader's missing-value tokens."""
    c = col_(c)
    return F.when(c.isin(*CSV_NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def enum_map(c: Column | str, mapping: dict) -> Column:
    """Trim, lower-case and look up in an enum domain; unknown -> NULL."""
    return lookup(mapping, F.lower(py_strip(col_(c))))


def email_clean(c: Column | str) -> Column:
    """Trim + lower-case; NULL stays NULL (the row is then rejected)."""
    return F.lower(py_strip(col_(c)))


def int_text(c: Column | str) -> Column:
    """Text of an integer ('  +12 ') -> INT; anything else -> NULL."""
    c = col_(c)
    return F.when(c.rlike(INT_TEXT), py_strip(c).try_cast("int"))


def float_text(c: Column | str) -> Column:
    """Text of a float (also inf / infinity) -> DOUBLE; else NULL."""
    c = col_(c)
    return F.when(c.rlike(FLOAT_TEXT), py_strip(c).try_cast("double"))


def bool_text(c: Column | str) -> Column:
    """true/1/yes/y -> true, false/0/no/n -> false, else NULL."""
    t = F.lower(py_strip(col_(c)))
    return F.when(t.isin(*BOOL_TRUE), F.lit(True)).when(t.isin(*BOOL_FALSE), F.lit(False))


def number_text(c: Column | str, dtype: str) -> Column:
    """Coercing numeric parse: text of a number -> ``dtype``, else NULL.

    Integral targets accept only whole values ('12', '12.0'), as a fractional
    value has no faithful integer form.
    """
    d = float_text(c)
    if dtype in ("int", "bigint"):
        return F.when(d == F.floor(d), d.try_cast(dtype))
    if dtype.startswith("decimal"):
        # via the double, as the source reads numbers as floats before storing
        finite = F.abs(d) != F.lit(float("inf"))
        return F.when(finite, d.try_cast(dtype))
    return d


# ISO-8601 text as the source system's parser accepts it: extended date, an
# optional time (T or space) with optional minutes / seconds / fraction, an
# optional UTC offset or Z; or the basic forms YYYYMMDD and YYYYMMDDTHHMMSS.
# Spark's own ISO cast reads every extended shape; the regex guard rejects the
# shapes it would also take but the source rejects (bare '2025', '2025-1-2').
ISO_EXT = (r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?)?"
            r"(?:Z|[+-]\d{2}(?::?\d{2})?)?$")
ISO_BASIC_DATE = r"^(\d{4})(\d{2})(\d{2})$"
ISO_BASIC_TIME = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(Z|[+-]\d{2}(?::?\d{2})?)?$"


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP (UTC instant); invalid -> NULL.

    'Z' means UTC; a naive time is read as UTC.  Compact enough to stay inside
    whole-stage codegen: one guard regex, one cast.
    """
    s = F.replace(col_(c), F.lit("Z"), F.lit("+00:00"))
    ext = F.regexp_replace(s, ",", ".")
    basic = F.regexp_replace(F.regexp_replace(s, ISO_BASIC_DATE, "$1-$2-$3"),
                             ISO_BASIC_TIME, "$1-$2-$3T$4:$5:$6$7")
    return (F.when(s.rlike(ISO_EXT), ext.try_cast("timestamp"))
            .when(s.rlike(ISO_BASIC_DATE) | s.rlike(ISO_BASIC_TIME), basic.try_cast("timestamp")))


# Non-ISO shapes a lenient date parser also reads, tried after ISO.
_LENIENT_FORMATS = ["yyyy/M/d[ H:m[:s]]", "M/d/yyyy[ H:m[:s]]"]


def parse_timestamp(c: Column | str) -> Column:
    """Best-effort timestamp parse with coercion to NULL (CSV dates, landing).

    Each row is parsed on its own: ISO first, then the lenient formats.
    """
    s = py_strip(col_(c))
    tries = [iso_timestamp(s)] + [F.try_to_timestamp(s, F.lit(f)) for f in _LENIENT_FORMATS]
    return F.coalesce(*tries)


def iso_text(c: Column | str) -> Column:
    """TIMESTAMP -> ISO text without zone, fraction only when non-zero
    (``2025-01-02T03:04:05`` / ``2025-01-02T03:04:05.120000``)."""
    c = col_(c)
    return F.when(
        F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def id_number(c: Column | str) -> Column:
    """Numeric suffix of an id such as ``u123`` -> 123 (BIGINT); bad -> NULL."""
    return F.substring(col_(c), 2, 1 << 30).try_cast("bigint")
