"""Small scalar helpers as Column expressions: time ids, flags, labels, names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def strip(text: Column) -> Column:
    """Text without white space (of any kind) at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def time_id(text: Column) -> Column:
    """time text -> ``HhhMmm``.

    ``H:M`` (split at the first colon, each side an integer) or four digits
    ``HHMM``; anything else is null.  ``HH:MM:SS`` is null because the part
    after the first colon is not an integer.  No range check.
    """
    s = strip(text.cast("string"))
    has_colon = F.instr(s, ":") > 0
    h_c = F.substring_index(s, ":", 1)
    m_c = F.substring(s, F.instr(s, ":") + F.lit(1), F.length(s))
    colon_ok = h_c.rlike(_INT_TEXT) & m_c.rlike(_INT_TEXT)
    four = s.rlike(r"^[0-9]{4}$")
    h = F.when(has_colon, strip(h_c)).otherwise(F.substring(s, 1, 2)).cast("bigint")
    m = F.when(has_colon, strip(m_c)).otherwise(F.substring(s, 3, 2)).cast("bigint")
    ok = F.when(has_colon, colon_ok).otherwise(four)
    return F.when(text.isNotNull() & ok, F.format_string("H%02dM%02d", h, m))


def takeout_flag(v: Column) -> Column:
    """C10: 'Y' (any case, trimmed) -> 'True'; null/blank -> 'False'; else unchanged."""
    s = v.cast("string")
    return (
        F.when(F.upper(strip(s)) == "Y", F.lit("True"))
        .when(s.isNull() | (strip(s) == ""), F.lit("False"))
        .otherwise(s)
    )


def normalize_name(v: Column) -> Column:
    """Upper + trim (nulls stay null)."""
    return F.upper(strip(v))


def name_key(v: Column) -> Column:
    """C12 key: trimmed, case-folded name."""
    return F.lower(strip(v))


def safe_float(v: Column, default: float = 0.0) -> Column:
    """Numeric value or a default when missing / not numeric."""
    return F.coalesce(v.try_cast("double"), F.lit(default))


def bundle_label(a: Column, b: Column) -> Column:
    """``A + B``."""
    return F.concat_ws(" + ", a, b)


def bundle_part(label: Column, i: int) -> Column:
    """F7 inverse: i-th side (0/1) of ``A + B`` when exactly two sides, else null."""
    parts = F.split(label, r" \+ ")
    return F.when(F.size(parts) == 2, F.trim(F.get(parts, i)))


def cap(s: Column, n: int = 50) -> Column:
    """text capped at n characters, the last replaced by an ellipsis."""
    t = F.coalesce(s.cast("string"), F.lit(""))
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.substring(t, 1, n - 1), F.lit("…")))


def slugify(s: Column, maxlen: int = 80) -> Column:
    """non-alphanumerics (except - and _) to '-', runs collapsed, ends trimmed, capped."""
    t = F.regexp_replace(s.cast("string"), r"[^\p{L}\p{N}_-]", "-")
    t = F.regexp_replace(F.regexp_replace(t, "-+", "-"), "^-|-$", "")
    return F.substring(t, 1, maxlen)


def to_snake_case(name: str) -> str:
    """C3 (plan time, on column names): 'Receipt No' -> 'receipt_no', 'LineTotal' -> 'line_total'."""
    if not isinstance(name, str) or not name.strip():
        return name.strip() if isinstance(name, str) else name
    words = []
    for chunk in re.split(r"[^0-9a-zA-Z]+", name.strip()):
        words.extend(w for w in re.split(r"(?<=[a-z0-9])(?=[A-Z])", chunk) if w)
    return "_".join(words).lower()


def iso_date(c: Column) -> Column:
    """C17: ISO date text."""
    return F.date_format(c, "yyyy-MM-dd")


def iso_timestamp(c: Column) -> Column:
    """C17: ISO timestamp text (seconds)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
