"""Product rules as Column expressions (JVM-side, whole-stage codegen friendly).

These are the scalar rules the warehouse applies to every product row:
parent SKU (F1), category (F2), drink-name normalisation and costing-sheet
score (F8/F9), and product cost (F10).  No Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _tokens(s: Column) -> Column:
    """Whitespace tokens, like ``str.split()`` (no empty tokens)."""
    return F.filter(F.split(s, r"\s+"), lambda t: t != F.lit(""))


# \b(8|12|16)\s*(?:O|0)Z\.?\b  — size mention such as "12 OZ", "16OZ", "8 0Z."
_SIZE_ALT = "|".join(C.PARENT_SKU_SIZES)
SIZE_PATTERN = r"\b(" + _SIZE_ALT + r")\s*(?:O|0)Z\.?\b"
ZERO_OZ_PATTERN = r"\b(" + _SIZE_ALT + r")0Z\b"


def parent_sku(name: Column) -> Column:
    """parent SKU of a product name.

    Upper-cased trimmed name; dots become spaces and ``120Z`` is read as
    ``12OZ``.  A temperature token or a size mention triggers stripping of
    sizes and temperature tokens (falling back to the full name when nothing
    remains).  Trailing variant digits 1/2/3 are dropped; tokens joined by '-'.
    """
    orig = F.upper(F.trim(name))
    work = F.regexp_replace(F.regexp_replace(orig, r"\.", " "), ZERO_OZ_PATTERN, "$1OZ")
    triggered = F.arrays_overlap(_tokens(work), _arr(C.PARENT_SKU_TRIGGER_TOKENS)) | work.rlike(SIZE_PATTERN)
    drop = _arr(C.PARENT_SKU_TRIGGER_TOKENS + ("OZ",) + C.PARENT_SKU_SIZES)
    stripped = F.filter(
        _tokens(F.regexp_replace(work, SIZE_PATTERN, "")),
        lambda t: ~F.array_contains(drop, t),
    )
    stripped = F.when(F.size(stripped) == 0, _tokens(orig)).otherwise(stripped)
    toks = F.when(triggered, stripped).otherwise(_tokens(orig))
    digits = "[" + "".join(C.PARENT_SKU_TRAILING_DIGITS) + "]"
    spaced = F.regexp_replace(F.array_join(toks, " "), r"(^|\s)" + digits + r"(\s" + digits + r")*$", "")
    out = F.regexp_replace(spaced, " ", "-")
    return F.when(name.isNull() | (F.trim(name) == ""), F.lit("")).otherwise(out)


def _word(s: Column, word: str) -> Column:
    return s.rlike(r"\b" + word + r"\b")


def product_category(name: Column, product_id: Column) -> Column:
    """OTHERS / EXTRA / DRINK / FOOD from the name, id markers force DRINK over FOOD."""
    up = F.upper(F.coalesce(name, F.lit("")))
    is_others = F.lit(False)
    for s in C.OTHERS_SUBSTRINGS:
        is_others = is_others | up.contains(s)
    for w in C.OTHERS_WORDS:
        is_others = is_others | _word(up, w)
    is_extra = F.lit(False)
    for s in C.EXTRA_SUBSTRINGS:
        is_extra = is_extra | up.contains(s)
    for w in C.EXTRA_WORDS:
        is_extra = is_extra | _word(up, w)
    is_drink_name = F.arrays_overlap(F.regexp_extract_all(up, F.lit("[A-Z0-9]+"), 0), _arr(C.DRINK_KEYWORDS))
    upid = F.upper(F.coalesce(product_id, F.lit("")))
    is_drink_id = F.lit(False)
    for m in C.DRINK_ID_MARKERS:
        is_drink_id = is_drink_id | upid.contains(m)
    return (
        F.when(is_others, "OTHERS")
        .when(is_extra, "EXTRA")
        .when(is_drink_name | is_drink_id, "DRINK")
        .otherwise("FOOD")
    )


def normalize_drink_name(name: Column) -> Column:
    """F8: key used to match a drink to a costing sheet."""
    s = F.replace(F.coalesce(name, F.lit("")), F.lit("CAR "), F.lit("CARAMEL "))
    s = F.upper(s)
    s = F.replace(s, F.lit(" "), F.lit(""))
    s = F.replace(s, F.lit("OZ"), F.lit(""))
    return F.replace(s, F.lit("CHOCO"), F.lit("CHOCOLATE"))


def cost_match_score(product_norm: Column, sheet_norm: Column) -> Column:
    """+2 whole normalised name (>= 4 chars) inside the sheet name; +1 first
    size shared; +1 HOT/HOT or (ICED|COLD)/ICED."""
    name_hit = F.when(
        (F.length(product_norm) >= C.COST_MATCH_MIN_NAME_LEN) & F.instr(sheet_norm, product_norm).cast("boolean")
        & (product_norm != ""),
        2,
    ).otherwise(0)
    size_hit = F.lit(False)
    for s in C.COST_MATCH_SIZES:
        size_hit = size_hit | (product_norm.contains(s) & sheet_norm.contains(s))
    temp_hit = F.when(product_norm.contains("HOT") & sheet_norm.contains("HOT"), 1).when(
        (product_norm.contains("ICED") | product_norm.contains("COLD")) & sheet_norm.contains("ICED"), 1
    ).otherwise(0)
    return name_hit + F.when(size_hit, 1).otherwise(0) + temp_hit


def product_cost(category: Column, price: Column, matched_cost: Column | None = None) -> Column:
    """drinks take a non-zero matched sheet cost, everything else 60 % of price
    (decimal arithmetic, half-up to cents); null price gives null."""
    fallback = F.round(price.cast("decimal(10,2)") * F.lit(C.DEFAULT_COGS_MULTIPLIER).cast("decimal(3,2)"), 2)
    fallback = fallback.cast("decimal(10,2)")
    if matched_cost is None:
        return fallback
    use_match = (category == "DRINK") & matched_cost.isNotNull() & (matched_cost != 0)
    return F.when(use_match, F.round(matched_cost, 2).cast("decimal(10,2)")).otherwise(fallback)
