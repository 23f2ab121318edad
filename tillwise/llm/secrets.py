"""Operator 6, secret scans: fixed patterns plus sliding-window entropy.

DataFrame functions only.  Spans of a pattern come from the text cut into
(what lies between, match) pairs, whose lengths add up to code-point places.
Candidate strings of each character class get a window of fixed width slid
over them: a step takes the leaving character out of the counts and the
entering one in, and changes the sum of c * log2(c) by just these two terms
(kept in whole millionths, so that it is exact).  A window at or above its
class's entropy is hot; from the first to the last hot window is one span.
Allow-listed strings, and spans inside a fixed pattern's span, are dropped.

Defined cases: a null text is the empty text and has no spans; null ids,
repeated rows and ties get a row each; spans with the same start come in the
order of KINDS; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import fresh, id_text

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
ASSIGNED = "[A-Za-z0-9+/_.=-]+"
ASSIGNED_MIN = 12
#: `AKIA[A-Z0-9]+` of 18 or more characters and `[0-9a-f]+` of 16 or more: a run is matched whole or not at all.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"

#: name: (characters, window, least bits of entropy, pattern a candidate must hold)
CLASSES = {
    "hex": ("[0-9A-Fa-f]", 16, 3.0, "[0-9]"),
    "base64": ("[A-Za-z0-9+/_=-]", 24, 3.9, "[0-9][A-Za-z]|[A-Za-z][0-9]"),
}
#: Strings that look random and are no secrets: all digits, UUIDs, runs of one alphabet, placeholders.
ALLOWED = ("^[0-9]+$", "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
           "(?i)0123456789|abcdefghijkl|example|placeholder|xxxxxx")
#: The one of them that may stand anywhere.
WORDS = ALLOWED[-1]
MICRO = 1_000_000
MASK = "[SECRET]"
_SPANS = "array<struct<start:int,end:int,kind:int>>"


def terms(window: int) -> list[int]:
    """c * log2(c) in millionths, for counts 0 to the window's width."""
    return [0, *(round(MICRO * c * math.log2(c)) for c in range(1, window + 1))]


def hot_limit(window: int, bits: float) -> int:
    """A window is hot where its sum of terms is at most this."""
    return math.floor(MICRO * window * (math.log2(window) - bits))


def _none() -> Column:
    return F.array().cast(_SPANS)


def _places(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches."""
    whole = rf"(?s)\G(.*?)({pattern})"
    cut = F.arrays_zip(F.regexp_extract_all(text, F.lit(whole), F.lit(1)).alias("gap"), F.regexp_extract_all(text, F.lit(whole), F.lit(2)).alias("match"))
    step = lambda s, x: F.struct(
        (s["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("at"),
        F.array_append(s["out"], F.struct((s["at"] + F.length(x["gap"])).alias("start"), (s["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"), x["match"].alias("match"))).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))
    return F.aggregate(cut, start, step, lambda s: s["out"])


def _as_spans(places: Column, kind: str) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind")))


def base_spans(text: Column) -> Column:
    """Spans (start, end, kind number) of the fixed patterns, by start, then kind."""
    def of(kind: str, hint: Column, pattern: str, keep=None) -> Column:
        places = _places(text, pattern)
        return F.when(hint, _as_spans(F.filter(places, keep) if keep else places, kind)).otherwise(_none())

    long_enough = lambda p: F.length(F.regexp_extract(p["match"], f"^{ASSIGN}({ASSIGNED})$", 1)) >= ASSIGNED_MIN
    return F.sort_array(F.concat(
        of("assign", text.rlike(ASSIGN), ASSIGN + ASSIGNED, long_enough),
        of("access", text.contains("AKIA"), ACCESS),
        of("hex", text.rlike(HEX), HEX)))


def _coded(place: Column) -> Column:
    """A candidate with its characters as numbers in its own alphabet, worked out once."""
    chars = F.split(place["match"], "")
    return F.struct(place["start"].alias("start"), place["match"].alias("match"), chars.alias("chars"), F.array_distinct(chars).alias("alphabet"))


def _numbered(x: Column) -> Column:
    return F.struct(x["start"].alias("start"), x["match"].alias("match"), F.size(x["alphabet"]).alias("kinds"),
                    F.transform(x["chars"], lambda c: F.array_position(x["alphabet"], c).cast("int") - 1).alias("codes"))


def _counted(x: Column, window: int) -> Column:
    """With the counts of the first window's characters."""
    head = F.slice(x["codes"], 1, window)
    counts = F.transform(F.sequence(F.lit(0), x["kinds"] - 1), lambda a: F.size(F.filter(head, lambda c: c == a)))
    return F.struct(x["start"].alias("start"), x["match"].alias("match"), x["codes"].alias("codes"), counts.alias("counts"))


def _hot_span(x: Column, window: int, bits: float) -> Column:
    """(start, end, match) from the first to the last hot window of a candidate; nulls where none is hot.

    Windows that hold one of the WORDS are not hot.
    """
    term = F.array(*[F.lit(t).cast("long") for t in terms(window)])
    limit = F.lit(hot_limit(window, bits)).cast("long")
    sum_first = F.aggregate(x["counts"], F.lit(0).cast("long"), lambda s, c: s + F.get(term, c))
    plain = ~x["match"].rlike(WORDS)
    fits = lambda total, at: (total <= limit) & (plain | ~F.substring(x["match"], at + 1, F.lit(window)).rlike(WORDS))
    hot = lambda total, at, was: F.when(fits(total, at), at).otherwise(was)
    nothing = F.lit(None).cast("int")
    start = F.struct(x["counts"].alias("counts"), sum_first.alias("total"), hot(sum_first, F.lit(0), nothing).alias("lo"), hot(sum_first, F.lit(0), nothing).alias("hi"))

    def step(s: Column, k: Column) -> Column:
        out, in_ = F.get(x["codes"], k - 1), F.get(x["codes"], k + window - 1)
        c_out, c_in = F.get(s["counts"], out), F.get(s["counts"], in_)
        same = out == in_
        total = F.when(same, s["total"]).otherwise(s["total"] - F.get(term, c_out) + F.get(term, c_out - 1) - F.get(term, c_in) + F.get(term, c_in + 1))
        counts = F.when(same, s["counts"]).otherwise(F.transform(s["counts"], lambda c, i: c + F.when(i == in_, 1).when(i == out, -1).otherwise(0)))
        return F.struct(counts.alias("counts"), total.alias("total"), F.coalesce(s["lo"], hot(total, k, nothing)).alias("lo"), hot(total, k, s["hi"]).alias("hi"))

    n = F.size(x["codes"])
    steps = F.when(n > window, F.sequence(F.lit(1), n - window)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step, lambda s: F.struct(
        (x["start"] + s["lo"]).alias("start"), (x["start"] + s["hi"] + window).alias("end"),
        F.substring(x["match"], s["lo"] + 1, s["hi"] + window - s["lo"]).alias("match")))


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of candidate strings with a hot window, without allow-listed ones and those inside `base`.

    A word of the allow-list takes out the windows that hold it, not the span around it.
    """
    found = []
    for chars, window, bits, must in CLASSES.values():
        run = f"{chars}{{{window},}}"
        candidates = F.filter(_places(text, run), lambda p: p["match"].rlike(must))
        for step in (_coded, _numbered, lambda x: _counted(x, window), lambda x: _hot_span(x, window, bits)):
            candidates = F.transform(candidates, step)
        hot = F.filter(candidates, lambda h: h["start"].isNotNull())
        for pattern in ALLOWED[:-1]:
            hot = F.filter(hot, lambda h: ~h["match"].rlike(pattern))
        hot = F.filter(hot, lambda h: ~F.exists(base, lambda b: (b["start"] <= h["start"]) & (b["end"] >= h["end"])))
        found.append(F.when(text.rlike(run), _as_spans(hot, "entropy")).otherwise(_none()))
    return F.array_distinct(F.concat(*found))


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _with_spans(df: DataFrame, text: Column, base: str, spans: str) -> DataFrame:
    return df.withColumn(base, base_spans(text)).withColumn(spans, F.sort_array(F.concat(F.col(base), entropy_spans(text, F.col(base)))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and all spans (arrays of start, end, kind) and their written forms."""
    read = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _with_spans(read, F.col("text"), "base", "found").select(
        "doc_id", "base", "found", _told(F.col("base")).alias("base_spans"), _told(F.col("found")).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with each span, overlapping ones as one, replaced by `mask`."""
    step = lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(
        x["end"].alias("at"),
        F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mask))).alias("out")))
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All documents and columns, with secrets masked in the text (texts without one are unchanged)."""
    base, spans = fresh(docs, "secret_base"), fresh(docs, "secret_spans")
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = _with_spans(docs, text, base, spans)
    return out.withColumn(text_col, F.when(F.size(spans) > 0, masked(text, F.col(spans))).otherwise(F.col(text_col))).drop(base, spans)
