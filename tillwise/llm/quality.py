"""Operator 9, quality rules: how much of a text repeats itself.

Words are hashed by a rolling polynomial over the bytes; runs of 3, 5 and 10
words get hashes from their word hashes, all in numpy over blocks of whole
texts.  A run found twice or more in its text marks its words (the first
occurrence included), and a text is judged by the share of word characters
that are marked.  Every text is judged on its own, so nothing is shuffled.

Defined cases: null or empty text and text of white space have no words and
fail the base rule; a null id is kept as it is; repeated rows get a row each;
tied counts do not matter (only "twice or more" is asked); columns other than
id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import blocks, fresh, id_text, ngram_hashes, span_hashes, words_of

#: Least words of a kept text, and the most per cent of words in repeated 3-word runs.
MIN_WORDS = 50
MAX_REPEAT_WORDS_PCT = 50

#: n: most share of word characters inside repeated n-word runs.
MAX_RUN_SHARE = {5: 0.40, 10: 0.30}
#: Most share of characters, of all in lines with a word, in lines that occurred before.
MAX_LINE_SHARE = 0.30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "dup_line_chars"]
_RUNS = sorted(MAX_RUN_SHARE)
SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in _FIELDS + [f"dup_chars_{n}" for n in _RUNS]])


def _again(values: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    if not len(values):
        return np.zeros(0, bool)
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _seen_before(values: np.ndarray) -> np.ndarray:
    """Which values equal an earlier one."""
    out = np.ones(len(values), bool)
    out[np.unique(values, return_index=True)[1]] = False
    return out


def _in_repeated(words: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word run that its text has twice or more."""
    marked = np.zeros(len(words) + 1, np.int32)
    runs = ngram_hashes(words, n)
    if len(runs):
        whole = text[: len(runs)] == text[n - 1:]
        starts = np.flatnonzero(whole)
        starts = starts[_again(runs[starts] ^ (text[starts].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))]
        marked[starts] += 1
        marked[starts + n] -= 1
    return np.cumsum(marked[:-1]) > 0


def lines_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the \\n-split lines (an empty text has one empty line)."""
    cuts = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(at, cuts, "right") - 1
    starts = np.concatenate([at[:-1], cuts + 1])
    ends = np.concatenate([cuts, at[1:]])
    text_s, text_e = np.concatenate([np.arange(len(at) - 1), owner]), np.concatenate([owner, np.arange(len(at) - 1)])
    by_start, by_end = np.lexsort((starts, text_s)), np.lexsort((ends, text_e))
    return starts[by_start], ends[by_end], text_s[by_start]


def measure(texts: pa.Array) -> pa.StructArray:
    """The counts of each text of one Arrow batch."""
    cols = {name: np.zeros(len(texts), np.int64) for name in SCHEMA.names}
    for i, j, data, at in blocks(texts):
        m = j - i
        per = lambda where, weight=None: np.bincount(where, weight, m).astype(np.int64)
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        starts, ends, text = words_of(data, at)
        chars = points[ends] - points[starts]
        words = span_hashes(data, starts, ends)
        symbols = np.flatnonzero(_SYMBOL[data])
        cols["n_words"][i:j] = per(text)
        cols["word_chars"][i:j] = per(text, chars)
        cols["n_symbols"][i:j] = per(np.searchsorted(at, symbols, "right") - 1)
        cols["n_repeat_words"][i:j] = per(text, _in_repeated(words, text, 3))
        for n in _RUNS:
            cols[f"dup_chars_{n}"][i:j] = per(text, chars * _in_repeated(words, text, n))
        starts_l, ends_l, text_l = lines_of(data, at)
        with_word = np.searchsorted(starts, starts_l) < np.searchsorted(starts, ends_l)
        starts_l, ends_l, text_l = starts_l[with_word], ends_l[with_word], text_l[with_word]
        chars_l = points[ends_l] - points[starts_l]
        before = _seen_before(span_hashes(data, starts_l, ends_l) ^ (text_l.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        cols["n_dup_lines"][i:j] = per(text_l, before)
        cols["line_chars"][i:j] = per(text_l, chars_l)
        cols["dup_line_chars"][i:j] = per(text_l, chars_l * before)
    return pa.StructArray.from_arrays([pa.array(v) for v in cols.values()], list(cols))


@F.arrow_udf(SCHEMA)
def _measured(texts: pa.Array) -> pa.Array:
    return measure(texts)


def measures(text: Column) -> Column:
    """Struct of counts: words, characters, symbols, repeated lines, words and runs."""
    return _measured(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_WORDS_PCT * m["n_words"])


def too_repetitive(m: Column) -> Column:
    """The method's verdict: too many characters inside repeated runs or repeated lines."""
    bad = m["dup_line_chars"] > MAX_LINE_SHARE * m["line_chars"]
    for n, share in MAX_RUN_SHARE.items():
        bad = bad | (m[f"dup_chars_{n}"] > share * m["word_chars"])
    return bad


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its counts, `base_failed` and `kept`."""
    m = F.col("m")
    return (
        id_text(docs, id_col, text_col)
        .select("doc_id", measures(F.col("text")).alias("m"))
        .select("doc_id", "m.*", base_failed(m).alias("base_failed"), (~base_failed(m) & ~too_repetitive(m)).alias("kept"))
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that `assess` keeps, with all their columns."""
    m = measures(F.col(text_col))
    name = fresh(docs, "quality_measures")
    with_m = docs.withColumn(name, m)
    return with_m.where(~base_failed(F.col(name)) & ~too_repetitive(F.col(name))).drop(name)
