"""Operator 11, phrase collocation mining by best-first branch-and-bound growth.

Phrases of two and three words are scored per language by their weakest cut,
a * a / (l * r).  Words and pairs are counted over all texts, pairs only of words that
are frequent enough themselves.  Three-word phrases are grown from pairs: a phrase
with the prefix (x, y) occurs at most as often as its prefix, and its rest at least
as often as itself, so its cut after x scores at most f(x y) / f(x), and this bound
comes from prefix counts alone.  The frontier of pairs is expanded best first: with
a threshold per language, the score of its `limit` * 2-th pair, all pairs of a
bound at or above it are expanded in one pass over the texts, and so are pairs with such a
score to the left (three-word phrases that end in them), as these decide whether
the pair survives.  All phrases at or above the threshold are then known, with
ties.  A language is settled when `limit` of them survive, or when its frontier is
used up; the others go on with a threshold four times as deep.

Occurrences are summed inside a block of text before they are shuffled, and a
bitmap of fixed size spares shuffling those that no open pair wants.  Words are
told apart by 64-bit hashes (which hold the language), phrases by those of their words;
scores are worked out in decimals of 38 digits.

Defined cases: null and empty text has no words; a null language is `und`; null
ids, repeated rows and other columns do not matter (every row's words count); ties
in score go by count, then by the phrase's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import bitmap_test, blocks, mixed, span_hashes, words_of, written
from tillwise.llm.partenum import lowered

LIMIT = 2000
MIN_COUNT = 10
#: A pair goes where a longer phrase has this share of its occurrences, in percent.
DROP_PERCENT = 50
MAP_BITS = 25
#: Parts in which the best of a language are looked for first.
SALTS = 64

_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE = _BETWEEN.copy()
_SPACE[[0x20, 0x09]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- counting -----------------------------------------------------------------------------

def words_in(data: np.ndarray, at: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, starts, ends, text, joined) of the words of a block: `joined` where a word goes on in the piece of the one before."""
    starts, ends, text = words_of(data, at, _SPACE)
    hashes = mixed(span_hashes(data, starts, ends) ^ langs[text])
    pieces = np.append(0, np.cumsum(_BETWEEN[data]))
    joined = np.zeros(len(starts), bool)
    joined[1:] = (text[1:] == text[:-1]) & (pieces[starts[1:]] == pieces[starts[:-1]])
    return hashes, starts, ends, text, joined


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _ODD + b).view(np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, count = np.unique(keys, return_index=True, return_counts=True)
    return first, count


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    size = ends - starts
    at = np.append(0, np.cumsum(size))
    taken = data[np.arange(at[-1]) + np.repeat(starts - at[:-1], size)].astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(taken.tobytes())).cast(pa.string())


def _word_rows(texts: DataFrame) -> DataFrame:
    """h, lang, word, c summed by block; the empty word stands for all words of the language."""
    def run(batches):
        for batch in batches:
            lang, langs = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, j, data, at in blocks(batch.column(2)):
                data = lowered(data)
                h, starts, ends, text, _ = words_in(data, at, langs[i:j])
                first, count = _counted(h)
                names = ["h", "lang", "word", "c"]
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), lang.take(pa.array(i + text[first])), _strings(data, starts[first], ends[first]), pa.array(count)], names)
                one, total = np.unique(langs[i:j][text], return_inverse=True)
                where = np.zeros(len(one), np.int64)
                where[total] = i + text
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), lang.take(pa.array(where)), pa.array([""] * len(one), pa.string()), pa.array(np.bincount(total, minlength=len(one)))], names)
    return texts.mapInArrow(run, "h bigint, lang string, word string, c bigint")


def _pair_rows(texts: DataFrame, words: DataFrame) -> DataFrame:
    """x, y, c (summed by block) of the pairs whose two words may be frequent enough."""
    frequent = bitmap_test(words, "h", MAP_BITS)

    def run(batches):
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, j, data, at in blocks(batch.column(2)):
                h, *_, joined = words_in(lowered(data), at, langs[i:j])
                often = frequent(h.view(np.int64))
                y = np.flatnonzero(joined[1:] & often[1:] & often[:-1]) + 1
                first, count = _counted(pair_hash(h[y - 1], h[y]))
                y = y[first]
                yield pa.RecordBatch.from_arrays([pa.array(h[y - 1].view(np.int64)), pa.array(h[y].view(np.int64)), pa.array(count)], ["x", "y", "c"])
    return texts.mapInArrow(run, "x bigint, y bigint, c bigint")


def _triple_rows(texts: DataFrame, pairs: DataFrame, frontier: DataFrame, contenders: DataFrame) -> DataFrame:
    """x, y, z, c (summed by block) of the phrases grown from the frontier, or to the left of a contender, both of whose pairs may be frequent enough."""
    hashed = lambda df: bitmap_test(df.select("p"), "p", MAP_BITS)
    often, grown, ending = hashed(pairs), hashed(frontier), hashed(contenders)

    def run(batches):
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, j, data, at in blocks(batch.column(2)):
                h, *_, joined = words_in(lowered(data), at, langs[i:j])
                p = pair_hash(h[:-1], h[1:])
                p, there = (p, joined[1:] & often(p)) if len(h) > 1 else (p, joined[1:])
                z = np.flatnonzero(there[1:] & there[:-1]) + 2
                z = z[grown(p[z - 2]) | ending(p[z - 1])]
                first, count = _counted(pair_hash(p[z - 2].view(np.uint64), h[z]))
                z = z[first]
                yield pa.RecordBatch.from_arrays([*(pa.array(h[z - k].view(np.int64)) for k in (2, 1, 0)), pa.array(count)], ["x", "y", "z", "c"])
    return texts.mapInArrow(run, "x bigint, y bigint, z bigint, c bigint")


# ---- scores -------------------------------------------------------------------------------

def score(a: str, l: str, r: str) -> Column:
    """floor(1000000 * a * a / (l * r)), exactly."""
    wide = lambda c: f"cast({c} as decimal(38,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))) div ({wide(l)} * {wide(r)})")


def _best(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of each language, with their rank: first in parts, so that no task sorts a whole language."""
    part = df.withColumn("salt", F.pmod(F.xxhash64("x", "y"), F.lit(SALTS)))
    few = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= n)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= n).drop("salt")


def _scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """x, y, z, lang, a, l, r, score by the weakest cut."""
    head = pairs.select("x", "y", "lang", F.col("c").alias("f12"), F.col("l").alias("f1"))
    tail = pairs.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("c").alias("f23"), F.col("r").alias("f3"))
    both = triples.withColumnRenamed("c", "a").join(head, ["x", "y"]).join(tail, ["y", "z"])
    both = both.withColumn("s1", score("a", "f1", "f23")).withColumn("s2", score("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    return both.select("x", "y", "z", "lang", "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limit: int = LIMIT, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best `limit` phrases."""
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("code"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = _word_rows(texts).groupBy("h", "lang", "word").agg(F.sum("c").alias("c"))
    words = written(counted.where((F.col("c") >= min_count) | (F.col("word") == "")), "collocations-words")
    frequent, totals = words.where("word <> ''"), words.where("word = ''").select("lang", F.col("c").alias("n"))
    count = frequent.select("h", "lang", "c")
    often = _pair_rows(texts, frequent).groupBy("x", "y").agg(F.sum("c").alias("c")).where(F.col("c") >= min_count)
    pairs = often.join(count.select(F.col("h").alias("x"), "lang", F.col("c").alias("l")), "x").join(count.select(F.col("h").alias("y"), F.col("c").alias("r")), "y")
    pairs = pairs.withColumn("score", score("c", "l", "r")).withColumn("bound", F.expr("(cast(1000000 as decimal(7,0)) * cast(c as decimal(18,0))) div cast(l as decimal(18,0))"))
    # pair_hash of the two words, for the bitmaps
    pairs = written(_with_hash(pairs), "collocations-pairs")

    deep, settled = 2 * limit, []
    open_ = pairs.select("lang").distinct()
    while True:
        mine_ = pairs.join(open_, "lang")
        cut = _best(mine_, deep, F.desc("score"), "x", "y").groupBy("lang").agg(F.when(F.count("*") >= deep, F.min("score")).otherwise(F.lit(0)).alias("least"))
        held = written(mine_.join(cut, "lang"), "collocations-open")
        contenders = held.where("score >= least")
        triples = _triple_rows(texts, held, held.where("bound >= least"), contenders).groupBy("x", "y", "z").agg(F.sum("c").alias("c")).where(F.col("c") >= min_count)
        triples = written(_scored_triples(triples, held), "collocations-triples")
        longest = triples.select("x", "y", "a").unionByName(triples.select(F.col("y").alias("x"), F.col("z").alias("y"), "a")).groupBy("x", "y").agg(F.max("a").alias("longest"))
        alone = contenders.join(longest, ["x", "y"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < DROP_PERCENT * F.col("c")))
        alone = alone.select("x", "y", F.lit(None).cast("bigint").alias("z"), "lang", F.col("c").alias("a"), "l", "r", "score", "least")
        known = written(alone.unionByName(triples.join(cut, "lang").where("score >= least")), "collocations-known")
        done = cut.join(known.groupBy("lang").agg(F.count("*").alias("found")), "lang", "left").select("lang", ((F.col("found") >= limit) | (F.col("least") == 0)).alias("done"))
        done = written(done, "collocations-done")
        settled.append(known.join(done.where("done").select("lang"), "lang").drop("least"))
        open_ = done.where("not coalesce(done, false)").select("lang")
        if not open_.head(1):
            break
        deep *= 4
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    name = lambda k: frequent.select(F.col("h").alias(k), F.col("word").alias(f"word_{k}"))
    named = found.join(name("x"), "x").join(name("y"), "y").join(name("z"), "z", "left").withColumn("phrase", F.concat_ws(" ", "word_x", "word_y", "word_z"))
    best = _best(named, limit, F.desc("score"), F.desc("a"), "phrase")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _with_hash(pairs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("x", "y"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pair_hash(x, y))], [*batch.schema.names, "p"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return pairs.mapInArrow(run, f"{kinds}, p bigint")
