"""Operator 3, sharding: vector bin packing of bytes, tokens and rows.

Rows with equal text form a group and go to one shard together.  Groups above
1/4096 of the corpus in any dimension are placed one by one (there can be at
most 3 * 4096); all lighter groups are dealt by hash to three tiers of 1024
bundles, of falling size, so that the last ones even out what the first ones
leave.  The vectors (bytes, tokens, rows) of these units, a number bounded by
constants whatever the input, are placed in falling order: each goes to the
shard with room for it at which the dot product of its vector with the
residual capacity is highest.  A group above half a shard is the exception:
it is cut into pieces of 1/4096 by a hash of the ids, and the pieces are
placed on their own, as no shard could take it whole and stay equal.

A slot is the unit's offset in its shard plus the row's rank in the unit, so no
task ever sorts a shard.  Text is read once and never shuffled.

Defined cases: a null text counts as the empty text; rows with the same id, or
repeated rows, get a slot each (ranked by id, then text hash); a null id ranks
first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import id_text, written

SHARDS = 16
#: A group is heavy, and a piece is full, at one part in so many of the corpus.
PARTS = 4096
#: (per cent of the hash space, bundles) of each tier of light groups.
TIERS = ((75, 1024), (20, 1024), (5, 1024))
LAW = "bytes"
_DIMS = ("size", "tokens", "n")


def default_tokens(text: Column) -> Column:
    """Blank-separated pieces: a cheap stand-in where no token counts are at hand."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit (rows of bytes, tokens, rows as shares of the whole)."""
    room = np.full((shards, vectors.shape[1]), 1.0 / shards)
    out = np.zeros(len(vectors), np.int64)
    for u in np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1))):
        v = vectors[u]
        fits = room[:, 0] >= v[0]
        score = room @ v if fits.any() else room[:, 0]
        best = int(np.argmax(np.where(fits, score, -np.inf) if fits.any() else score))
        out[u] = best
        room[best] -= v
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, tokens, text_hash, law, shard, slot, grown_shard for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    source = id_text(docs, id_col, text_col) if tokens is None else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), tokens.alias("tokens"))
    rows = written(source.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        (default_tokens(text) if tokens is None else F.coalesce(F.col("tokens"), F.lit(0)).cast("long")).alias("tokens"), F.xxhash64(text).alias("text_hash")), "shard-rows")
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    total = rows.agg(*[F.sum(c).alias(c) for c in _DIMS[:2]], F.count("*").alias("n")).first()
    whole = np.array([max(1, total[c] or 0) for c in _DIMS], float)
    share = F.greatest(*[F.col(c) / F.lit(w) for c, w in zip(_DIMS, whole.tolist())])
    light_units = sum(n for _, n in TIERS)
    # at most 3 * PARTS rows: each holds over 1 / PARTS of one of three sums
    heavy = groups.where(share > 1.0 / PARTS).select("text_hash", share.alias("share")).orderBy("text_hash").collect()
    heavy_table = spark.createDataFrame(
        [(h.text_hash, light_units + i, int(np.ceil(h.share * PARTS)), bool(h.share > 0.5 / shards)) for i, h in enumerate(heavy)],
        "heavy_hash bigint, heavy_unit int, pieces int, apart boolean")
    spread = F.xxhash64("text_hash", F.lit(3))
    at, within = F.pmod(spread, F.lit(100)), F.shiftrightunsigned(spread, 20)
    light, above, first = None, 0, 0
    for percent, n in TIERS:
        above += percent
        unit = first + F.pmod(within, F.lit(n))
        light = F.when(at < above, unit) if light is None else light.when(at < above, unit)
        first += n
    dealt = rows.join(F.broadcast(heavy_table), rows["text_hash"] == F.col("heavy_hash"), "left").select(
        *rows.columns, F.coalesce("heavy_unit", light).cast("int").alias("unit"),
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("pieces")), F.lit(0)).cast("int").alias("piece"),
        F.coalesce("apart", F.lit(False)).alias("apart"))
    # bounded: the light bundles and at most 2 * 3 * PARTS pieces
    summary = dealt.groupBy("unit", "piece", "apart").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).orderBy("unit", "piece").collect()
    keys = [(r.unit, r.piece if r.apart else -1) for r in summary]
    number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    vectors = np.zeros((len(number), 3))
    for k, r in zip(keys, summary):
        vectors[number[k]] += np.array([r[c] for c in _DIMS]) / whole
    where = place(vectors, shards)
    offset, plan = [0] * shards, []
    for k, r in zip(keys, summary):
        s = int(where[number[k]])
        plan.append((r.unit, r.piece, s, offset[s]))
        offset[s] += r.n
    placed = spark.createDataFrame(plan, "unit int, piece int, shard int, offset long")
    rank = F.row_number().over(Window.partitionBy("unit", "piece").orderBy("doc_id", "text_hash"))
    return dealt.withColumn("rank", rank).join(F.broadcast(placed), ["unit", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "tokens", "text_hash")
