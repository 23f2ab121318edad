"""Operator 1, SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprints are 64 bits, cut into four segments of 16, each read as a word of
the perfect binary Golay code (23 bits, padded with zeros).  The key of a segment
is the 12-bit index of a code word: its *own* one (within 3 bits) or all its
*near* ones (within 4 bits: one, or six where the own one is 3 bits away).  If
two words differ in one bit or none, the own index of either is near the other.
At most four errors in four segments leave, in rising order, (0, 0), (0, 1, 1) or
(1, 1, 1, 1), so every link has one of these keys in common:

* two segments exact (six pairs);
* one segment exact and two by index, the own of one with a near of the other;
* the first three by index: two own ones with a near one, or the reverse.

That is some 160 keys of 32 to 40 bits for a fingerprint.  Buckets hold distinct
fingerprints.  A bucket of two is one comparison; in a larger one every member
is compared with two hubs (the least and the greatest), the links found are
joined into components, and only members of buckets that still hold two
components are compared with each other.  So a dense group costs a star for
each bucket, not all its pairs, and no link is lost.

Defined cases: null and empty text and text without words has fingerprint 0
and links like any other; a text of fewer words than a shingle is one shingle;
null ids give a null component only where no member has an id; repeated rows
and ties share a component; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import bitmap_test, fresh, id_text, written
from tillwise.llm.graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

#: First bits of the segments.
SEGMENTS = (0, 16, 32, 48)
#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011

#: Fingerprints whose keys are made at once.
KEY_ROWS = 1024
#: Bits of the maps that spare shuffling rows that no join wants (4 MB).
MAP_BITS = 25

_LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


# ---- fingerprints -------------------------------------------------------------------------

def fingerprint_of(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i: i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The 64-bit fingerprint as a (signed) long."""
    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint_of(t.as_py(), shingle) for t in texts), np.uint64, len(texts)).view(np.int64))
    return of(text)


# ---- Golay keys ---------------------------------------------------------------------------

def _remainder(words: np.ndarray) -> np.ndarray:
    """23-bit words modulo the generator: the 11-bit syndrome."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << bit - 11), rest)
    return rest


def _error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: error patterns of 4 bits or fewer (own one first, -1: none) and how many there are."""
    table, found = np.full((2048, 6), -1, np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for e, s in zip(errors.tolist(), _remainder(errors).tolist()):
            table[s, found[s]] = e
            found[s] += 1
    return table, found


_PATTERNS, _COUNTS = _error_patterns()


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word, indices of code words within 4 bits (own one first; -1: none)."""
    s = _remainder(words)
    errors = _PATTERNS[s]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11), _COUNTS[s]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key): the distinct keys of each fingerprint."""
    parts = [(prints.astype(np.uint64) >> np.uint64(at)).astype(np.int64) & 0xFFFF for at in SEGMENTS]
    near = [near_indices(p)[0] for p in parts]
    own = [n[:, :1] for n in near]
    tags, rows, keys = count(), [], []

    def add(tag: int, values: np.ndarray, there: np.ndarray) -> None:
        row, col = np.nonzero(there)
        rows.append(row)
        keys.append(values[row, col] | tag << 48)

    every = np.ones((len(prints), 1), bool)
    for i, j in combinations(range(4), 2):
        add(next(tags), (parts[i] << 16 | parts[j])[:, None], every)
    for i in range(4):
        for j, k in combinations([x for x in range(4) if x != i], 2):
            tag, exact = next(tags), parts[i][:, None] << 24
            add(tag, exact | own[j] << 12 | near[k], near[k] >= 0)
            add(tag, exact | near[j][:, 1:] << 12 | own[k], near[j][:, 1:] >= 0)
    tag = next(tags)
    add(tag, own[0] << 24 | own[1] << 12 | near[2], near[2] >= 0)
    both = (near[0][:, :, None] << 12 | near[1][:, None, :]).reshape(len(prints), -1)
    there = ((near[0] >= 0)[:, :, None] & (near[1] >= 0)[:, None, :]).reshape(len(prints), -1)
    there[:, 0] = False
    add(tag, both << 12 | own[2], there)
    return np.concatenate(rows), np.concatenate(keys)


def _folded(key):
    """Number or column: keys so folded that their low bits hold all of them (keys are not hashes)."""
    if isinstance(key, Column):
        return key.bitwiseXOR(F.shiftrightunsigned(key, 17)).bitwiseXOR(F.shiftrightunsigned(key, 34))
    return key ^ key >> 17 ^ key >> 34


def _with_keys(prints: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """(key, fp): the keys of all fingerprints; with `among`, few others than those in its `key`."""
    test = bitmap_test(among.select(_folded(F.col("key")).alias("key")), "key", MAP_BITS) if among is not None else None

    def run(batches):
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(whole), KEY_ROWS):
                fp = whole[at: at + KEY_ROWS]
                row, key = keys_of(fp.view(np.uint64))
                if test:
                    wanted = test(_folded(key))
                    row, key = row[wanted], key[wanted]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], ["key", "fp"])
    return prints.select("fp").mapInArrow(run, "key bigint, fp bigint")


# ---- links and components -----------------------------------------------------------------

def _bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for distinct non-null fingerprints; root is the least (signed) fingerprint reachable."""
    if max_bits > 4:
        raise ValueError("the keys find links of up to 4 bits")
    # a print makes some 160 rows: the few megabytes of prints are spread over all tasks first
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    hubs = written(_with_keys(spread).groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count("*").alias("n")).where("n > 1"), "simhash-hubs")
    large = F.col("n") > 2
    members = written(_with_keys(spread, hubs.where(large)).join(hubs.where(large), "key").where("fp <> low and fp <> high"), "simhash-buckets")
    linked = lambda a, b: _bits(F.col(a), F.col(b)) <= max_bits
    spokes = (
        hubs.where(linked("low", "high")).select(F.col("high").alias("u"), F.col("low").alias("v"))
        .unionByName(members.where(linked("fp", "low")).select(F.col("fp").alias("u"), F.col("low").alias("v")))
        .unionByName(members.where(linked("fp", "high")).select(F.col("high").alias("u"), F.col("fp").alias("v")))
    )
    first = written(components(spokes), "simhash-roots")
    # what the hubs did not settle: the other members of buckets that still hold two components
    open_ = members.where("n > 3").select("key", "fp")
    open_ = open_.join(first, open_["fp"] == first["node"], "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    mixed = open_.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    left = written(open_.join(mixed, "key"), "simhash-open")
    a, b = left.alias("a"), left.alias("b")
    late = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.root") < F.col("b.root")) & (_bits(F.col("a.fp"), F.col("b.fp")) <= max_bits))
    late = late.select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))
    second = components(late).select(F.col("node").alias("root"), F.col("root").alias("last"))
    return (
        prints.select("fp")
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"))
        .join(second, "root", "left")
        .select("fp", F.coalesce("last", "root").alias("root"))
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """A row per document: doc_id, fp (long), text_hash, root (least fingerprint) and component_id (least id of its component)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(id_text(docs, id_col, text_col).select("doc_id", fingerprint(F.col("text"), shingle).alias("fp"), F.xxhash64(text).alias("text_hash")), "simhash-prints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    rooted = written(distinct.join(classes(distinct, max_bits), "fp"), "simhash-classes")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the least id, with all its columns.

    Of several rows with that id, in the component, the text with the least hash stays, once.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    rows = written(found.groupBy("root", "doc_id", "text_hash").agg(F.first("component_id").alias("component_id"), F.count("*").alias("n")), "simhash-decided")
    stay = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(F.min(F.struct("text_hash", "n")).alias("stays"))
    stay = written(stay.select(F.col("doc_id").alias("stay_id"), "stays.*"), "simhash-stay")
    # documents are told by id and text; only those that go or are repeated meet their like, all others stay where they are
    told = lambda i, h: F.xxhash64(i, h)
    once = stay.where("n = 1").select("stay_id", F.col("text_hash").alias("stay_hash"))
    unsure = rows.join(once, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("text_hash") == F.col("stay_hash")), "left_anti")
    test = bitmap_test(unsure.select(told(F.col("doc_id"), F.col("text_hash")).alias("told")), "told", MAP_BITS)

    @F.arrow_udf(T.BooleanType())
    def may_go(values: pa.Array) -> pa.Array:
        return pa.array(test(values.to_numpy(zero_copy_only=False)))
    hashed, flag = fresh(docs, "text_hash"), fresh(docs, "may_go")
    with_hash = docs.withColumn(hashed, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).withColumn(flag, may_go(told(F.col(id_col), F.col(hashed))))
    asked = with_hash.where(F.col(flag))
    left = asked.join(stay, asked[id_col].eqNullSafe(stay["stay_id"]) & (asked[hashed] == stay["text_hash"]), "left_semi").dropDuplicates([id_col, hashed])
    return with_hash.where(~F.col(flag)).unionByName(left).drop(hashed, flag)
