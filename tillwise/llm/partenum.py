"""Operator 12, n-gram Jaccard join by PartEnum signatures.

Two sets of s and t shingles with Jaccard similarity of J or more differ in at
most (1 - J) / (1 + J) * (s + t) shingles.  Sets are dealt to size bands; sets of a
band, and those of the band below that are large enough to have a partner in it,
meet under the band's tag.  There the shingle domain is cut by hash into
n = d + 1 + slack parts, d being the most shingles in which a pair of the tag can
differ.  A signature is a part with the set's projection on it, and the subsets
of parts that must agree are enumerated down to single parts by pigeonhole: a pair
that differs in h shingles agrees in n - h parts or more.

Most of these agreements are not needed, and the worst can be left out with no
link lost.  Signatures have one order for all sets, heavy projections first, and
a set that differs from any partner in at most h parts gives its first h + 1 + `spare`
only; two partners then share at least 1 + `spare` of them, the heaviest.  (Parts
that hold nothing or one common shingle fall away here.)  Of the signatures that
some other set has too, each set then drops its `spare` most frequent ones under
each tag, again in one order for all, which leaves at least one shared: so a line
or passage that a third of all documents hold does not fill a bucket.

Buckets hold distinct sets, and each has a hub, the set that meets most others.
Links are looked for in three steps, each only where a bucket still holds two
components: every set is compared with the best hub that it meets; then the sets
of a bucket with its hub; then pairs of sets that hub can not tell apart.  For a set
x that adds a(x) shingles to the hub's and lacks r(x) of them, two sets differ in
a(x) + a(y) - 2 * common additions + |r(x) - r(y)| shingles at least.  Pairs with a common
addition meet by it, and the others can only be linked where a(x) + a(y) +
|r(x) - r(y)| is small, which a join over cells of (a, r) finds.  So in a large group
of near copies, whose changes are each copy's own, those too far from the hub are
settled without being compared with all others, and no link is lost.  A comparison
works out both whole sets and their exact intersection, so similarity is never estimated.

Shingles and sets are told apart by 64-bit hashes.  Defined cases: null and empty
text and text without words has no shingles, is linked with nothing and is its
own component; fewer words than a shingle are one shingle; equal sets are
linked; repeated rows and ties share a component; a null id gives a null component
only where no member has an id; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import bitmap_test, blocks, id_text, mixed, ngram_hashes, span_hashes, utf8_bytes, words_of, written
from tillwise.llm.graph import components

SHINGLE_WORDS = 5
PERCENT = 80

#: Parts above the least number, as a share of it: lighter parts, of which the lightest are left out.
SLACK = 0.42
#: Signatures that a set may drop as too frequent, as a share of the most differing shingles.
SPARE = 0.2
#: Bits of the map that spares shuffling signatures nobody shares (4 MB).
MAP_BITS = 25
#: Text bytes compared at once inside a task.
PAIR_BYTES = 1 << 20

_TAG = 0xD6E8FEB86659FD93


# ---- sets ---------------------------------------------------------------------------------

def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def sets_of(data: np.ndarray, at: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): text i of a block has the distinct shingles hashes[first[i]: first[i + 1]], in rising order."""
    data = lowered(data)
    starts, ends, text = words_of(data, at)
    words = span_hashes(data, starts, ends)
    n_texts = len(at) - 1
    count = np.bincount(text, minlength=n_texts)
    head = np.append(0, np.cumsum(count))
    grams = ngram_hashes(words, width)
    whole = np.flatnonzero(text[: len(grams)] == text[len(words) - len(grams):])
    owner, hashes = [text[whole]], [grams[whole]]
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        if len(short):
            owner.append(short)
            hashes.append(ngram_hashes(words, n)[head[short]])
    owner, hashes = np.concatenate(owner), np.concatenate(hashes)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.append(0, np.cumsum(np.bincount(owner, minlength=n_texts)))


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums modulo 2 ** 64 of values[first: last]."""
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=run[1:])
    return run[last] - run[first]


def nodes_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each set, the same for equal sets."""
    return mixed(_sums(mixed(hashes), first[:-1], first[1:]) + np.diff(first).astype(np.uint64)).view(np.int64)


# ---- signatures ---------------------------------------------------------------------------

def bands(size: np.ndarray) -> np.ndarray:
    """The least size of each size's band: 1, 5, 10, 20, ...; a band ends before twice its least size (the first at 4)."""
    at = np.maximum(size, 5) // 5
    lo = 5 << np.floor(np.log2(at)).astype(np.int64)
    return np.where(size < 5, 1, lo)


def shape_of(lo: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(parts, spare) of the tag of the band that starts at `lo`."""
    hi = np.where(lo == 1, 4, 2 * lo - 1)
    differ = 2 * hi * (100 - percent) // (100 + percent)
    return differ + 1 + np.ceil(SLACK * (differ + 1)).astype(np.int64), np.ceil(SPARE * differ).astype(np.int64)


def signatures_of(hashes: np.ndarray, first: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, ...]:
    """(key, set number, size, tag, spare) of the signatures that the sets of a block give."""
    size = np.diff(first)
    lo = bands(size)
    up = np.where(lo == 1, 5, 2 * lo)
    own = np.flatnonzero(size > 0)
    above = np.flatnonzero((size > 0) & (100 * size >= percent * up))
    owner, tag = np.concatenate([own, above]), np.concatenate([lo[own], up[above]])
    hi = np.where(tag == 1, 4, 2 * tag - 1)
    partner = np.minimum(hi, 100 * size[owner] // percent)
    differ = (size[owner] + partner) * (100 - percent) // (100 + percent)
    some = hi * 2 * (100 - percent) // (100 + percent) > 0  # else only equal sets are linked, and those are one node
    owner, tag, differ = owner[some], tag[some], differ[some]
    parts, spare = shape_of(tag, percent)
    base = np.append(0, np.cumsum(parts))
    # elements of each (set, tag), one after the other; hashes rise, so those of a part are neighbours
    n = size[owner]
    row = np.repeat(np.arange(len(owner)), n)
    element = hashes[np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(n))[:-1], n) + np.repeat(first[owner], n)]
    part = ((element >> np.uint64(32)) * parts[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64) + base[row]
    weight = np.bincount(part, minlength=base[-1])
    ends = np.cumsum(weight)
    total = _sums(mixed(element ^ np.uint64(_TAG)), ends - weight, ends)
    row = np.repeat(np.arange(len(owner)), parts)
    place = np.arange(len(row)) - base[row]
    key = mixed(total + mixed((tag[row] << 32 | place).astype(np.uint64) + np.uint64(_TAG)))
    # one order for all sets: heavy projections first; the first `differ + 1 + spare` are given
    order = np.lexsort((key, -weight, row))
    given = np.arange(len(row)) - base[row] < np.minimum(differ + 1 + spare, parts)[row]
    order = order[given]
    row = row[order]
    return key[order].view(np.int64), owner[row], n[row].astype(np.int32), tag[row].astype(np.int32), spare[row].astype(np.int32)


def _sized(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, node (null without words) and n_shingles of every document."""
    def run(batches):
        for batch in batches:
            for i, j, data, at in blocks(batch.column(1)):
                hashes, first = sets_of(data, at, width)
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(nodes_of(hashes, first), mask=n == 0), pa.array(n)], ["doc_id", "node", "n_shingles"])
    return docs.mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("node bigint, n_shingles bigint").fields]))


def _keys(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, _, data, at in blocks(batch.column(0)):
                hashes, first = sets_of(data, at, width)
                key, owner, *_ = signatures_of(hashes, first, percent)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(nodes_of(hashes, first)[owner])], ["key", "node"])
    return docs.select("text").mapInArrow(run, "key bigint, node bigint")


def _shared_keys(docs: DataFrame, shared: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of `_keys` whose key may be in `shared`, with size, tag and spare."""
    test = bitmap_test(shared, "key", MAP_BITS)

    def run(batches):
        for batch in batches:
            for _, _, data, at in blocks(batch.column(0)):
                hashes, first = sets_of(data, at, width)
                key, owner, size, tag, spare = signatures_of(hashes, first, percent)
                there = test(key)
                yield pa.RecordBatch.from_arrays([pa.array(x[there]) for x in (key, nodes_of(hashes, first)[owner], size, tag, spare)], ["key", "node", "size", "tag", "spare"])
    return docs.select("text").mapInArrow(run, "key bigint, node bigint, size int, tag int, spare int")


# ---- comparison ---------------------------------------------------------------------------

def compared(left: pa.Array, right: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, ...]:
    """Pair by pair: set sizes, shingles in both; and (pair, hash) of what the right one adds."""
    data, at = utf8_bytes(pa.concat_arrays([left.cast(pa.large_string()), right.cast(pa.large_string())]))
    m = len(left)
    hashes, first = sets_of(data, at, width)
    n = np.diff(first)
    text = np.repeat(np.arange(2 * m), n)
    side, pair = text // max(m, 1), text % max(m, 1)
    order = np.lexsort((side, hashes, pair))
    side, pair, hashes = side[order], pair[order], hashes[order]
    same = np.zeros(len(pair), bool)
    same[1:] = (pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])
    more = (side == 1) & ~same
    return n[:m], n[m:], np.bincount(pair[same], minlength=m), pair[more], hashes[more]


def enough(both: Column | np.ndarray, left: Column | np.ndarray, right: Column | np.ndarray, percent: int = PERCENT) -> Column | np.ndarray:
    return 100 * both >= percent * (left + right - both)


def _texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, text), one text for each node of `wanted` (node, first_id); the text of its least document."""
    ids = wanted.select("node", F.xxhash64("first_id").alias("held"))
    test = bitmap_test(ids, "held", MAP_BITS)

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column(0).to_numpy(zero_copy_only=False))))
            for i, j, data, at in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(nodes_of(*sets_of(data, at, width))), batch.column(1).slice(i, j - i)], ["held", "node", "text"])
    near = docs.select(F.xxhash64("doc_id").alias("held"), "text").mapInArrow(run, "held bigint, node bigint, text string")
    return near.join(ids, ["held", "node"]).dropDuplicates(["held", "node"]).select("node", "text")


def _compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """For pairs (u, v): set sizes su and sv, shingles in both, and those that v has and u has not.

    v's text travels to u, so the text of a hub u moves once.
    """
    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ends = utf8_bytes(left)[1][1:] + utf8_bytes(right)[1][1:]
            i = 0
            while i < len(ends):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIR_BYTES, "right")))
                su, sv, both, pair, more = compared(left.slice(i, j - i), right.slice(i, j - i), width)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(pair, minlength=j - i))).astype(np.int32)), pa.array(more.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(su), pa.array(sv), pa.array(both), lists], ["u", "v", "su", "sv", "both", "more"])
                i = j
    met = pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v").join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
    return met.select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint, su bigint, sv bigint, both bigint, more array<bigint>")


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    return _compared(pairs, texts, width).where(enough(F.col("both"), F.col("su"), F.col("sv"), percent)).select("u", "v")


def _may_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _open(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """key, node, size, root and the hub (with its size and root) of the members of buckets that hold two components."""
    now = members.withColumn("root", F.col("node")) if roots is None else (
        members.join(roots, "node", "left").select("key", "node", "size", "weight", F.coalesce("root", "node").alias("root")))
    ends = now.groupBy("key").agg(F.max(F.struct("weight", "node", "size", "root")).alias("hub"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
    return now.join(ends.select("key", "hub"), "key").select("key", "node", "size", "root", "hub")


def _unlike(facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) under one hub, in different components, that their differences from the hub leave open.

    `facts`: hub, hub_size, hub_root, node, size, root, a (additions), r (lacking shingles) and more (the
    additions).  One of a pair, x, is not in the hub's component.
    """
    loose = (F.col("root") != F.col("hub_root")).alias("loose")
    rows = facts.select("hub", "node", "size", "root", "a", "r", "more", loose)
    differ = F.floor((F.col("x.size") + F.col("y.size")) * F.lit(100 - percent) / F.lit(100 + percent))
    apart = F.col("x.loose") & (F.col("x.root") != F.col("y.root")) & (~F.col("y.loose") | (F.col("x.node") < F.col("y.node"))) & _may_fit("x.size", "y.size", percent)
    gap = F.col("x.a") + F.col("y.a") + F.abs(F.col("x.r") - F.col("y.r"))
    # a common addition
    each = rows.select("hub", "node", "size", "root", "a", "r", "loose", F.explode("more").alias("at"))
    by_more = each.where("loose").alias("x").join(each.alias("y"), (F.col("x.hub") == F.col("y.hub")) & (F.col("x.at") == F.col("y.at")) & apart)
    by_more = by_more.groupBy("x.hub", F.col("x.node").alias("u"), F.col("y.node").alias("v")).agg(F.min(gap - differ).alias("beyond"), F.count("*").alias("common"))
    by_more = by_more.where("beyond <= 2 * common").select("u", "v")
    # none: cells of a width that grows with the sizes, so that a set reaches a fixed number of them
    # (partners are in one band or in adjacent ones, hence the width of the hub's band)
    most = F.floor(F.col("size") * F.lit(100 - percent) / F.lit(percent)).cast("long") + 1  # differing shingles, any partner
    cell = F.greatest(F.lit(1), F.floor(F.col("hub_size") / F.lit(8 * 9))).cast("long")
    cells = facts.select("hub", "node", "size", "root", "a", "r", loose, (most - F.col("a")).alias("room"), cell.alias("w"))
    home = cells.select("hub", "node", "size", "root", "a", "r", "loose", F.floor(F.col("a") / F.col("w")).alias("ca"), F.floor(F.col("r") / F.col("w")).alias("cr"))
    reach = cells.where("loose and room >= 0").withColumn("ca", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("room") / F.col("w")))))
    left = F.col("room") - F.col("ca") * F.col("w")  # what |r - r'| may still be
    reach = reach.withColumn("cr", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("r") - left) / F.col("w"))).cast("long"), F.floor((F.col("r") + left) / F.col("w")).cast("long"))))
    by_cell = reach.alias("x").join(home.alias("y"), (F.col("x.hub") == F.col("y.hub")) & (F.col("x.ca") == F.col("y.ca")) & (F.col("x.cr") == F.col("y.cr"))
                                    & apart & (gap <= differ))
    found = by_more.unionByName(by_cell.select(F.col("x.node").alias("u"), F.col("y.node").alias("v")))
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def classes(docs: DataFrame, sized: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(node, root) for the nodes that are linked with another one."""
    shared = written(_keys(docs, width, percent).groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
                     .where("low < high").select("key", "n"), "partenum-shared")
    found = _shared_keys(docs, shared, width, percent).join(shared, "key").distinct()
    rank = F.row_number().over(Window.partitionBy("node", "tag").orderBy(F.desc("n"), "key"))
    # how many others a set meets: greatest for the least changed of a group of near copies
    weight = F.sum("n").over(Window.partitionBy("node"))
    members = written(found.withColumn("rank", rank).withColumn("weight", weight).where("rank > spare").select("key", "node", "size", "weight"), "partenum-members")
    firsts = sized.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    texts = written(_texts(docs, members.select("node").distinct().join(firsts, "node"), width), "partenum-texts")

    # 1: every set with the best hub of its buckets
    met = _open(members, None).where((F.col("node") != F.col("hub.node")) & _may_fit("size", "hub.size", percent))
    best = met.groupBy("node").agg(F.max(F.struct("hub.weight", "hub.node")).alias("hub")).select(F.col("hub.node").alias("u"), F.col("node").alias("v"))
    links = written(_links(best, texts, width, percent), "partenum-links")
    roots = written(components(links), "partenum-roots")

    # 2: the sets of open buckets with the bucket's hub
    open_ = written(_open(members, roots).groupBy("node", "hub.node").agg(F.first("size").alias("size"), F.first("hub.size").alias("hub_size")).toDF("node", "hub", "size", "hub_size"), "partenum-open")
    facts = written(_compared(open_.select(F.col("hub").alias("u"), F.col("node").alias("v")), texts, width).select(
        F.col("u").alias("hub"), F.col("v").alias("node"), F.col("sv").alias("size"), F.col("su").alias("hub_size"), (F.col("sv") - F.col("both")).alias("a"), (F.col("su") - F.col("both")).alias("r"), "both", "more"), "partenum-facts")
    links = links.unionByName(facts.where(enough(F.col("both"), F.col("hub_size"), F.col("size"), percent) & (F.col("hub") != F.col("node"))).select(F.col("hub").alias("u"), F.col("node").alias("v")))
    roots = written(components(links), "partenum-roots")

    # 3: what the hubs leave open
    rooted = facts.drop("both").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_ = rooted.groupBy("hub").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max(F.when(F.col("node") == F.col("hub"), F.col("root"))).alias("hub_root"))
    mixed_ = mixed_.where("r0 < r1").select("hub", "hub_root")
    pairs = _unlike(written(rooted.join(mixed_, "hub"), "partenum-unlike"), percent)
    links = links.unionByName(written(_links(pairs, texts, width, percent), "partenum-links"))
    return written(components(links), "partenum-roots")


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, n_shingles (size of its set) and component_id (least id of its component)."""
    read = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = written(_sized(read, width), "partenum-sizes")
    roots = classes(read, sized, width, percent)
    rooted = sized.join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
