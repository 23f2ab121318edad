"""Operator 2, substring dedup by compact windows.

Tokens are five-word shingles.  For each hash function a Cartesian tree over a
text's min-hashes gives the compact windows (l, c, r): the subsequences between
l and r that hold c all have c's hash as their least one.  Of these,
subsequences of exactly WINDOW shingles (50 words) form an interval of starts;
the intervals of a text are disjoint.  An interval join of the intervals of the
two functions of a band gives signatures: runs of 50-word passages with the same
two min-hashes.  A signature counts where two different texts have it.

Runs of a signature with the same shingles around the same min-hash are one
content: its first text speaks for all.  A signature with one content is settled
by that; the first texts of the others are read again, and their contents are
verified in two tiers:

* exact: the hash of every 50-word passage inside a run; equal ones are
  repeats.  As passages that are equal have equal signatures, this finds every
  repeat of 50 words or more, whatever surrounds it.
* near: aligned at the shared min-hash, two 50-word passages with a Jaccard
  similarity of 0.8 or more of their shingles are near duplicates.  In each
  signature's group, contents are first compared with two hubs (those of the
  least and the greatest first text).  Where that leaves several components,
  contents meet again in buckets of their shingles that are rarest in the group:
  near ones share a bucket without exception.  A bucket gets two hubs too; what
  these leave unlinked is compared in full.  Linked contents are one class.

A group costs a row or two for each member, and pairs only inside buckets that
no hub settles; sums are combined before shuffles and joins on a hot signature
can be split.  A run has
at most 46 starts, so what is found in one is one passage.  Equal texts have
equal rows, whose sums do not tell them apart; each copy gets its rows in the
end.

The result has a row for each passage and class of each document: words start
to end, exclusive, and class_id, the least document id of the texts it was
found equal or near to (itself included).  Overlapping and adjoining repeats of
one class are merged; those of several classes have a row each, so that every
link between two texts is a class that both have.  Defined cases: null, empty and shorter texts have no passage and
no row; null ids are kept (a class has a null id only if all its members
have); repeated rows are copies of one text and get a row each; tied hashes in
a text go to the leftmost; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm import graph
from tillwise.llm.common import (bitmap_test, blocks, dropped, dropped_table, id_text, mixed, ngram_hashes, powers, shuffles_removed, span_hashes,
                                 words_of, written)
from tillwise.session import shared_path

SHINGLE_WORDS = 5
MIN_WORDS = 50
SIMILARITY = 0.8
#: Seeds of the hash functions, two for each band.
BANDS = ((0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47), (0x6A09E667F3BCC909, 0xD1B54A32D192ED03))
#: Lowest bits of a signature that tell its band.
BAND_BITS = 3
#: Bits of the map of texts worth shuffling (8 MB), a power of two.
MAP_BITS = 26
WINDOW = MIN_WORDS - SHINGLE_WORDS + 1
#: Windows handled at once when their rarest shingles are looked for (6 MB).
PLACE_WINDOWS = 1 << 14
_ODD = 0xC6BC279692B5C323
_INVERSE = pow(_ODD, -1, 1 << 64)


# ---- compact windows ----------------------------------------------------------------------

def _sliding(v: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of each run of `width` values."""
    n = len(v)
    if n < width:
        return v[:0]
    pad = -n % width
    last = np.iinfo(np.uint64).max if best is np.minimum else np.uint64(0)
    grid = np.append(v, np.full(pad, last, np.uint64)).reshape(-1, width)
    before = best.accumulate(grid, axis=1).ravel()
    after = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(after[: n - width + 1], before[width - 1: n])


def _tree(values: np.ndarray, spots: np.ndarray, owner: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Span (left, right) of each node of the Cartesian trees over the spots' values, one tree a text; of equal values the leftmost is above.

    All nodes climb at once: one that is not yet at a smaller value goes on to where the node it has reached has got to.
    """
    node = np.arange(1, len(spots) + 1) + np.cumsum(np.diff(owner, prepend=owner[:1]) != 0)
    size = int(node[-1]) + 2 if len(node) else 2
    # a zero before and after each text is smaller than any value
    held, place = np.zeros(size, np.uint64), np.zeros(size, np.int64)
    held[node], place[node] = values, spots
    ends = []
    for step in (-1, 1):
        at = np.arange(size)
        at[node] += step
        climbing = node
        while len(climbing):
            met = held[at[climbing]]
            climbing = climbing[met > held[climbing] if step < 0 else met >= held[climbing]]
            at[climbing] = at[at[climbing]]
        ends.append(at[node])
    left, right = ends
    return np.where(held[left] > 0, place[left] + 1, first[owner]), np.where(held[right] > 0, place[right], last[owner]) - 1


def compact_windows(v: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all compact windows of `width` or more values.

    v holds the values of several texts; text i is v[first[i]: last[i]].  Only
    values that are the least of some window are put through the tree: the
    nearest smaller value of such a one is always such a one itself.
    """
    n = len(v)
    starts = np.zeros(n + 1, np.int64)
    long_enough = last - first >= width
    np.add.at(starts, first[long_enough], 1)
    np.add.at(starts, last[long_enough] - width + 1, -1)
    valid = np.cumsum(starts[:n])[: max(0, n - width + 1)] > 0
    least = _sliding(v, width, np.minimum)
    # a value is the least of a window if the greatest window minimum around it is its own
    held = np.where(valid, least, np.uint64(0))
    around = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), held, np.zeros(width - 1, np.uint64)]), width, np.maximum)[:n] if n >= width else v[:0]
    spots = np.flatnonzero((around == v[: len(around)]) & (around > 0))
    owner = np.searchsorted(first, spots, "right") - 1
    left, right = _tree(v[spots], spots, owner, first, last)
    wide = right - left + 1 >= width
    return left[wide], spots[wide], right[wide]


def shingles_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes, first, last): text i of the block has shingles first[i] to last[i]."""
    starts, ends, text = words_of(data, at)
    grams = ngram_hashes(span_hashes(data, starts, ends), SHINGLE_WORDS)
    texts = np.arange(len(at) - 1)
    first = np.searchsorted(text, texts)
    last = np.searchsorted(text, texts, "right") - SHINGLE_WORDS + 1
    return grams, np.minimum(first, len(grams)), np.maximum(np.minimum(first, len(grams)), last)


def runs_of(grams: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(key, text, lo, hi, spot): runs of window starts with the same pair of min-hashes; places count in the text."""
    out = []
    for band, seeds in enumerate(BANDS):
        parts = []
        for seed in seeds:
            v = mixed(grams ^ np.uint64(seed)) | np.uint64(1)
            l, c, r = compact_windows(v, first, last, width)
            lo, hi = np.maximum(l, c - width + 1), np.minimum(c, r - width + 1)
            parts.append((lo, hi, c, v[c]))
        (lo1, hi1, c1, v1), (lo2, hi2, c2, v2) = parts
        starts = np.union1d(lo1, lo2)
        if not len(starts):
            continue
        i, j = np.searchsorted(lo1, starts, "right") - 1, np.searchsorted(lo2, starts, "right") - 1
        key = mixed(v1[i] * np.uint64(_ODD) + v2[j]) & ~np.uint64(BAND_BITS) | np.uint64(band)
        text = np.searchsorted(first, starts, "right") - 1
        head = first[text]
        out.append((key, text, starts - head, np.minimum(hi1[i], hi2[j]) - head, c1[i] - head))
    if not out:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def _sums(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and the powers that take a run's place out of their difference."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(grams * powers(_ODD, len(grams)), out=sums[1:])
    return sums, powers(_INVERSE, len(grams) + 1)


def _signatures(texts: DataFrame) -> DataFrame:
    """A row per run of a text: key, tid, place (first start, then 6 bits each: last start and spot, from the first), content;
    and for a text of MIN_WORDS or more a row without key, whose place is its number of words."""
    def run(batches):
        for batch in batches:
            tid = batch.column(0).to_numpy(zero_copy_only=False)
            for i, _, data, at in blocks(batch.column(1)):
                grams, first, last = shingles_of(data, at)
                key, text, lo, hi, spot = runs_of(grams, first, last)
                place = lo << 12 | hi - lo << 6 | spot - lo
                sums, back = _sums(grams)
                head = first[text] + lo
                content = mixed((sums[head + hi - lo + WINDOW] - sums[head]) * back[head] + (place & 4095).astype(np.uint64))
                whole = np.flatnonzero(last - first >= WINDOW)
                none = pa.nulls(len(whole), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([pa.array(key.view(np.int64)), none]),
                    pa.array(tid[i + np.append(text, whole)]),
                    pa.array(np.append(place, (last - first)[whole] + SHINGLE_WORDS - 1)),
                    pa.concat_arrays([pa.array(content.view(np.int64)), none])], ["key", "tid", "place", "content"])
    return texts.select("tid", "text").mapInArrow(run, "key bigint, tid bigint, place bigint, content bigint")


def _few_but(rows: DataFrame, among: DataFrame) -> DataFrame:
    """Rows whose key is in `among`, and few others."""
    test = bitmap_test(among, "key", MAP_BITS)

    @F.arrow_udf(T.BooleanType())
    def wanted(key: pa.Array) -> pa.Array:
        return pa.array(test(key.to_numpy(zero_copy_only=False)))
    return rows.where(wanted(F.col("key")))


# ---- verification -------------------------------------------------------------------------

def _windows(open_: DataFrame) -> DataFrame:
    """For (tid, text, runs): a row per 50-word passage in the first band's runs (tier 0, its hash as key) and per run (tier 1, with its shingles)."""
    def run(batches):
        names = ["tier", "key", "run", "off", "tid", "far", "hub", "spot", "near"]
        for batch in batches:
            tids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            fields = lists.flatten()
            number, key, place, far = (fields.field(n).to_numpy(zero_copy_only=False) for n in ("run", "key", "place", "far"))
            hub = fields.field("hub").to_numpy(zero_copy_only=False)
            for i, j, data, at in blocks(batch.column(1)):
                grams, first, _ = shingles_of(data, at)
                sums, back = _sums(grams)
                mine = np.arange(ends[i], ends[j])
                text = np.repeat(np.arange(i, j), np.diff(ends[i: j + 1]))
                lo, more = first[text - i] + (place[mine] >> 12), place[mine] >> 6 & 63
                # equal passages have equal signatures in every band: the first one's tell all
                starts = np.where(key[mine] & BAND_BITS == 0, more + 1, 0)
                each = np.repeat(np.arange(len(mine)), starts)
                off = np.arange(len(each)) - np.repeat(np.cumsum(starts) - starts, starts)
                s = lo[each] + off
                whole = mixed((sums[s + WINDOW] - sums[s]) * back[s])
                short = (grams >> np.uint64(32)).astype("<u4")
                near = [short[x: x + m + WINDOW].tobytes() for x, m in zip(lo.tolist(), more.tolist())]
                n, m, rows = len(s), len(mine), np.append(each, np.arange(len(mine)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([0, 1], [n, m]).astype(np.int32)),
                    pa.array(np.append(whole.view(np.int64), key[mine])),
                    pa.array(number[mine][rows]),
                    pa.array(np.append(off, np.zeros(m, np.int64)).astype(np.int32)),
                    pa.array(tids[text][rows]),
                    pa.array(far[mine][rows]),
                    pa.array(hub[mine][rows].astype(bool)),
                    pa.array([None] * n + (place[mine] & 63).tolist(), pa.int32()),
                    pa.array([None] * n + near, pa.binary())], names)
    return open_.mapInArrow(run, "tier int, key bigint, run bigint, off int, tid bigint, far bigint, hub boolean, spot int, near binary")


def similar(a: np.ndarray, spot_a: int, b: np.ndarray, spot_b: int, width: int = WINDOW, similarity: float = SIMILARITY) -> tuple[int, int] | None:
    """Starts of a window of a and the nearest one of b (both aligned at their spots; all offsets are compared), or None if none is near."""
    left = min(spot_a, spot_b)
    n = left + min(len(a) - spot_a, len(b) - spot_b)
    if n < width:
        return None
    start_a, start_b = spot_a - left, spot_b - left
    x, y = a[start_a: start_a + n], b[start_b: start_b + n]
    held = {v: i for i, v in enumerate(y.tolist())}
    pairs = [(i, held[v]) for i, v in enumerate(x.tolist()) if v in held]
    if len(held) == n == len(set(x.tolist())):
        need = math.ceil(2 * width * similarity / (1 + similarity) - 1e-9)
        if len(pairs) < need:
            return None
        # a shingle counts at the offsets whose windows hold it on both sides: words put in or left out shift what follows
        at = np.array(pairs)
        steps = np.zeros(n + 1, np.int64)
        lo, hi = np.maximum(at.max(axis=1) - width + 1, 0), np.minimum(at.min(axis=1), n - width)
        np.add.at(steps, lo[lo <= hi], 1)
        np.add.at(steps, hi[lo <= hi] + 1, -1)
        shared = np.cumsum(steps[: n - width + 1])
        best = int(np.argmax(shared))
        return (start_a + best, start_b + best) if shared[best] >= need else None
    if len(pairs) == 0:
        return None
    # the shingles of a window repeat: sets at each offset
    found, most = None, 0.0
    for o in range(n - width + 1):
        p, q = set(x[o: o + width].tolist()), set(y[o: o + width].tolist())
        same = len(p & q)
        if same >= similarity * (len(p) + len(q) - same) and same / (len(p) + len(q) - same) > most:
            found, most = (start_a + o, start_b + o), same / (len(p) + len(q) - same)
    return found


def _verified(pairs: DataFrame) -> DataFrame:
    """Of pairs of contents, the near ones: a row (run, off, other) for the window of each."""
    def run(batches):
        for batch in batches:
            out = []
            for run_, spot, near, hub, hub_spot, hub_near in zip(*[c.to_pylist() for c in batch.columns]):
                found = similar(np.frombuffer(near, "<u4"), spot, np.frombuffer(hub_near, "<u4"), hub_spot)
                if found is not None:
                    out += [(run_, found[0], hub), (hub, found[1], run_)]
            if out:
                r, o, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(o, pa.int32()), pa.array(c, pa.int64())], ["run", "off", "other"])
    met = pairs.where(F.least("tid", "hub_tid") < F.greatest("far", "hub_far"))  # a pair of one text's own runs is none
    return met.select("run", "spot", "near", "hub_run", "hub_spot", "hub_near").mapInArrow(run, "run bigint, off int, other bigint")


def _edges(links: DataFrame) -> DataFrame:
    return links.where("run > other").select(F.col("run").alias("u"), F.col("other").alias("v"))


# ---- near contents that no hub is near to -------------------------------------------------

def prefix_size(size: int, least: int, similarity: float = SIMILARITY) -> int:
    """Of two sets of these sizes with this Jaccard similarity, shingles of the first (in any one order) of which the other's first ones hold one."""
    return size - math.ceil(similarity / (1 + similarity) * (size + least) - 1e-9) + 1


def window_sizes(near: np.ndarray, width: int = WINDOW) -> set[int]:
    """Numbers of different shingles in a run's windows."""
    if len(set(near.tolist())) == len(near):
        return {width}
    return {len(set(near[k: k + width].tolist())) for k in range(len(near) - width + 1)}


def places(near: np.ndarray, ends: np.ndarray, ranked: tuple[np.ndarray, np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray],
           width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, size, shingle): the places where the windows of runs meet every window near to them.

    Run i has the shingles near[ends[i]: ends[i + 1]]; `ranked` are (run, shingle, how many runs of its group hold it),
    `sizes` (run, size) those that its group has.  Shingles come in the order of these counts; those in no other run come
    first and are left out in the end.  Near windows of p >= q shingles share one of the first prefix_size(p, q) of the one and
    prefix_size(q, p) of the other, which prefix_size(q, q) holds: they meet at size q.
    """
    run = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    whole = run << 32 | near
    known = ranked[0] << 32 | ranked[1]
    by_shingle = np.argsort(known)
    at = np.minimum(np.searchsorted(known, whole, sorter=by_shingle), len(known) - 1)
    count = np.where(known[by_shingle[at]] == whole, ranked[2][by_shingle[at]], 0) if len(known) else np.zeros(len(whole), np.int64)
    order = count << 32 | near
    # of equal shingles a window has the first only
    by_place = np.argsort(whole, kind="stable")
    again = whole[by_place[1:]] == whole[by_place[:-1]]
    before = np.full(len(whole), -1)
    before[by_place[1:][again]] = by_place[:-1][again]
    starts = np.flatnonzero(np.arange(len(near)) + width <= ends[1:][run])
    most = prefix_size(width, math.ceil(SIMILARITY * width - 1e-9))
    out = []
    for k in range(0, len(starts), PLACE_WINDOWS):
        start = starts[k: k + PLACE_WINDOWS, None]
        inside = start + np.arange(width)
        held = np.where(before[inside] < start, order[inside], np.iinfo(np.int64).max)
        size = width - (before[inside] >= start).sum(axis=1)
        least = np.sort(np.partition(held, most - 1, axis=1)[:, :most], axis=1)
        of = run[start[:, 0]]
        for q in np.unique(sizes[1]).tolist():
            wanted = np.zeros(len(ends), bool)
            wanted[sizes[0][sizes[1] == q]] = True
            first = np.array([prefix_size(p, q) if SIMILARITY * p <= q + 1e-9 and q <= p else 0 for p in range(width + 1)])[size]
            meets = (np.arange(most) < np.where(wanted[of], first, 0)[:, None]) & (least >> 32 > 0)
            row, column = np.nonzero(meets)
            met = np.unique(of[row] << 32 | least[row, column] & 0xFFFFFFFF)
            out.append((met, np.full(len(met), q)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    met, q = (np.concatenate(c) for c in zip(*out))
    # a run's windows may be in two blocks
    met, q = np.unique(np.stack([met, q]), axis=1) if len(starts) > PLACE_WINDOWS else (met, q)
    return met >> 32, q, met & 0xFFFFFFFF


def prefixes(near: np.ndarray, ranked: dict[int, int], sizes: list[int], width: int = WINDOW) -> set[tuple[int, int]]:
    """(size, shingle) of a single run, from a mapping of shingles to counts."""
    shingles, counts = np.array(list(ranked), np.int64), np.array(list(ranked.values()), np.int64)
    found = places(near, np.array([0, len(near)]), (np.zeros(len(ranked), np.int64), shingles, counts), (np.zeros(len(sizes), np.int64), np.array(sizes)), width)
    return set(zip(*(c.tolist() for c in found[1:])))


def _shingles(left: DataFrame) -> DataFrame:
    """key, run, shingle: the different shingles of each run."""
    def run(batches):
        for batch in batches:
            held = [np.unique(np.frombuffer(near, "<u4")).view(np.int32) for near in batch.column(2).to_pylist()]
            if held:
                each = np.repeat(np.arange(len(held)), [len(x) for x in held])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(each)), batch.column(1).take(pa.array(each)), pa.array(np.concatenate(held))], ["key", "run", "shingle"])
    return left.select("key", "run", "near").mapInArrow(run, "key bigint, run bigint, shingle int")


def _sizes(left: DataFrame) -> DataFrame:
    """key, sizes (at most WINDOW): the numbers of different shingles in the windows of a group's runs."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def of(near: pa.Array) -> pa.Array:
        return pa.array([sorted(window_sizes(np.frombuffer(x, "<u4"))) for x in near.to_pylist()], pa.list_(pa.int32()))
    return left.select("key", F.explode(of(F.col("near"))).alias("size")).distinct().groupBy("key").agg(F.collect_list("size").alias("sizes"))


def _buckets(left: DataFrame, within: str) -> DataFrame:
    """key, size, shingle, run, root: near windows of a group share a bucket."""
    def run(batches):
        for batch in batches:
            held = batch.column(3).to_pylist()
            near = np.frombuffer(b"".join(held), "<u4")
            ends = np.append(0, np.cumsum([len(x) // 4 for x in held], dtype=np.int64))
            ranked, sizes = batch.column(4), batch.column(5)
            each = lambda lists: np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            n, shingle = (ranked.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "shingle"))
            mine, size, met = places(near, ends, (each(ranked), shingle & 0xFFFFFFFF, n), (each(sizes), sizes.flatten().to_numpy(zero_copy_only=False)))
            if len(mine):
                of = pa.array(mine)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), pa.array(size.astype(np.int32)), pa.array(met), batch.column(1).take(of), batch.column(2).take(of)],
                                                 ["key", "size", "shingle", "run", "root"])
    shingles = _shingles(left)
    counts = written(shingles.groupBy("key", "shingle").agg(F.count("*").alias("n")).where("n > 1"), "passages-counts", within)
    ranked = shingles.join(counts.hint("merge"), ["key", "shingle"]).groupBy("run").agg(F.collect_list(F.struct("n", "shingle")).alias("ranked"))
    sized = written(_sizes(left), "passages-sizes", within)
    return left.join(ranked, "run").join(sized.hint("merge"), "key").select("key", "run", "root", "near", "ranked", "sizes").mapInArrow(
        run, "key bigint, size int, shingle bigint, run bigint, root bigint")


def _late(left: DataFrame, within: str) -> DataFrame:
    """Links (run, off, other) between the components that the hubs left in a group.

    Buckets of shared rare shingles get a star each; in those that still hold
    two components all contents of different ones are compared.
    """
    of = ["key", "size", "shingle"]
    held = left.select("run", "tid", "far", "spot", "near")
    hub = held.select(*[F.col(c).alias(f"hub_{c}") for c in held.columns])
    verified = lambda pairs, name: written(_verified(pairs.distinct().join(held, "run").join(hub, "hub_run")), name, within)
    buckets = written(_buckets(left, within), "passages-buckets", within)

    def mixed(rows: DataFrame, name: str) -> DataFrame:
        ends = rows.groupBy(*of).agg(F.min(F.struct("root", "run")).alias("low"), F.max(F.struct("root", "run")).alias("high")).where("low.root < high.root")
        return written(rows.join(written(ends, f"{name}-ends", within).hint("merge"), of), name, within)

    met = mixed(buckets, "passages-mixed")
    spoke = lambda end: met.where(F.col("root") != F.col(f"{end}.root")).select(F.greatest("run", f"{end}.run").alias("run"), F.least("run", f"{end}.run").alias("hub_run"))
    star = verified(spoke("low").unionByName(spoke("high")), "passages-spokes")
    roots = left.select("run", "root")
    joined = _edges(star).join(roots.withColumnRenamed("run", "u").withColumnRenamed("root", "a"), "u").join(roots.withColumnRenamed("run", "v").withColumnRenamed("root", "b"), "v")
    second = written(graph.components(joined.select(F.col("a").alias("u"), F.col("b").alias("v"))), "passages-second", within)
    again = met.select(*of, "run", "root").join(second.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left")
    open_ = mixed(again.select(*of, "run", F.coalesce("last", "root").alias("root")), "passages-open").select(*of, "run", "root")
    a, b = open_.alias("a"), open_.alias("b")
    rest = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in of] + [F.col("a.root") < F.col("b.root")]).select(
        F.greatest("a.run", "b.run").alias("run"), F.least("a.run", "b.run").alias("hub_run"))
    return star.unionByName(verified(rest, "passages-rest"))


def _near(held: DataFrame, within: str) -> DataFrame:
    """run, off, least: windows that are near to one of another content; least is the least text of all that are linked."""
    hubs = held.where("hub").select("key", *[F.col(c).alias(f"hub_{c}") for c in ("run", "tid", "far", "spot", "near")])
    # two hubs are compared once
    pairs = held.join(hubs, "key").where((~F.col("hub") & (F.col("run") != F.col("hub_run"))) | (F.col("run") < F.col("hub_run")))
    links = written(_verified(pairs), "passages-star", within)
    roots = written(graph.components(_edges(links)), "passages-roots", within)
    placed = held.select("key", "run").join(roots.withColumnRenamed("node", "run"), "run", "left").select("key", "run", F.coalesce("root", "run").alias("root"))
    # groups of three contents are settled by their hubs
    mixed = written(placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).where("a < b and n > 3").select("key"), "passages-unsettled", within)
    open_ = held.join(mixed.hint("merge"), "key").select("key", "run", "tid", "far", "spot", "near")
    left = written(open_.join(placed.select("run", "root"), "run"), "passages-left", within)
    if not left.isEmpty():
        late = _late(left, within)
        links = links.unionByName(late)
        # the components found so far stand for their links
        stars = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = written(graph.components(stars.unionByName(_edges(late))), "passages-linked", within)
    dropped_table(left)
    rooted = roots.withColumnRenamed("node", "run")
    least = rooted.join(held.select("run", "tid"), "run").groupBy("root").agg(F.min("tid").alias("least"))
    return links.select("run", "off").join(rooted.join(least, "root").select("run", "least"), "run")


# ---- the texts ----------------------------------------------------------------------------

def _among(ids: DataFrame):
    """A test on a tid column that holds for every tid in `ids`, and for few others while they fill
    little of a bitmap of fixed size: it only spares shuffling texts that no join will want."""
    place = F.col("tid").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    found = ids.select(place.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toPandas()
    bitmap = np.zeros(1 << MAP_BITS - 6, np.int64)  # at most so many rows, whatever the input
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    held = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf(T.BooleanType())
    def test(tids: pa.Array) -> pa.Array:
        at = tids.to_numpy(zero_copy_only=False) & (1 << MAP_BITS) - 1
        return pa.array((held.value[at >> 6] >> (at & 63) & 1).astype(bool))
    return test(F.col("tid"))


def _shared_by(rows: DataFrame, far: str = "tid") -> DataFrame:
    return rows.groupBy("key").agg(F.min("tid").alias("least"), F.max(far).alias("far")).where("least < far")


def _contents(members: DataFrame, within: str) -> DataFrame:
    """A row per signature and content: key, content, run (a hash of both, the same in any layout of partitions), tid and place of its first text, far (its last text),
    open (the signature has other contents) and hub."""
    of = members.groupBy("key", "content").agg(F.min(F.struct("tid", "place")).alias("first"), F.max("tid").alias("far")).select("key", "content", "first.*", "far")
    ends = of.groupBy("key").agg(F.min(F.struct("tid", "content")).alias("low"), F.max(F.struct("tid", "content")).alias("high"))
    opened = F.col("low.content") != F.col("high.content")
    hub = F.col("content").isin(F.col("low.content"), F.col("high.content"))
    return written(of.join(ends, "key").select("key", "content", "tid", "place", "far", opened.alias("open"), hub.alias("hub")).withColumn("run", F.xxhash64("key", "content")), "passages-contents", within)


def _found(contents: DataFrame, rows: DataFrame, within: str) -> DataFrame:
    """run, least, first, last: the repeated starts of each content and class, counted in its run."""
    windows, held = rows.where("tier = 0").select("key", "run", "off", "tid", "far"), rows.where("tier = 1").drop("tier", "off")
    exact = windows.select("key", "run", "off").join(_shared_by(windows, "far").select("key", "least"), "key").select("run", "off", "least")
    near = _near(held, within)
    whole = contents.where("tid < far").select("run", F.lit(0).alias("first"), F.shiftright("place", 6).bitwiseAND(F.lit(63)).cast("int").alias("last"), F.col("tid").alias("least"))
    part = exact.unionByName(near).select("run", F.col("off").alias("first"), F.col("off").alias("last"), "least")
    return whole.unionByName(part).groupBy("run", "least").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def _merged(links: DataFrame) -> DataFrame:
    """tid, least, start_word, end_word: overlapping and adjoining passages (first start `at`, last start `last`) of one class as one."""
    by_text = Window.partitionBy("tid", "least").orderBy("at")
    starts = links.groupBy("tid", "least", "at").agg(F.max("last").alias("last"))
    so_far = F.max("last").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    stepped = starts.withColumn("new", F.coalesce((F.col("at") > so_far + MIN_WORDS).cast("int"), F.lit(0)))
    numbered = stepped.withColumn("number", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("tid", "least", "number").agg(F.min("at").cast("long").alias("start_word"), (F.max("last") + MIN_WORDS).cast("long").alias("end_word"))


def _passages(read: DataFrame, every: DataFrame, classes: DataFrame, within: str) -> DataFrame:
    """tid (a text's number), least, start_word, end_word: what texts share; the tables between lie in `within`."""
    runs = every.where(F.col("key").isNotNull())
    # a written table, so that both sides come straight from a shuffle and a hot signature's part can be split
    keys = written(_shared_by(runs).select("key"), "passages-keys", within)
    shared = _few_but(runs, keys).join(keys.hint("merge"), "key")
    members = written(shared.join(classes.select("tid", "number"), "tid").select("key", "content", F.col("number").alias("tid"), "place"), "passages-members", within)
    dropped_table(every)
    contents = _contents(members, within)
    by_text = contents.where("open").groupBy("tid").agg(F.collect_list(F.struct("run", "key", "place", "far", "hub")).alias("runs"))
    # one row of each text: it travels by its document's id, so copies of a text do not meet
    by_doc = written(by_text.withColumnRenamed("tid", "number").join(classes.select("number", "own", F.col("tid").alias("held")), "number").select("held", "own", "number", "runs"), "passages-runs", within)
    wanted = read.where(_among(by_doc.select(F.col("held").alias("tid"))))
    texts = wanted.join(by_doc, wanted["doc_id"].eqNullSafe(by_doc["own"]) & (wanted["tid"] == by_doc["held"])).select(F.col("number").alias("tid"), "text", "runs")
    windows = written(_windows(texts), "passages-windows", within)
    dropped_table(by_doc)
    found = _found(contents, windows, within)
    found = found.join(contents.select("run", "key", "content"), "run").select("key", "content", "first", "last", "least")
    at = F.shiftright("place", 12)
    return _merged(members.join(found, ["key", "content"]).select("tid", (at + F.col("first")).alias("at"), (at + F.col("last")).alias("last"), "least"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start_word, end_word, class_id: the repeated passages of every document."""
    read = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tid", F.xxhash64("text"))
    copies = written(read.select("doc_id", "tid"), "passages-copies")
    spark, within = docs.sparkSession, f"llm-passages-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        # the texts are put through the windows once; later steps need a few of the rows
        every = written(_signatures(read), "passages-signatures", within)
        lengths = every.where(F.col("key").isNull()).groupBy("tid").agg(F.max("place").alias("n_words"))
        # texts are numbered in the order of their least document ids: small numbers shuffle well, and the least number is the class
        classes = written(copies.groupBy("tid").agg(F.min("doc_id").alias("own"), F.count("*").alias("n")).join(lengths, "tid", "left")
                          .orderBy(F.asc_nulls_last("own"), "tid").withColumn("number", F.monotonically_increasing_id()), "passages-classes")
        merged = written(_passages(read, every, classes, within), "passages-merged")
    # what is left are the tables that the result reads
    dropped(spark, shared_path(spark, within))
    merged = merged.select(F.col("tid").alias("number"), "start_word", "end_word", "least").join(classes.select("number", "tid"), "number").join(
        classes.select(F.col("number").alias("least"), F.col("own").alias("class_id")), "least").select("tid", "start_word", "end_word", "class_id")
    whole = classes.where((F.col("n") > 1) & F.col("n_words").isNotNull()).select("tid", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"), F.col("own").alias("class_id"))
    # a text that has copies is a passage from end to end, beside those it shares with other texts
    found = merged.unionByName(whole).distinct()
    return copies.select("doc_id", "tid").join(found, "tid").select("doc_id", "start_word", "end_word", "class_id")
