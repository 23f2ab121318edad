"""Operator 4, benchmark decontamination by a BM25 inverted index with block-max pruning.

The index is over the benchmark's items: Spark counts terms and writes the
postings with BM25 weights, scaled so that an item's own words score 1.  Every
text is cut into passages (windows of two cells, each as long as the longest
item, so that any copy lies whole in one) and each passage is a query: its
distinct known words against blocks of BLOCK_ITEMS items, first with the
blocks' greatest weights (an upper bound, for all passages and blocks at
once), then item by item in the blocks that can still reach the threshold.
Every item at or above it is verified by its five-word shingles: the share
found in the passage, for the question (the first line, or the first half of a
text of one line) and for the answer (the rest), must reach MIN_OVERLAP each.

The index that a task holds is bounded: a benchmark above PART_ITEMS items or
PART_BYTES bytes is dealt by a hash of the item to several parts, each collected
and broadcast on its own, with term statistics and passage width of all items;
each part is one more pass over the passages.  Results depend neither on the
number of parts nor on the benchmark's files.

Words are ASCII-lower-cased and split at ASCII characters that are no letter
or digit.  Defined cases: null or empty texts hold no passage and items
without words match nothing; null ids are kept; repeated rows and repeated
items get a row each; a score equal to a threshold counts; empty tables give an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import fresh, id_text, written

K1, B = 1.2, 0.75
THRESHOLD = 0.7
MIN_OVERLAP = 0.8
SHINGLE_WORDS = 5
BLOCK_ITEMS = 4
PART_ITEMS = 512
PART_BYTES = 4 << 20
#: Cells of a text whose bounds are held at once.
CELLS = 4096

_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
_LEAK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                      T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())])
_LEAKS = T.ArrayType(_LEAK)
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def _words(text: Column) -> Column:
    """The same words as a DataFrame expression."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def postings(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(items, postings): number, id, question and answer words and part; number, term, weight and part."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    parts = max(1, -(-size.n // PART_ITEMS), -(-(size.bytes or 0) // PART_BYTES))
    line = F.regexp_extract(text, r"(?s)^\s*([^\n]+)\n(.*\S.*)$", 1)
    rest = F.regexp_extract(text, r"(?s)^\s*([^\n]+)\n(.*\S.*)$", 2)
    half = F.ceil(F.size("words") / 2).cast("int")
    known = written(items.select(F.col(id_col).cast("long").alias("item_id"), _words(text).alias("words"), _words(line).alias("q"), _words(rest).alias("a")).select(
        "item_id", "words",
        F.when((F.size("q") > 0) & (F.size("a") > 0), F.col("q")).otherwise(F.slice("words", F.lit(1), half)).alias("question"),
        F.when((F.size("q") > 0) & (F.size("a") > 0), F.col("a")).otherwise(F.slice("words", half + 1, F.size("words"))).alias("answer"))
        .where(F.size("words") > 0).withColumn("number", F.monotonically_increasing_id())
        .withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)).cast("int")), "benchmark-items")
    terms = known.select("number", "part", F.size("words").alias("len"), F.explode("words").alias("term")).groupBy("number", "part", "len", "term").agg(F.count("*").alias("tf"))
    spread = terms.groupBy("term").agg(F.count("*").alias("df"))
    whole = known.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    n, mean = float(whole.n), float(whole.mean or 1.0)
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    return known, written(terms.join(spread, "term").select("number", "part", "term", weight.alias("weight")), "benchmark-postings")


class Index:
    """One part of the benchmark, as arrays: what a task needs to score and verify."""

    def __init__(self, items, weights, cell: int) -> None:
        self.vocab = {t: i for i, t in enumerate(sorted({w[1].encode() for w in weights}))}
        number = {r.number: i for i, r in enumerate(items)}
        self.ids = [r.item_id for r in items]
        self.parts = [[self._ids(p) for p in (r.question, r.answer)] for r in items]
        self.terms: list = [[] for _ in items]
        self.weights: list = [[] for _ in items]
        for k, term, w in weights:
            self.terms[number[k]].append(self.vocab[term.encode()])
            self.weights[number[k]].append(w)
        blocks = -(-len(items) // BLOCK_ITEMS)
        self.greatest = np.zeros((len(self.vocab), blocks), np.float32)
        for i in range(len(items)):
            order = np.argsort(self.terms[i])
            self.terms[i] = np.array(self.terms[i], np.int64)[order]
            w = np.array(self.weights[i])[order]
            self.weights[i] = w / w.sum()
            np.maximum.at(self.greatest[:, i // BLOCK_ITEMS], self.terms[i], self.weights[i].astype(np.float32))
        self.cell = cell

    def _ids(self, words) -> list[int]:
        return [self.vocab[w.encode()] for w in words]

    def overlap(self, part: list[int], passage: list[int]) -> float:
        """Share of a part's shingles found in the passage (a shorter part is one shingle)."""
        n = min(SHINGLE_WORDS, len(part))
        if not n:
            return 1.0
        held = {tuple(passage[k: k + n]) for k in range(len(passage) - n + 1)}
        wanted = {tuple(part[k: k + n]) for k in range(len(part) - n + 1)}
        return len(wanted & held) / len(wanted)

    def _verify(self, passage: np.ndarray, block: int, best: dict[int, tuple]) -> None:
        """Keep the items of a block that the passage retrieves and that stand the verification."""
        there = np.unique(passage)
        for i in range(block * BLOCK_ITEMS, min(len(self.ids), (block + 1) * BLOCK_ITEMS)):
            score = round(float(self.weights[i][np.isin(self.terms[i], there, assume_unique=True)].sum()), 9)
            if score >= THRESHOLD:
                held = passage.tolist()
                overlaps = [self.overlap(p, held) for p in self.parts[i]]
                if min(overlaps) >= MIN_OVERLAP:
                    best[i] = max(best.get(i, (0.0,)), (score, *overlaps))

    def search(self, text: str) -> list[dict]:
        """Items that the text's passages retrieve and that stand the verification, best score first by item."""
        words = words_of(text)
        ids = np.fromiter((self.vocab.get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return []
        v = len(self.vocab)
        pairs = np.unique(at // self.cell * v + ids[at])
        cell = pairs // v
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        best: dict[int, tuple] = {}
        # a long text's bounds are worked out for some cells at a time; the last cell of one run is the first of the next
        cells = -(-len(ids) // self.cell)
        for lo in range(0, cells, CELLS):
            run = first[(cell[first] >= lo) & (cell[first] <= lo + CELLS)]
            if not len(run):
                continue
            last = np.searchsorted(cell, lo + CELLS, "right")
            bound = np.zeros((min(CELLS, cells - lo) + 1, self.greatest.shape[1]), np.float32)
            bound[cell[run] - lo] = np.add.reduceat(self.greatest[pairs[run[0]: last] % v], run - run[0], axis=0)
            # the slack covers rounding in single precision, so that no item is lost
            for c, block in zip(*np.nonzero(bound[:-1] + bound[1:] >= THRESHOLD - 1e-4)):
                self._verify(ids[(lo + c) * self.cell: (lo + c + 2) * self.cell], block, best)
        return [{"item_id": self.ids[i], "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in sorted(best.items())]


def indexes(items: DataFrame, **cols) -> Iterator[Index]:
    """The benchmark as index parts of bounded size, one at a time; passages are as wide for all of them."""
    known, weights = postings(items, **cols)
    cell = known.agg(F.max(F.size("words"))).first()[0] or 1
    for p in sorted(r.part for r in known.select("part").distinct().collect()):
        rows = known.where(F.col("part") == p).orderBy(F.asc_nulls_first("item_id"), "words").collect()
        yield Index(rows, [tuple(r) for r in weights.where(F.col("part") == p).select("number", "term", "weight").collect()], cell)


def leaks(text: Column, items: DataFrame, **cols) -> Column:
    """Array of (item_id, score, question_overlap, answer_overlap) of a text."""
    def by(index: Index) -> Column:
        held = items.sparkSession.sparkContext.broadcast(index)

        @F.arrow_udf(_LEAKS)
        def search(texts: pa.Array) -> pa.Array:
            return pa.array([held.value.search(t.as_py() or "") for t in texts], _ARROW)
        return search(text)

    found = [by(index) for index in indexes(items, **cols)]
    return F.concat(*found) if found else F.array().cast(_LEAKS)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: a row for each document row and item it holds."""
    read = id_text(docs, id_col, text_col)
    return read.select("doc_id", F.inline(leaks(F.col("text"), items)))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    name = fresh(docs, "benchmark_leaks")
    return docs.withColumn(name, leaks(F.col(text_col), items)).where(F.size(name) == 0).drop(name)
