"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import ensure_checkpoint_dir, shared_path

#: Text bytes handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

#: ASCII white space: the separators of `[^\x20\x09-\x0D]+`.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint in the folder the cluster shares, so that a lost executor costs no earlier step."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, within: str = "") -> DataFrame:
    """Write as Parquet below the shared checkpoint folder (there in the folder `within`) and read it back (sizes are then known)."""
    path = shared_path(df.sparkSession, *[within] * bool(within), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, folder: str) -> None:
    """Delete a folder of written tables that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped_table(table: DataFrame) -> None:
    """Delete a written table that no later step reads."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        dropped(table.sparkSession, folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, each write or checkpoint removes its shuffle files at its end; else they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def bitmap_test(df: DataFrame, column: str, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """A test on arrays of longs that holds for every value of `column`, and for few others while these
    fill little of a bitmap of 2 ** `bits` places: it only spares shuffling rows that no join will want.

    Values should be hashes.  The bitmap reaches the driver in a few hundred pieces of 8 KB, whatever the input.
    """
    last = (1 << bits) - 1
    place = F.col(column).bitwiseAND(F.lit(last))
    words = df.select(place.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits"))

    def pieces(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            word, bit = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for piece in np.unique(word >> 10).tolist():
                mine = word >> 10 == piece
                held.setdefault(piece, np.zeros(1024, np.int64))[word[mine] & 1023] |= bit[mine]
        for piece, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece]), pa.array([found.tobytes()], pa.binary())], ["piece", "bits"])
    bitmap = np.zeros(1 << max(10, bits - 6), np.int64)
    for row in words.repartition(4, F.shiftrightunsigned("word", 10)).mapInArrow(pieces, "piece bigint, bits binary").toLocalIterator():
        bitmap[row.piece << 10: row.piece + 1 << 10] = np.frombuffer(row.bits, np.int64)
    held = df.sparkSession.sparkContext.broadcast(bitmap)

    def test(values: np.ndarray) -> np.ndarray:
        at = values & last
        return (held.value[at >> 6] >> (at & 63) & 1).astype(bool)
    return test


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read; other columns, whatever their names, stay behind."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, one after the other, and each text's offset (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: first, last + 1, bytes, offsets inside."""
    data, at = utf8_bytes(texts)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i]: at[j]], at[i: j + 1] - at[i]
        i = j


def words_of(data: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends (exclusive) and text numbers in a block of texts; `space` says which bytes are between words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~word[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~word[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64; kept for one block's length."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        made = _powers(base, max(n, BLOCK_BYTES + 1))
        if n > BLOCK_BYTES + 1:
            return made
        have = _POWERS[base] = made
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit rolling hashes of byte spans: the same in every task and at every place in a text."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_ODD, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes (one for each start at which a whole run fits)."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out *= np.uint64(_ODD)
        out += words[k: k + count]
    return mixed(out)
