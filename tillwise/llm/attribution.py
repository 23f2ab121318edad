"""Operator 5, token counts by offset-mapped attribution.

A document's fields are joined by a line feed and encoded once, as a whole.
Byte-level tokens tile the document's bytes, so the running sum of their
lengths gives each token's span; an interval join by binary search maps the
spans to sections (fields, or the lines of the fields).  A token that crosses a
boundary is allocated by a stated rule, whole, to one section: the one with its
first byte (`start`), its last byte (`end`), or most of its bytes (`majority`,
ties to the earlier), so the counts of a document add up to its tokens.

A section owns the line feed that ends it.  Defined cases: null fields are
empty; every document has at least one section, also if it is empty; null ids
are kept; repeated rows get their sections each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.tokens import byte_lengths, default_path, encode

RULES = ("start", "end", "majority")
SCHEMA = "doc_id bigint, section bigint, field bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
_NAMES = ["doc_id", "section", "field", "start", "end", "n_tokens", "n_crossing"]


def allocate(lengths: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses); bounds are the sections' first bytes, the first one 0."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = first != last
    if rule == "start":
        return first, crossing
    if rule == "end":
        return last, crossing
    out = first.copy()
    edges = np.append(bounds, ends[-1] if len(ends) else 0)
    for t in np.flatnonzero(crossing):
        held = [min(ends[t], edges[s + 1]) - max(starts[t], edges[s]) for s in range(first[t], last[t] + 1)]
        out[t] = first[t] + int(np.argmax(held))
    return out, crossing


def sections(fields: list[str], by: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The joined document, its sections' first bytes and their field numbers."""
    parts = [f.encode() for f in fields]
    whole = b"\n".join(parts)
    heads = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
    if by == "line":
        bounds = np.append(0, np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x0A) + 1)
    else:
        bounds = heads
    return whole.decode(), bounds, np.searchsorted(heads, bounds, "right") - 1


def count_tokens(docs: DataFrame, id_col: str = "doc_id", fields: tuple[str, ...] = ("text",), by: str = "line", rule: str = "start", tokenizer: str | None = None) -> DataFrame:
    """A row per section: doc_id, section, field, start, end (bytes), n_tokens, n_crossing (of these, tokens that cross its bounds)."""
    if rule not in RULES or by not in ("line", "field"):
        raise ValueError("rule is start, end or majority; by is line or field")
    path = tokenizer or default_path()
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"field_{i}") for i, f in enumerate(fields)])

    def run(batches):
        of = byte_lengths(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, rows = part.column(0).to_pylist(), zip(*(c.to_pylist() for c in part.columns[1:]))
                out, owners = [], []
                for doc_id, row in zip(ids, rows):
                    whole, bounds, field = sections(list(row), by)
                    lengths = of[encode(whole, path)]
                    where, crossing = allocate(lengths, bounds, rule)
                    n = len(bounds)
                    ends = np.append(bounds[1:], lengths.sum())
                    out.append((np.arange(n), field, bounds, ends, np.bincount(where, minlength=n), np.bincount(where[crossing], minlength=n)))
                    owners += [doc_id] * n
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), *(pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out))], _NAMES)

    return read.mapInArrow(run, SCHEMA)
