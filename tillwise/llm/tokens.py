"""Public byte-level BPE tokenizers, loaded once in each worker.

`byte_bpe_50k` is read from its rank file: the same vocabulary and merges as
its JSON form, so the same ids, several times faster.  The JSON's added tokens
(`<|endoftext|>`) are taken from it, and their strings inside a text become
their ids, as the JSON's own reading has it.
"""

from __future__ import annotations

import base64
import functools
import json
import os

import numpy as np
import public_tokenizers
import tiktoken

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Longer texts are encoded in chunks, cut where a token always begins.
CHUNK_CHARS = 100_000


def added_tokens(path: str) -> dict[str, int]:
    """String and id of the added tokens, from the JSON form beside a rank file."""
    form = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(form):
        return {}
    with open(form, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", ())}


@functools.lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added = added_tokens(path)
    sizes = {i: len(t) for t, i in ranks.items()} | {i: len(t.encode()) for t, i in added.items()}
    lengths = np.zeros(max(sizes) + 1, np.int64)
    lengths[list(sizes)] = list(sizes.values())
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added), lengths


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def chunks(text: str, size: int = CHUNK_CHARS) -> list[str]:
    """Pieces that encode as the whole does: a cut is before a blank between a non-blank and an ASCII letter."""
    out, at = [], 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) - 1 and not (text[cut] == " " and not text[cut - 1].isspace() and text[cut + 1].isascii() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def encode(text: str, path: str) -> np.ndarray:
    """Token ids of a whole text (unsigned 32-bit)."""
    encoding = _loaded(path)[0]
    if len(text) <= CHUNK_CHARS:
        return encoding.encode_to_numpy(text, allowed_special="all")
    return np.concatenate([encoding.encode_to_numpy(c, allowed_special="all") for c in chunks(text)])


def byte_lengths(path: str) -> np.ndarray:
    """Bytes of each id: byte-level tokens cover a text's bytes without gap or overlap."""
    return _loaded(path)[1]
