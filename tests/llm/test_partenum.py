"""N-gram Jaccard join: signatures, brute force, crowded buckets, defined cases."""

import random
import re

import numpy as np
import pyarrow as pa

from tillwise.llm import partenum
from tillwise.llm.common import utf8_bytes

from .conftest import messy_rows, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Every pair of sets; components by repeated least ids."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changed(words, n, rng):
    """n words swapped, put in or left out."""
    words = list(words)
    for _ in range(n):
        at, how = rng.randrange(len(words)), rng.random()
        if how < 0.5:
            words[at] = f"new{rng.randrange(10 ** 6)}"
        elif how < 0.75:
            words.insert(at, f"more{rng.randrange(10 ** 6)}")
        elif len(words) > 1:
            del words[at]
    return words


def block(texts):
    return utf8_bytes(pa.array(texts))


def test_sets_and_linked():
    texts = ["A b c d e f", "a b c d E f", "", None, "one two", "one two three", "x " * 50, "é ü\x0bß\x0c漢 🙂 z"]
    hashes, first = partenum.sets_of(*block(texts))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    nodes = partenum.nodes_of(hashes, first)
    assert nodes[0] == nodes[1] and len(set(nodes.tolist())) == len(texts) - 2
    rng = random.Random(4)
    base = [prose(i, rng.randrange(5, 200)).split() for i in range(60)]
    left = [" ".join(b) for b in base]
    right = [" ".join(changed(b, rng.randrange(0, 1 + len(b) // 20), rng)) for b in base]
    want = [100 * len(shingles(a) & shingles(b)) >= 80 * len(shingles(a) | shingles(b)) for a, b in zip(left, right)]
    n, m, both, pair, more = partenum.compared(pa.array(left), pa.array(right))
    assert partenum.enough(both, n, m).tolist() == want and 10 < sum(want) < 60
    assert np.bincount(pair, minlength=60).tolist() == [len(shingles(b) - shingles(a)) for a, b in zip(left, right)] and len(more) == len(pair)


def test_every_link_keeps_a_signature():
    """Also after each set drops its `spare` first ones in any one order."""
    rng = random.Random(9)
    pairs = 0
    for trial in range(600):
        base = prose(trial, rng.randrange(1, 260)).split()
        a, b = " ".join(base), " ".join(changed(base, rng.randrange(0, 2 + len(base) // 22), rng))
        hashes, first = partenum.sets_of(*block([a, b]))
        n, m, both, *_ = partenum.compared(pa.array([a]), pa.array([b]))
        if not partenum.enough(both, n, m)[0] or len(set(partenum.nodes_of(hashes, first).tolist())) < 2:
            continue
        key, owner, size, tag, spare = partenum.signatures_of(hashes, first)
        assert len(set(zip(key.tolist(), owner.tolist()))) == len(key)
        left = []
        for one in (0, 1):
            kept = set()
            for t in set(tag[owner == one].tolist()):
                mine = (owner == one) & (tag == t)
                kept |= set(sorted(key[mine].tolist())[int(spare[mine][0]):])
            left.append(kept)
        assert left[0] & left[1], (len(base), size)
        pairs += 1
    assert pairs > 150


def test_against_brute_force(spark, messy):
    assert got(partenum.similar_sets(messy.repartition(4))) == brute(messy_rows())


def corpus(seed, n):
    """Near copies of all lengths, a line and a passage that many documents share, and one large group of near copies."""
    rng = random.Random(seed)
    rows, line, passage = [], prose(seed + 1, 12).split(), prose(seed + 2, 70).split()
    big = prose(seed + 3, 120).split()
    for i in range(n):
        kind = i % 5
        words = prose(seed + 10 + i // 3 * (kind != 4), rng.choice([1, 3, 5, 6, 9, 20, 60, 150])).split()
        if kind == 0:
            words = changed(words, rng.randrange(0, 1 + len(words) // 25), rng)
        elif kind == 1:
            words = line + words
        elif kind == 2:
            words = words + passage
        elif kind == 3:
            words = changed(big, rng.randrange(0, 5), rng)
        rows.append((i, " ".join(words)))
    return rows


def test_crowded_groups(spark):
    rows = corpus(50, 400)
    assert got(partenum.similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))) == brute(rows)


def test_large_group_around_the_threshold(spark):
    """Near copies of which a part is linked with none, some share a change, some are cut off."""
    rng = random.Random(77)
    base, other = prose(900, 130).split(), prose(901, 30).split()
    rows = []
    for i in range(260):
        words = changed(base, rng.randrange(0, 11), rng)
        if i % 4 == 0:
            words = words[: 40] + other + words[60:]
        if i % 7 == 0:
            words = words[: rng.randrange(80, 125)]
        rows.append((i, " ".join(words)))
    want = brute(rows)
    assert 20 < len({c for _, _, c in want}) < 200
    assert got(partenum.similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


def test_empty(spark, empty):
    assert partenum.similar_sets(empty).collect() == []
    bare = spark.createDataFrame([(1, None), (None, ""), (3, " ")], "doc_id long, text string")
    assert got(partenum.similar_sets(bare)) == sorted([(1, 0, 1), (None, 0, None), (3, 0, 3)], key=str)
