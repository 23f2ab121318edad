"""Collocation mining against a count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tillwise.llm import collocations

from .conftest import messy_rows


def brute(rows, limit=2000, least=10):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                f[lang].update(tuple(words[i: i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]], p))
        longer = defaultdict(int)
        for *_, p in found:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], c[p])
        kept = sorted(x for x in found if len(x[5]) == 3 or 100 * longer[x[5]] < 50 * c[x[5]])
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for i, x in enumerate(kept[:limit])]
    return sorted(out)


def corpus(seed, n, langs=("en", "fr", None, "und", "x")):
    rng = random.Random(seed)
    fixed = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([2, 3, 3, 4]))) for _ in range(60)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 120)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else f"w{int(rng.expovariate(0.03))}")
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!\x0b", " A "]))
        rows.append((rng.choice(langs), "".join(parts)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(l, t, 1, 2, "c") for l, t in rows], "lang string, text string, x int, h long, word string")


@pytest.mark.parametrize("limit", [3, 40, 2000])
def test_against_a_count_of_all(spark, limit):
    rows = corpus(3, 500) + [("long", "alpha beta gamma " * 3000), (None, "é🙂 ß " * 20)]
    assert sorted(tuple(r) for r in collocations.mine(frame(spark, rows).repartition(5), limit=limit).collect()) == brute(rows, limit)


def test_dropped_pairs_send_the_search_deeper(spark):
    """The best pairs all lie inside longer phrases, so the first threshold leaves too few."""
    rng = random.Random(8)
    rows = [("en", ". ".join(f"a{i} b{i} c{i}" for i in range(200))) for _ in range(12)]
    rows += [("en", ". ".join(f"{x} {y}" for x, y in ((f"p{rng.randrange(9)}", f"q{rng.randrange(9)}") for _ in range(900))))]
    for limit in (30, 210, 250):
        assert sorted(tuple(r) for r in collocations.mine(frame(spark, rows), limit=limit).collect()) == brute(rows, limit)


def test_ties_at_the_last_place_go_by_the_phrase(spark):
    rows = [("en", ". ".join(f"x{i}é y{i}" for i in range(50))) for _ in range(10)]
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), limit=7).collect())
    assert got == brute(rows, 7) and {r[7] for r in got} == {1000000}


def test_messy_and_empty(spark, messy, empty):
    by_lang = messy.withColumnRenamed("m", "lang")
    assert sorted(tuple(r) for r in collocations.mine(by_lang).collect()) == brute([("m", t) for _, t in messy_rows()])
    assert collocations.mine(empty.withColumnRenamed("m", "lang")).collect() == []
