import random
import sys

import pytest

ROWS = [
    (1, "one two three four five"), (2, None), (3, ""), (None, "one two three four five"), (4, " \t\n "), (5, "Solo"), (5, "Solo"), (6, "solo"),
    (7, "a b c " * 40), (8, "line one here\nline one here\nother\n\n\nother"), (9, "x" * 5000), (10, "é ü ß 漢字 🙂 " * 30), (11, "nul\x00byte and   separators kept together"),
]


def prose(seed, n, vocab=400):
    rng = random.Random(seed)
    words = [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{i}" for i in range(vocab)]
    return " ".join(rng.choice(words) for _ in range(n))


def messy_rows():
    base = prose(1, 300)
    words = base.split()
    near = " ".join(words[:150] + ["CHANGED"] + words[151:])
    return [*ROWS, (20, base), (21, base), (22, near), (23, prose(2, 300)), (24, prose(3, 20000, 3000)), (25, base), (25, base),
            (26, prose(4, 80) + " " + " ".join(words[100:170]) + " " + prose(5, 80)), (27, prose(6, 40) + "\n" + " ".join(words[100:170]))]


SCHEMA = "doc_id long, text string, fp long, tid long, key long, tokens string, m string, spans string, unit int, `Rank` int"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, copies, repeated rows and columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, 2, 3, "t", "m", "s", 5, 6) for i, t in messy_rows()], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
