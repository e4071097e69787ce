from __future__ import annotations

import random

import pytest

WORDS = "the of and a in licence free éa über niño word text model data page line cat dog sun sea 42 x1".split()


def document(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = rng.choice(WORDS) + (rng.choice("abcdefgh") * rng.randint(0, 3))
        out.append(w.capitalize() if rng.random() < 0.1 else w)
        out.append(rng.choice([" ", " ", " ", "  ", "\n", ", "]))
    return "".join(out)


def corpus(seed: int = 1) -> list[tuple[int, str | None]]:
    """Rows with distinct keys: copies, near copies, shared passages, short, long, empty and NULL texts."""
    rng = random.Random(seed)
    rows: list[tuple[int, str | None]] = []
    passage, notice = document(rng, 40), "Licensed under CC BY-NC 4.0. All Rights Reserved."
    for i in range(120):
        kind = i % 8
        if kind == 0 or len(rows) < 10:
            text = document(rng, rng.randint(5, 120))
        elif kind in (1, 2):
            text = rng.choice(rows)[1]
        elif kind in (3, 4):
            parts = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randint(1, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(WORDS)
            text = " ".join(parts)
        elif kind == 5:
            text = document(rng, rng.randint(0, 30)) + passage + document(rng, rng.randint(0, 30))
        elif kind == 6:
            text = document(rng, rng.randint(0, 20)) + notice + document(rng, rng.randint(0, 3))
        else:
            text = rng.choice([None, "", " ", "\n\t", "one", "two words", "a b c d", "ha " * 60, "x" * 90, "\U0001f600 émoji"])
        rows.append((i * 7 % 1000, text))
    rows.append((5000, document(rng, 9000)))
    rows.append((5001, rows[-1][1][200:]))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


# Rows that no table should hold, and names that the operators use themselves.
ODD = [
    (None, None), (None, "same text with a few more words"), (None, "same text with a few more words"),
    (1, None), (1, ""), (1, "same text with a few more words"), (1, "same text with a few more words"),
    (2, "same  text with a few more words "), (3, "y " * 20000), (3, "y " * 20000), (-4, "\x00 \x7f nul"), (9, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    wide = [(k, t, "x", i, None, "s", True, 7) for i, (k, t) in enumerate(ODD)]
    return spark.createDataFrame(
        wide, "doc_id long, text string, kept string, part int, score double, source string, _rest boolean, _key int"
    )


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
