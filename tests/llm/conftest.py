import random

import pytest

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, key string, node string, h string, size string, hash string, row string, quality string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names the operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, *["x"] * 8) for r in rows]
        return spark.createDataFrame(full, SHAPE).repartition(3)

    return make


@pytest.fixture(scope="session")
def words():
    def make(n, seed, vocabulary=5000):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def odd(words):
    """NULLs, empty and blank texts, repeated rows, one id with several texts, line feeds, a long text, other scripts."""
    long = " ".join(words(20000, 1))
    base = " ".join(words(200, 2))
    lines = "\n".join(" ".join(words(12, k)) for k in range(8))
    return [
        (1, None, "a"), (2, "", None), (3, " \t\n ", "b"), (4, base, "a"), (4, base, "a"), (5, base, None), (6, base.upper(), "a"), (7, long, "c"), (8, long + " end", "a"),
        (9, lines, "b"), (9, lines + "\nmore of it here", "b"), (10, lines.replace("\n", "\n\n"), "b"), (None, "no id at all " * 20, None), (None, base + " x", "a"),
        (-3, "日本語のテキスト " * 60 + "\x1c\x85 ", "é"), (11, "x", "a"), (12, "one two", "a"), (13, "one two", "b"), (14, "###$$$ " * 80, "b"), (15, "aaaa" * 400, "b"), (16, "<|endoftext|> and  more\n\n spaces   ", "c"),
    ]
