import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard string, rest string, label string, node string, h string, repeats_target string"


def prose(seed: int, words: int, line: int = 12) -> str:
    r = random.Random(seed)
    out = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + line]) for i in range(0, words, line))


def messy_rows() -> list[tuple]:
    base = prose(1, 300)
    changed = base.split(" ")
    changed[40] = "other"
    texts = [
        (1, base), (2, base.upper()), (3, base), (4, " ".join(changed)), (5, None), (6, ""), (7, "   \n \t"),
        (8, "One"), (9, "one"), (10, "two words"), (11, "É È Ñ é"), (12, "é è ñ é"), (13, "x" * 64), (14, "x" * 65),
        (15, "X" * 64), (16, prose(2, 20_000, 500)), (17, prose(3, 90)), (17, prose(3, 90)), (17, prose(4, 90)),
        (None, prose(5, 40)), (None, None), (18, prose(6, 50, 10_000)), (20, "a\x00b  c\r\n\td e <|endoftext|> | x|"),
    ]
    sources = ["b", "a", None, "", "a", "c", "a"]
    return [(i, t, "en", sources[k % len(sources)], None, "k", "s", "sh", "r", "l", "n", "h", "t") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, columns whose names the operators use."""
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    """The same rows as ``(doc_id, text, source)``."""
    return [(r[0], r[1], r[3]) for r in messy_rows()]


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
