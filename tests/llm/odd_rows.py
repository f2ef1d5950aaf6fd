import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, token string, tox_x int, entries int, bucket int"


def prose(rnd: random.Random, words: int) -> str:
    parts = ["al", "be", "ci", "do", "eu", "fa", "go", "hi", "jé"]
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    """Nulls, empty and long texts, repeated rows, near copies, shared passages, odd white space; columns with clashing names."""
    rnd = random.Random(11)
    shared = prose(rnd, 60)
    base = prose(rnd, 120)
    near = base.split(" ")
    near[40] = "changed"
    texts = [None, "", "   \n ", "a", "one two", "One TWO", base, base, " ".join(near), base.upper()]
    texts += [f"{prose(rnd, 30)}\n{shared}\n{prose(rnd, 30)}" for _ in range(3)]
    texts += ["x" * 900, "ab " * 300, "a  b\t\tc \n\n d", "é" * 500, "Released under the MIT License.", shared + shared, "\\### <|x|> </turn>"]
    texts += [prose(rnd, 4000)]
    rows = [(i, t, "en", "s", len(t) if t is not None else None, 1, "t", 2, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[6], rows[12], (None, base, None, None, None, None, None, None, None, None), (None, None, *[None] * 8)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
