import random

import pytest

WORDS = [a + b for a in ("ta", "re", "mi", "so", "lu", "ke", "vo", "pa", "di", "ne") for b in ("n", "r", "st", "l", "nd", "k", "m", "sh")]


@pytest.fixture
def prose():
    """A function of a seed and a number of words: made-up text in lines."""

    def make(seed, n):
        rng = random.Random(seed)
        words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]
        return "\n".join(" ".join(words[k : k + 12]) for k in range(0, n, 12))

    return make


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    def make(rows, schema=SCHEMA):
        return spark.createDataFrame(rows, schema)

    return make
