import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, brought along by a caller.
CLASHING = "key string, size int, fp string, spans string, `kept_n` int, `a.b` int, u int, block int"


def invented(seed, n=60, words=400):
    """Documents of invented words, with copies, near copies, shared passages and odd texts."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abdeghilnorstu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(stems) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(k))
    passage = prose(70)
    texts = []
    for i in range(n):
        text = prose(rng.randint(1, words))
        if i % 5 == 0:
            text = f"{prose(30)} {passage} {prose(rng.randint(0, 30))}"
        if i % 7 == 3 and texts:
            text = rng.choice(texts)
        if i % 11 == 5 and texts:
            text = rng.choice(texts) + " tail"
        texts.append(text)
    odd = ["", " \n\t ", "a", "a b", "x " * 500, "wort" * 3000, "É日本 😀 z\xa0q", "A\x00b\r\nC  d \n"]
    return [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate([*texts, *odd])]


@pytest.fixture(scope="session")
def corpus(spark):
    """Invented documents, written and read back in several parts."""
    return invented(3)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, COLUMNS).repartition(4)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, repeated rows and clashing names."""
    rows = [
        (None, None, None, None, None),
        (None, "one text without an id", "en", None, 3),
        (1, None, None, "s", None),
        (2, "", "en", "s", 0),
        (3, "three words here", None, "s", 1),
        (3, "three words here", None, "s", 1),
        (4, "three words here", "en", None, 1),
    ]
    extra = ("k", 1, "f", None, 1, 2, 3, 4)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{COLUMNS}, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{COLUMNS}, {CLASHING}")
