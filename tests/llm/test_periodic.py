"""Periodic runs against a search of all periods at all places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, COLUMNS
from tradeflow.llm import periodic

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACES.split(text or "") if w]


def brute(words):
    """All (start, length, period): maximal stretches by every lag, without those of a smaller period."""
    n, stretches = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                stretches.append((i, j - i + p, p))
            i = max(j, i + 1)
    smallest = [
        (s, m, p)
        for s, m, p in stretches
        if not any(all(words[x] == words[x + q] for x in range(s, s + m - q)) for q in range(1, p))
    ]
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def looped(doc_id, text):
    words = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(words):
    runs = brute(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def found_by_method(words):
    return [(r.start, r.length, r.period) for r in periodic.find_runs([np.array(words, dtype=np.int64)])[0]]


@pytest.mark.parametrize("seed", range(30))
def test_planted_runs(seed):
    """Runs of all scales beside one another, inside one another and cut short, over few words."""
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 3, 50, 1000])
    words = []
    while len(words) < 700:
        kind = rng.random()
        p = rng.choice([1, 2, 3, 7, 15, 16, 17, 23, 24, 25, 36, 37, 40, 60, 61, 90, 200])
        block = [rng.randrange(letters) for _ in range(p)]
        if kind < 0.3:  # a period made of shorter ones
            block = (block[: max(1, p // 5)] * 5)[:p]
        if kind < 0.6:
            words += [block[i % len(block)] for i in range(rng.randint(2 * p, 5 * p))]
        elif kind < 0.8:  # one word off
            part = block * 6
            part[rng.randrange(len(part))] = -5
            words += part
        else:
            words += [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
    words = words[:900]
    assert found_by_method(words) == brute(words)


@pytest.mark.parametrize("p", [1, 2, 8, 9, 15, 16, 17, 24, 25, 36, 37, 55, 56, 100, 333])
def test_exact_bounds(p):
    """Just long enough counts, one word less does not, wherever the run stands."""
    block = list(range(10, 10 + p))
    need = max(24, 3 * p)
    for lead in (0, 1, 13):
        for length in (need - 1, need, need + 1):
            run = [block[i % p] for i in range(length)]
            words = [-i - 2 for i in range(lead)] + run + [-10_000]
            assert found_by_method(words) == ([(lead, length, p)] if length >= need else [])


def test_texts_of_a_block_do_not_meet():
    numbers = [np.full(n, 7) for n in (23, 24, 0, 30, 5)]
    assert [[(r.start, r.length, r.period) for r in runs] for runs in periodic.find_runs(numbers)] == [
        [], [(0, 24, 1)], [], [(0, 30, 1)], [],
    ]


def test_digest_of_documents(spark, docs, corpus):
    found = {r.doc_id: tuple(r)[1:] for r in periodic.periodic_digest(docs).collect()}
    assert len(found) == len(corpus)
    for doc_id, text, *_ in corpus:
        assert found[doc_id] == digest(looped(doc_id, text)), doc_id
    assert sum(row[0] > 0 for row in found.values()) >= 3


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sorted(map(tuple, periodic.periodic_digest(odd_docs).collect()), key=repr)
    expected = [(r.doc_id, *digest(looped(r.doc_id, r.text))) for r in odd_docs.collect()]
    assert rows == sorted(expected, key=repr)
    assert periodic.periodic_digest(no_docs).collect() == []
    general = periodic.periodic_runs(odd_docs)
    assert general.count() == odd_docs.count() and general.schema["doc_id"].dataType.simpleString() == "bigint"
    assert periodic.periodic_runs(no_docs).collect() == []


def test_very_long_texts(spark):
    """Millions of characters: one word throughout, a long period, and no repetition at all."""
    loop = " ".join(f"w{i}" for i in range(9_000))
    texts = ["x " * 1_000_000, f"{loop} " * 30 + "end", " ".join(f"u{i}" for i in range(300_000))]
    df = spark.createDataFrame([(i, t, None, None, 0, *[None] * 8) for i, t in enumerate(texts)], f"{COLUMNS}, {CLASHING}")
    rows = {r.doc_id: r for r in periodic.periodic_runs(df).collect()}
    assert [tuple(r) for r in rows[0].runs] == [(0, 1_000_000, 1)] and rows[0].collapsed == "x"
    assert [tuple(r) for r in rows[1].runs] == [(0, 270_000, 9_000)] and rows[1].collapsed == f"{loop} end"
    assert rows[2].runs == [] and rows[2].collapsed == texts[2]


def test_repeated_rows_alike(spark):
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b " * 20).alias("text"))
    assert periodic.periodic_digest(df).distinct().count() == 1
