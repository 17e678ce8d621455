"""Runs of words that repeat with a period, by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends and that
is at least max(24, 3 q) words long. Words become numbers, equal for equal words only.

Periods below SHORT are found by direct scans: for each lag, stretches where words that far apart agree.

Longer periods are taken in scales from lo to hi = 3/2 lo. At a scale every window of w = 2 lo - hi + 1
grams of hi words selects the leftmost of its smallest gram hashes. A run with period p of that scale
holds a window and the one p words on whole, since both together need p + 2 lo <= 3 p words; they select
grams at distance p. No gram between them is equal, since a gram is as long as p and the run has no
smaller period. So neighbours among the equal grams selected, at a distance of the scale, seed all runs,
a number linear in the text. A seed is extended both ways by comparing words that far apart, in steps
that double. What it finds counts if it is long enough and no period that divides the distance fits.

Documents are worked on in blocks of bounded size, longest first, so that the documents which are long
enough for a scale are the head of the block; rows are independent, and one text is the least a task holds.

Defined results. A null or empty text has no words and no runs. Runs with different periods may overlap;
each counts, and a word is dropped once. Repeated rows and rows without an id get the same runs as any
other. An empty table gives no rows; columns besides id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import SPACE, let, quoted
from tradeflow.llm.substrings import FACTORS, Reaches, _blocks, _mixed

LEAST, TIMES = 24, 3
SHORT = 16


@dataclass(frozen=True)
class Run:
    start: int
    length: int
    period: int


def scales(longest: int) -> list[tuple[int, int]]:
    """Periods (lo, hi) of every scale that a text of so many words can hold."""
    found, lo = [], SHORT
    while TIMES * lo <= longest:
        found.append((lo, lo + lo // 2))
        lo += lo // 2 + 1
    return found


def _selected(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the leftmost smallest hash of every window of w, each once and in order."""
    place = np.arange(len(hashes))
    span = 1
    while span < w:
        step = min(span, w - span)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(hashes[right] < hashes[left], right, left)
        span += step
    return place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place


def _seeds(words: np.ndarray, hashes: Reaches, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal grams at a distance of the scale."""
    at = np.arange(len(words) - hi + 1)
    grams = _mixed(hashes(at, at + hi))
    picked = _selected(grams, 2 * lo - hi + 1)
    order = np.lexsort((picked, grams[picked]))
    picked = picked[order]
    distance = np.diff(picked)
    seed = (np.diff(grams[picked].view(np.int64)) == 0) & (distance >= lo) & (distance <= hi)
    return picked[:-1][seed], distance[seed]


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many words from the first on agree, looked up in steps that double."""
    done, step = 0, 32
    while done < len(a):
        unlike = a[done : done + step] != b[done : done + step]
        if unlike.any():
            return done + int(unlike.argmax())
        done += step
        step *= 2
    return len(a)


def _is_smallest(words: np.ndarray, period: int) -> bool:
    """Whether no proper divisor of the period fits the words, which are at least two periods long."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            q = period // factor
            if np.array_equal(words[:period], words[q : q + period]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def find_runs(numbers: list[np.ndarray]) -> list[list[Run]]:
    """Runs of each text, given as a row of word numbers, by start and then period."""
    found: list[list[Run]] = [[] for _ in numbers]
    order = sorted(range(len(numbers)), key=lambda i: -len(numbers[i]))
    lengths = np.array([len(numbers[i]) for i in order], dtype=np.int64)
    lengths = lengths[: int((lengths >= LEAST).sum())]
    if not len(lengths):
        return found
    # A word of its own after each text, so that no stretch goes on into the next.
    joined = [part for place, i in enumerate(order[: len(lengths)]) for part in (numbers[i], [-1 - place])]
    words = np.concatenate(joined).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])

    def keep(text: int, a: int, b: int, period: int) -> None:
        length = b - a + period
        if length >= max(LEAST, TIMES * period) and _is_smallest(words[a : a + 2 * period], period):
            found[order[text]].append(Run(int(a - begins[text]), int(length), int(period)))

    for lag in range(1, SHORT):
        same = np.concatenate([[False], words[lag:] == words[:-lag], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts + lag >= max(LEAST, TIMES * lag)
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            keep(int(np.searchsorted(begins, a, "right")) - 1, a, b, lag)

    with np.errstate(over="ignore"):
        mixed = _mixed(words.view(np.uint64) * np.uint64(FACTORS[1]))
    hashes = Reaches(mixed, FACTORS[0])
    for lo, hi in scales(int(lengths[0])):
        head = begins[int((lengths >= TIMES * lo).sum())]
        places, distances = _seeds(words[:head], hashes, lo, hi)
        rank = np.lexsort((places, distances))
        places, distances = places[rank], distances[rank]
        texts = np.searchsorted(begins, places, "right") - 1
        last, end = None, -1
        for at, d, text in zip(places.tolist(), distances.tolist(), texts.tolist(), strict=True):
            stop = int(begins[text + 1]) - 1
            if at + d >= stop or ((d, text) == last and at < end):
                continue
            b = at + _agreeing(words[at : stop - d], words[at + d : stop])
            first = int(begins[text])
            a = at - _agreeing(words[first:at][::-1], words[first + d : at + d][::-1])
            last, end = (d, text), b
            keep(text, a, b, d)
    return [sorted(set(runs), key=lambda r: (r.start, r.period)) for runs in found]


def numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The words of each text as numbers, equal for equal words only."""
    known: dict[bytes, int] = {}
    return [np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) for words in texts]


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        edges[r.start + r.period] += 1
        edges[r.start + r.length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period, compared without rounding."""
    best = None
    for r in runs:
        if best is None or r.length * best.period > best.length * r.period:
            best = r
    return best


RUNS = "key string, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, texts in _blocks(batches):
        found = find_runs(numbered(texts))
        yield pd.DataFrame(
            {
                "key": frame["key"].to_numpy(),
                "runs": [[vars(r) for r in runs] for runs in found],
                "collapsed": [b" ".join(kept_words(w, r)).decode() for w, r in zip(texts, found, strict=True)],
            }
        )


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, its runs by start and then period, and the text without their repetitions."""
    rows = docs.select(quoted(key).cast("string").alias("key"), quoted(text).alias("text"))
    found = rows.mapInPandas(_runs, RUNS)
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "runs", "collapsed")


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, texts in _blocks(batches):
        rows = []
        for doc, words, runs in zip(frame["doc_id"], texts, find_runs(numbered(texts)), strict=True):
            best = _strongest(runs)
            listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
            told = [None] * 4
            if best is not None:
                told = [best.start, best.length, best.period, 1000 * best.length // best.period]
            digests = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(kept_words(words, runs)))]
            rows.append((None if pd.isna(doc) else int(doc), len(runs), *told, *digests))
        names = [part.split()[0] for part in DIGEST.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({n: "Int64" for n in names[:6]})


def looped(doc_id: Column, text: Column) -> Column:
    """The texts that the query looks at: those of a tenth of the ids repeat from some word on.

    With h the CRC-32 of the decimal id and g = h div 10, where h ends in 0 the words from a = g % n on
    become the first p = 1 + (n - a) div (3 + g % 8) of them, over and over.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def loop(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        turned = F.transform(ws, lambda w, i: F.get(ws, place(i.cast("long")).cast("int")))
        return F.when(n > 0, F.array_join(turned, " ")).otherwise(text)

    return F.when(h % 10 == 0, let(words, loop)).otherwise(text)


def periodic_digest(docs: DataFrame) -> DataFrame:
    """Digest of the runs of the looped texts, one row per document."""
    rows = docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    return rows.mapInPandas(_digest, DIGEST)
