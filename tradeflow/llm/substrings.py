"""Substring dedup by seed and extend.

Seeds. Every window of WINDOW words takes as its anchor the smallest hash among its k-grams of
GRAM words (winnowing), so equal windows have equal anchors wherever they stand. Consecutive windows of one
anchor form a run; a document has about 2 / (WINDOW - GRAM + 2) runs a word. Only anchors that stand in
several documents are carried on.

Extension. A run reaches from its first window's first word to its last window's last word, as far
both ways as its anchor is the seed. Runs of the same words are one class, known by 128-bit hashes
of its reach: copies and the inside of shared passages collapse into one class, whose members after
the first are repeats as a whole. Where an anchor has several classes, which happens at the ends of passages and
around common phrases, the windows of the smallest document of each class are compared by 128-bit
hashes, and each takes the smallest document among the classes that hold it. Neighbouring repeated windows,
over all runs, join to maximal repeats of at least WINDOW words.

Tables between the steps go into the files that their rows or texts need, however many partitions a shuffle or the
input has; large ones stay as they are dealt. For that, texts are measured and two tables counted.

No pairs of documents are formed. Sums by key combine on the map side, and what a hot anchor, class
or window meets in a join is one row of a written table, so adaptive execution can split it.

Defined results. A null or empty text has no words; a text shorter than a window loses nothing.
Windows repeated within a document, or in rows that share an id, are no repeats. A row without
an id counts as larger than every id. Repeated rows lose the same words. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import in_files, quoted, written

WINDOW, GRAM = 50, 12
CACHED = 1_000_000
BATCH_CHARS = 2_000_000
TEXT_A_FILE = 4_000_000  # bytes of texts that a task reads at least, where it writes a file
NO_ID = 2**63 - 1
# Odd multipliers of the two polynomial hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD95)


class WordHashes(dict):
    """Place of a word in a table of hashes; new words join the table."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros(1 << 16, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = xxhash.xxh64_intdigest(word, 7)
        self[word] = at
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED:
            self.clear()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[places]


_hashes = WordHashes()


class Reaches:
    """Hashes of any stretch of a row of word hashes, by prefix sums modulo 2**64."""

    def __init__(self, words: np.ndarray, factor: int):
        n = len(words)
        inverse = pow(factor, -1, 1 << 64)
        with np.errstate(over="ignore"):
            powers = np.full(n + 1, factor, dtype=np.uint64)
            powers[0] = 1
            np.cumprod(powers, out=powers)
            self.back = np.full(n + 1, inverse, dtype=np.uint64)
            self.back[0] = 1
            np.cumprod(self.back, out=self.back)
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(words * powers[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.back[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _smallest(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of the n entries that start at each place, as long as n remain."""
    best, span = x, 1
    while span < n:
        step = min(span, n - span)
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    return best


def find_runs(words: np.ndarray, lengths: np.ndarray):
    """Runs of texts whose word hashes lie in a row: text, start, windows, anchor, two hashes."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    counts = np.maximum(lengths - WINDOW + 1, 0)
    if not counts.sum():
        none = np.empty(0, np.int64)
        return none, none, none, none, none, none
    first, second = (Reaches(words, f) for f in FACTORS)
    at = np.arange(len(words) - GRAM + 1)
    anchors = _smallest(_mixed(first(at, at + GRAM)), WINDOW - GRAM + 1)
    text = np.repeat(np.arange(len(lengths)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[text]
    anchor = anchors[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 1) | (anchor[1:] != anchor[:-1])
    begins = np.nonzero(new)[0]
    n = np.diff(np.concatenate([begins, [len(start)]]))
    text, start, anchor = text[begins], start[begins], anchor[begins]
    end = start + n - 1 + WINDOW
    return text, start - offsets[text], n, anchor.view(np.int64), *(
        r(start, end).view(np.int64) for r in (first, second)
    )


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Rows in blocks of bounded size, with the words of their texts."""
    for frame in batches:
        lo = size = 0
        sizes = frame["text"].str.len().fillna(0).to_numpy()
        for hi in range(1, len(frame) + 1):
            size += sizes[hi - 1]
            if size >= BATCH_CHARS or hi == len(frame):
                part = frame.iloc[lo:hi]
                yield part, [(t or "").encode().split() for t in part["text"]]
                lo, size = hi, 0


RUNS = "key long, th long, start int, n int, anchor long, r1 long, r2 long"


def _seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, texts in _blocks(batches):
        lengths = np.array([len(w) for w in texts], dtype=np.int64)
        hashes = _hashes.of([w for words in texts for w in words])
        text, start, n, anchor, r1, r2 = find_runs(hashes, lengths)
        yield pd.DataFrame(
            {
                "key": frame["key"].to_numpy()[text],
                "th": frame["th"].to_numpy()[text],
                "start": start, "n": n, "anchor": anchor, "r1": r1, "r2": r2,
            }
        )


WINDOWS = "w1 long, w2 long, key long, th long, start int"


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of the windows of the runs asked for."""
    for frame, texts in _blocks(batches):
        out = []
        for key, th, asked, words in zip(frame["key"], frame["th"], frame["asked"], texts, strict=True):
            hashes = _hashes.of(words)
            runs = np.array([(r["start"], r["n"]) for r in asked], dtype=np.int64)
            starts = np.unique(np.concatenate([np.arange(s, s + n) for s, n in runs]))
            w1, w2 = (
                Reaches(hashes, f)(starts, starts + WINDOW).view(np.int64) for f in FACTORS
            )
            out.append(
                pd.DataFrame({"w1": w1, "w2": w2, "key": key, "th": th, "start": starts})
            )
        if out:
            yield pd.concat(out, ignore_index=True)


def _text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def repeats(docs: DataFrame, size: int | None = None) -> DataFrame:
    """key, th, spans: first words of repeated windows, as (from, to) with both ends included.

    docs has key (never null), th (hash of the text) and text; size is that of all texts in bytes, if it is known.
    """
    size = _text_bytes(docs) if size is None else size
    runs = written(in_files(docs.mapInPandas(_seeds, RUNS), size, TEXT_A_FILE), "runs")
    n = runs.count()  # of the tables made of runs, none has more rows
    shared = (
        runs.groupBy("anchor")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        .filter("lo < hi")
        .select("anchor")
    )
    shared = written(shared, "shared-anchors", rows=n)
    runs = written(runs.join(shared, "anchor"), "shared-runs", rows=n)
    reach = ["anchor", "r1", "r2", "n"]
    classes = written(
        runs.groupBy(*reach).agg(F.min("key").alias("lo"), F.max("key").alias("hi")), "run-classes", rows=n
    )
    several = written(
        classes.groupBy("anchor").count().filter("count > 1").select("anchor"), "unlike-anchors", rows=n
    )
    unlike = written(classes.join(several, "anchor").select(*reach, "lo"), "unlike-classes", rows=n)
    asked = (
        runs.join(unlike, reach)
        .filter("key = lo")  # the document that stands for the class, wherever it holds the run
        .groupBy("key", "th")
        .agg(F.collect_set(F.struct("start", "n")).alias("asked"))  # repeated rows ask once
    )
    asked = written(asked, "asked-runs", rows=n)
    windows = (
        docs.join(asked, ["key", "th"])
        .select("key", "th", "text", "asked")
        .mapInPandas(_windows, WINDOWS)
    )
    windows = written(in_files(windows, size, TEXT_A_FILE), "windows")
    least = (
        windows.groupBy("w1", "w2")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        .filter("lo < hi")
        .select("w1", "w2", "lo")
    )
    least = written(least, "repeated-windows", rows=windows.count())
    in_firsts = windows.join(least, ["w1", "w2"]).filter("key > lo").select(
        "key", "th", F.col("start").alias("from"), F.col("start").alias("to")
    )
    copied = classes.filter("lo < hi").select(*reach, "lo")
    in_copies = runs.join(copied, reach).filter("key > lo").select(
        "key", "th", F.col("start").alias("from"), (F.col("start") + F.col("n") - 1).alias("to")
    )
    # A set: rows that share id and text find the same spans, and each row gets them once.
    return in_firsts.unionByName(in_copies).groupBy("key", "th").agg(
        F.collect_set(F.struct("from", "to")).alias("spans")
    )


def covered(spans, n_words: int) -> np.ndarray:
    """Which words the repeated windows cover, as a mask."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    where = np.array([(s["from"], s["to"]) for s in spans], dtype=np.int64)
    np.add.at(edges, where[:, 0], 1)
    np.add.at(edges, where[:, 1] + WINDOW, -1)
    return np.cumsum(edges)[:n_words] > 0


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, texts in _blocks(batches):
        rows = []
        for doc, spans, words in zip(frame["doc_id"], frame["spans"], texts, strict=True):
            n, removed = len(words), 0
            if spans is not None and len(spans):
                gone = covered(spans, n)
                removed = int(gone.sum())
                words = compress(words, (~gone).tolist())
            kept = hashlib.sha256(b" ".join(words)).hexdigest()
            rows.append((None if pd.isna(doc) else int(doc), n, removed, kept))
        yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        quoted(key).cast("long").alias("doc_id"),
        F.coalesce(quoted(key).cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64(quoted(text)).alias("th"),
        quoted(text).alias("text"),
    )


def _without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, texts in _blocks(batches):
        kept = []
        for spans, words in zip(frame["spans"], texts, strict=True):
            gone = covered(spans, len(words)) if spans is not None and len(spans) else None
            left = words if gone is None else compress(words, (~gone).tolist())
            kept.append(b" ".join(left).decode())
        yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "text": kept})


def _with_spans(docs: DataFrame, key: str, text: str, each, schema: str) -> DataFrame:
    """What `each` makes of documents and their spans."""
    keyed = _keyed(docs, key, text)
    size = _text_bytes(keyed)
    found = repeats(keyed.select("key", "th", "text"), size)
    rows = keyed.join(found, ["key", "th"], "left").select("doc_id", "text", "spans")
    return in_files(rows.mapInPandas(each, schema), size, TEXT_A_FILE)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the kept words of each text, joined by one space."""
    return _with_spans(docs, key, text, _without, "doc_id long, text string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Digest of the kept words, one row per document."""
    return _with_spans(docs, "doc_id", "text", _digest, DIGEST)
