"""Scores of a language model by deleted interpolation.

The probability of a token after its predecessor mixes three estimates: relative frequency of the pair,
relative frequency of the token, and one over the vocabulary. The mixture weights belong to a
bucket of the context's frequency (powers of two) and are learned by expectation-maximisation on
held-out counts: one fold of the training documents is deleted from the counts, its
tokens are predicted from what is left. The model then uses the counts of all training documents.

Counting. Documents are dealt into blocks of about BLOCK_BYTES of text by a hash of their id. A block lists its
distinct words and pairs as sorted 64-bit hashes with their counts, cut by ranges of the hash into
buckets and compressed. A bucket meets the lists of all blocks, adds up, and sends every block
the totals that differ from the block's own counts. So each distinct word or pair of a block crosses the
network once, however frequent it is, and no task holds more than a bucket or a block.
The number of blocks and buckets follows the input.

The held-out tokens are summed into a histogram over context bucket and both ratios of the estimates
in steps of a quarter of a power of two, with their means: at most some hundred thousand rows whatever the
input, on which the driver iterates.

Defined results. A null or empty text is one end token. Text is lower-cased in A-Z. A row
without an id belongs to the training documents. Repeated rows count as often as they stand there. An
empty table gives no rows. Context and token counts of zero leave the weight to the estimates that
remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import quoted, written
from tradeflow.llm.substrings import WordHashes

FOLDS, TEST_FOLD, DELETED_FOLD = 7, 2, 3
BLOCK_BYTES, LEAST_BLOCKS = 8_000_000, 64
BUCKET_BYTES, LEAST_BUCKETS = 60_000_000, 32  # bytes of text whose words and pairs fill a bucket
CONTEXTS = 32  # buckets of context frequency; 0 is for unseen contexts
ROUNDS = 40
# Arbitrary hashes for the end of a text and for the place before its first word.
END, BEGIN = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_hashes = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """Tokens of the documents of a block, and its distinct words and pairs in order."""

    def __init__(self, texts: Iterator[str | None]):
        lengths, parts = [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            parts.append(_hashes.of(words))
            lengths.append(len(words))
        self.lengths = np.array(lengths, dtype=np.int64) + 1
        ends = np.cumsum(self.lengths)
        starts = ends - self.lengths
        tokens = np.full(int(ends[-1]), END)
        inside = np.ones(len(tokens), dtype=bool)
        inside[ends - 1] = False
        tokens[inside] = np.concatenate(parts)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[starts] = BEGIN
        self.doc = np.repeat(np.arange(len(lengths)), self.lengths)
        self.words, self.word = np.unique(tokens, return_inverse=True)
        with np.errstate(over="ignore"):
            pairs = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + tokens)
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)
        self.context = np.full(len(tokens), -1, dtype=np.int64)
        self.context[1:] = self.word[:-1]
        self.context[starts] = -1

    def cuts(self, keys: np.ndarray, buckets: int) -> np.ndarray:
        """Where each bucket's range of keys begins, and the end."""
        edges = [(b << 64) // buckets for b in range(1, buckets)]
        inner = np.searchsorted(keys, np.array(edges, dtype=np.uint64))
        return np.concatenate([[0], inner, [len(keys)]])

    def counts(self, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each word and pair in the documents that train."""
        weight = trains[self.doc].astype(np.float64)
        return (
            np.bincount(self.word, weight, len(self.words)).astype(np.uint64),
            np.bincount(self.pair, weight, len(self.pairs)).astype(np.uint64),
        )


def _planes(x: np.ndarray) -> bytes:
    """64-bit integers byte by byte: high bytes, mostly zero, come together and compress away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, n).T).view("<u8").reshape(n)


def squeeze(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers as one compressed value; the first, ascending, as differences."""
    n = len(columns[0])
    steps = np.diff(columns[0], prepend=np.zeros(1, np.uint64))
    raw = b"".join(_planes(c) for c in (steps, *columns[1:]))
    packed = pa.Codec("zstd").compress(raw, asbytes=True) if n else b""
    return n.to_bytes(8, "little") + packed


def unsqueeze(data: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return [np.empty(0, np.uint64)] * columns
    raw = pa.Codec("zstd").decompress(data[8:], 8 * n * columns, asbytes=True)
    found = [_from_planes(raw[8 * n * c : 8 * n * (c + 1)], n) for c in range(columns)]
    return [np.cumsum(found[0], dtype=np.uint64), *found[1:]]


LISTS = "bucket int, block long, words binary, pairs binary"


def _lists(buckets: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The words and pairs of a block with their counts, bucket by bucket."""
        block = Block(rows["text"])
        out = {"bucket": list(range(buckets)), "block": int(rows["block"].iloc[0])}
        counted = block.counts((rows["fold"] != TEST_FOLD).to_numpy())
        for name, keys, n in zip(("words", "pairs"), (block.words, block.pairs), counted, strict=True):
            cuts = block.cuts(keys, buckets)
            out[name] = [
                squeeze(keys[a:b], n[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
        return pd.DataFrame(out)

    return run


TOTALS = "block long, bucket int, words binary, pairs binary, n long, n_deleted long, v long"


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of a bucket, for each block those that its own counts do not tell; and sums over words.

    A block holds deleted documents only if its number is odd.
    """
    bucket = int(rows["bucket"].iloc[0])
    blocks = rows["block"].to_numpy()
    out = {"block": [*blocks.tolist(), -1], "bucket": bucket, "n": 0, "n_deleted": 0, "v": 0}
    sums = (0, 0, 0)
    for name in ("words", "pairs"):
        lists = [unsqueeze(data, 2) for data in rows[name]]
        keys = np.concatenate([k for k, _ in lists])
        own = np.concatenate([n for _, n in lists])
        deleted = np.where(np.repeat(blocks % 2 == 1, [len(k) for k, _ in lists]), own, 0)
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        group = np.empty(len(keys), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        n_groups = int(new.sum())
        total = np.bincount(group, own.astype(np.float64), n_groups).astype(np.uint64)
        gone = np.bincount(group, deleted.astype(np.float64), n_groups).astype(np.uint64)
        if name == "words":
            sums = (int(total.sum()), int(gone.sum()), int((total > 0).sum()))
        answers, at = [], 0
        for k, n in lists:
            g = group[at : at + len(k)]
            d = deleted[at : at + len(k)]
            other = np.nonzero((total[g] != n) | (gone[g] != d))[0]
            answers.append(squeeze(other.astype(np.uint64), total[g][other], gone[g][other]))
            at += len(k)
        out[name] = [*answers, None]
    found = pd.DataFrame(out)
    found.loc[len(blocks), ["n", "n_deleted", "v"]] = sums
    return found


class Counts:
    """Totals and deleted counts of a block's words and pairs."""

    def __init__(self, block: Block, rows: pd.DataFrame, trains, is_deleted: bool, buckets: int):
        cut_words, cut_pairs = (block.cuts(k, buckets) for k in (block.words, block.pairs))
        self.word, self.pair = block.counts(trains)
        none = np.zeros_like
        self.word_gone = self.word.copy() if is_deleted else none(self.word)
        self.pair_gone = self.pair.copy() if is_deleted else none(self.pair)
        for bucket, words, pairs in zip(rows["bucket"], rows["words"], rows["pairs"], strict=True):
            for data, cuts, total, gone in (
                (words, cut_words, self.word, self.word_gone),
                (pairs, cut_pairs, self.pair, self.pair_gone),
            ):
                at, n, d = unsqueeze(data, 3)
                places = at.astype(np.int64) + cuts[bucket]
                total[places], gone[places] = n, d


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the floor of its count's logarithm to base two."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], CONTEXTS - 1)


HISTOGRAM = "context int, pair_step int, word_step int, n long, pair_ratio double, word_ratio double"


def _histogram(buckets: int, sizes: dict):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """Held-out tokens by context bucket and the ratios of both frequencies to 1 / vocabulary."""
        if rows.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in HISTOGRAM.split(", ")])
        block = Block(rows["text"])
        trains = np.ones(len(rows), dtype=bool)
        counts = Counts(block, answers, trains, True, buckets)
        word = (counts.word - counts.word_gone).astype(np.float64)
        pair = (counts.pair - counts.pair_gone).astype(np.float64)[block.pair]
        first = float(sizes["docs"] - sizes["docs_deleted"])
        context = np.where(block.context >= 0, word[block.context], first)
        scale = float(sizes["v"] + 1)
        word_ratio = word[block.word] * scale / max(sizes["n"] - sizes["n_deleted"], 1)
        pair_ratio = pair * scale / np.maximum(context, 1.0)
        with np.errstate(divide="ignore"):
            step = lambda r: np.where(r > 0, np.floor(4 * np.log2(r)), -1000).astype(np.int64)
            frame = pd.DataFrame(
                {
                    "context": context_bucket(context), "pair_step": step(pair_ratio),
                    "word_step": step(word_ratio), "n": 1, "pair_ratio": pair_ratio, "word_ratio": word_ratio,
                }
            )
        return frame.groupby(["context", "pair_step", "word_step"], as_index=False).sum()

    return run


def learn_weights(histogram: pd.DataFrame) -> np.ndarray:
    """Weights (context bucket; pair, word, vocabulary) by expectation-maximisation."""
    weights = np.tile([0.4, 0.5, 0.1], (CONTEXTS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if histogram.empty:
        return weights
    context = histogram["context"].to_numpy()
    n = histogram["n"].to_numpy(dtype=np.float64)
    ratios = np.stack(
        [histogram["pair_ratio"] / n, histogram["word_ratio"] / n, np.ones(len(n))], axis=1
    )
    ratios[context == 0, 0] = 0.0
    for _ in range(ROUNDS):
        share = weights[context] * ratios
        share *= (n / share.sum(axis=1))[:, None]
        # One held-out token on each estimate keeps every weight above zero.
        expected = np.stack([np.bincount(context, share[:, k], CONTEXTS) + 1.0 for k in range(3)], axis=1)
        expected[0, 0] = 0.0
        weights = expected / expected.sum(axis=1, keepdims=True)
    return weights


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _scores(buckets: int, sizes: dict, weights: np.ndarray):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])
        block = Block(rows["text"])
        trains = (rows["fold"] != TEST_FOLD).to_numpy()
        is_deleted = int(rows["block"].iloc[0]) % 2 == 1
        counts = Counts(block, answers, trains, is_deleted, buckets)
        words = counts.word.astype(np.float64)
        word, pair = words[block.word], counts.pair.astype(np.float64)[block.pair]
        context = np.where(block.context >= 0, words[block.context], float(sizes["docs"]))
        w = weights[context_bucket(context)]
        v1, n = float(sizes["v"] + 1), float(max(sizes["n"], 1))
        p = w[:, 0] * pair / np.maximum(context, 1.0) + w[:, 1] * word / n + w[:, 2] / v1
        base = np.log10((word + 1.0) / (sizes["n"] + v1))
        docs = len(rows)
        add = lambda x: np.bincount(block.doc, x, docs)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy(),
                "held_out": ~trains,
                "n_tokens": block.lengths,
                "n_known": add(word > 0).astype(np.int64),
                "train_tokens": sizes["n"],
                "base_score": add(base),
                "score": add(np.log10(p)),
            }
        )

    return run


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all documents under a model of those outside the test fold."""
    fold = F.crc32(F.coalesce(quoted(key).cast("string"), F.lit(""))) % FOLDS
    rows = docs.select(quoted(key).cast("long").alias("doc_id"), quoted(text).alias("text"), fold.cast("int").alias("fold"))
    size = rows.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
        F.count_if(F.col("fold") != TEST_FOLD).alias("docs"),
        F.count_if(F.col("fold") == DELETED_FOLD).alias("docs_deleted"),
    ).first()
    blocks = max(LEAST_BLOCKS, size["bytes"] // BLOCK_BYTES)
    buckets = max(LEAST_BUCKETS, size["bytes"] // BUCKET_BYTES)
    dealt = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(blocks))
    # A seventh of the documents is deleted: a seventh of the blocks, with odd numbers, is theirs.
    deleted = F.col("fold") == DELETED_FOLD
    few = max(1, blocks // FOLDS)
    block = F.when(deleted, 2 * F.pmod(dealt, F.lit(few)) + 1).otherwise(2 * dealt)
    rows = rows.withColumn("block", block)
    lists = rows.groupBy("block").applyInPandas(_lists(int(buckets)), LISTS)
    totals = written(lists.groupBy("bucket").applyInPandas(_add_up, TOTALS), "lm-totals")
    sums = totals.filter("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_deleted", "v")]).first()
    sizes = {**size.asDict(), **sums.asDict()}
    answers = totals.filter("block >= 0").select("block", "bucket", "words", "pairs")
    held = (
        rows.filter(deleted)
        .groupBy("block")
        .cogroup(answers.filter("block % 2 = 1").groupBy("block"))
        .applyInPandas(_histogram(int(buckets), sizes), HISTOGRAM)
        .groupBy("context", "pair_step", "word_step")
        .agg(*[F.sum(c).alias(c) for c in ("n", "pair_ratio", "word_ratio")])
        .orderBy("context", "pair_step", "word_step")
    )
    # Bounded: context buckets times steps of both ratios.
    histogram = pd.DataFrame(held.collect(), columns=held.columns)
    weights = learn_weights(histogram)
    return (
        rows.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(_scores(int(buckets), sizes, weights), SCORES)
    )


def lm_scores(docs: DataFrame) -> DataFrame:
    """Digest of the scores, one row per document."""
    return scored(docs.select("doc_id", "text"))
