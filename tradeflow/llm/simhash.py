"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints of documents are computed in Arrow batches. Equal fingerprints become one node, so copies
are never paired. If the 64 bits are split into groups with thresholds that add up to the distance
minus the number of groups plus one, two fingerprints within the distance are within the threshold
in at least one group; a threshold of -1 skips a group. Correlated bits are put into one
group, since spread over several they make each of these less selective. Thresholds come from
dynamic programming over estimated candidate counts and the probes a threshold costs, both of
which depend on the number of fingerprints: few are matched on exact groups of 21 bits, many on
longer groups probed with flipped bits. Candidates are verified on all 64 bits.

The layout is estimated on at most SAMPLE fingerprints. It decides how pairs are found, never
which: any layout finds every pair within the distance.

Defined results. A null text is empty. A text without words has fingerprint zero and is linked
like any other; one with fewer words than a shingle is one shingle. Ties in a bit (set in exactly
half) leave it unset. Rows without an id take part, but do not name a component unless it has no
other id. Repeated rows share a component. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tradeflow.llm.common import TEXTS_A_FILE, fresh, in_files, quoted, written
from tradeflow.llm.components import components

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
SAMPLE = 8_000
CHUNK = 50_000  # shingles whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and the six spaces alone
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    is_set = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(is_set, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return fingerprints


def group_bits(sample: np.ndarray, groups: int) -> list[list[int]]:
    """The 64 bits in groups of near equal size, each around its most correlated bits."""
    bits = np.unpackbits(
        sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    ).astype(np.float64)
    bits -= bits.mean(axis=0) if len(bits) else 0.0
    scale = np.sqrt(np.maximum((bits * bits).sum(axis=0), 1e-9))
    likeness = np.abs(bits.T @ bits) / np.outer(scale, scale)
    np.fill_diagonal(likeness, 0.0)
    free, found = set(range(BITS)), []
    for k in range(groups):
        size = (BITS - k + groups - 1) // groups
        pick = sorted(free)
        first = pick[int(np.argmax(likeness[np.ix_(pick, pick)].max(axis=1)))]
        group = [first]
        free.discard(first)
        while len(group) < size and free:
            rest = sorted(free)
            best = rest[int(np.argmax(likeness[np.ix_(rest, group)].mean(axis=1)))]
            group.append(best)
            free.discard(best)
        found.append(sorted(group))
    return found


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def flips(bits: list[int], radius: int) -> list[int]:
    """Masks that flip at most so many of the bits."""
    found = [0]
    if radius >= 1:
        found += [1 << b for b in bits]
    if radius >= 2:
        found += [1 << a | 1 << b for i, a in enumerate(bits) for b in bits[i + 1 :]]
    if radius > 2:
        raise ValueError("distances over 2 within a group are not supported")
    return found


def _near_share(sample: np.ndarray, bits: list[int], radius: int) -> float:
    """Estimated share of all pairs that a group at a radius makes candidates."""
    masks = flips(bits, radius)
    chance = len(masks) / 2.0 ** len(bits)
    n = len(sample)
    if n < 2 or len(masks) * n > 50_000_000:
        return chance
    values, counts = np.unique(sample & np.uint64(mask_of(bits)), return_counts=True)
    met = -n
    for flip in masks:
        other = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        met += int((counts * np.where(values[at] == other, counts[at], 0)).sum())
    return max(chance, met / (n * (n - 1.0)))


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost; costs[g][t + 1] is that of threshold t in group g.

    Every group uses t + 1 of a budget of distance + 1, which dynamic programming spends.
    """
    budget = distance + 1
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * budget
    for of_group in costs:
        nexts = [(float("inf"), [])] * (budget + 1)
        for spent, (cost, chosen) in enumerate(best):
            for use, more in enumerate(of_group):
                if spent + use <= budget and cost + more < nexts[spent + use][0]:
                    nexts[spent + use] = (cost + more, [*chosen, use - 1])
        best = nexts
    return best[budget]


def layout(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with thresholds for a self-join of n fingerprints."""
    found = []
    for groups in range(1, distance + 3):
        parts = group_bits(sample, groups)
        costs = [
            [0.0]
            + [
                n * float(len(flips(bits, t))) + n * (n / 2.0) * _near_share(sample, bits, t)
                for t in range(min(distance, 2) + 1)
            ]
            for bits in parts
        ]
        cost, thresholds = allocate(costs, distance)
        found.append((cost, [(b, t) for b, t in zip(parts, thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _keys(fingerprint: Column, plan: list[tuple[list[int], int]], probing: bool) -> Column:
    """Array of (group, value of the group's bits); when probing, also of the flipped values."""
    return F.array(
        *[
            F.struct(
                F.lit(g).alias("g"),
                fingerprint.bitwiseAND(F.lit(_signed(mask_of(bits))))
                .bitwiseXOR(F.lit(_signed(flip)))
                .alias("value"),
            )
            for g, (bits, radius) in enumerate(plan)
            for flip in (flips(bits, radius) if probing else [0])
        ]
    )


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: all pairs of the distinct fingerprints (fp) within the distance, a > b."""
    n = nodes.count()
    rows = nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()  # a bounded sample
    plan = layout(np.array([r.fp for r in rows], dtype=np.int64).view(np.uint64), n, distance)

    def keyed(name: str, probing: bool) -> DataFrame:
        keys = nodes.select(
            F.col("fp").alias(name), F.explode(_keys(F.col("fp"), plan, probing)).alias("k")
        )
        return keys.select(name, "k.*")

    return (
        keyed("a", True)
        .join(keyed("b", False), ["g", "value"])
        .filter("a > b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )


def _clustered(
    docs: DataFrame, key: str, text: str, shingle: int, distance: int
) -> tuple[DataFrame, int]:
    """What clustered() returns, and its number of rows."""
    rows = written(
        docs.select(
            quoted(key).alias("key"),
            F.xxhash64(*[quoted(c) for c in docs.columns]).alias("row"),
            fingerprint_udf(shingle)(quoted(text)).alias("fp"),
        ),
        "fingerprints",
    )
    n = rows.count()  # bounds what is kept by fingerprint
    nodes = written(rows.groupBy("fp").agg(F.min("key").alias("first")), "fingerprint-nodes", rows=n)
    roots = components(links(nodes.select("fp"), distance)).withColumnRenamed("node", "fp")
    of = nodes.join(roots, "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = of.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(of.join(names, "root").select("fp", "root", "component_id"), "fingerprint-names", rows=n)
    return rows.join(named, "fp"), n


def clustered(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """key, row (a hash of the row), fp and component_id of every row, all written."""
    return _clustered(docs, key, text, shingle, distance)[0]


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of docs."""
    rows, most = _clustered(docs, key, text, shingle, distance)
    kept = rows.groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "row")).alias("k")
    )
    kept = written(kept.select("k.key", "k.row"), "kept", rows=most)
    own, row, n = fresh(docs.columns, "kept_key", "kept_row", "kept_n")
    columns = [quoted(c) for c in docs.columns]
    hashed = docs.select(*columns, F.xxhash64(*columns).alias(row))
    of = kept.toDF(own, row + "_of")
    joined = hashed.join(
        of, quoted(key).eqNullSafe(F.col(own)) & (F.col(row) == F.col(row + "_of"))
    )
    # Rows alike in every column all match; one of them stays.
    once = Window.partitionBy(own, row + "_of").orderBy(F.lit(0))
    found = joined.withColumn(n, F.row_number().over(once)).filter(F.col(n) == 1).select(*columns)
    return in_files(found, kept.count(), TEXTS_A_FILE)


def simhash(docs: DataFrame) -> DataFrame:
    """Digest of the groups, one row per document."""
    return clustered(docs.select("doc_id", "text")).select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
