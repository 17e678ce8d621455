"""Embedding near-dedup by lattice hashing.

In each of TABLES tables a random projection takes a unit vector to 8 dimensions, where it is decoded
to the nearest point of the lattice E8. Vectors own the cell of their point and visit the PROBES
neighbouring cells (of the 240 at least distance) nearest to them. Two vectors are compared if
in some table one owns a cell that the other owns or visits, and linked if their labels are equal and
their cosine in double precision is SIMILARITY or more.

A cell may be hot, and all pairs of its members may be true links, whose number is asked for.
Members of a cell are split into blocks of BLOCK; pairs of blocks are compared by matrix products,
which return one row per vector (links counted, root of a local spanning tree), never pairs. A pair
that meets in several cells is counted in the first of them, which both vectors' keys tell.

Defined results. Vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing; vectors of different lengths do not link. A repeated row
is another vector. Rows without an id take part, but name a component only if no member has
an id. Ties (a cosine equal to SIMILARITY) link. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tradeflow.llm.common import quoted, written
from tradeflow.llm.components import components

SIMILARITY = 0.98
TABLES, PROBES = 8, 2
SCALE = 1.0
SEED = 17
BLOCK = 512
GROUP_ROWS = 4096  # rows that one call compares, about

KEYS = 1 + PROBES


def least_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two of eight coordinates +-1, or all +-1/2 with even minus signs."""
    found = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a in (1.0, -1.0):
                for b in (1.0, -1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    found.append(v)
    for signs in range(256):
        minus = np.array([signs >> k & 1 for k in range(8)])
        if minus.sum() % 2 == 0:
            found.append(0.5 - minus)
    return np.array(found)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum."""
    near = np.rint(x)
    odd = (near.sum(axis=1) % 2).astype(bool)
    worst = np.argmax(np.abs(x - near), axis=1)
    rows = np.nonzero(odd)[0]
    at = worst[rows]
    near[rows, at] += np.where(x[rows, at] >= near[rows, at], 1.0, -1.0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: even integer points, or those moved by a half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def cell_keys(units: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Keys (rows, TABLES * KEYS) of unit vectors of one length: per table the own cell, then visits."""
    n, width = units.shape
    near = least_vectors()
    found = np.empty((n, TABLES * KEYS), dtype=np.int64)
    for t in range(TABLES):
        rng = np.random.default_rng([SEED, t, width])
        x = units @ rng.standard_normal((width, 8)) * SCALE
        factors = rng.integers(1, 2**63, 10, dtype=np.uint64) | np.uint64(1)
        point = nearest_point(x)
        order = np.argsort(-((x - point) @ near.T), axis=1, kind="stable")[:, :PROBES]
        cells = [point, *(point + near[order[:, p]] for p in range(PROBES))]
        for k, cell in enumerate(cells):
            coordinates = np.rint(2 * cell).astype(np.int64).view(np.uint64)
            key = (coordinates * factors[:8]).sum(axis=1, dtype=np.uint64)
            key += labels.view(np.uint64) * factors[8] + np.array([width], np.uint64) * factors[9]
            key ^= key >> np.uint64(29)
            found[:, t * KEYS + k] = (key * factors[0]).view(np.int64)
    return found


@pandas_udf(T.ArrayType(T.LongType()))
def keys_of(labels: pd.Series, vectors: pd.Series) -> pd.Series:
    """cell_keys() of valid rows, null for the others."""
    found = np.empty(len(vectors), dtype=object)
    usable: dict[int, list[int]] = {}
    arrays = [None if v is None else np.asarray(v, dtype=np.float64) for v in vectors]
    for i, (label, v) in enumerate(zip(labels, arrays, strict=True)):
        if v is not None and not pd.isna(label) and len(v) and np.isfinite(v).all() and v.any():
            usable.setdefault(len(v), []).append(i)
    for rows in usable.values():
        keys = cell_keys(
            unit_rows(np.stack([arrays[i] for i in rows])),
            labels.iloc[rows].astype("int64").to_numpy(),
        )
        for i, k in zip(rows, keys, strict=True):
            found[i] = k
    return pd.Series(found)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _meet(own_a, keys_b, own_b, keys_a, t: int) -> np.ndarray:
    """Whether rows of a and b meet in table t, as a matrix."""
    met = np.zeros((len(own_a), len(own_b)), dtype=bool)
    for k in range(t * KEYS, (t + 1) * KEYS):
        met |= own_a[:, t, None] == keys_b[None, :, k]
        met |= keys_a[:, k, None] == own_b[None, :, t]
    return met


def compare(ids, units, labels, keys, left, right, t: int, cell: int, similarity: float):
    """Links found in one cell between rows `left` and `right`: counts and a local root by row."""
    own = keys[:, ::KEYS]
    a, b = np.nonzero(left)[0], np.nonzero(right)[0]
    alike = (units[a] @ units[b].T >= similarity) & (labels[a][:, None] == labels[b][None, :])
    alike &= ids[a][:, None] != ids[b][None, :]
    owner = own[:, t] == cell
    alike &= owner[a][:, None] | owner[b][None, :]
    if alike.any():
        # Two owners of different cells that visit each other meet twice: the smaller key counts.
        for_a = own[a, t][:, None]
        for_b = own[b, t][None, :]
        visits_a = (keys[a, t * KEYS : (t + 1) * KEYS][:, :, None] == for_b[:, None, :]).any(axis=1)
        visits_b = (keys[b, t * KEYS : (t + 1) * KEYS].T[None, :, :] == for_a[:, None, :]).any(axis=1)
        alike &= ~(visits_a & visits_b) | (np.minimum(for_a, for_b) == cell)
        for earlier in range(t):
            if not alike.any():
                break
            alike &= ~_meet(own[a], keys[b], own[b], keys[a], earlier)
    count = np.zeros(len(ids), dtype=np.int64)
    root = np.arange(len(ids))
    if not alike.any():
        return count, root
    if a is b or np.array_equal(a, b):
        count[a] += alike.sum(axis=1)
    else:
        np.add.at(count, a, alike.sum(axis=1))
        np.add.at(count, b, alike.sum(axis=0))
    while True:  # smallest root among linked rows, until nothing changes
        big = len(ids)
        new = root.copy()
        np.minimum.at(new, a, np.where(alike, root[b][None, :], big).min(axis=1))
        np.minimum.at(new, b, np.where(alike, root[a][:, None], big).min(axis=0))
        new = np.minimum(new, new[new])
        if (new == root).all():
            return count, root
        root = new


RESULT = "rid long, n long, root long"


def _compared(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """All cells, or pairs of blocks of a cell, that one group holds."""
        rows = rows.sort_values(["t", "cell", "i", "j", "block", "rid"], kind="stable")
        where = rows[["t", "cell", "i", "j"]].to_numpy()
        cuts = np.nonzero((where[1:] != where[:-1]).any(axis=1))[0] + 1
        ids, block = rows["rid"].to_numpy(), rows["block"].to_numpy()
        labels = rows["label"].to_numpy()
        lengths = rows["vector"].map(len).to_numpy()
        keys = np.stack(rows["keys"].to_list())
        vectors = rows["vector"].to_list()
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            t, cell, i, j = (int(x) for x in where[lo])
            if hi - lo < 2 or len(set(lengths[lo:hi])) > 1:  # keys tell lengths apart
                continue
            left, right = block[lo:hi] == i, block[lo:hi] == j
            count, root = compare(
                ids[lo:hi], unit_rows(np.stack(vectors[lo:hi])), labels[lo:hi], keys[lo:hi],
                left, right, t, cell, similarity,
            )
            linked = count > 0
            out.append((ids[lo:hi][linked], count[linked], ids[lo:hi][root][linked]))
        if not out:
            return pd.DataFrame({"rid": [], "n": [], "root": []}, dtype="int64")
        rid, n, root = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"rid": rid, "n": n, "root": root})

    return run


def clustered(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """key, n_links, component_id of every row."""
    vectors = written(
        rows.select(
            F.monotonically_increasing_id().alias("rid"),
            quoted(key).alias("key"),
            quoted(label).cast("long").alias("label"),
            quoted(vector).cast("array<double>").alias("vector"),
        ).withColumn("keys", keys_of("label", "vector")),
        "lattice-keys",
    )
    usable = vectors.filter(F.col("keys").isNotNull())
    member = usable.select("rid", F.posexplode("keys").alias("at", "cell")).select(
        "rid",
        F.floor(F.col("at") / KEYS).cast("int").alias("t"),
        (F.col("at") % KEYS == 0).cast("int").alias("own"),
        "cell",
    )
    cells = (
        member.groupBy("t", "cell")
        .agg(F.count("*").alias("members"), F.sum("own").alias("owners"))
        .filter("members > 1 AND owners > 0")
        .select("t", "cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    active = written(member.join(cells, ["t", "cell"]).select("rid", "t", "cell", "blocks"), "lattice-cells")
    spread = active.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    spread = spread.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "rid", "t", "cell", "block",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )
    groups = max(1, spread.count() // GROUP_ROWS)
    found = written(
        spread.join(usable.select("rid", "label", "vector", "keys"), "rid")
        .withColumn("group", F.pmod(F.xxhash64("t", "cell", "i", "j"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(_compared(similarity), RESULT),
        "lattice-links",
    )
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rid").agg(F.sum("n").alias("n_links"))
    of = (
        vectors.select("rid", "key")
        .join(counts, "rid", "left")
        .join(roots.withColumnRenamed("node", "rid"), "rid", "left")
        .select("key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rid").alias("root"))
    )
    of = written(of, "lattice-components")
    names = of.groupBy("root").agg(F.min("key").alias("component_id"))
    return of.join(names, "root").select("key", "n_links", "component_id")


def embedding_dedup(rows: DataFrame) -> DataFrame:
    """Digest of the groups, one row per vector."""
    found = clustered(rows.select("vec_id", "embedding", "label"))
    return found.select(
        F.col("key").alias("vec_id"),
        "n_links",
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
