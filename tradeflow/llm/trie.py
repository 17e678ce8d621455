"""Prefix trie of conversations from vertical bitmaps.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. Rows
are one turn of one conversation: its position, two hashes of role and text, and two hashes of the
path up to it, which are running exclusive-ors of what position and turn hash to. Positions and paths are
running sums over ranges of the sorted rows, so a conversation may be as long as it likes.

Shards. The sorted rows are cut into shards of at most SHARD_ROWS rows and SHARD_CONVERSATIONS
conversations, wherever they end. Within a shard the turns are laid out vertically: for each (position,
turn) the bitset of conversations that have it there. Depth first, the bitset of a node meets the posting
of its lowest member's next turn: their intersection is a child, its popcount the child's members, its
lowest bit the smallest of them; the rest of the bitset holds the other children. Those whose last turn it
is are the child's end list. A shard that begins inside conversations begins at the nodes they have
reached.

Merging. Nodes of all shards with one path are one node: members add up, and the smallest conversation
owns it. Since a conversation that owns a node owns all of its later ones too, each conversation owns the
rest of its path from some depth on, and every node has one owner. So sums over a subtree are sums over
the members' rows: a child counts where its owner passes, a leaf where its owner ends, and what is
saved are the texts a member has in the subtree before it owns its path. No level after level is needed.

End lists stay in pieces, one a shard, in order of conversations. Their SHA-256 is taken piece by piece
as a stream; being a chain, one list's hash is one task's work, in constant memory and over pieces
of thousands of ids.

Defined results. Turns without a number come first, those with equal numbers go by the hash of role and
text; repeated rows are turns one after another. A null role or text is empty. Rows without a
conversation id belong to no conversation. An empty table gives no rows, not even a root. Turns are equal
if 128 bits of hash are.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import quoted, written
from tradeflow.plans.running import PART, in_ranges, running

SHARD_ROWS, SHARD_CONVERSATIONS = 1 << 15, 1 << 12
NODE = ["depth", "p1", "p2"]
MOST_GRAFTED = 8


def turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos, a, b, size: the turns by position from 1, as two hashes and the bytes of the text."""
    said = [F.coalesce(quoted(c), F.lit("")) for c in (role, text)]
    hashed = conversations.filter(quoted(key).isNotNull()).select(
        quoted(key).cast("long").alias("conv"),
        quoted(turn).alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("a"),
        F.xxhash64(F.lit(2), *said).alias("b"),
        F.octet_length(said[1]).cast("long").alias("size"),
    )
    order = [F.col("turn").asc_nulls_first(), "a", "b"]
    ranges = in_ranges(hashed, ["conv", *order], "trie-turns")
    placed = running(ranges, ["conv"], order, {"pos": ("sum", F.lit(1).cast("long"))})
    return written(placed.select("conv", "pos", "a", "b", "size"), "trie-positions")


def lengths(placed: DataFrame) -> DataFrame:
    return written(placed.groupBy("conv").agg(F.count("*").alias("n")), "trie-lengths")


def rebuilt(placed: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of the conversations that the query looks at.

    Conversation c begins with the first h turns of conversation c - c % 5, as far as there are any, and
    goes on with its own after the first h; h is the CRC-32 of the decimal c, modulo 9.
    """
    h = F.crc32(F.col("conv").cast("string")) % (MOST_GRAFTED + 1)
    own = convs.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % 5).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    grafted = F.least("h", F.coalesce("n_base", F.lit(0)))
    plan = own.join(bases, "base", "left").select("conv", "n", "h", "base", grafted.alias("k"))
    plan = written(plan, "trie-grafts")
    tails = placed.join(plan.select("conv", "h", "k"), "conv").filter("pos > h")
    tails = tails.select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "a", "b", "size")
    heads = placed.filter(F.col("pos") <= MOST_GRAFTED).withColumnRenamed("conv", "base")
    heads = heads.join(plan.select("conv", "base", "k"), "base").filter("pos <= k")
    now = plan.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return heads.select("conv", "pos", "a", "b", "size").unionByName(tails), now


def _step(hashed: str) -> Column:
    """What a turn adds to the hash of a path; the root, at position 0, adds nothing."""
    return F.when(F.col("pos") > 0, F.xxhash64("pos", hashed)).otherwise(F.lit(0).cast("long"))


def paths(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """The turns and a row for the root of every conversation, each with its path.

    p1, p2: the path; q1, q2: the path before; upto: bytes of the texts up to here; last: the
    conversation ends here.
    """
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", *[zero.alias(c) for c in ("pos", "a", "b", "size")])
    rows = placed.unionByName(roots).join(convs, "conv")
    rows = rows.select("conv", "pos", "a", "b", "size", (F.col("pos") == F.col("n")).alias("last"))
    ranges = in_ranges(rows, ["conv", "pos"], "trie-rows")
    sums = {"p1": ("xor", _step("a")), "p2": ("xor", _step("b")), "upto": ("sum", F.col("size"))}
    found = running(ranges, ["conv"], ["pos"], sums)
    before = [F.col(p).bitwiseXOR(_step(c)).alias(q) for p, c, q in (("p1", "a", "q1"), ("p2", "b", "q2"))]
    return written(found.select("*", *before), "trie-paths")


NODES = (
    "depth long, p1 long, p2 long, q1 long, q2 long, conv long, size long, upto long, "
    "n long, n_ends long, first long, ids string"
)
ROW = ["conv", "pos", "a", "b", "p1", "p2", "q1", "q2", "size", "upto", "last"]


def bits(bitset: int) -> Iterator[int]:
    """Places of the bits set, from the lowest on."""
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def shard_nodes(rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of a shard, from its rows sorted by conversation and position (see ROW and NODES)."""
    starts: list[int] = []  # first row of each conversation
    postings: dict[tuple, int] = defaultdict(int)
    begun: dict[tuple, int] = defaultdict(int)
    here_last: dict[int, int] = defaultdict(int)  # by position: conversations with their last row of the shard
    ended: dict[int, int] = defaultdict(int)  # by position: conversations with their last turn
    conv = None
    for i, (c, pos, a, b, _, _, q1, q2, _, _, last) in enumerate(rows):
        if c != conv or not starts:
            conv = c
            starts.append(i)
            begun[pos, q1, q2] |= 1 << (len(starts) - 1)
        bit = 1 << (len(starts) - 1)
        postings[pos, a, b] |= bit
        if last:
            ended[pos] |= bit
        if i + 1 == len(rows) or rows[i + 1][0] != c:
            here_last[pos] |= bit
    firsts = [rows[i][1] for i in starts]
    stack = [(members, pos) for (pos, _, _), members in begun.items()]
    while stack:
        rest, pos = stack.pop()
        while rest:
            k = (rest & -rest).bit_length() - 1
            c, _, a, b, p1, p2, q1, q2, size, upto, _ = rows[starts[k] + pos - firsts[k]]
            child = rest & postings[pos, a, b]
            rest ^= child
            ends = child & ended[pos]
            ids = [rows[starts[e]][0] for e in bits(ends)]
            listed = (ids[0], ",".join(map(str, ids))) if ids else (None, None)
            yield pos, p1, p2, q1, q2, c, size, upto, child.bit_count(), len(ids), *listed
            deeper = child & ~here_last[pos]
            if deeper:
                stack.append((deeper, pos + 1))


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in NODES.split(", ")]

    def out(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(shard_nodes(rows), columns=names).astype({"first": "Int64"})

    rows: list[tuple] = []
    part, conv, n_convs = None, None, 0
    for frame in batches:
        for where, *row in zip(frame[PART].tolist(), *(frame[c].tolist() for c in ROW), strict=True):
            n_convs += row[0] != conv
            if rows and (where != part or len(rows) >= SHARD_ROWS or n_convs > SHARD_CONVERSATIONS):
                yield out(rows)
                rows, n_convs = [], 1
            part, conv = where, row[0]
            rows.append(tuple(row))
    if rows:
        yield out(rows)


def shards(rows: DataFrame) -> DataFrame:
    """Nodes of each shard, with the shard's piece of the end list; rows is a table of paths()."""
    dealt = rows.select(PART, *ROW).repartition(PART).sortWithinPartitions(PART, "conv", "pos")
    return written(dealt.mapInPandas(_shards, NODES), "trie-shards")


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's end list, from its pieces in order."""
    node, chain = None, None
    for frame in batches:
        done = []
        for *at, ids in zip(*(frame[c].tolist() for c in (*NODE, "ids")), strict=True):
            if at != node:
                if chain is not None:
                    done.append((*node, chain.hexdigest()))
                node, chain = at, hashlib.sha256()
            else:
                chain.update(b",")
            chain.update(ids.encode())
        yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
    if chain is not None:
        yield pd.DataFrame([(*node, chain.hexdigest())], columns=[*NODE, "ends_sha256"])


def merged(parts: DataFrame) -> DataFrame:
    """One row per node: its owner, members, ends, and path before."""
    nodes = parts.groupBy(*NODE).agg(
        F.min("conv").alias("conv"),
        F.sum("n").alias("n"),
        F.sum("n_ends").alias("n_ends"),
        *[F.min(c).alias(c) for c in ("q1", "q2", "size", "upto")],
    )
    return written(nodes, "trie-nodes")


def nodes(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie, one row per node; placed holds conv, pos, a, b, size and convs conv, n."""
    rows = paths(placed, convs)
    parts = shards(rows)
    all_nodes = merged(parts)
    pieces = parts.filter("ids IS NOT NULL").select(*NODE, "first", "ids")
    digests = (
        pieces.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInPandas(_chained, "depth long, p1 long, p2 long, ends_sha256 string")
    )
    # Each conversation owns its path from some depth on; before: bytes of the texts up to there.
    owners = all_nodes.groupBy("conv").agg(
        F.min("depth").alias("owned"),
        F.min_by(F.col("upto") - F.col("size"), "depth").alias("before"),
        F.min_by(F.struct("q1", "q2"), "depth").alias("q"),
        F.bool_or(F.col("n_ends") == F.col("n")).alias("leaf"),
    )
    owners = written(owners, "trie-owners")
    above = all_nodes.select(
        (F.col("depth") + 1).alias("owned"), F.struct(F.col("p1").alias("q1"), F.col("p2").alias("q2")).alias("q"), F.col("conv").alias("parent")
    )
    grafts = written(owners.join(above, ["owned", "q"]).select("conv", "owned", "parent"), "trie-parents")
    whole = rows.filter("last").select("conv", F.col("upto").alias("whole"))
    shares = whole.join(owners.select("conv", "owned", "before", "leaf"), "conv", "left")
    owned = F.coalesce(F.col("owned") <= F.col("pos"), F.lit(False))
    rest = F.coalesce("before", "whole") - F.col("upto") + F.col("size")
    sums = (
        rows.join(shares, "conv")
        .groupBy(F.col("pos").alias("depth"), "p1", "p2")
        .agg(
            F.count_if((F.col("owned") <= F.col("pos") + 1) & ~F.col("last")).alias("n_children"),
            F.count_if(F.coalesce("leaf", F.lit(False))).alias("n_leaves"),
            F.sum(F.when(owned, 0).otherwise(rest)).alias("saved_tokens"),
        )
    )
    none = hashlib.sha256(b"").hexdigest()
    found = all_nodes.join(sums, NODE).join(digests, NODE, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", F.col("conv")))
    return found.join(grafts.withColumnRenamed("owned", "depth"), ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        parent.alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are, one row per node."""
    placed = turns(conversations)
    return nodes(placed, lengths(placed))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    placed = turns(conversations)
    return nodes(*rebuilt(placed, lengths(placed)))
