"""The prefix trie against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tradeflow.llm import trie

TURNS = "conv_id long, turn long, role string, text string, a int, pos string, `x.y` int, depth int"


@pytest.fixture
def many_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def ordered(rows):
    """Turns of each conversation; rows of one number must be equal, or their order is the hash's."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [said for _, said in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        kids = children[path]
        size = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in kids) if kids else 1
        saved[path] = (len(members[path]) - 1) * size + sum(saved[k] for k in kids)
    rows = []
    for path, mine in members.items():
        ends = ",".join(str(c) for c in sorted(mine) if len(convs[c]) == len(path))
        rows.append((
            min(mine), len(path), min(members[path[:-1]]) if path else None, len(mine), len(children[path]),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], TURNS).repartition(parts)


def answer(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def invented(seed, n=150):
    """Few different turns, so that much is shared; some conversations are copies of a common one."""
    rng = random.Random(seed)
    said = [("user", "Où?"), ("user", ""), ("assistant", "yes"), ("", "no " * 40), (None, None)]
    rows = []
    for c in rng.sample(range(400), n):
        path = [rng.choice(said) for _ in range(rng.randint(1, 9))]
        if c % 3 == 0:
            path = said[:4]
        rows += [(c, None if i == 0 and c % 4 == 0 else 10 * i, *turn) for i, turn in enumerate(path)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, many_ranges, monkeypatch, seed):
    rows = invented(seed)
    convs = ordered(rows)
    assert answer(trie.rebuilt_trie(table(spark, rows))) == brute(rebuilt(convs))
    assert answer(trie.prefix_trie(table(spark, rows))) == brute(convs)


def test_shards_cut_conversations():
    """Any cut of the sorted rows gives the same nodes once members are added up."""
    rng = random.Random(1)
    rows, paths = [], {}
    for c in range(40):
        path = [rng.randint(1, 2) for _ in range(rng.randint(0, 8))]
        key = lambda d: hash(tuple(path[:d])) % 2**60  # noqa: E731, B023
        for pos in range(len(path) + 1):
            rows.append((c, pos, path[pos - 1] if pos else 0, 0, key(pos), pos, key(pos - 1) if pos else 0, pos - 1, 1, pos, pos == len(path)))
        paths[c] = path

    def total(cuts):
        found = defaultdict(lambda: [0, 0, 10**9, []])
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            for pos, p1, _, _, _, c, _, _, n, n_ends, _, ids in trie.shard_nodes(rows[lo:hi]):
                node = found[pos, p1]
                node[0] += n
                node[1] += n_ends
                node[2] = min(node[2], c)
                node[3] += [ids] if ids else []
        return {k: (a, b, c, ",".join(ids)) for k, (a, b, c, ids) in found.items()}

    whole = total([])
    assert whole[0, hash(()) % 2**60][0] == 40
    for n in (1, 5, 30):
        assert total(sorted(rng.sample(range(1, len(rows)), n))) == whole


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"), (5, None, None, None), (5, None, "", ""), (6, 0, "user", "a"), (6, 0, "user", "a"),
        (-7, 3, "user", "x" * 300_000), (11, 1, None, "b"), (2**62, 0, "user", "a"),
    ]
    convs = ordered(rows)
    convs_cut = {c: convs.get(c - (abs(c) % 5) * (1 if c > 0 else -1), [])[: zlib.crc32(str(c).encode()) % 9] + own[zlib.crc32(str(c).encode()) % 9 :] for c, own in convs.items()}
    assert answer(trie.rebuilt_trie(table(spark, rows, 2))) == brute(convs_cut)
    assert answer(trie.prefix_trie(table(spark, rows, 2))) == brute(convs)


def test_no_rows(spark):
    assert answer(trie.rebuilt_trie(table(spark, [], 1))) == []
    assert answer(trie.prefix_trie(table(spark, [(None, 1, "user", "a")], 1))) == []


def test_one_conversation_holds_most_rows_and_copies(spark, many_ranges, monkeypatch):
    """A long conversation over several ranges, and thousands of copies of a short one."""
    long = spark.range(6_000).selectExpr("1 AS conv_id", "id AS turn", "'user' AS role", "concat('t', id % 7) AS text")
    copies = spark.range(10, 3_010).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'same' AS text")
    df = long.unionByName(copies)
    placed = trie.turns(df)
    convs = trie.lengths(placed)
    ranges = trie.paths(placed, convs)
    assert ranges.filter("conv = 1").select("range_part").distinct().count() > 1
    found = {(r.depth, r.n_convs): r for r in trie.nodes(placed, convs).collect()}
    assert len(found) == 6_000 + 2
    root, same = found[0, 3_001], found[1, 3_000]
    assert (root.n_children, root.n_leaves, root.saved_tokens) == (2, 2, 4 * 2_999)
    assert same.ends_sha256 == hashlib.sha256(",".join(map(str, range(10, 3_010))).encode()).hexdigest()
    assert found[6_000, 1].parent_conv_id == 1 and found[6_000, 1].n_leaves == 1
    assert not df.filter(F.col("conv_id") < 0).count()
