"""Components, SimHash, lattice hashing and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradeflow.llm import common, components, lattice, simhash, substrings

WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    links = {
        "chain": [(i, i + 1) for i in range(0, 60)],
        "star": [(0, i) for i in range(1, 300)] + [(7, 7), (3, 0), (400, 300), (400, 0)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "none": [],
    }[shape]
    found = components.components(spark.createDataFrame([(a * 7 - 50, b * 7 - 50) for a, b in links], "a long, b long"))
    pairs = [(a * 7 - 50, b * 7 - 50) for a, b in links if a != b]
    assert {r["node"]: r["root"] for r in found.collect()} == reachable({n for p in pairs for n in p}, pairs)


@pytest.fixture()
def many_partitions(spark, tmp_path, monkeypatch):
    """A session whose shuffles make 24 partitions and keep them; lists the files of the tables written."""
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    tables = []

    def folder(spark, name):
        tables.append((name, tmp_path / str(len(tables)) / name))
        return str(tables[-1][1])

    monkeypatch.setattr(common, "folder", folder)
    yield lambda: [(name, len(list(path.glob("part-*")))) for name, path in tables]
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_links_are_written_in_one_file_a_step(spark, many_partitions):
    pairs = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 300)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"))
    nodes = {n for p in pairs for n in p}
    assert {r["node"]: r["root"] for r in found.collect()} == reachable(nodes, pairs)
    files = [n for name, n in many_partitions() if name == "stars"]
    assert len(files) > 2
    assert set(files) == {1}


def test_links_beyond_a_file_are_written_in_several(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(common, "in_files", lambda df, rows, a_file=40: df.coalesce(max(1, -(-rows // a_file))))
    pairs = [(i, i + 1) for i in range(0, 300)]
    found = components.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["root"] for r in found.collect()} == {0}
    assert all(n > 4 for name, n in many_partitions() if name == "stars")


def test_few_documents_are_kept_in_few_files(spark, many_partitions, docs, corpus):
    kept = simhash.keep_one(docs)
    assert kept.rdd.getNumPartitions() == 1
    fps = {d: plain_fingerprint(t) for d, t, *_ in corpus}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(reachable(fps, links).values()))
    small = ("fingerprint-nodes", "stars", "fingerprint-names", "kept")
    assert all(n == 1 for name, n in many_partitions() if name in small)


# -- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORDS((text or "").encode().lower())
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(docs, corpus):
    found = by_id(simhash.simhash(docs))
    prints = {d: plain_fingerprint(t) for d, t, *_ in corpus}
    assert {d: int(r["fingerprint"], 16) for d, r in found.items()} == prints
    assert all(len(r["fingerprint"]) == 16 for r in found.values())
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = reachable(prints, links)
    assert {d: r["component_id"] for d, r in found.items()} == roots
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))


def test_spark_hashes_as_the_contract_says(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_every_layout_finds_every_link(spark):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    prints = set()
    for c in centres:
        for _ in range(20):
            flip = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))
            prints.add(int(c) ^ flip)
    values = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    table = spark.createDataFrame([(v,) for v in values], "fp long")
    u = np.array(values, dtype=np.int64).view(np.uint64)
    near = {(a, b) for i, a in enumerate(values) for j, b in enumerate(values) if a > b and (int(u[i]) ^ int(u[j])).bit_count() <= 2}
    found = {(r["a"], r["b"]) for r in simhash.links(table).collect()}
    assert found == near and len(near) > 100


@pytest.mark.parametrize("n", [1_000, 10**7, 10**11])
def test_thresholds_spend_the_distance(n):
    sample = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    plan = simhash.layout(sample, n)
    assert sum(t + 1 for _, t in plan) == simhash.DISTANCE + 1
    assert len({b for bits, _ in plan for b in bits}) == sum(len(bits) for bits, _ in plan)


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40:50] = bits[:, 3:4]
    sample = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    groups = simhash.group_bits(sample, 3)
    assert any({3, *range(40, 50)} <= set(g) for g in groups)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_allocation_is_optimal():
    costs = [[0, 5, 9, 12], [0, 1, 8, 20], [0, 6, 6.5, 30]]
    cost, thresholds = simhash.allocate(costs, 2)
    best = min(
        costs[0][a] + costs[1][b] + costs[2][c]
        for a in range(4) for b in range(4) for c in range(4) if a + b + c == 3
    )
    assert cost == best == sum(c[t + 1] for c, t in zip(costs, thresholds, strict=True))


def test_simhash_of_odd_rows(odd_docs, no_docs):
    found = simhash.simhash(odd_docs).collect()
    assert len(found) == 7
    groups = {}
    for r in found:
        groups.setdefault((r["fingerprint"], r["component_id"]), []).append(r["doc_id"])
    assert groups[("0" * 16, 1)] == [None, 1, 2] or sorted(groups[("0" * 16, 1)], key=str) == [1, 2, None]
    assert sorted(next(v for (f, c), v in groups.items() if c == 3)) == [3, 3, 4]
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None]
    assert simhash.simhash(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


# -- lattice ---------------------------------------------------------------------------------


def test_lattice_vectors_and_decoding():
    near = lattice.least_vectors()
    assert near.shape == (240, 8) and np.allclose((near**2).sum(axis=1), 2)
    x = np.random.default_rng(0).normal(size=(300, 8)) * 2
    point = lattice.nearest_point(x)
    for other in near:
        assert (((x - point) ** 2).sum(axis=1) <= ((x - point - other) ** 2).sum(axis=1) + 1e-9).all()
    doubled = np.rint(2 * point).astype(int)
    assert np.allclose(2 * point, doubled)
    assert (np.ptp(doubled % 2, axis=1) == 0).all() and (point.sum(axis=1) % 2 == 0).all()


def vectors(seed=1, n=400, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            base = np.array(rows[rng.integers(0, len(rows))][1])
            v = base + rng.normal(size=width) * rng.choice([0.0, 0.01, 0.04, 0.07])
        else:
            v = rng.normal(size=width)
        rows.append((i, [float(x) for x in np.float32(v * rng.choice([1.0, 3.0]))], int(rng.integers(0, 3))))
    return rows


def linked(rows, least=0.98):
    units = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: k for i, _, k in rows}
    return [
        (a, b) for a in units for b in units if a < b and label[a] == label[b] and units[a] @ units[b] >= least
    ]


def test_links_between_vectors(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = by_id(lattice.embedding_dedup(table.repartition(3)), "vec_id")
    links = linked(rows)
    degree = {i: 0 for i, *_ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    n_found = sum(r["n_links"] for r in found.values()) / 2
    assert all(found[i]["n_links"] <= degree[i] for i in degree)
    assert len(links) > 50 and n_found >= 0.95 * len(links)
    assert all((r["vec_id"] == r["component_id"]) == r["kept"] for r in found.values())


def test_hot_cell_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 20)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in centre + rng.normal(size=16) * 0.001], 1) for i in range(150)]
    rows += [(200 + i, [float(x) for x in rng.normal(size=16)], 1) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = by_id(lattice.embedding_dedup(table), "vec_id")
    assert all(found[i]["n_links"] == 149 and found[i]["component_id"] == 0 for i in range(150))
    assert all(found[200 + i]["kept"] for i in range(30))


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (0, one, 1), (1, one, 1), (1, one, 1), (2, one, None), (3, None, 1), (4, [0.0, 0.0, 0.0], 1),
        (5, [1.0, None, 3.0], 1), (6, [1.0, float("nan"), 3.0], 1), (7, [1.0, float("inf"), 3.0], 1),
        (8, [], 1), (9, [1.0, 2.0], 1), (10, one, 2), (None, one, 1), (11, [x * 1e200 for x in one], 1),
    ]
    schema = "vec_id long, embedding array<double>, label int, rid long, keys string"
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    found = lattice.embedding_dedup(table).collect()
    assert len(found) == len(rows)
    n = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert n[0] == n[1] == n[11] == n[None] == (4, 0)
    assert all(n[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 8, 9, 10))
    assert lattice.embedding_dedup(table.limit(0)).count() == 0


# -- substrings ------------------------------------------------------------------------------


def kept_words(rows):
    """Digest of each document by the contract, over all windows."""
    first = {}
    texts = sorted((d, WORDS((t or "").encode())) for d, t in rows)
    for d, words in texts:
        for i in range(len(words) - 49):
            first.setdefault(tuple(words[i : i + 50]), d)
    out = {}
    for d, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            if first[tuple(words[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[d] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def passages(seed):
    """Texts cut from a few stretches at random places, with common phrases and repeated words."""
    rng = random.Random(seed)
    stretches = [[f"w{rng.randrange(40)}" for _ in range(300)] for _ in range(4)]
    phrase = [f"p{i}" for i in range(20)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(1, 5)):
            s = rng.choice(stretches)
            a = rng.randrange(250)
            words += s[a : a + rng.choice([20, 49, 50, 51, 80, 300])]
            words += phrase if rng.random() < 0.5 else [f"u{rng.randrange(9999)}"] * rng.choice([1, 70])
        rows.append((d * 3, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_windows(spark, seed):
    rows = passages(seed)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    told = kept_words(rows)
    found = by_id(substrings.substring_dedup(table))
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in found.items()} == {
        d: t[:3] for d, t in told.items()
    }
    if seed == 1:
        texts = by_id(substrings.deduplicated(table))
        assert {d: r["text"] for d, r in texts.items()} == {d: t[3] for d, t in told.items()}


def test_substrings_of_documents(docs, corpus):
    told = kept_words([(d, t) for d, t, *_ in corpus])
    found = by_id(substrings.substring_dedup(docs))
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in found.items()} == {
        d: t[:3] for d, t in told.items()
    }


def test_substrings_of_odd_rows(spark, odd_docs, no_docs):
    found = substrings.substring_dedup(odd_docs).collect()
    assert len(found) == 7 and all(r["n_removed"] == 0 for r in found)
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (5, long), (None, long), (4, long + " tail")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    gone = sorted((str(r["doc_id"]), r["n_removed"]) for r in substrings.substring_dedup(table).collect())
    assert gone == [("4", 0), ("5", 60), ("5", 60), ("None", 60)]
    assert substrings.substring_dedup(no_docs).count() == 0


@pytest.mark.parametrize("key", [None, 7])
def test_rows_that_share_id_and_text_find_their_spans_once(spark, key):
    """Thousands of such rows: each gets one short list, not one entry for every other row."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = spark.range(4_000).select(F.lit(key).cast("long").alias("doc_id"), F.lit(f"own words {passage} end").alias("text"))
    other = spark.createDataFrame([(1, f"{passage} else")], "doc_id long, text string")
    docs = rows.unionByName(other)
    spans = substrings.repeats(substrings._keyed(docs, "doc_id", "text").select("key", "th", "text"))
    assert max(len(r.spans) for r in spans.collect()) <= 60
    found = substrings.substring_dedup(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 61, 0, 1), (key, 63, 60, 4_000)], key=repr)


def test_few_substrings_are_written_in_few_files(spark, many_partitions, monkeypatch):
    rows = passages(4)
    told = {d: t[:3] for d, t in kept_words(rows).items()}
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    for most in (1, 4):
        before = len(many_partitions())
        if most > 1:  # texts and rows beyond one file
            monkeypatch.setattr(substrings, "TEXT_A_FILE", sum(len(t.encode()) for _, t in rows) // 4 + 1)
        result = substrings.substring_dedup(table)
        assert result.rdd.getNumPartitions() == most
        assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in by_id(result).items()} == told
        files = dict(many_partitions()[before:])
        assert len(files) == 9
        assert {n for name, n in files.items() if name not in ("runs", "windows")} == {1}
        assert files["runs"] == most and 1 <= files["windows"] <= most
