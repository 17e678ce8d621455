"""Language-model scores, piece encoding, token files, toxicity and the pipeline."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tradeflow.llm import interpolated, mixing, packed, pieces, secrets, simhash, toxicity

WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall

ODD_TEXTS = [
    "", " ", "  a  b ", "\ta\nb", "\n\n  \n x", "é ﬁ Ⅷ", "a　b", "x\x00y", "<s> <unk> <0x0A>", "▁a", "a▁▁b", " \n",
    "a" * 5000, "ab\r\n cd \n", "   ", "日本語 テキスト😀", "<|endoftext|>", "a <|endoftext|>b", "a\xa0 b", "a \x1c b",
    "word's they're!'s (it's) ²x", "abcЖ d1e2", "éa x", "# 12 ... --",
]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def odd_mixtures(n):
    rng = random.Random(8)
    signs = ["a", "b", " ", " ", "\n", "\t", "é", "😀", ".", "'s", "tion", "the", "1", "\xa0", "Ж", "́", "(", "'", "▁"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(n)]


# -- language model --------------------------------------------------------------------------


def test_language_model(docs, corpus):
    rows = [(d, [*WORDS((t or "").encode().lower()), None]) for d, t, *_ in corpus]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts, pairs, contexts = collections.Counter(), collections.Counter(), collections.Counter()
    gone, gone_pairs, gone_contexts = collections.Counter(), collections.Counter(), collections.Counter()
    for d, words in rows:
        before = ["<begin>", *words[:-1]]
        if not held[d]:
            counts.update(words), pairs.update(zip(before, words, strict=True)), contexts.update(before)
        if zlib.crc32(str(d).encode()) % 7 == interpolated.DELETED_FOLD:
            gone.update(words), gone_pairs.update(zip(before, words, strict=True)), gone_contexts.update(before)
    n, v = sum(counts.values()), len(counts)
    events = []
    for (a, b), times in gone_pairs.items():
        context = contexts[a] - gone_contexts[a]
        ratio = (pairs[a, b] - gone_pairs[a, b]) / max(context, 1) * (v + 1)
        word = (counts[b] - gone[b]) / (n - sum(gone.values())) * (v + 1)
        events.append((min(int(context).bit_length(), 31), times, times * ratio, times * word))
    weights = interpolated.learn_weights(
        pd.DataFrame(events, columns=["context", "n", "pair_ratio", "word_ratio"])
    )
    found = by_id(interpolated.lm_scores(docs))
    assert len(found) == len(rows)
    for d, words in rows:
        r = found[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d], len(words), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        score = 0.0
        for a, b in zip(["<begin>", *words[:-1]], words, strict=True):
            w = weights[min(contexts[a].bit_length(), 31)]
            score += math.log10(w[0] * pairs[a, b] / max(contexts[a], 1) + w[1] * counts[b] / n + w[2] / (v + 1))
        # The operator learns from a histogram of the ratios, here they are taken one by one.
        assert r["score"] == pytest.approx(score, rel=2e-3, abs=1e-3)


def test_weights_do_not_lower_the_likelihood():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 9, 200)
    table = pd.DataFrame({"context": rng.integers(1, 4, 200), "n": n, "pair_ratio": n * rng.exponential(50, 200) * rng.integers(0, 2, 200), "word_ratio": n * rng.exponential(5, 200)})

    def likelihood(w):
        mix = w[table["context"]] * np.stack([table["pair_ratio"] / n, table["word_ratio"] / n, np.ones(200)], axis=1)
        return (n * np.log(mix.sum(axis=1))).sum()

    learned = interpolated.learn_weights(table)
    start = interpolated.learn_weights(table.iloc[:0])
    assert np.allclose(learned.sum(axis=1), 1) and likelihood(learned) > likelihood(start)


def test_lists_of_counts_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    n = rng.integers(0, 300, len(keys)).astype(np.uint64)
    for k in (keys, keys[:1], keys[:0]):
        a, b = interpolated.unsqueeze(interpolated.squeeze(k, n[: len(k)]), 2)
        assert (a == k).all() and (b == n[: len(k)]).all()


def test_language_model_of_odd_rows(odd_docs, no_docs):
    found = interpolated.lm_scores(odd_docs).collect()
    assert len(found) == 7 and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in found)
    assert interpolated.lm_scores(no_docs).count() == 0


# -- pieces ----------------------------------------------------------------------------------


def test_pieces_are_those_of_the_library(spark):
    library = pieces.pieces(pieces.default_model()).library
    texts = [*ODD_TEXTS, *odd_mixtures(400)]
    found = by_id(pieces.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, text in enumerate(texts):
        ids = library.encode(text, num_threads=1)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), text
        assert found[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest(), text
        assert found[i]["n_differing"] == 0


def test_agenda_alone_and_both_of_its_forms():
    vocabulary = pieces.Pieces(pieces.default_model())
    for text in [t for t in [*ODD_TEXTS, *odd_mixtures(300)] if t]:
        whole = pieces.MARK + text.replace(" ", pieces.MARK)
        ids = list(vocabulary.agenda(whole))
        assert ids == vocabulary.library.encode(text, num_threads=1), text
        if len(whole) < 200:
            assert vocabulary._merge_short(whole) == vocabulary._merge_long(whole)


def test_any_ids_decode_like_the_library():
    vocabulary = pieces.pieces(pieces.default_model())
    rng = random.Random(3)
    for _ in range(500):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids)


def test_encode_and_decode_columns(spark):
    table = spark.createDataFrame([(1, "a b\nc"), (2, None), (3, "")], "doc_id long, text string")
    ids = table.select("doc_id", pieces.encode(table["text"]).alias("ids"))
    back = by_id(ids.select("doc_id", pieces.decode(ids["ids"]).alias("text")))
    assert [back[i]["text"] for i in (1, 2, 3)] == ["a b\nc", "", ""]


def test_pieces_of_odd_rows(odd_docs, no_docs):
    found = pieces.encoded(odd_docs).collect()
    assert len(found) == 7 and sorted(r["n_tokens"] == 0 for r in found) == [False] * 4 + [True] * 3
    assert pieces.encoded(no_docs).count() == 0


# -- token files -----------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [0, 1, 3, 9, 16, 33, 60, 64])
def test_simple8b_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 59, 240, 1000):
        values = rng.integers(0, 2**bits, n, dtype=np.uint64) if bits else np.zeros(n, np.uint64)
        values[rng.random(n) < 0.3] = 0
        words, escapes = packed.pack(values)
        assert (packed.unpack(words, escapes, n) == values).all()
        if bits == 0 and n:
            assert len(words) == -(-n // 240) or len(words) <= 1 + n // 120


def test_words_of_sixty_bits_are_no_escapes():
    values = np.array([2**60 - 1, 2**60, 2**64 - 1, 2**53 + 1], dtype=np.uint64)
    words, escapes = packed.pack(values)
    assert escapes[:, 0].tolist() == [1, 2] and (packed.unpack(words, escapes, 4) == values).all()


def test_vocabulary_is_the_library(monkeypatch):
    monkeypatch.setattr(packed.Vocabulary, "CACHED", 300)  # the tables are cleared now and then
    vocabulary = packed.Vocabulary(packed.default_vocabulary())
    for lo in range(0, 3000, 300):
        texts = [*ODD_TEXTS, *odd_mixtures(3000)[lo : lo + 300]]
        lengths, ids = vocabulary.encode_batch(texts)
        for text, part in zip(texts, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
            assert part.tolist() == [*vocabulary.library.encode(text, add_special_tokens=False).ids, 0], text


def test_parts_are_cut_where_the_library_cuts():
    signs = [*"abZ éÉ×÷ßȿɀɏƻжЖ中가 \t\n\r\x0b\x0c\x00\x1c\x85\xa0\u1680\u2003\u2028\u202f\u200b\u3000.,'!9²_`{~@[😀\u0301"]
    signs += ["'s", " the", "<|endoftext|>", "<|endoftext", "|>", "  ", "\n\n"]
    rng = np.random.default_rng(7)
    vocabulary = packed.Vocabulary(packed.default_vocabulary())
    for _ in range(30):
        texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 30, 200)]
        lengths, ids = vocabulary.encode_batch(texts)
        for text, part in zip(texts, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
            assert part.tolist() == [*vocabulary.library.encode(text, add_special_tokens=False).ids, 0], text


def test_a_word_is_one_entry_whatever_stands_behind_it(monkeypatch):
    vocabulary = packed.Vocabulary(packed.default_vocabulary())
    asked, marks = [], ".,;:!?)"
    monkeypatch.setattr(vocabulary, "_encode", lambda t, ask=vocabulary._encode: asked.append(t) or ask(t))
    for _ in range(2):
        vocabulary.encode_batch(["".join(word + m for m in marks) for word in (" stonewall", " Größe")])
    assert vocabulary.n_places == 2 + len(marks) + 2  # words, marks, the end and what stands for it among the parts
    assert not any("stonewall" in t or "Größe" in t for t in asked)  # the model alone is asked for words


def test_token_files(docs, corpus, monkeypatch):
    library = packed.vocabulary(packed.default_vocabulary()).library
    found = by_id(packed.packed(docs))
    at = 0
    for d, text, *_ in sorted(corpus):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        r = found[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_of_odd_rows(odd_docs, no_docs):
    found = sorted(packed.packed(odd_docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, None, 1, 2, 3, 3, 4]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:], strict=False))
    assert packed.packed(no_docs).count() == 0


# -- toxicity --------------------------------------------------------------------------------


def labelled_texts(n=600):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    insults = [f"vile{w}" for w in ("ab", "cd", "ef", "gh", "ij", "kl")]
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 10)):
                words[rng.randrange(len(words))] = rng.choice(insults).upper() + rng.choice([".", "!", ""])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_documents_without_labels(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 2], "doc_id long, quality int, toxic int")
    labels = labels.unionByName(spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 4 == 0], labels.schema))
    found = by_id(toxicity.toxicity(docs, labels))
    unseen = [(i, y) for i, _, y in rows if i % 4 == 2]
    hits = sum(found[i]["toxic"] == bool(y) for i, y in unseen)
    assert len(found) == len(rows) and hits >= 0.98 * len(unseen)
    assert all(0 <= r["p_toxic"] <= r["severity"] <= 2 for r in found.values())
    kept = toxicity.without_toxic(docs, toxicity.labelled(labels))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["toxic"]}


def test_ordinal_grades_share_weights():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 900)
    rows = [np.concatenate([np.arange(5 * g), 100 + rng.integers(0, 50, 6)]) for g in grades]
    model = toxicity.fit_ordinal([np.unique(r) for r in rows], grades, 2)
    scores = np.array([model.weights[np.unique(r)].sum() for r in rows])
    up = model.at_least(scores)
    assert model.thresholds[0] < model.thresholds[1] and (up[:, 0] >= up[:, 1]).all()
    assert (np.rint(up.sum(axis=1)) == grades).mean() > 0.99


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (9, None, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(odd_docs, labels).count() == 7
    assert toxicity.toxicity(no_docs, labels).count() == 0
    none = toxicity.toxicity(odd_docs, labels.limit(0))
    assert none.count() == 7 and none.filter("toxic").count() == 0
    assert toxicity.without_toxic(odd_docs, toxicity.labelled(labels)).columns == odd_docs.columns


# -- pipeline --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents and labels as tables, documents with a column of its own."""
    root = tmp_path_factory.mktemp("corpus")
    rows = labelled_texts(240)
    texts = [(i, t, "en", f"s{i % 3}", len(t), i) for i, t, _ in rows]
    texts += [(1000 + i, rows[i][1], "en", "s0", 1, i) for i in range(0, 60)]
    texts += [(2000, 'a token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" b', None, None, None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int"
    spark.createDataFrame(texts, schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages(spark, folder):
    """Each stage against what its operator says about the stage's own input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "secrets", "mixing", "sentencepiece"]

    clean = stages["toxicity"](spark, docs, folder).cache()
    told = by_id(toxicity.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    assert {r["doc_id"] for r in clean.collect()} == {i for i, r in told.items() if not r["toxic"]}

    distinct = stages["simhash"](spark, clean, folder).cache()
    groups = by_id(simhash.simhash(clean))
    assert {r["doc_id"] for r in distinct.collect()} == {r["component_id"] for r in groups.values()}
    assert 0 < distinct.count() < clean.count() < docs.count()

    redacted = by_id(stages["secrets"](spark, distinct, folder))
    for i, r in by_id(distinct).items():
        assert redacted[i]["text"] == (r["text"] if i != 2000 else 'a [SECRET]" b')

    safe = secrets.redact(distinct).cache()
    mixed = collections.Counter(r["doc_id"] for r in stages["mixing"](spark, safe, folder).collect())
    taken = {i: r["taken"] // max(r["size"], 1) for i, r in by_id(mixing.mixed(safe)).items()}
    assert dict(mixed) == {i: n for i, n in taken.items() if n}

    for frame in (clean, distinct, safe):
        assert frame.columns == docs.columns
    found = corpus_pipeline.run(spark, folder).collect()
    library = pieces.pieces(pieces.default_model()).library
    texts = {r["doc_id"]: r["text"] for r in safe.collect()}
    assert collections.Counter(r["doc_id"] for r in found) == mixed
    for r in found:
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]]))


def test_pipeline_of_odd_rows(spark, folder, odd_docs, no_docs):
    for docs, least in ((odd_docs, 1), (no_docs, 0)):
        frame = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, folder)
            assert frame.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, folder).count() >= least
