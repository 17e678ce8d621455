"""Token ids in Simple-8b files, and back.

Documents are range-partitioned by id, so that files are in ascending order and a hot range splits.
Each task encodes its documents and writes one file in blocks of BLOCK ids. A 64-bit word holds a
4-bit selector and as many values of equal width as fit in 60 bits; a word takes as many of the next
values as any selector allows. Values of 60 bits and more are escapes: a zero in the words, place and
value in the block's list. The footer holds offset and sizes of every block, and the lengths of all documents, so
that blocks decode by themselves, selector by selector as arrays.

File: MAGIC, blocks (words, then escapes as pairs), footer (block index of four and document index
of three 64-bit integers a row), sizes of both indexes, MAGIC. Everything is little-endian.

A task that is repeated writes a file of another name; the manifest, itself a table written by Spark, lists the
files of the tasks that counted.

Defined results. A null or empty text has the end id alone. Documents without an id come first, and
those that share an id lie side by side in any order. An empty table gives files without documents.
Very long texts span blocks. A text that holds a special token's string gets that token, as the
library does by default.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import folder, quoted, written

MAGIC = b"TFS8B001"
BLOCK = 1 << 16
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
# Selectors: how many values of how many bits a word holds.
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
_COUNT = np.array([n for n, _ in SELECTORS], dtype=np.int64)
_SHORT_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _widest(bits: np.ndarray) -> dict[int, np.ndarray]:
    """For each selector's count, the largest of so many entries from each place on; 0 past the end."""

    def moved(x: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[: max(0, len(x) - step)] = x[step:]
        return out

    doubled, span = {1: bits}, 1
    while 2 * span <= max(n for n, _ in SELECTORS):
        doubled[2 * span] = np.maximum(doubled[span], moved(doubled[span], span))
        span *= 2
    found = {}
    for n, _ in SELECTORS:
        span = 1 << (n.bit_length() - 1)
        found[n] = doubled[span] if span == n else np.maximum(doubled[span], moved(doubled[span], n - span))
    return found


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of values below 2**60."""
    if values.max() < len(_SHORT_BITS):
        return _SHORT_BITS[values]
    bits = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    wide = values >= np.uint64(1) << np.uint64(52)  # float rounding may add a bit there
    if wide.any():
        bits[wide] = [int(v).bit_length() for v in values[wide]]
    return bits


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes (place, value) of unsigned 64-bit values."""
    values = np.asarray(values, dtype=np.uint64)
    large = np.nonzero(values >= np.uint64(1) << np.uint64(60))[0]
    escapes = np.stack([large.astype(np.uint64), values[large]], axis=1)
    if len(large):
        values = values.copy()
        values[large] = 0
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), escapes
    widest = _widest(_bits(values))
    chosen = np.full(n, len(SELECTORS) - 1, dtype=np.uint8)
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, width = SELECTORS[s]
        chosen[widest[count] <= width] = s
    jump = (_COUNT[chosen]).tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += jump[at]
    where = np.array(starts)
    selector = chosen[where]
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    words = selector.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(SELECTORS):
        own = np.nonzero(selector == s)[0]
        if width and len(own):
            shifts = (np.arange(count) * width).astype(np.uint64)
            parts = padded[where[own][:, None] + np.arange(count)] << shifts
            words[own] |= np.bitwise_or.reduce(parts, axis=1)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(_COUNT[selector])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    starts = ends - _COUNT[selector]
    for s, (count, width) in enumerate(SELECTORS):
        own = np.nonzero(selector == s)[0]
        if width and len(own):
            shifts = (np.arange(count) * width).astype(np.uint64)
            mask = np.uint64((1 << width) - 1)
            out[starts[own][:, None] + np.arange(count)] = (words[own][:, None] >> shifts) & mask
    out = out[:n]
    if len(escapes):
        out[escapes[:, 0].astype(np.int64)] = escapes[:, 1]
    return out


class Writer:
    """Writes documents to one file, a block at a time."""

    def __init__(self, out):
        self.out, self.at = out, len(MAGIC)
        out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[np.ndarray] = []

    def add(self, keys: np.ndarray, named: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(np.stack([keys, named, lengths], axis=1).astype("<i8"))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            ids = np.concatenate(self.waiting)
            full = len(ids) // BLOCK * BLOCK
            for lo in range(0, full, BLOCK):
                self._block(ids[lo : lo + BLOCK])
            self.waiting, self.n_waiting = [ids[full:]], len(ids) - full

    def _block(self, ids: np.ndarray) -> None:
        words, escapes = pack(ids)
        data = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
        self.out.write(data)
        self.blocks.append((self.at, len(words), len(escapes), len(ids)))
        self.at += len(data)
        self.n_ids += len(ids)

    def close(self) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint64)
        if len(rest):
            self._block(rest)
        blocks = np.array(self.blocks, dtype="<i8").reshape(-1, 4)
        docs = np.concatenate(self.docs) if self.docs else np.empty((0, 3), dtype="<i8")
        self.out.write(blocks.tobytes() + docs.tobytes())
        self.out.write(np.array([len(blocks), len(docs)], dtype="<i8").tobytes() + MAGIC)


def read_file(file) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a file as (key, named, ids), in order; one block is decoded at a time."""
    size = file.size()
    tail = 16 + len(MAGIC)
    file.seek(size - tail)
    end = file.read(tail)
    if end[16:] != MAGIC:
        raise ValueError("not a file of packed ids")
    n_blocks, n_docs = np.frombuffer(end[:16], "<i8").tolist()
    file.seek(size - tail - 24 * n_docs - 32 * n_blocks)
    blocks = np.frombuffer(file.read(32 * n_blocks), "<i8").reshape(-1, 4)
    docs = np.frombuffer(file.read(24 * n_docs), "<i8").reshape(-1, 3)
    ready, next_block = np.empty(0, np.uint64), 0
    for key, named, length in docs:
        parts, got = [], 0
        while got < length:
            if not len(ready):
                at, n_words, n_escapes, n = blocks[next_block].tolist()
                next_block += 1
                file.seek(at)
                words = np.frombuffer(file.read(8 * n_words), "<u8")
                escapes = np.frombuffer(file.read(16 * n_escapes), "<u8").reshape(-1, 2)
                ready = unpack(words, escapes, n)
            take = ready[: length - got]
            parts.append(take)
            got += len(take)
            ready = ready[len(take) :]
        yield key, named, np.concatenate(parts) if len(parts) != 1 else parts[0]


# What the vocabulary's pattern treats as white space beside the ASCII characters of that kind, in UTF-8.
_WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
_WIDE_2, _WIDE_3 = ([int.from_bytes(c) for c in _WIDE if len(c) == n] for n in (2, 3))
# Kinds of bytes. LETTER: of a Latin letter up to U+023F, which the pattern never joins with a MARK behind it, or behind
# the first byte of a character. MARK: ASCII, neither letter nor white space. OTHER: first of another character.
OTHER, WHITE, LETTER, MARK = range(4)
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[:0x80] = MARK
_KIND[[0x20, *range(0x09, 0x0E)]] = WHITE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = LETTER
# One space and such letters: one word to the pattern, whatever stands beside it.
_WORD = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf])+").fullmatch
# The characters that byte-level vocabularies write bytes as: printing ones are themselves, the others follow from 256 on.
_PRINTING = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in _PRINTING)}


def _parts(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts in a row, each text with an end part behind it, and where the end parts are.

    A part starts with each run of white space, and with the MARK behind letters that make up a part so far.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\0".join([b"", *raw, b""]), dtype=np.uint8)
    ends = np.cumsum([0, *(len(r) + 1 for r in raw)])
    kind = _KIND[data]
    signs = np.nonzero(data == 0xC3)[0]  # multiplication and division, among letters
    kind[signs[np.isin(data[signs + 1], (0x97, 0xB7))]] = OTHER
    at = np.nonzero(kind == OTHER)[0]
    at = at[data[at] <= 0xE3]
    if len(at):
        code = data[at].astype(np.uint32) << 16 | data[at + 1].astype(np.uint32) << 8 | data[at + 2]
        two, three = at[np.isin(code >> 8, _WIDE_2)], at[np.isin(code, _WIDE_3)]
        for places in (two, two + 1, three, three + 1, three + 2):
            kind[places] = WHITE
    white = kind == WHITE
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = white[1:] > white[:-1]
    cut[ends] = cut[ends + 1] = True
    white[ends] = True  # letters may stand at the start of a text
    no_letters = np.nonzero(kind != LETTER)[0]
    before, behind = no_letters[:-1], no_letters[1:]
    cut[behind[(behind - before > 1) & (kind[behind] == MARK) & white[before]]] = True
    offsets = np.nonzero(cut)[0][1:]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
    return found, np.searchsorted(offsets, ends[1:])


class Vocabulary:
    """Ids by the tokenizers library, asked once for a part of a text that a worker meets.

    The library's pattern never reaches across the start of a run of white space, nor between a
    Latin letter and ASCII punctuation or digits behind it, so ids of such parts side by side are
    those of the whole text. New words of letters go to the library's model, which is the step behind the
    pattern; other new parts go through the whole library in one string, with its special token between them. Parts are cut and told apart as arrays, a block of texts at a time, so that the table of
    all parts met is looked up once a block for each; their ids lie in one row, and a part is a place in it.
    """

    CACHED, LONGEST, MOST_IDS = 1_600_000, 64, 24_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = [t for t in self.library.get_added_tokens_decoder().values() if t.special]
        if not special:
            raise ValueError("the vocabulary needs a special token to put between parts")
        self.between = special[0].content
        self.between_id = self.library.token_to_id(self.between)
        self.model = self._model()
        self.clear()

    def _model(self):
        """The model, if the pattern is the only step before it and each of its words has one result."""
        from tokenizers import models, pre_tokenizers

        before, model = self.library.pre_tokenizer, self.library.model
        plain = isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and self.library.normalizer is None
        return model if plain and isinstance(model, models.BPE) and not model.dropout else None

    def clear(self) -> None:
        self.parts: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.length = np.zeros(1 << 14, dtype=np.int64)
        self.n_flat = self.n_places = 0
        self.end = self._append(np.array([END_ID], np.uint32), np.array([1]))[0]

    def _append(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """Places of new entries whose ids lie in a row."""
        while self.n_flat + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n_places + len(lengths) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        places = slice(self.n_places, self.n_places + len(lengths))
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.start[places] = self.n_flat + np.cumsum(lengths) - lengths
        self.length[places] = lengths
        self.n_flat += len(ids)
        self.n_places += len(lengths)
        return range(places.start, places.stop)

    def _encode(self, text: str) -> np.ndarray:
        found = self.library.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype=np.uint32)

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Places of parts that the library is asked for."""
        places = np.empty(len(new), dtype=np.int64)
        words = [i for i, p in enumerate(new) if _WORD(p)] if self.model else []
        if words:
            ask = self.model.tokenize
            found = [[t.id for t in ask(new[i].decode("latin-1").translate(_WRITTEN))] for i in words]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            places[words] = self._append(np.fromiter(chain.from_iterable(found), np.uint32), lengths)
        others = sorted({*range(len(new))}.difference(words))
        texts = {i: new[i].decode() for i in others}
        plain = [i for i in others if self.between not in texts[i]]
        for lo in range(0, len(plain), 5000):
            some = plain[lo : lo + 5000]
            ids = self._encode(self.between.join([texts[i] for i in some]))
            cuts = np.nonzero(ids == self.between_id)[0]
            lengths = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            places[some] = self._append(np.delete(ids, cuts), lengths)
        for i, t in texts.items():
            if self.between in t:
                ids = self._encode(t)
                places[i] = self._append(ids, np.array([len(ids)]))[0]
        self.parts.update((p, at) for p, at in zip(new, places.tolist(), strict=True) if len(p) <= self.LONGEST)
        return places

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Length of each text in ids, the end id included, and all ids in a row."""
        if len(self.parts) > self.CACHED or self.n_flat > self.MOST_IDS:
            self.clear()
        parts, ends = _parts(texts)
        parts = parts.dictionary_encode()
        unlike = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter(map(self.parts.get, unlike, repeat(-1)), np.int64, len(unlike))
        missing = np.nonzero(known < 0)[0]
        if len(missing):
            known[missing] = self._learn([unlike[i] for i in missing.tolist()])
        places = known[parts.indices.to_numpy()]
        places[ends] = self.end
        lengths = self.length[places]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        source = np.arange(upto[-1]) - np.repeat(upto[:-1] - self.start[places], lengths)
        return np.diff(upto[np.concatenate([[0], ends + 1])]), self.flat[source]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


BATCH_CHARS = 2_000_000


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.Series, list[str]]]:
    """Keys and texts in bounded blocks."""
    for frame in batches:
        lo = size = 0
        texts = [t or "" for t in frame["text"]]
        for hi, t in enumerate(texts, 1):
            size += len(t)
            if size >= BATCH_CHARS or hi == len(texts):
                yield frame["key"].iloc[lo:hi], texts[lo:hi]
                lo, size = hi, 0


MANIFEST = "part int, path string, n_docs long, n_ids long"


def _writing(root: str, path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        part = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}.s8b"
        n_docs = 0
        with store.open_output_stream(f"{base}/{name}") as out:
            writer = Writer(out)
            for keys, texts in _blocks(batches):
                lengths, ids = vocabulary(path).encode_batch(texts)
                named = keys.notna().to_numpy()
                writer.add(keys.fillna(0).astype("int64").to_numpy(), named, lengths, ids)
                n_docs += len(texts)
            writer.close()
        yield pd.DataFrame(
            {"part": [part], "path": [name], "n_docs": [n_docs], "n_ids": [writer.n_ids]}
        )

    return run


def write(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None):
    """Encode and write docs; the folder of the files and their manifest with the start of each file."""
    spark = docs.sparkSession
    root = folder(spark, "packed-ids")
    root = root if "://" in root else f"file://{root}"
    rows = (
        docs.select(quoted(key).cast("long").alias("key"), quoted(text).alias("text"))
        .repartitionByRange(F.col("key").asc_nulls_first())
        .sortWithinPartitions(F.col("key").asc_nulls_first())
    )
    files = written(
        rows.mapInPandas(_writing(root, path or default_vocabulary()), MANIFEST), "packed-manifest"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return root, files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_digest(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Digest of every document from the files: each task reads its files block by block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in batches:
            for name, start in zip(frame["path"], frame["start"], strict=True):
                rows, at = [], int(start)
                with store.open_input_file(f"{base}/{name}") as file:
                    for key, named, ids in read_file(file):
                        check = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((int(key) if named else None, at, len(ids), check))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                            rows = []
                yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.select("path", "start").repartition(max(1, files.count()))
    return spread.mapInPandas(run, DIGEST)


def packed(docs: DataFrame) -> DataFrame:
    """Digest of the files written for docs, one row per document."""
    root, files = write(docs.select("doc_id", "text"))
    return read_digest(docs.sparkSession, root, files)
