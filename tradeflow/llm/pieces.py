"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A segment of text starts as single characters. An agenda holds the adjacent pairs whose
concatenation is a piece, best score first, leftmost first among equals; the best pair is merged,
its new neighbours join the agenda, and entries whose symbols have changed are skipped when they come
up. What is no piece in the end falls back to its bytes.

Where pieces hold a word boundary mark only at their front, no merge reaches from a character to a
mark behind it; where no piece joins a Latin letter and another character, or holds a line end, none
crosses those. Texts are cut there as far as the vocabulary at hand allows, and the ids of short
segments are kept in a bounded cache in each worker. Each segment that enters
the cache in an Arrow batch, and each long one, is encoded by the sentencepiece library too; should the
two differ, the library's ids are taken and counted.

Defined results. A null or empty text has no ids and decodes to an empty text. Text is not
normalised beyond a mark in front and marks for spaces, as the model says. Repeated rows give the
same. An empty table gives no rows. Very long texts cost n log n at most, and memory for their
ids.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tradeflow.llm.common import fresh, quoted

# The mark that stands for a space, Latin letters.
MARK = "▁"
LATIN = "A-Za-z\u00c0-\u024f"
CACHED, SHORT = 600_000, 48  # segments a worker keeps, and the longest that it keeps
MODEL = "piece_bpe_32k.model"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _each_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("piece-bytes", _each_byte)


class Pieces:
    """A merge-type vocabulary with its agenda; learns segments as it meets them."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.get_piece_size()
        self.unknown = lib.unk_id()
        self.bytes: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.surface: list[bytes] = []
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(i):
                self.surface.append(b"")
            elif lib.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.id_of[piece] = i
                self.score[piece] = lib.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.text_of_id = [str(i) for i in range(n)]
        self.segments = re.compile(self._cut()).findall
        self.cache: dict[str, tuple[int, ...]] = {}
        self.differing = 0

    def _cut(self) -> str:
        """Pattern of segments that no piece of the vocabulary reaches out of."""
        longer = [p for p in self.id_of if len(p) > 1]
        letter, other = f"[{LATIN}]", f"[^{LATIN}{MARK}\n]"
        if any(MARK in p.lstrip(MARK) for p in longer):
            return r"(?s).+"
        if any("\n" in p for p in longer):
            return f"{MARK}*[^{MARK}]+|{MARK}+"
        mixed = re.compile(f"{letter}{other}|{other}{letter}").search
        if any(mixed(p) for p in longer):
            return f"{MARK}*[^{MARK}\n]+|{MARK}+|\n"
        return f"{MARK}*{letter}+|{MARK}*{other}+|{MARK}+|\n"

    def agenda(self, segment: str) -> tuple[int, ...]:
        """Ids of a segment by merging its best adjacent pairs."""
        merged = self._merge_short(segment) if len(segment) <= SHORT else self._merge_long(segment)
        ids: list[int] = []
        for symbol in merged:
            known = self.id_of.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode())
            else:
                ids.append(self.unknown)
        return tuple(ids)

    def _merge_short(self, segment: str) -> list[str]:
        """Symbols left, with the agenda as a plain list: entry i is the score of symbols i, i + 1."""
        score, never = self.score.get, -math.inf
        symbols = list(segment)
        agenda = [score(a + b, never) for a, b in zip(segment, segment[1:], strict=False)]
        while agenda:
            best = max(agenda)
            if best == never:
                break
            i = agenda.index(best)
            merged = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(merged + symbols[i + 1], never)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + merged, never)
        return symbols

    def _merge_long(self, segment: str) -> list[str]:
        """Symbols left, with the agenda as a heap over linked symbols."""
        score, symbols, n = self.score, list(segment), len(segment)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in score:
                heap.append((-score[pair], i, i + 1, pair))
        heapq.heapify(heap)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                more = pair + symbols[nxt]
                if more in score:
                    heapq.heappush(heap, (-score[more], left, nxt, more))
            prev = before[left]
            if prev >= 0:
                more = symbols[prev] + pair
                if more in score:
                    heapq.heappush(heap, (-score[more], prev, left, more))
        return [symbol for symbol in symbols if symbol is not None]

    def learn(self, segments: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of segments by the agenda, compared with the library's."""
        found = {s: self.agenda(s) for s in segments}
        # The library puts a mark in front of any text: give it the own one, or a line end to stand on.
        marked = [s[0] == MARK and len(s) > 1 for s in segments]
        asked = [s[1:] if m else "\n" + s for s, m in zip(segments, marked, strict=True)]
        told = self.library.encode(asked, num_threads=1) if asked else []
        for s, m, ids in zip(segments, marked, told, strict=True):
            if not m:
                ids = ids[2:]  # the library's mark and the line end
            if list(found[s]) != ids:
                self.differing += 1
                found[s] = tuple(ids)
        return found

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; the segments new in the batch are learned together."""
        cuts = []
        new: dict[str, None] = {}
        if len(self.cache) > CACHED:
            self.cache.clear()
        cache = self.cache
        for text in texts:
            cut = self.segments(MARK + text.replace(" ", MARK)) if text else []
            cuts.append(cut)
            new.update((s, None) for s in cut if s not in cache)
        learned = self.learn(list(new))
        cache.update((s, ids) for s, ids in learned.items() if len(s) <= SHORT)
        for cut in cuts:
            try:
                yield list(chain.from_iterable([cache[s] for s in cut]))
            except KeyError:
                yield list(chain.from_iterable([cache[s] if s in cache else learned[s] for s in cut]))

    def decode(self, ids: list[int]) -> str:
        """Text of ids: surfaces in a row, without the space that stands for the mark in front."""
        surface = self.surface
        whole = b"".join([surface[i] for i in ids]).decode("utf-8", "piece-bytes")
        first = next((i for i in ids if surface[i]), None)
        spaced = first is not None and surface[first][:1] == b" " and first != self.unknown
        return whole[1:] if spaced and first not in self.bytes.values() else whole


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The vocabulary of a model file, loaded once in a worker."""
    return Pieces(path)


BATCH_CHARS = 2_000_000


def _blocks(texts: pd.Series) -> Iterator[list[str]]:
    """Texts of an Arrow batch in blocks of bounded size; null becomes empty."""
    block, size = [], 0
    for t in texts:
        block.append(t or "")
        size += len(block[-1])
        if size >= BATCH_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode(text: Column, model: str | None = None) -> Column:
    """Ids of a text column as array<int>."""
    path = model or default_model()

    @pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = pieces(path)
        for texts in batches:
            yield pd.Series([i for block in _blocks(texts) for i in vocabulary.encode_batch(block)], dtype=object)

    return ids(text)


def decode(ids: Column, model: str | None = None) -> Column:
    """Text of a column of ids; null for null."""
    path = model or default_model()

    @pandas_udf(T.StringType())
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = pieces(path)
        for rows in batches:
            yield pd.Series([None if r is None else vocabulary.decode([int(i) for i in r]) for r in rows], dtype=object)

    return texts(ids)


DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("n_differing", T.LongType()),
    ]
)


def digest(text: Column, model: str | None = None) -> Column:
    """Number of ids, hashes of the ids and of the text decoded from them, in one pass.

    n_differing counts segments of the row's block of texts for which the library had other ids.
    """
    path = model or default_model()

    @pandas_udf(DIGEST)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = pieces(path)
        for texts in batches:
            rows = []
            for block in _blocks(texts):
                vocabulary.differing = 0
                for ids in vocabulary.encode_batch(block):
                    listed = ",".join([vocabulary.text_of_id[i] for i in ids])
                    rows.append(
                        (
                            len(ids),
                            hashlib.sha256(listed.encode()).hexdigest(),
                            hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest(),
                            vocabulary.differing,
                        )
                    )
            yield pd.DataFrame(rows, columns=[f.name for f in DIGEST.fields])

    return digests(text)


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Digest of the encoding, one row per document."""
    (found,) = fresh(docs.columns, "pieces")
    rows = docs.select("doc_id", digest(quoted("text"), model).alias(found))
    return rows.select("doc_id", *[quoted(found)[f.name].alias(f.name) for f in DIGEST.fields])
