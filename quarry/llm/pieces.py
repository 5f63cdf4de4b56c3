"""Exact SentencePiece BPE encoding and decoding by a merge-type prefix table.

In a BPE vocabulary whose merge priority belongs to the merged string (not to the pair), the encoding
of every prefix of a text ends in one unique token, and a sequence of tokens is the encoding of its
text exactly when every two neighbours are compatible, that is when the pair encodes to itself. So
one pass from left to right suffices: at each end position an Aho-Corasick automaton over the
pieces lists the tokens that end there, and the one that is compatible with the last token of the
prefix before it is the last token of this prefix. The ids are then read backwards from the end.

Two things in the library's encoder do not follow that rule and are handled apart. Runs of the white
space mark share one score, so ties fall to the leftmost pair; they are merged after everything else
and no other piece holds two marks, which makes the run before a word independent of the word.
Characters outside the vocabulary never merge and become byte tokens.

No piece has a mark after another character, so a text splits into words that never merge with each
other; the table is filled once per distinct word and worker (a bounded cache, not a cap: longer or
later words are computed anew). The model file is read from a path on each executor.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, in_small_batches, tidy

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_WORDS, CACHE_CHARS = 200_000, 64


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a protobuf message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else (8 if kind == 1 else 4, i)
            v, i = b[i : i + n], i + n
        yield tag >> 3, v


def read_model(path: str) -> tuple[list[tuple[str, float, int]], dict[int, object], dict[int, object]]:
    """Pieces (string, score, type), trainer fields and normaliser fields of a model file."""
    import struct

    pieces, trainer, normaliser = [], {}, {}
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    return pieces, trainer, normaliser


class PieceCodec:
    """Encoder and decoder of one BPE model with byte fallback and an identity normaliser."""

    def __init__(self, path: str):
        self.pieces, trainer, normaliser = read_model(path)
        if trainer.get(3) != 2 or normaliser.get(2) or normaliser.get(4, 1) or not trainer.get(35):
            raise ValueError("a BPE model with byte fallback and an identity normaliser is needed")
        self.dummy = bool(normaliser.get(3, 1))
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)}
        self.score = [s for _, s, _ in self.pieces]
        self.size = [len(p) for p, _, _ in self.pieces]
        self.byte = [0] * 256
        self.raw: list[bytes] = []
        for i, (p, _, kind) in enumerate(self.pieces):
            if kind == BYTE:
                self.byte[int(p[3:5], 16)] = i
            self.raw.append(bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode())
        if any(re.search(f"[^{MARK}]{MARK}|{MARK}{MARK}[^{MARK}]", p) for p in self.ids):
            raise ValueError("pieces that cross words are not supported")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if p.strip(MARK) or len(p) == 1:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        #: Words seen last, and those of the generation before; a word found there moves on.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.run = lru_cache(4096)(self._run)

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge is the last step of building the token; None for one character."""
        if token not in self.parts:
            word = self.pieces[token][0]
            got = self._merged(list(word), stop=True) if len(word) > 1 else []
            self.parts[token] = (self.ids[got[0]], self.ids[got[1]]) if len(got) == 2 else None
        return self.parts[token]

    def _merged(self, symbols: list[str], stop: bool = False) -> list[str]:
        """Merges best score first, then leftmost. stop: the whole string itself is not formed."""
        whole = "".join(symbols) if stop else None
        right = [*range(1, len(symbols)), -1]
        left = [*range(-1, len(symbols) - 1)]
        heap: list[tuple[float, int, int, int]] = []

        def push(i: int, j: int) -> None:
            both = symbols[i] + symbols[j]
            if both != whole and both in self.ids:
                heapq.heappush(heap, (-self.score[self.ids[both]], i, j, len(both)))

        for i in range(len(symbols) - 1):
            push(i, i + 1)
        while heap:
            _, i, j, n = heapq.heappop(heap)
            if not symbols[i] or right[i] != j or len(symbols[i]) + len(symbols[j]) != n:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                push(i, right[j])
            if left[i] >= 0:
                push(left[i], i)
        return [s for s in symbols if s]

    def _rank(self, a: int, b: int) -> float:
        """Priority of merging a and b, higher first; minus infinity if they do not merge."""
        i = self.ids.get(self.pieces[a][0] + self.pieces[b][0])
        return float("-inf") if i is None else self.score[i]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of a and b encodes to (a, b): no merge across the border comes before both are formed.

        The last merges inside a and b are undone from the best-forming side back, and a pair that
        would have merged across the border before the merge that was undone speaks against it.
        """
        key = a << 20 | b
        if key not in self.fits:
            if len(self.fits) >= 2 * CACHE_WORDS:
                self.fits.clear()
            self.fits[key] = self._compatible(a, b)
        return self.fits[key]

    def _compatible(self, a: int, b: int) -> bool:
        if self._rank(a, b) > float("-inf"):
            return False
        while True:
            pa, pb = self._split(a), self._split(b)
            if pa is None and pb is None:
                return True
            # undo the later of the two last merges: the lower score; at a tie the right one, formed after the left
            if pb is None or (pa is not None and self.score[a] < self.score[b]):
                # a was formed last; across the border the pair (right part of a, b) stood ready before
                if self._rank(pa[1], b) > self.score[a]:
                    return False
                a = pa[1]
            else:
                if self._rank(a, pb[0]) >= self.score[b]:
                    return False
                b = pb[0]

    def _run(self, n: int) -> tuple[int, ...]:
        """A run of n marks alone."""
        return tuple(self.ids[s] for s in self._merged([MARK] * n))

    def _word(self, word: str) -> list[int]:
        """A word with one mark before it at most: the prefix table, then back from the end."""
        n = len(word)
        last = [-1] * (n + 1)  # last token of each prefix; -1 where a character outside the vocabulary ends it
        fits, compatible = self.fits, self.compatible
        for end, (token, size) in self.automaton.iter(word):
            if last[end + 1] < 0:
                before = last[end + 1 - size]
                if before < 0:
                    last[end + 1] = token
                else:
                    fit = fits.get(before << 20 | token)
                    if compatible(before, token) if fit is None else fit:
                        last[end + 1] = token
        out: list[int] = []
        while n:
            if last[n] >= 0:
                out.append(last[n])
                n -= self.size[last[n]]
            else:
                out.extend(self.byte[c] for c in reversed(word[n - 1].encode("utf-8", "replace")))
                n -= 1
        return out[::-1]

    def chunk(self, chunk: str) -> bytes:
        """Ids, as native 32-bit integers, of the marks before a word and the word."""
        got = self.cache.get(chunk) or self.older.get(chunk)
        if got is None:
            word = chunk.lstrip(MARK)
            marks = len(chunk) - len(word)
            ids = self._word(MARK * min(marks, 1) + word) if word else []
            if marks and word and ids[0] == self.ids[MARK]:
                ids = [*self.run(marks), *ids[1:]]  # the mark stayed alone and merges with the others
            elif marks > 1 or not word:
                ids = [*self.run(marks - bool(word)), *ids]
            got = array("I", ids).tobytes()
        if len(chunk) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_WORDS:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = got
        return got

    words = staticmethod(re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall)

    def encode(self, text: str | None) -> list[int]:
        """The library's ids of the text, without begin and end. Null and empty: none."""
        if not text:
            return []
        text = text.replace(" ", MARK)
        chunks = self.words(MARK + text if self.dummy else text)
        chunk = self.chunk
        out: list[bytes] = []
        for i in range(0, len(chunks), 4096):  # the cache may be renewed in between
            get = self.cache.get
            out += [get(c) or chunk(c) for c in chunks[i : i + 4096]]
        return memoryview(b"".join(out)).cast("I").tolist()

    def decode(self, ids: list[int]) -> str:
        """The library's text of the ids: bytes are joined, broken sequences become U+FFFD each byte."""
        raw = self.raw
        data = b"".join([raw[i] for i in ids])
        if self.dummy and data[:1] == b" " and self.pieces[ids[0]][2] != BYTE:
            data = data[1:]
        return data.decode("utf-8", "replace")


@lru_cache(4)
def codec(path: str) -> PieceCodec:
    """One codec per worker process and model."""
    return PieceCodec(path)


KEPT["pieces"] = codec.cache_clear


def encode_ids(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with an array<int> column of ids: whole texts; null and empty texts have no ids. A clashing column is replaced."""
    df = in_small_batches(df.drop(ids))

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        own = codec(model)
        return pd.Series([own.encode(t) for t in texts], dtype=object)

    return df.withColumn(ids, run(F.col(text)))


def decode_ids(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the decoded text of an array of ids; null ids give an empty text."""
    df = in_small_batches(df.drop(text))

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        own = codec(model)
        return pd.Series([own.decode([int(i) for i in x]) if x is not None and len(x) else "" for x in rows], dtype=object)

    return df.withColumn(text, run(F.col(ids)))


def token_digests(df: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, decoded again and digested in one pass.

    One Arrow pass without any shuffle; memory is one batch of texts. Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model)
        names = [str(i) for i in range(len(own.pieces))]
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"], strict=True):
                ids = own.encode(t)
                said = ",".join([names[i] for i in ids])
                rows.append((k, len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["key", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"key": pdf["key"].dtype})

    kind = df.schema[key].dataType.simpleString()
    rows = in_small_batches(df.select(F.col(key).alias("key"), F.col(text).alias("text")))
    return rows.mapInPandas(tidy(run, "pieces"), f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
