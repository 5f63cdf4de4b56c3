"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability is
the sum over all its segmentations into pieces (forward algorithm); a text's log probability is the sum
over its words, so a whole text of any length is scored. The piece probabilities come from one
expectation step over the segmentations of the training words, counted per task and summed in Spark;
the driver receives languages x pieces numbers at most, which the vocabulary bounds.

Words are maximal runs of letters of the lower-cased text, whole whatever their length: words up to WORD letters
are scored many at once, each kept in a bounded cache of its worker, and longer ones letter by letter with the last
positions alone in memory, to the same sums. The model learns from words, of which those over WORD letters
count as consecutive parts of WORD letters.

Null texts and texts without a letter give "und" with score 0, as does a model without any language.
Rows with a null label or id are scored but never learned from. No shuffle of texts takes place.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, in_small_batches, tidy
from .pieces import BYTE, CONTROL, MARK, UNKNOWN, read_model

#: Letters up to which the product of the least probabilities stays a normal double.
WORD = 40
#: Probability of a character outside all pieces; start value of every piece in the expectation step.
STRAY, START = 1e-7, 1 / 256
CACHE_WORDS, LATTICE = 300_000, 20_000
LETTERS = re.compile(r"[^\W\d_]+").findall
_PARTS = re.compile(f".{{1,{WORD}}}", re.S).findall


def words_of(text: str | None) -> list[str]:
    """Runs of letters of the lower-cased text; empty where there is no letter."""
    found = LETTERS(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def in_parts(words: list[str]) -> list[str]:
    """words with those over WORD letters in parts."""
    return list(chain.from_iterable(map(_PARTS, words))) if words and max(map(len, words)) > WORD else words


@lru_cache(2)
def automaton(model: str) -> tuple[ahocorasick.Automaton, int]:
    pieces, _, _ = read_model(model)
    out = ahocorasick.Automaton()
    for i, (p, _, kind) in enumerate(pieces):
        if kind not in (BYTE, CONTROL, UNKNOWN) and (p.strip(MARK) or p == MARK):
            out.add_word(p, i << 8 | len(p))
    out.make_automaton()
    return out, len(pieces)


KEPT["language"] = automaton.cache_clear


class Lattice:
    """All segmentations of a list of words, each with the word mark before it."""

    def __init__(self, words: list[str], model: str):
        auto, _ = automaton(model)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.n = len(words)
        self.size = size
        starts = np.cumsum(size) - size
        flat = MARK + MARK.join(words)
        got = np.array(list(chain.from_iterable(auto.iter(flat))), np.int64).reshape(-1, 2)
        end, token, length = got[:, 0], got[:, 1] >> 8, got[:, 1] & 255
        word = np.repeat(np.arange(self.n), size)[end]
        to = end - starts[word] + 1
        inside = to >= length
        self.word, self.to, self.token = word[inside], to[inside], token[inside]
        self.since = self.to - length[inside]
        by = np.argsort(self.to, kind="stable")
        self.word, self.to, self.token, self.since = self.word[by], self.to[by], self.token[by], self.since[by]
        self.longest = int(size.max()) if self.n else 0

    def forward(self, p: np.ndarray) -> np.ndarray:
        """alpha[position, word] for one language's piece probabilities."""
        alpha = np.zeros((self.longest + 1, self.n))
        alpha[0] = 1
        at = np.searchsorted(self.to, np.arange(self.longest + 2))
        weight = p[self.token]
        for j in range(1, self.longest + 1):
            s = slice(at[j], at[j + 1])
            alpha[j] = np.bincount(self.word[s], alpha[self.since[s], self.word[s]] * weight[s], self.n) + alpha[j - 1] * STRAY
        return alpha

    def scores(self, p: np.ndarray) -> np.ndarray:
        return np.log(self.forward(p)[self.size, np.arange(self.n)])

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of all words."""
        alpha = self.forward(p)
        beta = np.zeros((self.longest + 1, self.n))
        beta[self.size, np.arange(self.n)] = 1
        by = np.argsort(self.since, kind="stable")
        since, to, word = self.since[by], self.to[by], self.word[by]
        weight = p[self.token[by]]
        at = np.searchsorted(since, np.arange(self.longest + 2))
        for j in range(self.longest - 1, -1, -1):
            s = slice(at[j], at[j + 1])
            beta[j] += np.bincount(word[s], beta[to[s], word[s]] * weight[s], self.n) + beta[j + 1] * STRAY
        total = alpha[self.size, np.arange(self.n)]
        uses = alpha[since, word] * weight * beta[to, word] * (counts / total)[word]
        return np.bincount(self.token[by], uses, len(p))


def long_score(word: str, p: np.ndarray, model: str) -> np.ndarray:
    """Log of the sum over all segmentations of a word of any length, in every language. p: probabilities[piece, language]."""
    auto, _ = automaton(model)
    most, n = max(map(len, auto.keys())), p.shape[1]
    ring = np.zeros((most + 1, n))  # the last positions, all under one scale for each language
    ring[0] = 1
    scale, size = np.zeros(n), most + 1
    small, up = 2.0**-300, 2.0**300
    at, now = 0, None
    for end, value in auto.iter(MARK + word):
        while at <= end:  # on to the position after this letter
            if now is not None and now.min() < small:
                low = now < small
                ring[:, low] *= up
                scale[low] -= 300 * np.log(2)
            now = ring[at % size] * STRAY
            at += 1
            ring[at % size] = now
            now = ring[at % size]
        length = value & 255
        if at >= length:
            now += ring[(at - length) % size] * p[value >> 8]
    for _ in range(at, len(word) + 1):  # letters after the last piece
        now = (now if now is not None else ring[0]) * STRAY
        low = now < small
        now, scale = np.where(low, now * up, now), scale - low * 300 * np.log(2)
    return np.log(now) + scale


def learn(train: DataFrame, model: str, text: str = "text", lang: str = "lang", smooth: float = 0.1) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities[language, piece]) from every row with a label and a text.

    The driver gets one number per language and piece that occurs: bounded by the label set and the vocabulary.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, n = automaton(model)
        seen: dict[str, Counter] = defaultdict(Counter)
        total: dict[str, np.ndarray] = {}

        def step(k: str) -> None:
            words = list(seen[k])
            counts = np.fromiter(seen[k].values(), float, len(words))
            seen[k] = Counter()
            for i in range(0, len(words), LATTICE):
                got = Lattice(words[i : i + LATTICE], model).expected(np.full(n, START), counts[i : i + LATTICE])
                total[k] = total.get(k, 0) + got

        for pdf in batches:
            for k, t in zip(pdf["lang"], pdf["text"], strict=True):
                seen[k].update(in_parts(words_of(t)))
                if len(seen[k]) >= CACHE_WORDS // 2:
                    step(k)
        for k in list(seen):
            if seen[k]:
                step(k)
        for k, v in total.items():
            used = np.flatnonzero(v)
            yield pd.DataFrame({"lang": k, "piece": used, "uses": v[used]})

    rows = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    # sums of doubles depend on the order in which tasks end: whole millionths make reruns agree
    uses = in_small_batches(rows).mapInPandas(tidy(count, "language"), "lang string, piece int, uses double").groupBy("lang", "piece").agg(F.sum(F.round(F.col("uses") * 1e6).cast("long")).alias("uses"))
    got = uses.toPandas()
    langs = sorted(got["lang"].unique())
    probabilities = np.full((len(langs), automaton(model)[1]), smooth)
    for i, k in enumerate(langs):
        own = got[got["lang"] == k]
        probabilities[i, own["piece"].to_numpy()] += own["uses"].to_numpy() / 1e6
    return langs, probabilities / probabilities.sum(axis=1, keepdims=True)


class Scorer:
    """Log probabilities of words in every language, kept for the words seen last."""

    def __init__(self, langs: list[str], probabilities: np.ndarray, model: str):
        self.langs, self.p, self.model = langs, probabilities, model
        self.by_piece = np.ascontiguousarray(probabilities.T)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.langs)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        docs = [words_of(t) for t in texts]
        if len(self.index) > CACHE_WORDS:
            self.clear()
        every = set().union(*docs) if docs else set()
        long = {w for w in every if len(w) > WORD}
        new = list(every - self.index.keys() - long)
        for i in range(0, len(new), LATTICE):
            part = new[i : i + LATTICE]
            lattice = Lattice(part, self.model)
            self.index.update(zip(part, range(len(self.rows), len(self.rows) + len(part)), strict=True))
            self.rows = np.vstack([self.rows, np.column_stack([lattice.scores(p) for p in self.p])]) if self.langs else self.rows
        out = []
        scored: dict[str, np.ndarray] = {}
        for words in docs:
            if not words or not self.langs:
                out.append(("und", 0.0))
                continue
            own = [w for w in words if w not in long] if long else words
            sums = self.rows[np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))].sum(axis=0)
            for w, n in Counter(w for w in words if w in long).items() if len(own) < len(words) else ():
                if w not in scored:
                    scored[w] = long_score(w, self.by_piece, self.model)
                sums = sums + n * scored[w]
            odds = np.exp(sums - sums.max())
            best = int(sums.argmax())
            out.append((self.langs[best], float(odds[best] / odds.sum())))
        return out


def identify(df: DataFrame, langs: list[str], probabilities: np.ndarray, model: str, text: str = "text") -> DataFrame:
    """df with lang_pred and score (posterior under equal priors); clashing columns are replaced."""

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(langs, probabilities, model)
        for texts in batches:
            found: list[tuple[str, float]] = []
            for i in range(0, len(texts), 500):
                found += scorer.predict(texts.iloc[i : i + 500].tolist())
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(predicted, "language")(batches)

    return in_small_batches(df.drop("lang_pred", "score")).withColumn("_id", run(F.col(text))).select("*", "_id.*").drop("_id")


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_rows(df: DataFrame) -> DataFrame:
    """The rows that a model may learn from: not held out, with id and label."""
    return df.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
