"""Removal of long repeated strings by two-stage suffix sorting.

A byte goes if it is covered by a string of a given number of bytes that also starts anywhere else, in the same text or
another. Strings of two lengths are found in one pass: what `removal` takes out (LENGTH bytes), and shorter
passages (PASSAGE bytes), which it counts. Suffixes that can matter are brought together without a global sort of all of them:

1. Every start of a string of the shorter length is owned by the string's anchor, its GRAM-byte substring of least hash. Equal
   strings have equal anchors, and consecutive starts with one anchor form a run, so a text is about a dozen runs a
   kilobyte. Only runs whose anchor occurs elsewhere go on.
2. The bytes that the runs of one anchor span, up to the longer length after the last start, are one small text collection.
   Equal spans collapse, with their number. Where distinct spans remain their suffixes are sorted in two
   stages: those smaller than their successor are sorted directly, all others are induced
   from them by a scan over the first-byte buckets, vectorised bucket by bucket.
3. Neighbours in that order with a common prefix of either length are repeats; their starts become
   intervals, which are merged per text.

Exact copies count as one text with several owners: a copied text that is long enough is repeated entirely and
is still a source of repeats for others. Anchors whose distinct spans exceed CHUNK are dealt as pairs of chunks, so
no task holds an unbounded group, and no span is left out. Overlaps count, and all repeats are judged on the input.

Texts are known by their SHA-256, never by an id: rows with a null id, rows that repeat an id and different texts of one id are
texts like all others. Null texts count as empty; shorter texts stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, dropped, in_small_batches, tidy, written
from .shingles import _BASE, mix

#: Bytes of a repeated string; bytes and words of a repeated passage; bytes of an anchor.
LENGTH, PASSAGE, WORDS, GRAM = 400, 240, 50, 48
#: Bytes hashed at once (what a processor's cache holds) and sorted at once; spans of a unit; rows of a batch.
BUFFER, SORT, CHUNK, ROWS = 32_000, 100_000, 512, 4000
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


@lru_cache(4)
def _table(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; those of a buffer are kept."""
    return _table(int(base), BUFFER)[:n] if n <= BUFFER else _table.__wrapped__(int(base), n)


def anchor_runs(texts: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the runs of starts with one anchor: (anchor hashes, first start of each run)."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BUFFER):
            size += len(texts[j])
            j += 1
        out += _runs(texts[i:j], length, gram)
        i = j
    return out


def _runs(texts: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray]]:
    none = (np.zeros(0, np.int64), np.zeros(0, np.int32))
    sizes = [len(t) for t in texts]
    if max(sizes) < length:
        return [none] * len(texts)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n, wide = len(raw), length - gram + 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=prefix[1:])
    hashes = mix((prefix[gram:] - prefix[:-gram]) * _powers(_INVERSE, n - gram + 1))
    # the upper half decides, then the place: the leftmost of equals, whatever else is in the buffer
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    blocks = -(-len(packed) // wide)
    padded = np.full(blocks * wide, np.uint64(2**64 - 1))
    padded[: len(packed)] = packed
    padded = padded.reshape(blocks, wide)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = max(0, n - length + 1)
    anchor = (np.minimum(after[:starts], before[wide - 1 : wide - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    out, at = [], 0
    for size in sizes:
        if size < length:
            out.append(none)
        else:
            own = anchor[at : at + size - length + 1]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            out.append((hashes[own[first]].view(np.int64), first.astype(np.int32)))
        at += size
    return out


def smaller_than_next(a: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(a)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(a[1:].astype(np.int16) - a[:-1])
    upcoming = np.minimum.accumulate(np.where(step != 0, np.arange(n), n - 1)[::-1])[::-1]
    return step[upcoming] > 0


def suffix_order(text: bytes, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of text in order up to depth bytes, by two-stage sorting: all, or the wanted ones. Where a wanted suffix is not
    smaller than its successor, the successor must be wanted too, since it brings the suffix in."""
    a = np.frombuffer(text, np.uint8)
    n = len(a)
    if not n:
        return np.zeros(0, np.int64)
    smaller = smaller_than_next(a)
    wanted = np.ones(n, bool) if wanted is None else wanted
    direct = np.flatnonzero(smaller & wanted)
    direct = np.array(sorted(direct.tolist(), key=lambda i: text[i : i + depth]), np.int64)
    cuts = np.searchsorted(a[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if wanted[-1]:
        waiting[a[-1]].append(np.array([n - 1]))
    order = []
    for c in np.unique(a[wanted]).tolist():
        bucket = []
        turn = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(turn):  # a larger suffix stands before the smaller ones of its byte and may bring in the one before it
            bucket.append(turn)
            turn = turn[turn > 0] - 1
            turn = turn[(a[turn] == c) & wanted[turn]]
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        whole = np.concatenate(bucket) if len(bucket) > 1 else bucket[0]
        order.append(whole)
        before = whole[whole > 0] - 1
        before = before[(a[before] > c) & wanted[before]]
        if len(before):
            byte = a[before]
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            ends = np.flatnonzero(np.concatenate([byte[1:] != byte[:-1], [True]])) + 1
            for s, e in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
                waiting[byte[s]].append(before[s:e])
    return np.concatenate(order)


def common_prefixes(text: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix in order shares depth bytes with the one before it (the first: not)."""
    n = len(text)
    words = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text + b"\0" * 8, np.uint8), 8)
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    out = np.zeros(len(order), bool)
    pairs = np.arange(1, len(order))
    pairs = pairs[(order[pairs] + depth <= n) & (order[pairs - 1] + depth <= n)]
    for at in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 and depth >= 8 else [])]:
        pairs = pairs[words[order[pairs] + at] == words[order[pairs - 1] + at]]
        if not len(pairs):
            break
    out[pairs] = True
    return out


def _needed(text: bytes, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Which suffixes bring in those from each of firsts to lasts: these, and on to the next one that is sorted directly."""
    n = len(text)
    direct = np.flatnonzero(smaller_than_next(np.frombuffer(text, np.uint8)))
    ends = np.append(direct, n - 1)[np.searchsorted(direct, lasts)]
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, firsts, 1)
    np.add.at(change, ends + 1, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_starts(spans: list[bytes], starts: np.ndarray, lengths: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the intervals (span, first, last) of starts whose string of that length starts anywhere else in the
    spans. The starts of a span are its first bytes, as many as starts says, that have the length after them."""
    text = b"".join(spans)
    sizes = np.fromiter(map(len, spans), np.int64, len(spans))
    firsts = np.cumsum(sizes) - sizes
    span = np.repeat(np.arange(len(spans)), sizes)
    place = np.arange(len(text)) - firsts[span]
    order = suffix_order(text, max(lengths), _needed(text, firsts, firsts + starts - 1))
    order = order[place[order] < starts[span[order]]]
    out = []
    for length in lengths:
        own = order[place[order] + length <= sizes[span[order]]]
        same = common_prefixes(text, own, length)
        hit = np.zeros(len(text) + 1, bool)
        hit[own[same | np.concatenate([same[1:], [False]])]] = True
        at = np.flatnonzero(hit)
        new = np.flatnonzero((at == firsts[span[at]]) | ~hit[at - 1])
        end = np.append(new[1:], len(at)) - 1 if len(at) else new
        out.append((span[at[new]], place[at[new]], place[at[end]]))
    return out


def merged(starts, ends, length: int) -> list[tuple[int, int]]:
    """Covered byte intervals [from, to) of intervals of starts [first, last]."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends, strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + length)
        else:
            out.append([s, e + length])
    return [(a, b) for a, b in out]


def wordy(raw: bytes, words: int) -> bool:
    """Whether there are so many words, those cut at either end included."""
    return len(raw.split(None, words)) >= words if words else True


def digest(text: str = "text"):
    """SHA-256 of a text's bytes; a null text is empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def repeated(docs: DataFrame, lengths: tuple[int, ...], gram: int = GRAM, words: int = 0) -> tuple[DataFrame, DataFrame]:
    """(texts, cuts): texts has (digest, rep, own, copies, n_bytes, wordy) of every distinct text, own the least id with
    it and wordy whether it has so many words; cuts has (digest, text, length, first, last), the intervals of repeated starts as three arrays,
    of every text of one row that has any. docs: (id, text); lengths ascending. The texts of several rows are repeated as a whole."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    length, most = lengths[0], lengths[-1]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in pdf["text"]]
            found = anchor_runs(texts, length, gram)
            yield pd.DataFrame(
                {
                    "id": pdf["id"],
                    "digest": [hashlib.sha256(t).hexdigest() for t in texts],
                    "n_bytes": [len(t) for t in texts],
                    "wordy": [wordy(t, words) for t in texts],
                    "anchors": [r[0] for r in found],
                    "firsts": [r[1] for r in found],
                }
            )

    table = in_small_batches(docs).mapInPandas(tidy(scan), "id long, digest string, n_bytes long, wordy boolean, anchors array<long>, firsts array<int>")
    once = [F.first(c).alias(c) for c in ("n_bytes", "wordy", "anchors", "firsts")]
    known = written(table.groupBy("digest").agg(F.min("id").alias("own"), F.count("*").alias("copies"), *once).withColumn("rep", F.monotonically_increasing_id()))
    texts = written(known.drop("anchors", "firsts"))
    ends = F.concat(F.slice("firsts", 2, F.size("firsts")), F.array((F.col("n_bytes") - (length - 1)).cast("int")))
    runs = known.where(F.col("n_bytes") >= length).select("rep", F.explode(F.arrays_zip("anchors", "firsts", ends.alias("ends"))).alias("r"))
    runs = runs.select("rep", F.col("r.anchors").alias("anchor"), F.col("r.firsts").alias("lo"), (F.col("r.ends") - 1).alias("hi"))
    # written, so that the joins below have a plain shuffle on either side and a hot anchor's partition can be split
    again = written(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    wanted = runs.join(again, "anchor", "left_semi").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "anchor"))).alias("r"))
    wanted = written(wanted.join(texts.select("rep", "digest", "own"), "rep").select("rep", "digest", "own", *[F.col(f"r.{c}").alias(f"{c}s") for c in ("lo", "hi", "anchor")]))
    dropped(known, again)
    # one document of each text is read, that of its least id; ids spread the copies of a text
    own = docs.withColumn("_digest", digest())
    held = written(wanted.join(own, (own._digest == wanted.digest) & own.id.eqNullSafe(wanted.own)).drop("_digest", "id", "own"))
    dropped(wanted)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row for each text, anchor and span: runs with equal spans, as a repeated line makes them, stay together."""
        names = ["anchor", "rep", "size", "times", "firsts", "lasts", "starts", "span", "key"]
        rows: list[tuple] = []
        for pdf in batches:
            for rep, t, los, his, anchors in zip(pdf["rep"], pdf["text"], pdf["los"], pdf["his"], pdf["anchors"], strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                same: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
                for lo, hi, anchor in zip(los.tolist(), his.tolist(), anchors.tolist(), strict=True):
                    same.setdefault((anchor, hi - lo + 1, raw[lo : hi + most]), []).append((lo, hi))
                for (anchor, starts, span), places in same.items():
                    first, last = [], []
                    for lo, hi in places:  # ascending
                        if last and lo <= last[-1] + 1:
                            last[-1] = hi
                        else:
                            first.append(lo)
                            last.append(hi)
                    key = int.from_bytes(hashlib.blake2b(span, digest_size=8, salt=starts.to_bytes(8, "little")).digest(), "little", signed=True)
                    rows.append((anchor, rep, len(raw), len(places), first, last, starts, span, key))
                if len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    spans = written(
        held.select("rep", "text", "los", "his", "anchors").mapInPandas(tidy(cut), "anchor long, rep long, size int, times int, firsts array<int>, lasts array<int>, starts int, span binary, key long")
    )
    places = spans.select("anchor", "key", "rep", "size", "times", "firsts", "lasts").distinct()
    kinds = written(places.groupBy("anchor", "key").agg(F.sum("times").alias("n")))
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    mixed = written(mixed.select("anchor", F.when(F.col("kinds") > CHUNK, F.ceil(F.col("kinds") * 1.25 / CHUNK)).otherwise(1).cast("int").alias("chunks")))
    # spans are first brought to one for each kind, by (anchor, key), so that those of a hot anchor lie in many tasks
    once = spans.groupBy("anchor", "key").agg(F.first("span").alias("span"), F.first("starts").alias("starts"))
    unique = once.join(written(kinds.join(mixed, "anchor").select("anchor", "key", "chunks")), ["anchor", "key"])
    unique = unique.withColumn("own", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    unique = unique.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    unique = unique.select("anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "key", "span", "starts")

    def sort(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        anchor, key = pdf["anchor"].to_numpy(), pdf["key"].to_numpy()
        found = repeated_starts(pdf["span"].tolist(), pdf["starts"].to_numpy(), lengths)
        for size, (at, a, b) in zip(lengths, found, strict=True):
            yield pd.DataFrame({"anchor": anchor[at], "key": key[at], "length": np.int32(size), "a": a, "b": b})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorts whole units, several at once; units of one anchor hold the same spans and are never sorted together."""
        rest: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            cut = _units(pdf)
            rest = pdf.iloc[cut[-2] :]
            for a, b in _together(pdf, cut[:-1]):
                yield from sort(pdf.iloc[a:b])
        if rest is not None and len(rest) > 1:
            yield from sort(rest)

    unit = ["anchor", "i", "j"]
    partial = unique.repartition(parts, *unit).sortWithinPartitions(*unit).mapInPandas(tidy(stream), "anchor long, key long, length int, a int, b int")
    whole = kinds.where("n > 1").join(places, ["anchor", "key"]).select("rep", "size", F.explode(F.arrays_zip("firsts", "lasts")).alias("p"))
    whole = whole.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
    whole = whole.select("rep", "length", F.col("p.firsts").alias("first"), F.least(F.col("p.lasts"), F.col("size") - F.col("length")).alias("last")).where("first <= last")
    some = partial.join(kinds.where("n = 1").select("anchor", "key"), ["anchor", "key"], "left_semi").join(places, ["anchor", "key"])
    place = F.element_at("firsts", 1)  # a span that occurs once has one place
    some = some.select("rep", "length", (place + F.col("a")).alias("first"), (place + F.col("b")).alias("last"))
    single = texts.where("copies = 1").select("rep")
    per = whole.unionByName(some).join(single, "rep", "left_semi").groupBy("rep").agg(F.collect_set(F.struct("length", "first", "last")).alias("r"))
    per = written(per.select("rep", *[F.col(f"r.{c}").alias(c) for c in ("length", "first", "last")]))
    dropped(spans)
    return texts, per.join(held.select("rep", "digest", "text").dropDuplicates(["rep"]), "rep").drop("rep")


def _units(pdf: pd.DataFrame) -> list[int]:
    """Where each unit of sorted rows begins, and the end."""
    change = np.zeros(len(pdf), bool)
    for c in ("anchor", "i", "j"):
        v = pdf[c].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return [0, *np.flatnonzero(change).tolist(), len(pdf)]


def _together(pdf: pd.DataFrame, cut: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows to sort at once: whole units of different anchors, of SORT bytes or one unit."""
    upto = np.concatenate([[0], np.cumsum(pdf["span"].map(len).to_numpy())])
    anchor = pdf["anchor"].to_numpy()
    begin = 0
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if a > begin and (upto[b] - upto[begin] > SORT or anchor[a] == anchor[a - 1]):
            yield begin, a
            begin = a
    if cut[-1] > begin:
        yield begin, cut[-1]


def _apply(docs: DataFrame, function, schema: str, lengths: tuple[int, ...], gram: int, words: int) -> tuple[DataFrame, DataFrame]:
    """(texts, (digest, *schema) of every text of one row with a repeat). function: (text, a list of covered intervals for each length)."""
    texts, cuts = repeated(docs, lengths, gram, words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, t, size, first, last in zip(pdf["digest"], pdf["text"], pdf["length"], pdf["first"], pdf["last"], strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                gone = [merged(first[size == n].tolist(), last[size == n].tolist(), n) for n in lengths]
                rows.append((name, *function(raw, gone)))
            yield pd.DataFrame(rows, columns=["digest", *[c.split()[0] for c in schema.split(", ")]])

    return texts, cuts.select("digest", "text", "length", "first", "last").mapInPandas(tidy(run), f"digest string, {schema}")


def removal(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, passage: int = PASSAGE, words: int = WORDS) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, n_passages) of every row. n_passages: maximal runs of bytes covered by
    strings of passage bytes (length at most) that start anywhere else too, those that hold so many words; they are counted, not removed."""
    lengths = (min(passage, length), length) if passage < length else (length,)

    def about(raw: bytes, gone: list[list[tuple[int, int]]]) -> tuple:
        kept, at = hashlib.sha256(), 0
        for a, b in gone[-1]:
            kept.update(raw[at:a])
            at = b
        kept.update(raw[at:])
        return sum(b - a for a, b in gone[-1]), len(gone[-1]), kept.hexdigest(), sum(wordy(raw[a:b], words) for a, b in gone[0])

    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts, got = _apply(docs, about, "n_removed long, n_spans long, kept_sha256 string, n_passages long", lengths, gram, words)
    copied = F.col("n_bytes") >= length
    copies = texts.where((F.col("copies") > 1) & (F.col("n_bytes") >= lengths[0])).select(
        "digest",
        F.when(copied, F.col("n_bytes")).otherwise(0).alias("n_removed"),
        copied.cast("long").alias("n_spans"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("digest")).alias("kept_sha256"),
        F.col("wordy").cast("long").alias("n_passages"),
    )
    found = written(got.unionByName(copies)).withColumnRenamed("digest", "_digest")
    rows = docs.select("id", digest().alias("digest"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    none = F.lit(0).cast("long")
    return rows.join(found, rows.digest == found._digest, "left").select(
        F.col("id").alias(key),
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
        F.coalesce("n_passages", none).alias("n_passages"),
    )


def cleaned(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = PASSAGE, gram: int = GRAM, words: int = WORDS) -> DataFrame:
    """df with the repeated strings cut out of its texts, whole characters only; texts of which no word is left go.

    Runs of repeated strings that hold fewer words stay. A character that a cut would split stays. n_chars, if there, is counted again.
    """

    def keep(raw: bytes, gone: list[list[tuple[int, int]]]) -> tuple[str]:
        parts, at = [], 0
        for a, b in gone[0]:
            if not wordy(raw[a:b], words):
                continue
            while a < b and raw[a] & 0xC0 == 0x80:  # a cut begins and ends with a character
                a += 1
            while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            parts.append(raw[at:a])
            at = b
        parts.append(raw[at:])
        return (b"".join(parts).decode("utf-8", "surrogatepass"),)

    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts, got = _apply(docs, keep, "_kept string", (length,), gram, words)
    copies = texts.where((F.col("copies") > 1) & (F.col("n_bytes") >= length) & F.col("wordy")).select("digest", F.lit("").alias("_kept"))
    changed = written(got.unionByName(copies)).withColumnRenamed("digest", "_digest")
    out = df.join(changed, digest(text) == changed._digest, "left")
    out = out.where(F.col("_kept").isNull() | F.col("_kept").rlike(f"[^{SPACE}]")).withColumn(text, F.coalesce("_kept", text))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.coalesce(F.when(F.col("_kept").isNotNull(), F.length(text).cast(df.schema["n_chars"].dataType)), "n_chars"))
    return out.select(*df.columns)
