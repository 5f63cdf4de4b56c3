"""N-gram Jaccard join by parity sketches.

A text's set is its distinct word shingles, as 64-bit hashes. A parity sketch of n segments lets every
token flip bits of one segment only (the segment is an interval of the hash, its value the XOR of the hashes in
it), so the number of differing segments lower-bounds the symmetric difference of two sets. Sets with a Jaccard of NUM / DEN or more differ in
at most d = (DEN - NUM) * (|A| + |B|) / (DEN + NUM) tokens; with more than d segments one of them is equal
(pigeonhole), so equal segments at the same place of the same size band find every pair. A band
fixes n; it follows from |A| + |B|, and a set sends its segments for every band that a partner may fall in (two at most).
Segments empty on both sides tell nothing: n leaves room for them, and the few sets with more empty segments than
that room send those too, which makes the join exact for every input.

A second parity sketch, one bit a token and a power of two of bits above the set's size (folded to the
smaller of the two by XOR), bounds the symmetric difference of a candidate pair before the texts are fetched and the
sets themselves compared.

Skew. Equal sets collapse to one class first. Segments travel packed, one row per task and bucket,
16 bytes an entry at most; a bucket is matched in parts of HELD entries, between which one class of each segment is kept, so a segment
of any number of classes takes bounded memory. A segment shared by g classes yields g - 1 pairs with its least class,
not g * g / 2. Where the classes so connected still differ inside a segment's group, the sketches of its members are
compared inside a task, which sends on a spanning set of the pairs that pass, two a part at most. These pairs are
verified on the sets; a component of the sketches' graph that is then still in several parts is compared set by
set across its parts, again inside tasks. Groups over CHUNK (UNIT) rows are cut into pairs of chunks. Nothing is
capped or dropped, and no step sends on more rows than members and chunks.

Null, empty and wordless texts have an empty set and stand alone; fewer words than k are one shingle. Rows that repeat an id are one
document. A null id gets a null component. The columns of the input other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, in_small_batches, tidy, written
from .shingles import mix, shingle_sets

NUM, DEN = 3, 4
BATCH, ENTRIES, HELD, CHUNK, MEMBERS, UNIT = 500, 4_000_000, 8_000_000, 1024, 64, 128
#: Segments per band: at least ROOM * d + 2, each band 16/9 of the one before.
ROOM = 1.15
BANDS = [4]
while BANDS[-1] < 2**31:
    BANDS.append(math.ceil(BANDS[-1] * 16 / 9))
_BANDS = np.array(BANDS)


def difference(total: int) -> int:
    """Most tokens in which two sets of so many tokens together may differ."""
    return (DEN - NUM) * total // (DEN + NUM)


def band(total: int) -> int:
    return int(np.searchsorted(_BANDS, ROOM * difference(total) + 2))


def segments(tokens: np.ndarray) -> np.ndarray:
    """Signatures of a sorted set in all of its bands: one for each segment that holds a token."""
    size = len(tokens)
    low, high = size + -(-NUM * size // DEN), size + DEN * size // NUM
    if not difference(high):
        return np.zeros(0, np.uint64)  # only equal sets are near, and those are one class
    out = []
    for j in range(band(low), band(high) + 1):
        n = int(_BANDS[j])
        place = ((tokens >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        at = place[first]
        salt = mix(at + np.uint64(n << 32))
        out.append(mix(np.bitwise_xor.reduceat(tokens, first) ^ salt))
        most = min(difference(high), int((n - 2) / ROOM))
        if n - most - (n - len(at)) < 1:
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), at)
            out.append(mix(~mix(empty + np.uint64(n << 32))))
    return np.concatenate(out)


def sketch(tokens: np.ndarray) -> bytes:
    """One parity bit a token, a power of two of bits, 256 at least."""
    bits = 256
    while bits < len(tokens):
        bits *= 2
    odd = np.bincount((mix(tokens) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    width = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), width), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width), axis=0)
    return out


def alike(held: list[bytes], n: np.ndarray, rows: slice) -> np.ndarray:
    """Whether the sketches of rows leave the threshold possible with each other sketch, [row, other]."""
    length = np.fromiter(map(len, held), np.int64, len(held))
    ok = np.zeros((len(held[rows]), len(held)), bool)
    for width in np.unique(length[rows]):
        left = np.flatnonzero(length[rows] == width)
        for other in np.unique(length):
            right = np.flatnonzero(length == other)
            words = folded([held[rows][i] for i in left] + [held[j] for j in right])
            own, words = words[: len(left)], words[len(left) :]
            apart = np.zeros((len(left), len(right)), np.int32)
            for w in range(words.shape[1]):
                apart += np.bitwise_count(own[:, w, None] ^ words[None, :, w])
            total = n[rows][left][:, None] + n[right][None]
            ok[np.ix_(left, right)] = apart <= (DEN - NUM) * total // (DEN + NUM)
    return ok & (np.minimum(n[rows][:, None], n[None]) * DEN >= np.maximum(n[rows][:, None], n[None]) * NUM)


def in_common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of blocks of the incidence matrix of shared tokens."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens, at, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(many > 1)
    place = np.full(len(tokens), -1)
    place[shared] = np.arange(len(shared))
    row, at = row[many[at] > 1], place[at[many[at] > 1]]
    by = np.argsort(at, kind="stable")
    row, at = row[by], at[by]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for s in range(0, len(shared), 8192):
        a, b = np.searchsorted(at, [s, s + 8192])
        block = np.zeros((len(sets), 8192), np.float32)
        block[row[a:b], at[a:b] - s] = 1
        both += block @ block.T
    return both.astype(np.int64)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard of two sorted sets reaches the threshold; sets without tokens are near nothing."""
    if not len(a) or not len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return DEN * both >= NUM * (len(a) + len(b) - both)


def _digests(tokens: np.ndarray) -> tuple[int, int]:
    sums = np.array([mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)])
    one, two = mix(sums + np.uint64(len(tokens))).view(np.int64)
    return int(one), int(two)


def _sets(pdf: pd.DataFrame, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for i in range(0, len(pdf), BATCH):
        yield i, shingle_sets(pdf["text"].iloc[i : i + BATCH].tolist(), k)


def even_keys(spark, n: int) -> list[int]:
    """One integer for each of n shuffle partitions that hash partitioning puts there."""
    found = spark.range(0, 24 * n + 64).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).collect()
    keys = {r.p: r.k for r in found}
    return [keys.get(p, p) for p in range(n)]


def describe(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, one, two, sketch) of every row: the set's size, two digests and its bit sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, sets in _sets(pdf, k):
                digests = [_digests(s) for s in sets]
                yield pd.DataFrame(
                    {
                        "id": pdf["id"].iloc[i : i + len(sets)].to_numpy(),
                        "n": [len(s) for s in sets],
                        "one": [d[0] for d in digests],
                        "two": [d[1] for d in digests],
                        "sketch": [sketch(s) if len(s) else None for s in sets],
                    }
                )

    return docs.mapInPandas(tidy(run), "id long, n long, one long, two long, sketch binary")


def _sorted_entries(sig: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (signature, class), in order."""
    order = np.lexsort((own, sig))
    sig, own = sig[order], own[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
    return sig[fresh], own[fresh]


def _rows(least: np.ndarray, own: np.ndarray, group: np.ndarray, member: np.ndarray) -> list[pd.DataFrame]:
    edge = np.unique(np.stack([least, own], axis=1)[least != own], axis=0)
    return [pd.DataFrame({"kind": np.int8(0), "x": edge[:, 0], "y": edge[:, 1]}), pd.DataFrame({"kind": np.int8(1), "x": group, "y": member})]


def _met(sigs: list[np.ndarray], ids: list[np.ndarray]) -> list[pd.DataFrame]:
    """Rows of groups() for a whole bucket. Groups with the same members are one."""
    sig, own = np.concatenate(sigs), np.concatenate(ids)
    order = np.argsort(sig)
    sig, own = sig[order], own[order]
    again = np.zeros(len(sig) + 1, bool)
    again[1:-1] = sig[1:] == sig[:-1]
    shared = again[1:] | again[:-1]
    sig, own = _sorted_entries(sig[shared], own[shared])
    if not len(sig):
        return []
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.append(first, len(sig)))
    group = mix(np.add.reduceat(mix(own.view(np.uint64)), first) + size.astype(np.uint64))
    _, one = np.unique(group, return_index=True)  # groups with the same members tell the same
    take = np.zeros(len(first), bool)
    take[one] = size[one] > 1
    rows = np.repeat(take, size)
    return _rows(np.repeat(own[first], size)[rows], own[rows], np.repeat(group, size)[rows].view(np.int64), own[rows])


def _met_again(sig: np.ndarray, own: np.ndarray, before: tuple | None) -> tuple[tuple, list[pd.DataFrame]]:
    """The next part of a bucket: what is kept of it and of before (sorted signatures, least classes, whether alone so far), and rows of
    groups(), where a group is named after its signature."""
    sig, own = _sorted_entries(sig, own)
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.append(first, len(sig)))
    names, least = sig[first], own[first].copy()
    old, old_least, old_alone = before if before is not None else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))
    at = np.minimum(np.searchsorted(old, names), max(0, len(old) - 1))
    known = old[at] == names if len(old) else np.zeros(len(names), bool)
    least[known] = old_least[at[known]]
    late = np.flatnonzero(known)
    late = late[old_alone[at[late]]]  # their first member has not been told yet
    take = known | (size > 1)
    rows = np.repeat(take, size)
    members = np.concatenate([own[rows], least[late]])
    group = np.concatenate([np.repeat(names, size)[rows], names[late]]).view(np.int64)
    out = _rows(np.repeat(least, size)[rows], own[rows], group, members)
    old_alone = old_alone.copy()
    old_alone[at[known]] = False
    every = np.concatenate([old, names[~known]])
    order = np.argsort(every)
    kept = (every[order], np.concatenate([old_least, least[~known]])[order], np.concatenate([old_alone, (size == 1)[~known]])[order])
    return kept, out


def groups(docs: DataFrame, k: int, buckets: int) -> DataFrame:
    """Classes (by digest one) that share a segment: kind 0 rows (least class, class), kind 1 rows (group, class)."""
    keys = np.array(even_keys(docs.sparkSession, buckets), np.int64)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        ids: list[int] = []
        total, done = 0, set()

        def flush() -> pd.DataFrame:
            sig = np.concatenate(held)
            own = np.repeat(np.array(ids, np.int64), [len(h) for h in held])
            bucket = ((sig >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sig, own, bucket = sig[order], own[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                s = slice(cuts[b], cuts[b + 1])
                if cuts[b] == cuts[b + 1]:
                    continue
                first = np.flatnonzero(np.concatenate([[True], own[s][1:] != own[s][:-1]]))
                runs = np.diff(np.append(first, cuts[b + 1] - cuts[b])).astype(np.int32)
                rows.append((int(keys[b]), sig[s].tobytes(), own[s][first].tobytes(), runs.tobytes()))
            return pd.DataFrame(rows, columns=["slot", "sigs", "ids", "runs"])

        for pdf in batches:
            for _, sets in _sets(pdf, k):
                for tokens in sets:
                    if not len(tokens):
                        continue
                    one, _ = _digests(tokens)
                    if one in done:
                        continue
                    if len(done) < 200_000:  # only spares work: a copy sent twice is merged on arrival
                        done.add(one)
                    sig = segments(tokens)
                    if len(sig):
                        held.append(sig)
                        ids.append(one)
                        total += len(sig)
                if total >= ENTRIES // 2:
                    yield flush()
                    held, ids, total = [], [], 0
        if held:
            yield flush()

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A bucket that is held at once, or part by part: then only (signature, least class, alone) of what came before is kept."""
        sigs, ids, total = [], [], 0
        before = None
        for pdf in batches:
            for s, i, r in zip(pdf["sigs"], pdf["ids"], pdf["runs"], strict=True):
                sigs.append(np.frombuffer(s, np.uint64))
                ids.append(np.repeat(np.frombuffer(i, np.int64), np.frombuffer(r, np.int32)))
                total += len(sigs[-1])
                if total >= HELD:
                    before, rows = _met_again(np.concatenate(sigs), np.concatenate(ids), before)
                    yield from rows
                    sigs, ids, total = [], [], 0
        if before is not None and sigs:
            yield from _met_again(np.concatenate(sigs), np.concatenate(ids), before)[1]
        elif sigs:
            yield from _met(sigs, ids)

    packed = docs.mapInPandas(tidy(pack), "slot int, sigs binary, ids binary, runs binary")
    return packed.repartition(buckets, "slot").mapInPandas(tidy(match), "kind tinyint, x long, y long")


def _passing(pairs: DataFrame) -> DataFrame:
    """Pairs (a, na, sa, b, nb, sb) whose sizes and bit sketches leave the threshold possible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [
                int(np.bitwise_count(np.bitwise_xor(*folded([x, y]))).sum()) <= difference(int(m + n))
                for x, y, m, n in zip(pdf["sa"], pdf["sb"], pdf["na"], pdf["nb"], strict=True)
            ]
            yield pdf[["a", "b"]][np.array(keep, bool)]

    return pairs.where((F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM) & (F.col("a") != F.col("b"))).mapInPandas(tidy(run), "a long, b long")


def chunked(members: DataFrame, size: int, more: DataFrame) -> DataFrame:
    """members (g, id, comp) of the groups of several comps, with the columns of more (id, ...), own, i and j: groups over size
    rows are cut into chunks, and each pair of chunks (i, j) is a unit."""
    large = members.groupBy("g").agg(F.count("*").alias("many"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    # written, so that rows of a hot group are not brought together before they are dealt by chunks
    large = written(large.select("g", F.when(F.col("many") > size, F.ceil(F.col("many") * 1.25 / size)).otherwise(1).cast("int").alias("chunks")))
    cut = members.join(large, "g").join(more, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return cut.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("chunks", "other")


def spanning(ids: np.ndarray, comp: np.ndarray, linked: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Pairs of ids that join the parts (comp) like all links do, two a part at most: a link of its own, and one member
    of it with one of the least part it hangs together with."""
    _, first, part = np.unique(comp, return_index=True, return_inverse=True)
    a = np.concatenate([x for x, _ in linked]) if linked else np.zeros(0, np.int64)
    b = np.concatenate([y for _, y in linked]) if linked else np.zeros(0, np.int64)
    root = forest(len(first), part[a], part[b])
    _, one = np.unique(part[a], return_index=True)
    far = np.flatnonzero(root != np.arange(len(first)))
    pairs = np.concatenate([np.stack([ids[a[one]], ids[b[one]]], axis=1), np.stack([ids[first[far]], ids[first[root[far]]]], axis=1)])
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def across(members: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect the members (g, id, comp) of a group like all its pairs of different comp
    that pass sizes and sketches. known: (id, n, sketch)."""
    cut = chunked(members, CHUNK, known).select("g", "i", "j", "own", "id", "n", "sketch", "comp")

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, n, comp, held = pdf["id"].to_numpy(), pdf["n"].to_numpy(), pdf["comp"].to_numpy(), pdf["sketch"].tolist()
        own, crossing = pdf["own"].to_numpy(), pdf["i"].iloc[0] != pdf["j"].iloc[0]
        found = []
        for s in range(0, len(pdf), 128):
            e = slice(s, s + 128)
            apart = comp[e, None] != comp[None]
            if crossing:
                apart &= own[e, None] != own[None]
            if apart.any():
                a, b = np.nonzero(apart & alike(held, n, e))
                found.append((a + s, b))
        return spanning(ids, comp, found)

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_unit(batches, ["g", "i", "j"]):
            yield pairs(pdf)

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(parts, "g", "i", "j").sortWithinPartitions("g", "i", "j").mapInPandas(tidy(stream), "a long, b long").distinct()


def linked_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the components of all links between members (g, id, comp) of a group with different comp.
    The sets themselves are compared, by blocks of UNIT members."""
    cut = chunked(members, UNIT, sets).select("g", "i", "j", "own", "id", "comp", "tokens")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_unit(batches, ["g", "i", "j"]):
            found = [np.frombuffer(t, np.uint64) for t in pdf["tokens"]]
            n, comp, own = np.fromiter(map(len, found), np.int64, len(found)), pdf["comp"].to_numpy(), pdf["own"].to_numpy()
            both = in_common(found)
            ok = (DEN * both >= NUM * (n[:, None] + n[None] - both)) & (comp[:, None] != comp[None])
            if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
                ok &= own[:, None] != own[None]
            yield spanning(pdf["id"].to_numpy(), comp, [np.nonzero(ok)])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(parts, "g", "i", "j").sortWithinPartitions("g", "i", "j").mapInPandas(tidy(stream), "a long, b long")


def by_unit(batches: Iterator[pd.DataFrame], unit: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal unit columns from sorted batches, whole even where they span batches."""
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        change = np.zeros(len(pdf), bool)
        for c in unit:
            v = pdf[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(change), len(pdf)]
        if rest and any(rest[-1][c].iloc[-1] != pdf[c].iloc[0] for c in unit):
            yield pd.concat(rest, ignore_index=True)
            rest = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            rest.append(pdf.iloc[a:b])
            if b < len(pdf):
                yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0].reset_index(drop=True)
                rest = []
    if rest:
        yield pd.concat(rest, ignore_index=True)


def token_sets(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(id, tokens) of every document in a pair."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, found in _sets(pdf, k):
                yield pd.DataFrame({"id": pdf["id"].iloc[i : i + len(found)].to_numpy(), "tokens": [s.tobytes() for s in found]})

    return docs.join(wanted, "id", "left_semi").mapInPandas(tidy(run), "id long, tokens binary").dropDuplicates(["id"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose sets reach the threshold; pairs of one a are dealt MEMBERS at a time."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts"))
    dealt = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("id"))
    own = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("id"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for pdf in by_unit(batches, ["a", "salt"]):
            center = pdf["a"].iloc[0]
            held = dict(zip(pdf["id"], pdf["tokens"], strict=True))
            mid = np.frombuffer(held[center], np.uint64)
            got = [m for m, t in held.items() if m != center and near(mid, np.frombuffer(t, np.uint64))]
            a += [center] * len(got)
            b += got
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fetched = dealt.unionByName(own).join(sets, "id").select("a", "salt", "id", "tokens")
    return fetched.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt").mapInPandas(tidy(check), "a long, b long")


def jaccard_classes(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    docs = in_small_batches(docs)
    about = written(describe(docs, k))
    classes = about.where("n > 0 and id is not null").groupBy("one", "two", "n").agg(F.min(F.struct("id", "sketch")).alias("m"))
    classes = written(classes.select("one", "two", "n", F.col("m.id").alias("rep"), F.col("m.sketch").alias("sketch")))
    entries = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(entries / ENTRIES))
    found = written(groups(docs.where("text is not null and id is not null"), k, buckets))
    side = lambda s: classes.select(F.col("one").alias(f"{s}1"), F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
    stars = found.where("kind = 0").select(F.col("x").alias("a1"), F.col("y").alias("b1")).distinct()
    first = written(_passing(stars.join(side("a"), "a1").join(side("b"), "b1").select("a", "na", "sa", "b", "nb", "sb")))
    guess = components(first)
    members = found.where("kind = 1").select(F.col("x").alias("g"), F.col("y").alias("one")).distinct()
    members = written(
        members.join(classes.select("one", "rep"), "one")
        .join(guess.withColumnRenamed("id", "rep"), "rep", "left")
        .select("g", F.col("rep").alias("id"), F.coalesce("component_id", "rep").alias("comp"))
    )
    second = written(across(members, classes.select(F.col("rep").alias("id"), "n", "sketch")))
    pairs = written(first.unionByName(second).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    sets = written(token_sets(pairs, docs, k))
    links = written(verified(pairs, sets))
    parts = written(components(links))
    # every link lies inside a component of the sketches' graph: where that still holds several parts, all are compared
    left = components(pairs).withColumnRenamed("component_id", "g").join(parts, "id", "left").withColumn("comp", F.coalesce("component_id", "id"))
    more = written(linked_across(written(left.select("g", "id", "comp")), sets))
    if not more.isEmpty():
        parts = components(links.unionByName(more))
    of = classes.select("one", "two", "n", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    of = of.select("one", "two", "n", F.coalesce("component_id", "rep").alias("component_id"))
    out = about.join(of, ["one", "two", "n"], "left")
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """The rows of df whose id is the smallest of its class; of rows that repeat an id one stays. A null id stays."""
    found = written(jaccard_classes(df, key, text, k))
    gone = written(found.where((F.col(key) != F.col("component_id")) & F.col(key).isNotNull()).select(F.col(key).alias("_gone")).distinct())
    out = df.join(gone, df[key] == gone._gone, "left_anti")
    twice = found.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    if twice.isEmpty():
        return out
    return out.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(out.where(F.col(key).isNull()))
