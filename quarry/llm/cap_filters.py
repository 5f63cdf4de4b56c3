"""Near duplicates of embeddings by spherical-cap filters.

A filter is a unit vector; a vector belongs to all filters whose inner product with it reaches
ALPHA, a cap of the sphere. The filters are a structured random product code: the space, turned by a random
rotation, is cut into PARTS blocks, each block has CODE random unit directions, and every choice of one
direction per block is a filter. So a vector's list is decoded from PARTS * CODE inner products instead of one for each
of the CODE ** PARTS filters. Two vectors with a cosine above the threshold share
a filter with probability near one (lists hold about twenty filters, and never fewer than LEAST, the best
ones); the pairs of a filter are verified by their cosine in double precision.

Each pair is counted once, in the least filter that both lists hold, inside the task that has the filter's
rows. Tasks send on link counts per vector and a spanning forest of the links, never the pairs, so a
group of g near copies costs O(g) rows. Filters with more than CHUNK rows are cut into chunks and
the pairs of chunks dealt separately; no row is dropped. Components come from the forests.

Vectors link only within an equal, non-null label. Null, zero, non-finite or incomplete vectors link with
nothing and stand alone. Vectors of different lengths never link. Exact copies are separate vectors.
Rows that repeat an id are one vector id: their links add up and they share a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, tidy, written
from .topk import usable

PARTS, CODE, ALPHA, LEAST, CHUNK, SEED = 2, 48, 0.30, 16, 1024, 20240607


class Filters:
    """The product code for vectors of one length."""

    def __init__(self, width: int, parts: int = PARTS, code: int = CODE):
        rng = np.random.default_rng([SEED, width])
        self.parts = min(parts, width)
        self.rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
        self.cuts = np.array_split(np.arange(width), self.parts)
        self.codes = []
        for cut in self.cuts:
            c = rng.normal(size=(code, len(cut)))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True))
        self.places = np.array(list(product(range(code), repeat=self.parts)))

    def lists(self, unit: np.ndarray, alpha: float = ALPHA, least: int = LEAST) -> list[np.ndarray]:
        """Ids of the filters of each unit vector, ascending."""
        turned = unit @ self.rotation
        total = 0.0
        for p, (cut, code) in enumerate(zip(self.cuts, self.codes, strict=True)):
            own = turned[:, cut] @ code.T / np.sqrt(self.parts)
            total = total + own[:, self.places[:, p]]
        kth = np.partition(total, -least, axis=1)[:, -least] if total.shape[1] > least else total.min(axis=1)
        return [np.flatnonzero(row >= min(alpha, t)).astype(np.int32) for row, t in zip(total, kth, strict=True)]


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows over their norms; scaled first so that neither huge nor tiny components leave the doubles."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_duplicates(df: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    sound = usable(rows.where("label is not null and id is not null"), "v").where(F.exists("v", lambda x: x != 0))
    kind = rows.schema["label"].dataType.simpleString()
    # vectors travel in the width they are stored in; all sums are taken in double
    stored = np.float32 if df.schema[vector].dataType.elementType.simpleString() == "float" else np.float64

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, Filters] = {}
        for pdf in batches:
            for width, own in pdf.groupby(pdf["v"].map(len)):
                if width not in codes:
                    codes[width] = Filters(width)
                for i in range(0, len(own), 512):
                    part = own.iloc[i : i + 512]
                    vectors = np.stack(part["v"].to_numpy()).astype(np.float64)
                    lists = codes[width].lists(_unit(vectors))
                    many = np.fromiter(map(len, lists), np.int64, len(lists))
                    at = np.repeat(np.arange(len(part)), many)
                    raw = [x.tobytes() for x in vectors.astype(stored)]
                    held = [x.tobytes() for x in lists]
                    yield pd.DataFrame(
                        {
                            "label": part["label"].to_numpy()[at],
                            "width": np.int32(width),
                            "filter": np.concatenate(lists),
                            "id": part["id"].to_numpy()[at],
                            "vector": [raw[j] for j in at],
                            "held": [held[j] for j in at],
                        }
                    )

    group = ["label", "width", "filter"]
    listed = written(sound.mapInPandas(tidy(decode), f"label {kind}, width int, filter int, id long, vector binary, held binary"))
    # chunks of large filters: the rows of a filter are cut by a hash, and each pair of chunks is one unit of work
    large = listed.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK).withColumn("chunks", F.ceil(F.col("n") * 1.25 / CHUNK).cast("int")).drop("n")
    large = written(large)  # a plain table: the join below can then split a hot filter's partition
    cut = listed.join(large, group, "left")
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    cut = cut.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.select(*group, "id", "vector", "held", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    unit = [*group, "i", "j"]

    def links(name: int, crossing: bool, ids: np.ndarray, own: np.ndarray, rows: np.ndarray, held: np.ndarray, counts: np.ndarray) -> tuple | None:
        """One unit: (ids with links, their number, roots of a spanning forest), None without any. rows are unit vectors, held their filters."""
        n = len(ids)
        number, parent, cursor = np.zeros(n, np.int64), np.arange(n), 256
        before = None
        for s in range(0, n, cursor):
            e = slice(s, min(s + cursor, n))
            found = rows[e] @ rows.T >= threshold
            found &= ids[e, None] != ids[None]
            if crossing:  # pairs inside a chunk are counted where the chunk meets itself
                found &= own[e, None] != own[None]
            if not found.any():
                continue
            if before is None:  # filters below this one that a row is also in, over the few that occur here
                row = np.repeat(np.arange(n), counts)
                row, lower = row[held < name], held[held < name]
                names, at = np.unique(lower, return_inverse=True)
                before = np.zeros((n, len(names)), np.float32)
                before[row, at] = 1
            found &= before[e] @ before.T == 0
            number[e] += found.sum(axis=1)
            a, b = np.nonzero(found)
            if len(a):
                parent = forest(n, np.concatenate([a + s, np.arange(n)]), np.concatenate([b, parent]))
        linked = number > 0
        return (ids[linked], number[linked], ids[parent[linked]]) if linked.any() else None

    def together(pdf: pd.DataFrame, cut: list[int]) -> Iterator[pd.DataFrame]:
        """The units of sorted rows, from one place of cut to the next; all rows are decoded at once."""
        pdf = pdf.iloc[: cut[-1]]
        ids, own, name = pdf["id"].to_numpy(), pdf["own"].to_numpy(), pdf["filter"].to_numpy()
        crossing, size = pdf["i"].to_numpy() != pdf["j"].to_numpy(), pdf["width"].to_numpy()
        counts = np.fromiter((len(x) // 4 for x in pdf["held"]), np.int64, len(pdf))
        held, upto = np.frombuffer(b"".join(pdf["held"]), np.int32), np.concatenate([[0], np.cumsum(counts)])
        vectors, ends = np.frombuffer(b"".join(pdf["vector"]), stored), np.concatenate([[0], np.cumsum(size)])
        out = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b - a > 1:
                rows = _unit(vectors[ends[a] : ends[b]].astype(np.float64).reshape(b - a, size[a]))
                got = links(int(name[a]), bool(crossing[a]), ids[a:b], own[a:b], rows, held[upto[a] : upto[b]], counts[a:b])
                if got is not None:
                    out.append(got)
        if out:
            yield pd.DataFrame(dict(zip(("id", "n", "root"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Units follow each other sorted; the last one of a batch may go on in the next."""
        rest: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            change = np.zeros(len(pdf), bool)
            for c in unit:
                v = pdf[c].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            cut = [0, *np.flatnonzero(change).tolist()]
            yield from together(pdf, cut)
            rest = pdf.iloc[cut[-1] :]
        if rest is not None and len(rest) > 1:
            yield from together(rest, [0, len(rest)])

    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = written(cut.repartition(parts, *unit).sortWithinPartitions(*unit).mapInPandas(tidy(stream), "id long, n long, root long"))
    n_links = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    parts_of = components(found, "id", "root")
    out = rows.select("id").join(n_links, "id", "left").join(parts_of, "id", "left")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
