"""Binary document trees: node tables with typed value pools, decoded to nested values or JSON.

Layout (fixed values of the format): magic WZJS, int32 version 5, then 32-byte nodes of eight int32 (kind, key, value, first child,
number of children, parent, path, path before). Kinds: 2 map, 5 bool, 6 int, 8 float, 11 and 12 string, 14 vector, 18 sprite,
19 map. Pools follow: bools as int16 (padded to four bytes), ints, floats, vectors, then keys, paths and strings, each as
zero-terminated bytes (padded to four) followed by its offsets. A header of twenty int32 may stand in front of the magic.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

MAGIC, VERSION, NODE = b"WZJS", 5, 8
MAP, BOOL, INT, FLOAT, STRINGS, VECTOR, SPRITE, NESTED = 2, 5, 6, 8, (11, 12), 14, 18, 19
KINDS = [MAP, BOOL, INT, FLOAT, *STRINGS, VECTOR, SPRITE, NESTED]
HEADER = 144


class DocumentError(ValueError):
    """A blob that does not hold a readable document."""


class Document:
    def __init__(self, raw: bytes):
        at = raw.find(MAGIC)
        if at < 0:
            raise DocumentError("no document magic")
        self.blob = raw[at:]
        if len(self.blob) < 8 or int(self._ints(1, 4)[0]) != VERSION:
            raise DocumentError("unknown document version")
        header = np.frombuffer(raw, "<i4", HEADER // 4, at - HEADER) if at >= HEADER else None
        if header is not None and header[1] == 8 and header[35] >= 8 and at + header[35] <= len(raw):
            self.blob = self.blob[: header[35]]
            self._from_header(header.tolist())
        else:
            self._from_layout()

    def _ints(self, count: int, offset: int) -> np.ndarray:
        if count < 0 or offset < 0 or offset + 4 * count > len(self.blob):
            raise DocumentError("table outside the blob")
        return np.frombuffer(self.blob, "<i4", count, offset)

    def _values(self, kind: str, count: int, offset: int) -> np.ndarray:
        if count < 0 or offset < 0 or offset + np.dtype(kind).itemsize * count > len(self.blob):
            raise DocumentError("pool outside the blob")
        return np.frombuffer(self.blob, kind, count, offset) if count else np.zeros(0, kind)

    def _cuts(self, count: int, offset: int) -> np.ndarray:
        cuts = self._ints(count, offset)
        if count < 1 or cuts[0] != 0 or (np.diff(cuts) < 0).any():
            raise DocumentError("string offsets are not ascending")
        return cuts

    def _strings(self, data: int, cuts: np.ndarray) -> list[str]:
        return [self.blob[data + a : data + b].rstrip(b"\0").decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _from_header(self, h: list[int]) -> None:
        self.nodes = self._ints(h[0] * NODE, h[1]).reshape(-1, NODE)
        if not np.isin(self.nodes[:, 0], KINDS).all():
            raise DocumentError("unknown kind of node")
        self.bools, self.ints = self._values("<i2", h[8], h[9]) != 0, self._values("<i4", h[10], h[11])
        self.floats, self.vectors = self._values("<f4", h[14], h[15]), self._values("<f4", 2 * h[16], h[17]).reshape(-1, 2)
        self.keys = self._strings(h[27], self._cuts(h[26] + 1, h[28]))
        self.paths = self._strings(h[30], self._cuts(h[29] + 1, h[31]))
        self.strings = self._strings(h[33], self._cuts(h[32] + 1, h[34]))

    def _from_layout(self) -> None:
        """Without a header the nodes end at the first row that cannot be one, and the pools are found from both ends."""
        rows = self._ints((len(self.blob) - 8) // 4 // NODE * NODE, 8).reshape(-1, NODE)
        if not len(rows):
            raise DocumentError("no nodes")
        limit = max(int(rows[0, 6]), 1) + 1
        good = np.isin(rows[:, 0], KINDS) & (rows[:, 1] >= 0) & (rows[:, 4] >= 0) & (rows[:, 5] >= -1) & (rows[:, 5] <= limit) & (rows[:, 3] >= -1) & (rows[:, 3] <= limit)
        self.nodes = rows if good.all() else rows[: int(good.argmin())]
        if not len(self.nodes) or self.nodes[0, 0] != MAP or self.nodes[0, 5] != -1:
            raise DocumentError("the root is no map")
        kind, value = self.nodes[:, 0], self.nodes[:, 2]
        most = lambda *kinds: int(value[np.isin(kind, kinds)].max(initial=-1)) + 1
        self._pools_from_end(int(self.nodes[:, 1].max()) + 1, int(self.nodes[0, 6]) + 1, max(1, most(*STRINGS)))
        at = 8 + 4 * NODE * len(self.nodes)
        self.bools = self._values("<i2", most(BOOL), at) != 0
        at = (at + 2 * len(self.bools) + 3) // 4 * 4
        self.ints = self._values("<i4", most(INT), at)
        at += 4 * len(self.ints)
        self.floats = self._values("<f4", most(FLOAT), at)
        at += 4 * len(self.floats)
        self.vectors = self._values("<f4", 2 * most(VECTOR), at).reshape(-1, 2)
        if at + 8 * len(self.vectors) > self.pool:
            raise DocumentError("value pools overlap the strings")

    def _pools_from_end(self, keys: int, paths: int, strings: int) -> None:
        floor = 8 + 4 * NODE * len(self.nodes)
        for pad in range(0, 20, 4):
            try:
                end = len(self.blob) - pad
                value_at, value_cuts, end = self._pool_before(end, strings, floor)
                path_at, path_cuts, end = self._pool_before(end, paths, floor)
            except DocumentError:
                continue
            for gap in range(0, 20, 4):
                try:
                    key_at, key_cuts, self.pool = self._pool_before(end - gap, keys, floor)
                except DocumentError:
                    continue
                self.keys, self.paths, self.strings = self._strings(key_at, key_cuts), self._strings(path_at, path_cuts), self._strings(value_at, value_cuts)
                return
        raise DocumentError("string pools not found")

    def _pool_before(self, end: int, count: int, floor: int) -> tuple[int, np.ndarray, int]:
        """Data start, offsets and start of the pool of count strings whose offsets end at end."""
        offsets = end - 4 * (count + 1)
        cuts = self._cuts(count + 1, offsets)
        data = offsets - (int(cuts[-1]) + 3) // 4 * 4
        if data < floor:
            raise DocumentError("pool overlaps the nodes")
        return data, cuts, data

    def value(self, i: int) -> Any:
        kind, _, v, first, count = map(int, self.nodes[i, :5])
        if kind == BOOL:
            return bool(self.bools[v])
        if kind == INT:
            return int(self.ints[v])
        if kind == FLOAT:
            return float(self.floats[v])
        if kind in STRINGS:
            return self.strings[v]
        if kind == VECTOR:
            return {"x": float(self.vectors[v, 0]), "y": float(self.vectors[v, 1])}
        if first < 0:
            children: dict[str, Any] = {}
        elif first + count > len(self.nodes):
            raise DocumentError("children outside the node table")
        else:
            gathered: dict[str, list] = {}
            for c in range(first, first + count):
                gathered.setdefault(self.keys[self.nodes[c, 1]], []).append(self.value(c))
            children = {k: x[0] if len(x) == 1 else x for k, x in gathered.items()}
        return {"$sprite": children} if kind == SPRITE else children

    def tree(self) -> dict[str, Any]:
        return {self.keys[self.nodes[0, 1]]: self.value(0)}


def _pool(texts: list[str]) -> tuple[bytes, int]:
    """Texts with their offsets behind them, and where the offsets begin."""
    parts = [t.encode() + b"\0" for t in texts]
    data = b"".join(parts)
    data += bytes(-len(data) % 4)
    return data + np.cumsum([0, *map(len, parts)]).astype("<i4").tobytes(), len(data)


def encode(name: str, tree: dict[str, Any]) -> bytes:
    """A document with a header that holds a tree of maps, bools, ints, floats, texts and (x, y) pairs of floats."""
    keys, texts, pools = {name: 0}, [], {BOOL: [], INT: [], FLOAT: [], VECTOR: []}
    nodes = [[MAP, 0, 0, -1, 0, -1, 0, -1]]
    queue = [(0, tree)]
    for at, children in queue:  # children of a map stand together, so maps are taken in the order they were met
        nodes[at][3], nodes[at][4] = (len(nodes) if children else -1), len(children)
        for key, value in children.items():
            kind = MAP if isinstance(value, dict) else BOOL if isinstance(value, bool) else INT if isinstance(value, int) else FLOAT if isinstance(value, float) else VECTOR if isinstance(value, tuple) else STRINGS[0]
            held = texts if kind in STRINGS else pools.get(kind, [])
            nodes.append([kind, keys.setdefault(key, len(keys)), len(held), -1, 0, at, 0, 0])
            if kind == MAP:
                nodes[-1][2] = 0
                queue.append((len(nodes) - 1, value))
            else:
                held.append(value)
    body = MAGIC + np.array([VERSION], "<i4").tobytes() + np.array(nodes, "<i4").tobytes()
    h = [0] * (HEADER // 4)
    h[0], h[1] = len(nodes), 8
    for place, kind, dtype in ((8, BOOL, "<i2"), (10, INT, "<i4"), (14, FLOAT, "<f4"), (16, VECTOR, "<f4")):
        h[place], h[place + 1] = len(pools[kind]), len(body)
        body += np.array(pools[kind], dtype).tobytes()
        body += bytes(-len(body) % 4)
    for place, held in ((26, list(keys)), (29, [""]), (32, texts)):
        data, cuts = _pool(held)
        h[place : place + 3] = len(held), len(body), len(body) + cuts
        body += data
    h[35] = len(body)
    return np.array(h, "<i4").tobytes() + body


def decode_json(blobs: DataFrame, asset: str = "asset", content: str = "content") -> DataFrame:
    """(asset, json, error): every document as JSON text, ready for parse_json; failures do not stop the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, raw in zip(pdf[asset], pdf[content], strict=True):
                try:
                    rows.append((name, json.dumps(Document(bytes(raw)).tree(), ensure_ascii=False), None))
                except (DocumentError, ValueError, IndexError, RecursionError) as problem:
                    rows.append((name, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=["asset", "json", "error"])

    return blobs.select(asset, content).mapInPandas(run, "asset string, json string, error string")


def footholds(documents: DataFrame) -> DataFrame:
    """(map_id, foothold_id, x1, y1, x2, y2) of the three-level foothold map in each (map_id, json) document."""
    from pyspark.sql import functions as F

    level = "map<string, map<string, map<string, struct<x1:int,y1:int,x2:int,y2:int>>>>"
    tree = documents.select("map_id", F.from_json(F.get_json_object("json", "$.foothold"), level).alias("t"))
    one = tree.select("map_id", F.explode("t").alias("a", "x"))
    two = one.select("map_id", "a", F.explode("x").alias("b", "y"))
    rows = two.select("map_id", "a", "b", F.explode("y").alias("foothold_id", "f")).where("f.x1 is not null and f.y1 is not null and f.x2 is not null and f.y2 is not null")
    last = rows.groupBy("map_id", "foothold_id").agg(F.max_by("f", F.struct("a", "b")).alias("f"))
    return last.select("map_id", "foothold_id", "f.*")
