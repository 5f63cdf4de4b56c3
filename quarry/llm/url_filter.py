"""URL filters over a sorted digest array.

The rules become one sorted array of 64-bit xxhash keys beside the full rule strings. The array is a
plain .npy file that Spark ships to every executor once (SparkContext.addFile) and that each Python
worker memory-maps; a batch of urls is probed with one vectorised binary search, and every hit is
confirmed against the stored string, so a hash collision cannot decide a verdict.

A rule (host, path) fits its host and all subdomains of it when the url's path starts with the rule's
path; among fitting rules the longest wins (code points of host plus path), ties to the longer host.
Nulls and urls without "://" have empty host and path and fit no rule (a rule needs a host).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import ascii_lower


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path: after the first ://, up to / ? # or the end; then up to ? # or the end."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    return df.withColumns(
        {"host": ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)}
    )


def _keys(strings: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in strings), np.uint64)


class DigestArray:
    """Sorted unique 64-bit keys with their full strings and verdicts, on disk and memory-mapped."""

    def __init__(self, folder: str):
        self.keys = np.load(f"{folder}.keys.npy", mmap_mode="r")
        self.ends = np.load(f"{folder}.ends.npy", mmap_mode="r")
        self.blob = np.load(f"{folder}.blob.npy", mmap_mode="r")
        self.verdicts = np.load(f"{folder}.verdicts.npy", mmap_mode="r")
        self.lengths = np.load(f"{folder}.lengths.npy")

    @staticmethod
    def build(rules: Iterable[tuple[str, str, str]], folder: str) -> list[str]:
        """rules: (verdict, host, path). Equal rules keep the first verdict. Returns the files written."""
        found: dict[str, str] = {}
        lengths = set()
        for verdict, host, path in rules:
            found.setdefault(f"{host}\n{path}", verdict)
            lengths.add(len(path))
        names = list(found)
        keys = _keys(names)
        order = np.argsort(keys, kind="stable")
        blobs = [names[i].encode() for i in order]
        parts = {
            "keys": keys[order],
            "ends": np.cumsum([0, *map(len, blobs)]).astype(np.int64),
            "blob": np.frombuffer(b"".join(blobs), np.uint8),
            "verdicts": np.array([found[names[i]] == "allow" for i in order], bool),
            "lengths": np.array(sorted(lengths), np.int64),
        }
        for k, v in parts.items():
            np.save(f"{folder}.{k}.npy", v)
        return [f"{folder}.{k}.npy" for k in parts]

    def name(self, i: int) -> str:
        return bytes(self.blob[self.ends[i] : self.ends[i + 1]]).decode()

    def probe(self, strings: list[str]) -> np.ndarray:
        """Index of each string among the rules, -1 where there is none."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.keys) or not strings:
            return out
        keys = _keys(strings)
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys):
            j = at[i]
            while j < len(self.keys) and self.keys[j] == keys[i]:  # equal keys of different strings stand together
                if self.name(j) == strings[i]:
                    out[i] = j
                    break
                j += 1
        return out


def judge(spark: SparkSession, df: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """df with host, path, rule (null if none fits) and verdict ("allow", "block" or the default).

    rules live on the driver only while the array is written; the columns of df are kept, but for
    clashing host, path, rule and verdict, which are replaced.
    """
    stem = f"digests-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="quarry-")  # executors fetch the files from the driver, which drops them when it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    for file in DigestArray.build(rules, os.path.join(folder, stem)):
        spark.sparkContext.addFile(file)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = DigestArray(SparkFiles.get(f"{stem}.keys.npy").removesuffix(".keys.npy"))
        for pdf in batches:
            strings, owner, hosts = [], [], []
            for row, (host, path) in enumerate(zip(pdf["host"], pdf["path"], strict=True)):
                labels = host.split(".")
                for k in range(len(labels)):
                    suffix = ".".join(labels[k:])
                    if not suffix:
                        continue
                    for n in index.lengths:
                        if n > len(path):
                            break
                        strings.append(f"{suffix}\n{path[:n]}")
                        owner.append(row)
                        hosts.append(len(suffix))
            hit = index.probe(strings)
            best: list[tuple[int, int, int]] = [(-1, -1, -1)] * len(pdf)
            for i in np.flatnonzero(hit >= 0):
                best[owner[i]] = max(best[owner[i]], (len(strings[i]) - 1, hosts[i], int(hit[i])))
            rule = [index.name(b[2]).replace("\n", "") if b[0] >= 0 else None for b in best]
            verdict = [("allow" if index.verdicts[b[2]] else "block") if b[0] >= 0 else default for b in best]
            yield pdf.assign(rule=pd.Series(rule, index=pdf.index, dtype=object), verdict=verdict)

    parts = with_parts(df.drop("host", "path", "rule", "verdict"), url)
    return parts.mapInPandas(fit, StructType([*parts.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())]))
