"""URL filter over a sorted digest array.

Method: each rule's key (host and path prefix) is hashed to 64 bits (xxhash);
the digests lie sorted in one file that every Python worker memory-maps, with
the full strings behind them.  A batch of URLs becomes the batch of keys that
could fit, all probed by one vectorised binary search; every hit is confirmed
against its stored string, so a digest collision never decides.

The file is written to the shared folder and handed to the executors with
``addFile``: one copy per executor, its pages shared by its workers.  Its size
is that of the rule list, a parameter of the caller, not of the table.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and gets ``default``; two rules of one length are told apart by the
longer host; a rule given twice counts once, and contradicting verdicts for one
key raise; extra columns are kept out of the result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch

MAGIC = b"URLSET01"


def pack_rules(rules: Iterable[tuple[str, str]], digest=xxhash.xxh64_intdigest) -> bytes:
    """(key, verdict) pairs as one blob: digests in order, verdicts, string offsets, strings.

    A key is ``host/path``: everything before its first slash is the host, the rest the path prefix.
    """
    known: dict[str, str] = {}
    for key, verdict in rules:
        if "/" not in key or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {key!r}, {verdict!r}")
        if known.setdefault(key, verdict) != verdict:
            raise ValueError(f"two verdicts for {key!r}")
    rows = sorted((digest(k.encode()), k.encode(), v == "block") for k, v in known.items())
    ends = np.cumsum([0, *(len(k) for _, k, _ in rows)], dtype="<u8")
    return b"".join((MAGIC, struct.pack("<Q", len(rows)), np.array([d for d, _, _ in rows], dtype="<u8").tobytes(),
                     ends.tobytes(), bytes(b for _, _, b in rows), *(k for _, k, _ in rows)))


class DigestArray:
    """A packed rule list, memory-mapped."""

    def __init__(self, path: str, digest=xxhash.xxh64_intdigest):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        assert raw[:8].tobytes() == MAGIC
        n = struct.unpack("<Q", raw[8:16].tobytes())[0]
        self.digest = digest
        self.digests = raw[16:16 + 8 * n].view("<u8")
        self.ends = raw[16 + 8 * n:24 + 16 * n].view("<u8")
        self.block = raw[24 + 16 * n:24 + 17 * n]
        self.strings = raw[24 + 17 * n:]
        # which path lengths occur with which host length: only those keys can fit
        shapes: dict[int, set[int]] = {}
        for i in range(n):
            host, _, path = self.key(i).partition("/")
            shapes.setdefault(len(host), set()).add(len(path) + 1)
        self.shapes = {h: sorted(p) for h, p in shapes.items()}

    def key(self, i: int) -> str:
        return self.strings[int(self.ends[i]):int(self.ends[i + 1])].tobytes().decode()

    def find(self, keys: list[str]) -> np.ndarray:
        """Place of each key, -1 if it is not there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not keys or not len(self.digests):
            return out
        want = np.fromiter((self.digest(k.encode()) for k in keys), dtype=np.uint64, count=len(keys))
        lo = np.searchsorted(self.digests, want, side="left")
        hit = np.flatnonzero((lo < len(self.digests)) & (self.digests[np.minimum(lo, len(self.digests) - 1)] == want))
        for j in hit:
            i = int(lo[j])
            while i < len(self.digests) and self.digests[i] == want[j]:  # all that collide
                if self.key(i) == keys[j]:
                    out[j] = i
                    break
                i += 1
        return out

    def candidates(self, host: str, path: str) -> Iterator[str]:
        """Keys of ``host`` and the domains above it with prefixes of ``path`` in the lengths that rules have."""
        at = 0
        while True:
            for n in self.shapes.get(len(host) - at, ()):
                if n <= len(path):
                    yield host[at:] + path[:n]
            at = host.find(".", at) + 1
            if not at:
                return

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """(key, verdict) of the longest fitting rule of each url; None where none fits."""
        keys, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            for key in self.candidates(host, path):
                keys.append(key)
                owner.append(i)
        best: dict[int, tuple[int, int, int]] = {}
        at = self.find(keys)
        for j in np.flatnonzero(at >= 0):
            rank = (len(keys[j]), keys[j].index("/"), int(at[j]))
            best[owner[j]] = max(best.get(owner[j], rank), rank)
        rule = [self.key(best[i][2]) if i in best else None for i in range(len(hosts))]
        return rule, [("block" if self.block[best[i][2]] else "allow") if i in best else None for i in range(len(hosts))]


@lru_cache(maxsize=4)
def mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def ship(spark: SparkSession, blob: bytes, name: str) -> str:
    """Write ``blob`` into the shared folder and have each executor fetch it; its name for ``SparkFiles.get``."""
    file = f"{name}-{xxhash.xxh64_hexdigest(blob)}.bin"
    jvm, folder = spark._jvm, scratch(spark, name)
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/{file}")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(blob))
    out.close()
    known = {str(f).rsplit("/", 1)[-1] for f in spark.sparkContext.listFiles}
    if file not in known:
        spark.sparkContext.addFile(f"{folder}/{file}")
    return file


def host_and_path(url):
    """(host, path) columns: host after the first ``://`` to ``/ ? #`` or the end, A-Z lower-cased; path to ``? #``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per url: id, host, path, rule (key of the longest fitting rule or null), verdict."""
    spark = pages.sparkSession
    file = ship(spark, pack_rules(rules), "urlrules")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = mapped(file)
        for pdf in batches:
            rule, verdict = index.judge(pdf["host"].tolist(), pdf["path"].tolist())
            yield pd.DataFrame({"id": pdf["id"], "host": pdf["host"], "path": pdf["path"], "rule": pd.Series(rule, dtype=object, index=pdf.index),
                                "verdict": pd.Series([v or default for v in verdict], dtype=object, index=pdf.index)})

    host, path = host_and_path(F.col(url_col))
    # ids go through pandas as text: a column of integers with a null would be one of floats
    out = (pages.select(F.col(id_col).cast("string").alias("id"), host.alias("host"), path.alias("path"))
           .mapInPandas(run, "id string, host string, path string, rule string, verdict string"))
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
