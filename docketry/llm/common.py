"""Shared pieces of the training-data operators.

Text rules used everywhere in this folder: a word is a run of bytes other than
space and \\t\\n\\v\\f\\r, and only A-Z are lower-cased. Word and shingle ids are
64-bit hashes computed from a whole Arrow buffer at once, so no Python object is
made for a word. Two different shingles share an id with probability 2**-64.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once in a Python worker; one longer text is handled alone.
CHUNK_BYTES = 2 << 20
SHINGLE = 5


# ------------------------------------------------------------------ tables

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share; a local one only where none is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame, what: str = "t") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends in files that survive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, buckets: int, key: str) -> DataFrame:
    """cut, with the rows in buckets by a column: joins on that column alone read them without a shuffle."""
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name, format="parquet")
    return spark.table(name)


def named(df: DataFrame) -> list:
    """The columns of df under their names, whatever signs these hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df does not have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sizes the number of buckets, decides nothing else."""
    return docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


# ------------------------------------------------------------------ hashing

_RNG = np.random.default_rng(20240229)
CASED = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE = CASED.copy()
for _c in range(ord("A"), ord("Z") + 1):
    _BYTE[_c] = _BYTE[_c + 32]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 2**64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    if len(_POWERS[0]) < n or len(_POWERS[0]) > 4 * max(n, CHUNK_BYTES):
        size = max(n, CHUNK_BYTES) + 1
        for k, r in enumerate((_R, _R_INV)):
            a = np.full(size, r, np.uint64)
            a[0] = 1
            _POWERS[k] = np.cumprod(a, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """Words of a chunk of texts: hash, first and last byte, and where each text's words begin."""

    def __init__(self, texts: pa.Array, space: np.ndarray = _SPACE, byte: np.ndarray = _BYTE):
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
        data = texts.buffers()[2]
        b = np.frombuffer(data, np.uint8, int(off[-1] - off[0]), int(off[0])) if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off = off - off[0]
        self.bytes, self.offsets = b, off
        if not len(b):
            self.hash, self.start, self.end = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.first = np.zeros(n + 1, np.int64)
            return
        solid = ~space[b]
        before = np.empty_like(solid)
        before[0] = False
        before[1:] = solid[:-1]
        inner = off[1:-1][off[1:-1] < len(b)]
        before[inner] = False
        after = np.empty_like(solid)
        after[-1] = False
        after[:-1] = solid[1:]
        after[inner[inner > 0] - 1] = False
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        p, q = _powers(len(b))
        total = np.empty(len(b) + 1, np.uint64)
        total[0] = 0
        np.cumsum(byte[b] * p, out=total[1:])
        self._total, self._back = total, q
        self.hash = self.hash_of(self.start, self.end)
        self.first = np.searchsorted(self.start, off)

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of runs of bytes, those of equal words where they are words."""
        return mix((self._total[end] - self._total[start]) * self._back[start])

    def shingles(self, k: int = SHINGLE):
        """(hashes, first): k-word hashes in text order; a shorter text has its whole sequence as one."""
        w, first = self.hash, self.first
        count = np.diff(first)
        many = np.maximum(count - k + 1, 0)
        begin = np.concatenate([[0], np.cumsum(np.where((many == 0) & (count > 0), 1, many))])
        out = np.zeros(begin[-1], np.uint64)
        if len(w) >= k:
            h = w[: len(w) - k + 1].copy()
            for j in range(1, k):
                h = mix(h * _M3 + w[j : len(w) - k + 1 + j])
            long = many > 0
            pos = np.repeat(first[:-1][long] - np.concatenate([[0], np.cumsum(many[long])])[:-1], many[long]) + np.arange(many.sum())
            dest = np.repeat(begin[:-1][long] - np.concatenate([[0], np.cumsum(many[long])])[:-1], many[long]) + np.arange(many.sum())
            out[dest] = h[pos]
        for d in np.flatnonzero((many == 0) & (count > 0)):
            out[begin[d]] = int.from_bytes(xxhash.xxh64_digest(w[first[d] : first[d + 1]].tobytes(), int(count[d])), "little")
        return out, begin

    def shingle_sets(self, k: int = SHINGLE):
        """The sorted distinct shingle hashes of each text."""
        h, begin = self.shingles(k)
        for d in range(len(begin) - 1):
            s = np.sort(h[begin[d] : begin[d + 1]])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """Record batches in pieces of at most `limit` bytes of text (or one text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        t = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(t), 0))
        at = np.cumsum(size)
        lo = 0
        while lo < batch.num_rows:
            base = at[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(at, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


# ------------------------------------------------------------------ components

def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over edges (a, b); ids without an edge are absent.

    Alternating large-star and small-star steps: each shrinks paths to stars in a
    logarithmic number of rounds, with map-side minima and no neighbour lists.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, "cc")
    last = None
    for _ in range(rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = e.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("s"), F.sum("v").cast("string").alias("t")).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components not stable after {rounds} rounds")
    pairs = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    return pairs.union(pairs.select(F.col("component").alias("id"), "component").distinct())
