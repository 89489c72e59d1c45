"""Toxicity by FTRL-proximal logistic regression (operator 2).

Features are presence of hashed words, neighbouring word pairs and pairs with one word
skipped. Learning keeps per-coordinate rates and an L1 bound, so nearly all weights are
exactly zero; the rest are small enough to broadcast (at most FEATURES of them). Learning
runs over a bounded sample of labelled texts in one task (so many texts and bytes at
most), scoring over every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, chunks, mix, table

BITS = 20
FEATURES = 1 << BITS
#: Labelled texts learnt from, at most: those with the lowest hash of doc_id; and bytes of these, in that order.
MAX_TRAIN, MAX_TRAIN_BYTES = 20_000, 192 << 20
#: Epochs, rate and L1 have the least log loss on two splits inside the training rows of sf0.1 (remainders 1 and 3).
EPOCHS, ALPHA, BETA, L1, L2 = 5, 2.0, 1.0, 8.0, 0.5
BIAS = 0  # the coordinate that every text has

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[:128] = [not chr(c).isalnum() for c in range(128)]


def features(texts: pa.Array):
    """(text number, coordinate) of every feature occurrence in a chunk of texts."""
    w = Words(texts, _SEPARATOR)
    h, count = w.hash, np.diff(w.first)
    own = np.repeat(np.arange(len(count)), count)
    parts, owners = [mix(h)], [own]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            same = own[gap:] == own[:-gap]
            parts.append(mix(h[:-gap] * np.uint64(salt) + h[gap:])[same])
            owners.append(own[gap:][same])
    at = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    at[at == BIAS] = 1
    return np.concatenate(owners), at


def fit(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """FTRL-proximal over (coordinates, label) in the order given."""
    z, n = np.zeros(FEATURES), np.zeros(FEATURES)

    def weight(i):
        zi = z[i]
        bound = np.where(i == BIAS, 0.0, L1)  # the intercept is not held to zero
        w = -(zi - np.sign(zi) * bound) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= bound, 0.0, w)

    for _ in range(EPOCHS):
        for i, y in rows:
            i = i.astype(np.int64)  # held as 32 bits, looked up faster by 64
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[i] + g * g)
            z[i] += g - (root - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weight(np.arange(FEATURES))


def _learn(most: int):
    def learn(batches):
        """Texts come in order of rank; those beyond `most` bytes are not learnt from."""
        rows, seen = [], 0
        for part in chunks(batches):
            size = pc.fill_null(pc.binary_length(part.column(1)), 0).to_numpy()
            part = part.slice(0, int((seen + np.cumsum(size) <= most).sum()) if seen <= most else 0)
            seen += int(size.sum())
            own, at = features(part.column(1))
            n = part.num_rows
            pair = np.unique(np.concatenate([np.arange(n) * FEATURES + BIAS, own * FEATURES + at]))  # each coordinate of a text once
            cuts, at = np.searchsorted(pair, np.arange(n + 1) * FEATURES), (pair % FEATURES).astype(np.int32)
            rows += [(at[a:b], y) for y, a, b in zip(part.column(0).to_pylist(), cuts[:-1], cuts[1:], strict=True)]
        if rows:
            w = fit(rows)
            keep = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(keep), pa.array(w[keep])], ["at", "w"])

    return learn


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_bytes: int = MAX_TRAIN_BYTES) -> list[tuple[int, float]]:
    """Weights other than zero, learnt from labels (doc_id, toxic) of which at most max_train count."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("rank", F.xxhash64("doc_id", F.lit(11))).orderBy("rank", "doc_id").limit(max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("rank", "doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = rows.repartition(1).sortWithinPartitions("rank", "doc_id").select("toxic", "text")
    return [(r["at"], r["w"]) for r in rows.mapInArrow(_learn(max_bytes), "at long, w double").collect()]


def _scorer(weights, name):
    def score(batches):
        at, w = weights.value
        full = np.zeros(FEATURES)
        full[at] = w
        for part in chunks(batches):
            own, i = features(part.column(part.schema.get_field_index("text")))
            use = full[i] != 0
            pair = np.unique(own[use] * FEATURES + i[use])
            total = full[BIAS] + np.bincount(pair // FEATURES, full[pair % FEATURES], part.num_rows)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], [*part.schema.names, name])

    return score


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def with_score(docs: DataFrame, labels: DataFrame, name: str = "score", max_train: int = MAX_TRAIN) -> DataFrame:
    """docs (doc_id, text, any others) with a column `name`, the score of each whole text."""
    rows = docs.where("doc_id is not null")
    learnt = train(rows, labels.select("doc_id", "toxic").where(~held_out()), max_train)
    at = np.array([a for a, _ in learnt] or [BIAS], np.int64)
    w = np.array([x for _, x in learnt] or [np.log(0.25 / 0.75)])
    shared = docs.sparkSession.sparkContext.broadcast((at, w))
    plain = ["text" if c == "text" else f"c{k}" for k, c in enumerate(rows.columns)]  # names that any sign may be in do not pass through there
    schema = T.StructType([*(T.StructField(c, f.dataType) for c, f in zip(plain, rows.schema.fields, strict=True)), T.StructField("s", T.DoubleType())])
    return rows.toDF(*plain).mapInArrow(_scorer(shared, "s"), schema).toDF(*rows.columns, name)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    Learns only from labelled rows that are not held out; labels that are null or not 0
    or 1 are not used, and of repeated ones the highest counts; of several texts under one
    doc_id the lowest is learnt from, and each is scored. An empty table gives no rows. Without any usable label
    there is nothing to learn: each score is 0.25 (a uniform prior leaning to clean) and
    predicted 0. Null, empty and wordless texts have the score of the intercept alone.
    Rows without a doc_id are left out. Other columns are not read.
    """
    scored = with_score(docs.select("doc_id", "text"), labels, max_train=max_train)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
