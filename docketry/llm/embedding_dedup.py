"""Embedding near-dedup by collision-counting projections (operator 3).

Unit vectors with cosine >= t differ on a Gaussian projection by N(0, 2(1-t)). Many
one-dimensional projections are taken. Windows of one projection alone hold a good part of
all vectors, so coarse cells of other projections part the vectors first, in TABLES ways.
In each cell the vectors are sorted by a projection and each meets those in a window
centred on it; for these, collisions in narrower windows are counted over WINDOWS
projections, and pairs reaching a count calibrated for RECALL are verified by cosine in
double precision. recall() is the probability that all this finds a pair at the threshold.
A pair is looked at in the first table where it meets only, so nothing is counted twice,
and each task returns link counts and a spanning forest instead of pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, table

THRESHOLD = 0.93
CELLS, TABLES, WIDTH = 10, 28, 2.0
WINDOWS, RECALL = 40, 0.997
#: Half the window of the sorted projection, in standard deviations of a pair at the threshold.
REACH = 3.5
#: Vectors of one cell that a task takes at once; larger cells are joined block by block.
BLOCK = 1024
_PAIRS = 200_000


def calibrate(threshold: float = THRESHOLD, windows: int = WINDOWS, recall: float = RECALL) -> tuple[float, int]:
    """Half-width of a window, and the least count that a pair at the threshold reaches with this probability."""
    sigma = math.sqrt(2 * (1 - threshold))
    p = math.erf(1 / math.sqrt(2))
    tail, c = 0.0, 0
    while True:
        tail += math.comb(windows, c) * p**c * (1 - p) ** (windows - c)
        if tail > 1 - recall:
            return sigma, c
        c += 1


def recall(threshold: float = THRESHOLD) -> float:
    """Probability that a pair at the threshold is found: some table has both in a cell and a window, and the count is reached."""
    sigma = math.sqrt(2 * (1 - threshold))
    x = np.linspace(0, WIDTH, 20_001)
    density = np.exp(-(x**2) / (2 * sigma**2)) * math.sqrt(2 / math.pi) / sigma
    cell = float(np.trapezoid(density * (1 - x / WIDTH), x))  # a gap x is cut by a border with probability x / WIDTH
    meet = cell**CELLS * math.erf(REACH / math.sqrt(2))
    return (1 - (1 - meet) ** TABLES) * RECALL


def _unit(vectors) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _project(batches):
    for pdf in batches:
        for dim, g in pdf.groupby(pdf["embedding"].map(len)):
            rng = np.random.default_rng(1000 + dim)
            proj, shift = rng.standard_normal((dim, CELLS * TABLES)), rng.random(CELLS * TABLES)
            x = _unit(g["embedding"].to_numpy())
            y = x @ proj
            cell = np.floor(y / WIDTH + shift).astype(np.int64).reshape(len(x), TABLES, CELLS)
            code = np.zeros((len(x), TABLES), np.int64)
            for k in range(CELLS):
                code = code * np.int64(1_000_003) + cell[:, :, k]
            yield pd.DataFrame({"id": g["id"], "label": g["label"], "dim": dim, "copies": g["copies"], "cells": list(code), "proj": list(y[:, :WINDOWS].astype(np.float32)), "vector": g["embedding"]})


def _count(threshold: float):
    window, least = calibrate(threshold)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        key = ["label", "dim", "t", "cell", "i", "j"]
        pdf = pdf.assign(at=np.stack(pdf["proj"].to_numpy())[np.arange(len(pdf)), pdf["t"]]).sort_values([*key, "at", "id"])  # a projection for each table
        key = pdf[key].to_numpy()
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        line = group * 1e3 + pdf["at"].to_numpy(np.float64)  # values are standard normal, so groups stay apart
        cells, proj, t = np.stack(pdf["cells"].to_numpy()), np.stack(pdf["proj"].to_numpy()), pdf["t"].to_numpy()
        side, ids, copies = pdf["side"].to_numpy(), pdf["id"].to_numpy(), pdf["copies"].to_numpy()
        cross = pdf["i"].to_numpy() != pdf["j"].to_numpy()
        vectors, dims = pdf["vector"].to_numpy(), pdf["dim"].to_numpy()
        matrix = {d: _unit(vectors[dims == d]) for d in np.unique(dims)}
        at = np.zeros(len(pdf), np.int64)
        for d in matrix:
            at[dims == d] = np.arange((dims == d).sum())
        last = np.searchsorted(line, line + REACH * window, side="right")
        left, right, held = [], [], 0

        def verified(a, b):
            first = (cells[a] == cells[b]).argmax(axis=1) == t[a]
            a, b = a[first], b[first]
            near = (np.abs(proj[a] - proj[b]) <= window).sum(axis=1) >= least
            a, b = a[near], b[near]
            ok = np.zeros(len(a), bool)
            for d, m in matrix.items():
                w = dims[a] == d
                ok[w] = np.einsum("ij,ij->i", m[at[a[w]]], m[at[b[w]]]) >= threshold
            return a[ok], b[ok]

        pairs, hold_a, hold_b = [], [], []
        for offset in range(1, int((last - np.arange(len(pdf))).max(initial=1))):
            a = np.flatnonzero(np.arange(len(pdf)) + offset < last)
            b = a + offset
            use = ~cross[a] | (side[a] != side[b])
            hold_a.append(a[use])
            hold_b.append(b[use])
            held += int(use.sum())
            if held >= _PAIRS:
                pairs.append(verified(np.concatenate(hold_a), np.concatenate(hold_b)))
                hold_a, hold_b, held = [], [], 0
        if held:
            pairs.append(verified(np.concatenate(hold_a), np.concatenate(hold_b)))
        left = ids[np.concatenate([a for a, _ in pairs])] if pairs else np.zeros(0, np.int64)
        right = ids[np.concatenate([b for _, b in pairs])] if pairs else np.zeros(0, np.int64)
        if not len(left):
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        weight = dict(zip(ids.tolist(), copies.tolist(), strict=True))
        node, inv = np.unique(np.concatenate([left, right]), return_inverse=True)
        a, b = inv[: len(left)], inv[len(left) :]
        w = np.array([weight[x] for x in node.tolist()], np.int64)
        links = np.bincount(a, w[b], len(node)) + np.bincount(b, w[a], len(node))
        root = np.arange(len(node))
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pd.DataFrame({"id": node, "links": links.astype(np.int64), "root": node[root]})

    return count


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are compared only under equal labels that are not null and in equal
    dimensions. Null, empty and zero vectors, and those with null or non-finite parts,
    link with nothing. Equal vectors form a class: they link with each other and share
    the links of the class. Rows without a vec_id are left out; an empty table gives no
    rows; other columns are not read.
    """
    v = vectors.select("vec_id", F.col("embedding").alias("embedding"), "label").where("vec_id is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    usable = v.where(good)
    classes = cut(usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes")
    unit = cut(
        classes.select("id", F.xxhash64("label").alias("label"), "copies", "embedding").mapInPandas(
            _project, "id long, label long, dim long, copies long, cells array<long>, proj array<float>, vector array<float>"
        ),
        "units",
    )
    keys = unit.select("id", "label", "dim", F.posexplode("cells").alias("t", "cell"))
    size = keys.groupBy("label", "dim", "t", "cell").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    member = keys.join(size, ["label", "dim", "t", "cell"]).withColumn("block", F.pmod(F.xxhash64("id", "t"), F.col("blocks").cast("long")).cast("int"))
    grid = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grid = grid.select("id", "label", "dim", "t", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    grid = cut(grid, "grid")
    tasks = max(12, -(-grid.count() // 50_000))
    data = grid.join(unit.select("id", "copies", "cells", "proj", "vector"), "id").withColumn("task", F.pmod(F.xxhash64("label", "dim", "t", "cell", "i", "j"), F.lit(tasks)))
    found = cut(data.groupBy("task").applyInPandas(_count(threshold), "id long, links long, root long"), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = classes.join(links, "id", "left").join(comp, "id", "left")
    classes = classes.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = usable.join(classes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = v.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
