"""Exact Jaccard metric-space join over word shingles (operator 1).

Jaccard distance is a metric, but between unrelated texts it is 1 almost always, so
distances to a few global pivots would tell nothing and each document would fall into
every window. Pivots are therefore chosen where distances are below 1:

1. *Isolation bound.* If x links with y, x lacks at most a quarter of its shingles in
   y. Of the lower half of x's shingles by hash, at least an eighth plus of |x| must
   then occur in the lower half of another document's. Documents that fail this are
   alone. Hashes travel packed (8 bytes each) to hash-range buckets and are sorted there.
2. *Pivots and regions.* Two linked documents share a shingle among the rarest quarter (and
   one) of either's. Each shingle elects the smallest member that has it as pivot; the
   region of a pivot holds all documents that share one of their rarest shingles with it:
   its Voronoi cell and every document near the border, which is so replicated into the
   regions of all pivots it overlaps. Text that very many documents share is rare for none
   of them, unless little else is in them, so it makes no region.
3. *Recursive exact join.* Inside a region one member after another becomes pivot. It
   is compared exactly, but only to members that another component holds and that the
   triangle inequality on the distances to earlier pivots leaves within 0.25.

Large regions are split: first all blocks are compared to a few pivots, which joins
groups of near copies in linear work; only regions that still hold several components
are then joined block against block.

These links suffice for the components. As linked documents are in one component, all
links are then counted by comparing the members of each, large ones block against block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, chunks, components, cut, signed, table, text_bytes

#: Link when 4 * |x & y| >= 3 * |x | y|: fixed by the contract (100 * i >= 75 * u).
#: Texts packed together, at most 65,535 rows so that a row number fits 16 bits.
PACK_BYTES, PACK_ROWS = 12 << 20, 60_000
#: In a pack, a shingle of so many documents sends two of them on and counts the rest at once.
HOT_IN_PACK = 32
#: Text behind one bucket of packed hashes.
BUCKET_BYTES = 64 << 20
#: Shingles of a region that one task holds; larger regions are dealt out in blocks.
BLOCK_SHINGLES = 2_000_000
#: Shingles of a component that are compared as one block when links are counted.
COUNT_SHINGLES = 100_000


def _links(i, n, m):
    return 4 * i >= 3 * (n + m - i)


# ------------------------------------------------------------------ 1. isolation bound

def _packer(buckets: int):
    def pack(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        seq = 0

        def flush(ids, sets):
            n = np.array([len(s) for s in sets], np.int64)
            key = np.array([signed(np.array([xxhash.xxh64_intdigest(s.tobytes(), 7)], np.uint64))[0] for s in sets], np.int64)
            _, rep, inv = np.unique(key, return_index=True, return_inverse=True)
            local = np.zeros(len(sets), np.int64)
            use = rep[n[rep] > 0]
            batch = (task << 32) | seq
            rows = []
            if len(use):
                size = n[use] // 2 + 1
                size = np.minimum(size, n[use])
                h = np.concatenate([sets[d][:m] for d, m in zip(use, size, strict=True)])
                own = np.repeat(use, size)
                order = np.argsort(h, kind="stable")
                h, own = h[order], own[order]
                new = np.concatenate([[True], h[1:] != h[:-1]])
                run = np.cumsum(new) - 1
                start = np.flatnonzero(new)
                length = np.diff(np.append(start, len(h)))
                keep = (length[run] < HOT_IN_PACK) | (np.arange(len(h)) - start[run] < 2)
                np.add.at(local, own[~keep], 1)
                h, own = h[keep], own[keep]
                b = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                el = ((h & np.uint64(0xFFFFFFFFFFFF)) << np.uint64(16)) | own.astype(np.uint64)
                cuts = np.searchsorted(b, np.arange(buckets + 1, dtype=np.uint64))
                for k in range(buckets):
                    if cuts[k] < cuts[k + 1]:
                        rows.append((k, batch, el[cuts[k] : cuts[k + 1]].tobytes()))
            meta = np.concatenate([np.array(ids, np.int64), n, key, local, rep[inv]])
            rows.append((-1 - batch % buckets, batch, meta.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "batch", "blob"])

        ids, sets, held = [], [], 0
        for part in chunks(batches):
            w = Words(part.column(1))
            ids += part.column(0).to_pylist()
            sets += w.shingle_sets()
            held += len(w.bytes)
            while len(ids) > PACK_ROWS or held >= PACK_BYTES and ids:
                yield flush(ids[:PACK_ROWS], sets[:PACK_ROWS])
                ids, sets, held, seq = ids[PACK_ROWS:], sets[PACK_ROWS:], 0, seq + 1
        if ids:
            yield flush(ids, sets)

    return pack


def _share(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: how many shingles of each packed document another one shares."""
    if pdf["bucket"].iloc[0] < 0:
        return pd.DataFrame({"batch": pdf["batch"], "meta": True, "blob": pdf["blob"]})
    parts = [np.frombuffer(x, np.uint64) for x in pdf["blob"]]
    el = np.concatenate(parts)
    of = np.repeat(np.arange(len(parts), dtype=np.int32), [len(x) for x in parts])
    order = np.argsort(el >> np.uint64(16), kind="stable")
    h = el[order] >> np.uint64(16)
    same = h[1:] == h[:-1]
    shared = np.zeros(len(h), bool)
    shared[1:] |= same
    shared[:-1] |= same
    who = order[shared]
    code = (of[who].astype(np.uint64) << np.uint64(16)) | (el[who] & np.uint64(0xFFFF))
    code, times = np.unique(code, return_counts=True)
    part = (code >> np.uint64(16)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(len(parts) + 1))
    batch, out = pdf["batch"].to_numpy(), []
    for k in range(len(parts)):
        if cuts[k] < cuts[k + 1]:
            s = slice(cuts[k], cuts[k + 1])
            out.append((batch[k], False, np.stack([code[s] & np.uint64(0xFFFF), times[s].astype(np.uint64)]).astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["batch", "meta", "blob"])


def _tally(pdf: pd.DataFrame) -> pd.DataFrame:
    meta = np.frombuffer(pdf.loc[pdf["meta"], "blob"].iloc[0], np.int64).reshape(5, -1)
    ids, n, key, count, rep = meta
    count = count.copy()
    for x in pdf.loc[~pdf["meta"], "blob"]:
        idx, times = np.frombuffer(x, np.uint32).reshape(2, -1)
        count[idx] += times
    count = count[rep]
    return pd.DataFrame({"doc_id": ids, "n": n, "key": key, "near": (n > 0) & (count >= np.maximum(1, np.ceil(0.1875 * n + 0.5)))})


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, n, key, near): set size, hash of the set, and whether a link is possible."""
    buckets = max(24, -(-text_bytes(docs) // BUCKET_BYTES))
    packed = docs.select("doc_id", "text").mapInArrow(_packer(buckets), "bucket long, batch long, blob binary")
    shared = packed.groupBy("bucket").applyInPandas(_share, "batch long, meta boolean, blob binary")
    return shared.groupBy("batch").applyInPandas(_tally, "doc_id long, n long, key long, near boolean")


# ------------------------------------------------------------------ 2. and 3. regions

def _sets(batches):
    for part in chunks(batches):
        sets = list(Words(part.column(1)).shingle_sets())
        off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = pa.array(signed(np.concatenate(sets)) if off[-1] else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(off).astype(np.int64)), pa.ListArray.from_arrays(pa.array(off), flat)], ["id", "n", "set"])


def local_links(ids, sets, comp=None, pivots=None, first=None):
    """Links that suffice to connect the members of a region, found exactly.

    comp: components known before. pivots: only these become pivots. first: members before
    this index are compared only to those from it on (two blocks of one region).
    """
    m = len(ids)
    sets = [np.ascontiguousarray(s).view(np.uint64) for s in sets]  # sorted as unsigned
    n = np.array([len(s) for s in sets], np.int64)
    comp = np.arange(m) if comp is None else np.unique(comp, return_inverse=True)[1]
    comp = comp.copy()
    begin = np.concatenate([[0], np.cumsum(n)])
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    out = []
    done = np.zeros(m, bool)
    for p in range(m) if pivots is None else pivots:
        done[p] = True
        ask = ~done if pivots is None else np.ones(m, bool)
        ask &= comp != comp[p]
        if first is not None:
            ask[(slice(0, first) if p < first else slice(first, m))] = False
        ask &= (4 * n >= 3 * n[p]) & (4 * n[p] >= 3 * n)
        for d, known in seen:
            if known[p]:
                ask &= ~known | (np.abs(d - d[p]) <= 0.25 + 1e-9)
        who = np.flatnonzero(ask)
        if not len(who):
            continue
        size = n[who]
        part = np.repeat(begin[who] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        x, s = flat[part], sets[p]
        at = np.searchsorted(s, x)
        hit = s[np.minimum(at, len(s) - 1)] == x
        both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(size)])[:-1], dtype=np.int64)
        linked = who[_links(both, size, n[p])]
        if len(who) > 4:
            d, known = np.zeros(m), np.zeros(m, bool)
            d[who] = 1 - both / (size + n[p] - both)
            known[who] = known[p] = True
            seen = [*seen[-5:], (d, known)]
        for y in linked:
            out.append((ids[p], ids[y]))
            if comp[y] != comp[p]:
                comp[comp == comp[y]] = comp[p]
    return out


def _edges(out):
    return pd.DataFrame(out, columns=["a", "b"]) if out else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})


def _light(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, g in pdf.groupby("region", sort=False):
        g = g.sort_values("id")
        out += local_links(g["id"].to_numpy(), list(g["set"]))
    return _edges(out)


def _stars(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["id"].to_numpy()
    return _edges(local_links(ids, list(pdf["set"]), pivots=np.flatnonzero(pdf["pivot"].to_numpy())))


def _grid(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["side", "id"])
    ids, comp = pdf["id"].to_numpy(), pdf["component"].to_numpy()
    first = int((pdf["side"] == 0).sum())
    return _edges(local_links(ids, list(pdf["set"]), comp, first=first if first < len(ids) else None))


def links(sets: DataFrame) -> DataFrame:
    """(a, b): links between the sets of (id, n, set), enough to connect all that linked pairs connect."""
    each = sets.select("id", "n", F.explode("set").alias("h"))
    shared = each.join(each.groupBy("h").agg(F.min("id").alias("region"), F.count("*").alias("holders")).where("holders > 1"), "h")
    # Linked sets share ceil(3/4 n) of either's n shingles, so of the other n - ceil(3/4 n) and one more, in any
    # order common to all, at least one. The rarest come first; those that no other has are not even rows here.
    own = Window.partitionBy("id")
    rank = F.row_number().over(own.orderBy("holders", "h")) + F.col("n") - F.count("*").over(own)
    member = shared.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(0.75 * F.col("n")) + 1).select("region", "id", "n").distinct()
    member = cut(member, "regions")
    size = member.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("members"))
    size = cut(size.where("members > 1").select("region", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int").alias("blocks"), "weight"), "sizes")
    total = size.where("blocks = 1").agg(F.sum("weight").alias("w")).first()["w"] or 0
    tasks = max(12, -(-total // BLOCK_SHINGLES))
    data = sets.select("id", "set")
    light = member.join(size.where("blocks = 1").select("region"), "region").select("region", "id").join(data, "id")
    found = cut(light.withColumn("task", F.pmod(F.xxhash64("region"), F.lit(tasks))).groupBy("task").applyInPandas(_light, "a long, b long").distinct(), "links")

    heavy = member.join(size.where("blocks > 1").select("region", "blocks"), "region")
    if heavy.isEmpty():
        return found
    # all blocks against a few pivots: the region's own and seven more by hash
    heavy = heavy.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")).withColumn("order", F.xxhash64("id", "region"))
    chosen = heavy.groupBy("region", "blocks").agg(F.min_by("id", "order").alias("p0"), *[F.min_by("id", F.xxhash64("id", F.lit(k))).alias(f"p{k}") for k in range(1, 8)])
    chosen = chosen.select("region", "blocks", F.explode(F.array_distinct(F.array("region", *[f"p{k}" for k in range(8)]))).alias("id"))
    spread = chosen.select("region", "id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("pivot"))
    rows = heavy.select("region", "id", "block", F.lit(False).alias("pivot")).union(spread).groupBy("region", "id", "block").agg(F.max("pivot").alias("pivot"))
    stars = cut(rows.join(data, "id").groupBy("region", "block").applyInPandas(_stars, "a long, b long"), "links")
    found = found.union(stars)
    comp = cut(components(found), "cc")
    label = heavy.select("region", "id", "blocks", "block").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = label.groupBy("region").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("region")
    label = label.join(mixed, "region")
    grid = label.select("region", "id", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    grid = grid.select("region", "id", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    return found.union(cut(grid.join(data, "id").groupBy("region", "i", "j").applyInPandas(_grid, "a long, b long"), "links"))


def count_links(sets, copies, first=None) -> np.ndarray:
    """Of each set, the copies of all others that it links with; first: only those of the other block."""
    m, n = len(sets), np.array([len(s) for s in sets], np.int64)
    begin = np.concatenate([[0], np.cumsum(n)])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    out, mark = np.zeros(m, np.int64), np.zeros(len(values), np.int8)
    for p in range(m - 1 if first is None else first):
        lo = p + 1 if first is None else first
        own = code[begin[p] : begin[p + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[code[begin[lo] :]], begin[lo:-1] - begin[lo], dtype=np.int64)
        mark[own] = 0
        linked = lo + np.flatnonzero(_links(both, n[lo:], n[p]))
        out[p] += copies[linked].sum()
        out[linked] += copies[p]
    return out


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, g in pdf.groupby("component", sort=False):
        g = g.sort_values("side")
        first = int((g["side"] == 0).sum()) if g["i"].iloc[0] < g["j"].iloc[0] else None
        if first != len(g):
            out.append(pd.DataFrame({"id": g["id"], "links": count_links(list(g["set"]), g["n_copies"].to_numpy(), first)}))
    return pd.concat(out) if out else pd.DataFrame({"id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})


def link_counts(sets: DataFrame, comp: DataFrame, copies: DataFrame) -> DataFrame:
    """(id, links) of the sets (id, n, set) of components (id, component), each as often as copies (id, n_copies) says."""
    member = cut(comp.join(sets.select("id", "n"), "id"), "members")
    size = member.groupBy("component").agg(F.ceil(F.sum("n") / COUNT_SHINGLES).cast("int").alias("blocks"), F.sum("n").alias("weight"))
    size = cut(size, "sizes")
    tasks = max(12, -(-(size.where("blocks = 1").agg(F.sum("weight").alias("w")).first()["w"] or 0) // BLOCK_SHINGLES))
    rows = member.drop("n").join(size, "component").join(copies, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.select("id", "component", "n_copies", "block", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.col("component")).alias("task"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("id", "component", "n_copies", "task", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    return rows.join(sets.select("id", "set"), "id").groupBy("task", "i", "j").applyInPandas(_count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, count: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text, ...): doc_id, n_shingles, component_id, n_copies and, with count, n_links.

    n_links is the number of other rows that a row links with, those of equal sets among
    them. Null and wordless texts have an empty set and link with nothing; equal sets are
    one class and link with each other. Rows without a doc_id are left out; repeated
    doc_ids give a row each, and of several texts under one doc_id that stand for a class
    the lowest is compared. An empty table gives no rows. Columns other than doc_id and
    text are not read.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    all_ = cut(sized(docs), "sized")
    classes = all_.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.max("near").alias("near"))
    classes = cut(classes, "classes")
    near = classes.where("near").select(F.col("rep").alias("doc_id"))
    sets = docs.join(near, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")).mapInArrow(_sets, "id long, n long, set array<long>")
    sets = cut(sets, "sets")
    comp = components(links(sets))
    own = []
    if count:
        comp = cut(comp, "cc")
        found = link_counts(sets, comp, classes.select(F.col("rep").alias("id"), "n_copies"))
        comp, own = comp.join(found, "id", "left"), [(F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links")]
    classes = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("key", "n_copies", F.coalesce("component", "rep").alias("component_id"), *own)
    alone = all_.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"), *([F.lit(0).cast("long").alias("n_links")] if count else []))
    return all_.where("n > 0").join(classes, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_copies", *(["n_links"] if count else [])).union(alone)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), count=True)
