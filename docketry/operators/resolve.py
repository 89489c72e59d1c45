"""Choosing among candidates, and making silence explicit. All orders are total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V


def first_by(frame: DataFrame, keys, *order) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def best_replies(items: DataFrame, keys=("case_id", "param_id")) -> DataFrame:
    """Verified before unverified, then longer, then the earlier file, window and item."""
    return first_by(items, keys, F.col("verified").desc(), F.length("text").desc(), "file_rank", "window", "ordinal")


def best_findings(items: DataFrame, keys=("case_id", "param_id")) -> DataFrame:
    """Not a recital, then verified, then the later window, then longer."""
    return first_by(items, keys, "is_recital", F.col("verified").desc(), F.col("window").desc(), F.length("text").desc(), "ordinal")


def widest_spans(items: DataFrame, keys=("case_id", "param_id")) -> DataFrame:
    return first_by(items, keys, (F.col("line_to") - F.col("line_from")).desc(), "window", "ordinal")


def with_fallback(items: DataFrame, lines: str = "lines") -> DataFrame:
    """items with fallback_text, the lines an unverified answer points at, and its status.

    status: verified, fallback (verbatim lines are shown) or dropped (nothing bears it out).
    """
    cut = X.strip(F.array_join(F.slice(lines, F.col("line_from"), F.col("line_to") - F.col("line_from") + 1), "\n"))
    f = F.when(~F.col("verified") & F.col("line_from").isNotNull() & (cut != ""), cut)
    return items.withColumn("fallback_text", f).withColumn("status", F.when(F.col("verified"), "verified").when(F.col("fallback_text").isNotNull(), "fallback").otherwise("dropped"))


def closed_world(spine: DataFrame, found: DataFrame, keys, failed: DataFrame | None = None, silent: str = "silent") -> DataFrame:
    """found over every key of the spine: status `silent` where nothing was found, 'failed' where a request failed.

    Keys outside the spine are dropped.
    """
    out = spine.select(*keys).distinct().join(found, list(keys), "left")
    missing = F.lit(silent)
    if failed is not None:
        out = out.join(failed.select(keys[0]).distinct().withColumn("_failed", F.lit(True)), keys[0], "left")
        missing = F.when(F.col("_failed"), F.lit("failed")).otherwise(missing)
    return out.withColumn("status", F.coalesce("status", missing)).drop("_failed")


def orphans(frame: DataFrame, spine: DataFrame, keys) -> DataFrame:
    return frame.join(spine, list(keys), "left_anti")


def gap_fill(sure: DataFrame, more: DataFrame, keys) -> DataFrame:
    """sure, and the rows of more whose key sure lacks."""
    return sure.unionByName(more.join(sure, list(keys), "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Merge, never overwrite: new rows replace old ones of the same key, other old rows stay."""
    return gap_fill(new, old, keys)


def agreement(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """One row: how many keys both have, only a, only b."""
    both = a.select(*keys).distinct().withColumn("_a", F.lit(1)).join(b.select(*keys).distinct().withColumn("_b", F.lit(1)), list(keys), "full_outer")
    return both.agg(F.count_if(F.expr("_a = 1 and _b = 1")).alias("both"), F.count_if(F.expr("_a = 1 and _b is null")).alias("only_a"), F.count_if(F.expr("_a is null and _b = 1")).alias("only_b"))
