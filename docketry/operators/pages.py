"""Pages of scanned files: fanned out, read twice, judged, and put together in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import evidence

KEYS = ("case_id", "file")
#: Pages that one task renders: a file of many pages is shared by many tasks.
RANGE = 16


def page_ranges(files: DataFrame, size: int = RANGE) -> DataFrame:
    """files with first_page and last_page, a row for every `size` pages of the column pages; none for a file without pages."""
    starts = F.sequence(F.lit(1), F.col("pages").cast("int"), F.lit(size))
    out = files.where("pages > 0").withColumn("first_page", F.explode(starts))
    return out.withColumn("last_page", F.least(F.col("first_page") + (size - 1), F.col("pages").cast("int")))


def judged(model: DataFrame, witness: DataFrame, keys=KEYS) -> DataFrame:
    """(*keys, page, text, verdict, witness_text) of two reads of pages, joined page by page.

    model: (*keys, page, response, error); witness: (*keys, page, text). Every page of the
    witness has a row. A model that failed leaves the witness's words under
    `model-failed-<kind>`, one that never answered under `model-failed-missing`; otherwise the
    page judge decides (`ok-...`, `ok-sparse`, `drift-...`, `blank`, `invented-on-blank-page`).
    A null witness saw nothing.
    """
    m = model.select(*keys, "page", "response", "error", F.lit(True).alias("asked"))
    seen = witness.select(*keys, "page", F.coalesce("text", F.lit("")).alias("witness_text"))
    both = seen.join(m, [*keys, "page"], "left")
    kind = F.when(F.col("asked").isNull(), "missing").otherwise(F.coalesce(F.nullif(F.regexp_extract(F.coalesce("error", F.lit("")), r"^(\w+)", 1), F.lit("")), F.lit("unknown")))
    failed = F.struct(F.col("witness_text").alias("text"), F.concat(F.lit("model-failed-"), kind).alias("verdict"))
    j = F.when(F.col("response").isNull(), failed).otherwise(evidence.judge_page("response", "witness_text"))
    return both.withColumn("j", j).select(*keys, "page", F.col("j.text").alias("text"), F.col("j.verdict").alias("verdict"), "witness_text")


def reassembled(pages: DataFrame, keys=KEYS) -> DataFrame:
    """(*keys, text, pages, caught, witness_text) of judged pages: texts in order of page, empty ones left out.

    caught lists the pages whose model read was not taken, as `p<page>:<verdict>` in order.
    """
    row = F.struct("page", "text", "verdict", "witness_text")
    g = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("p"))

    def joined(name):
        return F.array_join(F.transform(F.filter("p", lambda r: X.strip(r[name]) != ""), lambda r: r[name]), "\n")

    caught = F.transform(F.filter("p", lambda r: ~r["verdict"].startswith("ok")), lambda r: F.concat(F.lit("p"), r["page"].cast("string"), F.lit(":"), r["verdict"]))
    return g.select(*keys, joined("text").alias("text"), F.size("p").alias("pages"), caught.alias("caught"), joined("witness_text").alias("witness_text"))


def verdict_tally(pages: DataFrame) -> DataFrame:
    """(verdict, pages) with the shares and the kinds of failure left out of the names."""
    kind = F.regexp_replace(F.regexp_replace("verdict", r"-\d\.\d\d$", ""), "^model-failed-.*", "model-failed")
    return pages.groupBy(kind.alias("verdict")).agg(F.count("*").alias("pages"))
