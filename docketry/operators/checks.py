"""Quality checks: each a frame of violations (check, case_id, param_id, detail); none means passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V

KEYS = ["case_id", "param_id"]


def _bad(frame: DataFrame, name: str, detail=None) -> DataFrame:
    detail = F.lit("") if detail is None else detail.cast("string")
    return frame.select(F.lit(name).alias("check"), *[F.col(k).cast("string").alias(k) for k in KEYS], F.coalesce(detail, F.lit("")).alias("detail"))


def notice_checks(sections: DataFrame, docs: DataFrame, notices: DataFrame, reported=V.REPORTED) -> DataFrame:
    """Sections are verbatim, inside the body, not empty, and of the vocabulary."""
    s = sections.join(notices.select("case_id", "body_end"), "case_id")
    out = _bad(unprinted(sections, docs), "verbatim")
    out = out.union(_bad(s.where("start_line > body_end or end_line > body_end"), "inside body", F.col("start_line")))
    out = out.union(_bad(s.where(X.strip("text") == ""), "not empty"))
    return out.union(_bad(sections.where(~F.col("param_id").isin(list(reported))), "known parameter"))


def unprinted(sections: DataFrame, docs: DataFrame) -> DataFrame:
    """Sections whose text, white space aside, does not stand in their document.

    A document meets all its sections at once. Each is looked for among its own lines; the
    whole document is searched, once, only for those that are not there.
    """
    own = sections.groupBy("case_id").agg(F.collect_list(F.struct("param_id", "text", "start_line", "end_line")).alias("s"))
    both = own.join(docs.select("case_id", F.col("text").alias("doc")), "case_id")

    def among(ls):
        def lines(x):
            return F.array_join(F.slice(ls, F.greatest(x["start_line"], F.lit(1)), F.greatest(x["end_line"] - F.greatest(x["start_line"], F.lit(1)) + 1, F.lit(0))), "\n")

        return F.filter("s", lambda x: ~F.contains(X.squash_space(lines(x)), X.squash_space(x["text"])))

    both = both.select("case_id", "doc", X.let(X.lines("doc"), among).alias("s")).where(F.size("s") > 0)
    both = both.select("case_id", X.let(X.squash_space("doc"), lambda whole: F.filter("s", lambda x: ~F.contains(whole, X.squash_space(x["text"])))).alias("s"))
    return both.select("case_id", F.explode("s").alias("x")).select("case_id", "x.param_id")


def repair_checks(repairs: DataFrame) -> DataFrame:
    used = repairs.where("verified")
    out = _bad(used.where(F.size("bad_figures") > 0), "repair figures", F.array_join("bad_figures", ","))
    return out.union(_bad(used.where(F.size("lost") > 0), "repair loses figures", F.array_join("lost", ","))) if "lost" in repairs.columns else out


def answer_checks(answers: DataFrame, spine: DataFrame, side: str, witness: DataFrame | None = None) -> DataFrame:
    """Answers are grounded, of a raised parameter, and come from a request that did not fail.

    witness: (case_id, file, witness_text, text) of pages read twice; figures must occur in one of the reads.
    """
    shown = answers.where("status in ('verified', 'fallback', 'dropped')")
    out = _bad(shown.where("status = 'dropped' or (status = 'fallback' and fallback_text is null)"), f"{side} grounded")
    out = out.union(_bad(answers.join(spine, KEYS, "left_anti"), f"{side} raised"))
    out = out.union(_bad(answers.where("status = 'failed'"), f"{side} request"))
    if witness is not None:
        w = shown.where("status = 'verified'").join(witness.select("case_id", "file", F.concat("witness_text", F.lit("\n"), F.col("text")).alias("seen")), ["case_id", "file"])
        bad = F.filter(F.regexp_extract_all("text", F.lit(V.LONG_FIGURE), F.lit(0)), lambda f: F.length(X.digits(f)).between(4, 12) & ~F.contains(X.digits("seen"), X.digits(f)))
        out = out.union(_bad(w.where(F.size(bad) > 0), f"{side} witnessed", F.array_join(bad, ",")))
    return out


def finding_checks(findings: DataFrame, recital: str = V.RECITAL) -> DataFrame:
    """Verdicts are of the four; what a cell shows is not the notice or the reply recited."""
    f = findings.where("status in ('verified', 'fallback')")
    shown = F.when(F.col("status") == "fallback", F.col("fallback_text")).otherwise(F.col("text"))
    out = _bad(f.where(~F.coalesce("verdict", F.lit("")).isin(*V.VERDICTS)), "verdict", F.col("verdict"))
    return out.union(_bad(f.where(shown.rlike(recital)), "not a recital"))


def coverage(sections: DataFrame) -> DataFrame:
    return sections.agg(F.count_distinct("case_id").alias("cases"), F.count("*").alias("cells"))


def coverage_floor(now: DataFrame, best: DataFrame) -> DataFrame:
    """(measure, value, floor, ok): now against nine tenths of the best clean run (no row: nothing to fall short of)."""
    cols = ("cases", "cells")
    b = best.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(f"b_{c}") for c in cols]).select(F.lit(1).alias("k"), "*")
    n = now.select(F.lit(1).alias("k"), *cols).join(b, "k")
    row = n.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value"), F.floor(F.col(f"b_{c}") * V.TOLERANCE).cast("long").alias("floor")) for c in cols])).alias("r")).select("r.*")
    return row.withColumn("ok", F.col("value") >= F.col("floor"))


def raised_mark(now: DataFrame, best: DataFrame) -> DataFrame:
    """The mark after a clean run: the highest of each measure."""
    return now.unionByName(best).agg(F.max("cases").alias("cases"), F.max("cells").alias("cells"))


def outcome(violations: DataFrame, floors: DataFrame, now: DataFrame, best: DataFrame) -> tuple[int, DataFrame]:
    """(exit status, mark): 0 and the raised mark after a run without a violation above its floors, else 1 and the mark as it was."""
    clean = violations.isEmpty() and floors.where("not ok").isEmpty()
    return (0, raised_mark(now, best)) if clean else (1, best)


def reply_summary(replies: DataFrame) -> DataFrame:
    """(cells, answered, share, unverified) of answers: shown in their own words or by their lines; share is null without cells."""
    shown = F.count_if(F.col("status").isin("verified", "fallback"))
    total = F.count("*")
    return replies.agg(total.alias("cells"), shown.alias("answered"), F.when(total > 0, shown / total).alias("share"), F.count_if(F.col("status") == "fallback").alias("unverified"))


def verdict_counts(findings: DataFrame, verdicts=V.VERDICTS) -> DataFrame:
    """(verdict, findings) for each verdict there is, also those that no order came to."""
    every = findings.sparkSession.createDataFrame([(v,) for v in verdicts], "verdict string")
    return F.broadcast(every).join(findings.groupBy("verdict").agg(F.count("*").alias("findings")), "verdict", "left").na.fill(0, ["findings"])
