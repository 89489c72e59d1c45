"""All quality checks of a run as one table, the coverage floors, and the exit status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import checks
from ..sources import ledger

#: Names of all checks, in the order in which they are reported.
CHECKS = (
    "verbatim", "inside body", "not empty", "known parameter", "unique cell", "repair figures", "repair loses figures",
    "reply grounded", "reply raised", "reply request", "reply witnessed",
    "finding grounded", "finding raised", "finding request", "verdict", "not a recital",
)


def violations(notice_docs: DataFrame, notices: DataFrame, sections: DataFrame, replies: DataFrame, findings: DataFrame, repairs: DataFrame | None = None, witness: DataFrame | None = None) -> DataFrame:
    """(check, case_id, param_id, detail) of everything that any check objects to; no rows mean a clean run."""
    spine = sections.select(*checks.KEYS)
    out = checks.notice_checks(sections, notice_docs, notices)
    twice = spine.groupBy(*checks.KEYS).agg(F.count("*").alias("n")).where("n > 1")
    out = out.union(twice.select(F.lit("unique cell").alias("check"), *checks.KEYS, F.col("n").cast("string").alias("detail")))
    if repairs is not None:
        out = out.union(checks.repair_checks(repairs))
    out = out.union(checks.answer_checks(replies, spine, "reply", witness))
    out = out.union(checks.answer_checks(findings, spine, "finding"))
    return out.union(checks.finding_checks(findings))


def report(found: DataFrame, names=CHECKS, examples: int = 4) -> DataFrame:
    """(position, check, violations, ok, examples) for every check, also those without a violation; the first few in order are the examples."""
    spark = found.sparkSession
    every = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "position int, check string")
    row = F.array_join(F.array(F.concat_ws("/", "case_id", "param_id"), F.nullif("detail", F.lit(""))), ":")
    first = found.select("check", F.coalesce(row, F.lit("")).alias("row"))
    some = first.withColumn("r", F.row_number().over(Window.partitionBy("check").orderBy("row"))).where(F.col("r") <= examples)  # a task sends no more of a check
    some = some.groupBy("check").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "row"))), lambda x: x["row"]).alias("examples"))
    some = found.groupBy("check").agg(F.count("*").alias("violations")).join(some, "check")
    out = F.broadcast(every).join(some, "check", "left")
    n = F.coalesce("violations", F.lit(0))
    return out.select("position", "check", n.cast("long").alias("violations"), (n == 0).alias("ok"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def mark(spark: SparkSession, folder: str) -> DataFrame:
    """(cases, cells): the highest of each measure that any clean run recorded; no row before the first."""
    best: dict[str, int] = {}
    for r in ledger.records(spark, folder):
        if all(isinstance(r.get(c), int) for c in ("cases", "cells")):
            best = {c: max(r[c], best.get(c, 0)) for c in ("cases", "cells")}
    return spark.createDataFrame([(best["cases"], best["cells"])] if best else [], "cases long, cells long")


def raise_mark(spark: SparkSession, folder: str, now: DataFrame) -> None:
    """Record the measures of a clean run. Runs at the same time add a record each, and the mark is their maximum."""
    row = now.first()
    ledger.put(spark, folder, {"cases": row["cases"], "cells": row["cells"]})


@dataclass(frozen=True)
class Outcome:
    """What a run is worth: status 0 only if no check objects and no floor is missed."""

    status: int
    report: DataFrame
    floors: DataFrame

    def lines(self) -> list[str]:
        """What a console shows: a line for each check and floor, and the verdict."""
        out, failed = [], []
        for r in self.report.orderBy("position").collect():  # a row a check
            out.append(f"{'ok  ' if r['ok'] else 'FAIL'} {r['check']}" + ("" if r["ok"] else f": {r['violations']}: {', '.join(r['examples'])}"))
            failed += [] if r["ok"] else [r["check"]]
        for r in self.floors.orderBy("measure").collect():
            out.append(f"{'ok  ' if r['ok'] else 'FAIL'} {r['measure']} floor: {r['value']} >= {r['floor']}")
            failed += [] if r["ok"] else [f"{r['measure']} floor"]
        return [*out, f"{len(failed)} check(s) failed: {', '.join(failed)}" if failed else "all checks passed"]


def judge(spark: SparkSession, found: DataFrame, sections: DataFrame, marks: str) -> Outcome:
    """The outcome of a run; a clean one raises the mark kept under marks."""
    now, best = checks.coverage(sections), mark(spark, marks)
    floors = spark.createDataFrame(checks.coverage_floor(now, best).collect(), "measure string, value long, floor long, ok boolean")  # a row a measure
    summary = report(found)
    status, _ = checks.outcome(found, floors, now, best)
    if status == 0:
        raise_mark(spark, marks, now)
    return Outcome(status, summary, floors)
