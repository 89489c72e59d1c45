"""The register: the notice is the spine, everything else is joined onto it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V

KEYS = ["case_id", "param_id"]


def param_dim(spark: SparkSession, params=V.PARAMS) -> DataFrame:
    """The reported parameters in order: (param_id, position, sheet, title)."""
    rows = [(p.id, k, p.sheet[:31], p.title) for k, p in enumerate(p for p in params if p.sheet)]
    return spark.createDataFrame(rows, "param_id string, position int, sheet string, title string")


def _joined(*parts):
    return X.strip(F.array_join(F.filter(F.array(*parts), lambda p: F.coalesce(p, F.lit("")) != ""), "\n\n"))


def rendered_tables(tables):
    return F.array_join(F.transform(tables, X.render_table), "\n\n")


def notice_cell(text, prose, tables, verified):
    """The repaired section where the repair was proved, else the section as printed."""
    repaired = _joined(prose, rendered_tables(tables))
    return F.substring(F.when(F.coalesce(verified, F.lit(False)) & (repaired != ""), repaired).otherwise(text), 1, V.MAX_CELL)


def answer_cell(frame_status, text, tables, fallback, silent: str):
    """What an answer shows: its own words, else the lines it points at, else the word for silence."""
    own = _joined(text, rendered_tables(tables))
    shown = F.when(frame_status == "verified", own).when(frame_status == "fallback", fallback)
    return F.substring(F.when(F.coalesce(shown, F.lit("")) != "", shown).otherwise(F.lit(silent)), 1, V.MAX_CELL)


def register(sections: DataFrame, notices: DataFrame, replies: DataFrame, findings: DataFrame, repairs: DataFrame | None = None, rendered: DataFrame | None = None) -> DataFrame:
    """A row for every raised parameter: case_id, param_id, trade_name, notice, reply, finding, statuses."""
    s = sections.select(*KEYS, F.col("text").alias("section")).join(notices.select("case_id", "trade_name"), "case_id", "left")
    if repairs is not None:
        s = s.join(repairs.select(*KEYS, "prose", F.col("tables").alias("fixed"), F.col("verified").alias("fix_ok")), KEYS, "left")
        notice = notice_cell(F.col("section"), F.col("prose"), F.col("fixed"), F.col("fix_ok"))
    else:
        notice = F.substring("section", 1, V.MAX_CELL)
    if rendered is not None:
        s = s.join(rendered.select(*KEYS, F.col("text").alias("plain")), KEYS, "left")
        notice = F.coalesce(F.substring("plain", 1, V.MAX_CELL), notice)
    for name, part in (("reply", replies), ("finding", findings)):
        part = part.select(*KEYS, *[F.col(c).alias(f"{name}_{c}") for c in ("status", "text", "tables", "fallback_text")])
        s = s.join(part, KEYS, "left")
    cells = [answer_cell(F.col(f"{n}_status"), F.col(f"{n}_text"), F.col(f"{n}_tables"), F.col(f"{n}_fallback_text"), silent).alias(n) for n, silent in (("reply", V.NO_REPLY), ("finding", V.NO_FINDING))]
    return s.select(*KEYS, "trade_name", notice.alias("notice"), *cells, "reply_status", "finding_status")


def sheet(register_: DataFrame, notice_only: bool = False) -> DataFrame:
    """The columns of a sheet, cells cleaned, ordered by case."""
    names = ["notice"] if notice_only else ["notice", "reply", "finding"]
    return register_.select("param_id", "case_id", *[X.safe(c).alias(c) for c in ["trade_name", *names]]).orderBy("param_id", "case_id")


def contents(register_: DataFrame, dim: DataFrame) -> DataFrame:
    """Counts of every parameter, raised or not: companies, replies, no_reply, findings, no_finding."""
    answered = F.count_if(F.col("reply") != V.NO_REPLY).alias("replies")
    decided = F.count_if(F.col("finding") != V.NO_FINDING).alias("findings")
    n = register_.groupBy("param_id").agg(F.count("*").alias("companies"), answered, decided)
    out = dim.join(n, "param_id", "left").na.fill(0, ["companies", "replies", "findings"])
    return out.select("param_id", "position", "sheet", "title", "companies", "replies", (F.col("companies") - F.col("replies")).alias("no_reply"), "findings", (F.col("companies") - F.col("findings")).alias("no_finding"))


def preview(register_: DataFrame, case_id: str, sections: DataFrame, limit: int | None = 1200) -> DataFrame:
    """One case in order of its notice, cells cut to a preview unless limit is None."""
    def cut(c):
        more = F.length(c) - F.lit(limit or 0)
        return F.when(more > 0, F.concat(F.substring(c, 1, limit or 0), F.format_string("\n    ... [%d more characters]", more))).otherwise(F.col(c)) if limit else F.col(c)

    r = register_.where(F.col("case_id") == case_id).join(sections.select(*KEYS, "start_line"), KEYS)
    return r.select("param_id", "start_line", *[cut(c).alias(c) for c in ("notice", "reply", "finding")]).orderBy("start_line")
