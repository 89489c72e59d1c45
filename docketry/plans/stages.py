"""The whole register from extracted texts and stored or live model answers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V
from ..operators import evidence, files, items, register, resolve, segment
from ..sources import completions

KEYS = ["case_id", "param_id"]
#: requests (request_id, system, prompt, max_tokens) -> (request_id, response, error)
Answer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Prompt:
    """What a model is asked. The wording belongs to the deployment; {defects}, {body} and {hints} are filled in."""

    system: str = "You read case documents and reply with JSON only. Copy figures exactly, never invent one, and leave out what the text does not say."
    body: str = 'Defects:\n{defects}\n{hints}\nLines:\n{body}\n\nReturn {"items": [{"id": "", "lines": [1, 1], "text": "", "tables": []}]} with the words of the lines, only for ids above.'
    max_tokens: int = 12000


def _filled(prompt: Prompt, **parts):
    c = F.lit(prompt.body)
    for name, value in parts.items():
        c = F.replace(c, F.lit("{" + name + "}"), value)
    return c


def notices(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(notices, sections) of notice texts (case_id, file, text)."""
    lines = segment.split_lines(docs)
    ends = segment.body_end(lines, summary=options.get("summary", V.SUMMARY), tail=options.get("tail", V.TAIL))
    names = segment.trade_names(docs)
    n = docs.select("case_id", "file").join(ends.select("case_id", "body_end", F.col("n").alias("doc_lines")), "case_id", "left").join(names, "case_id", "left")
    return n.na.fill(0, ["body_end", "doc_lines"]), segment.sections(docs, **options)


def defects(sections: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """(case_id, allowed, defects): the raised ids in order and their list for a prompt."""
    titles = F.create_map(*[F.lit(x) for kv in V.TITLES.items() for x in kv])
    s = sections.withColumn("title", F.coalesce(F.element_at(titles, F.col("param_id")), F.col("param_id")))
    s = s.join(F.broadcast(descriptions), "param_id", "left") if descriptions is not None else s.withColumn("description", F.lit(None).cast("string"))
    line = F.concat(F.col("param_id"), F.lit(" | "), F.concat_ws("\n     ", "title", "description"))
    return s.groupBy("case_id").agg(F.array_sort(F.collect_set("param_id")).alias("allowed"), F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("param_id", line.alias("line")))), lambda d: d["line"]), "\n").alias("defects"))


def heading_hints(docs: DataFrame, allowed: DataFrame, keys=None) -> DataFrame:
    """(case_id, hints): at which lines, eight at most of each, raised parameters are named."""
    named = segment.headings(segment.split_lines(docs), keys=keys, wrap=1, compat=True).join(allowed, "case_id").where(F.array_contains("allowed", F.col("id")))
    per = named.groupBy("case_id", "id").agg(F.slice(F.array_sort(F.collect_list(F.col("i") + 1)), 1, 8).alias("at"))
    row = F.concat(F.lit("  "), F.col("id"), F.lit(" mentioned at line(s): "), F.array_join(F.col("at").cast("array<string>"), ", "))
    return per.groupBy("case_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", row.alias("row")))), lambda r: r["row"]), "\n").alias("hints"))


def _asked(docs: DataFrame, wanted: DataFrame, answer: Answer, prompt: Prompt, model: str, need_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(items, failed) of documents (case_id, file, file_rank, lines, hints), window by window."""
    w = docs.join(wanted, "case_id").withColumn("key", F.struct("case_id", "file", "file_rank", "allowed", "defects", "hints", F.col("lines").alias("all")))
    w = segment.windows(w, "key").select("key.*", F.col("start").alias("window"), F.col("lines").alias("chunk"))
    w = w.withColumn("prompt", _filled(prompt, defects=F.col("defects"), hints=F.coalesce("hints", F.lit("")), body=X.numbered("chunk", F.col("window") + 1)))
    w = completions.with_request_id(w.withColumns({"system": F.lit(prompt.system), "max_tokens": F.lit(prompt.max_tokens)}), model)
    got = w.join(answer(w.select("request_id", "system", "prompt", "max_tokens").distinct()), "request_id", "left")
    failed = got.where("response is null").select("case_id", "file", "window", "error")
    read = items.parse_items(got.where("response is not null").withColumn("n_lines", F.size("all")), need_text=need_text)
    read = read.withColumn("v", evidence.verified("text", "tables", F.array_join("chunk", "\n"))).select("*", "v.*").drop("v")
    return read.withColumnRenamed("id", "param_id").withColumn("lines", F.col("all")), failed


def replies(texts: DataFrame, sections: DataFrame, answer: Answer, prompt: Prompt = Prompt(), model: str = "replay", descriptions: DataFrame | None = None, argues: str = V.ARGUES) -> DataFrame:
    """The best reply to every raised parameter: verified, fallback, dropped, silent or failed."""
    picked = files.pick_replies(texts, pattern=argues).withColumn("hints", F.lit(""))
    found, failed = _asked(picked, defects(sections, descriptions), answer, prompt, model)
    found = resolve.with_fallback(found)
    # within a file any candidate may win; across files only what can be shown
    per_file = resolve.first_by(found, ("case_id", "file", "param_id"), F.col("verified").desc(), F.length("text").desc(), "window", "ordinal").where("status <> 'dropped'")
    best = resolve.best_replies(per_file)
    return resolve.closed_world(sections, best.drop("lines", "all", "chunk"), KEYS, failed)


def findings(texts: DataFrame, sections: DataFrame, answer: Answer, prompt: Prompt = Prompt(), model: str = "replay", descriptions: DataFrame | None = None, keys=None) -> DataFrame:
    """The officer's finding on every raised parameter, recitals left out."""
    wanted = defects(sections, descriptions)
    hints = heading_hints(texts, wanted, keys)
    docs = texts.withColumns({"lines": X.lines("text"), "file_rank": F.lit(1)}).join(hints, "case_id", "left")
    found, failed = _asked(docs, wanted, answer, prompt, model)
    found = found.withColumn("verdict_model", F.lower(X.strip(F.coalesce("verdict", F.lit(""))))).withColumn("j", evidence.judge_verdict("verdict", "text"))
    found = found.withColumns({"verdict": F.col("j.verdict"), "verdict_supported": F.col("j.supported"), "is_recital": evidence.is_recital("text")}).drop("j")
    best = resolve.with_fallback(resolve.best_findings(found).where("not is_recital")).where("status <> 'dropped'")
    # the lines shown instead of the words must be the officer's too
    best = best.where((F.col("status") != "fallback") | ~evidence.is_recital("fallback_text"))
    return resolve.closed_world(sections, best.drop("lines", "all", "chunk"), KEYS, failed)


def repairs(sections: DataFrame, answer: Answer, prompt: Prompt = Prompt(body="Title: {defects}\n{hints}\n{body}", max_tokens=4000), model: str = "replay") -> DataFrame:
    """Rebuilt tables of damaged sections, verified when no figure is made up and none is lost."""
    titles = F.create_map(*[F.lit(x) for kv in V.TITLES.items() for x in kv])
    r = sections.where(evidence.damaged("text")).withColumn("prompt", _filled(prompt, defects=F.coalesce(F.element_at(titles, F.col("param_id")), F.col("param_id")), hints=F.lit(""), body=F.substring("text", 1, V.REPAIR_CHARS)))
    r = completions.with_request_id(r.withColumns({"system": F.lit(prompt.system), "max_tokens": F.lit(prompt.max_tokens)}), model)
    got = items.parse_repairs(r.join(answer(r.select("request_id", "system", "prompt", "max_tokens").distinct()), "request_id").where("response is not null"))
    payload = evidence.payload_text("prose", "tables")
    out = got.withColumns({"bad_figures": evidence.bad_repairs(payload, "text"), "lost": evidence.lost_figures(F.regexp_replace("text", r"(\d{4,})\s(\d{1,3})(?!\d)", "$1$2"), payload)})
    return out.select(*KEYS, "prose", "tables", "bad_figures", "lost", ((F.size("bad_figures") == 0) & (F.size("lost") == 0)).alias("verified"))


def rendered(sections: DataFrame, answer: Answer, prompt: Prompt = Prompt(body="{defects}\n{hints}\n{body}", max_tokens=6000), model: str = "replay") -> DataFrame:
    """(case_id, param_id, text, lost, invented, failed): sections in plain words; a failed call keeps the section."""
    r = sections.withColumn("prompt", _filled(prompt, defects=F.col("param_id"), hints=F.lit(""), body=F.col("text")))
    r = completions.with_request_id(r.withColumns({"system": F.lit(prompt.system), "max_tokens": F.lit(prompt.max_tokens)}), model)
    got = r.join(answer(r.select("request_id", "system", "prompt", "max_tokens").distinct()), "request_id", "left")
    plain = F.coalesce(X.strip_fence("response"), F.col("text"))
    return got.select(*KEYS, plain.alias("text"), evidence.lost_figures("text", plain).alias("lost"), evidence.invented_figures("text", plain).alias("invented"), F.col("response").isNull().alias("failed"))


def second_opinion(docs: DataFrame, notices_: DataFrame, sections: DataFrame, answer: Answer, prompt: Prompt = Prompt(), model: str = "replay", keys=None) -> tuple[DataFrame, DataFrame]:
    """(sections with the gaps filled, rejected): spans a model gives for parameters the keywords missed.

    A span must begin inside the body and hold its own heading, wrapped or not, in its first five lines.
    """
    every = F.array(*map(F.lit, V.REPORTED))
    wanted = docs.select("case_id", every.alias("allowed"), F.array_join(F.transform(every, lambda i: i), "\n").alias("defects"))
    body = docs.join(notices_.select("case_id", "body_end"), "case_id").select("case_id", "file", F.lit(1).alias("file_rank"), F.slice(X.lines("text"), 1, F.col("body_end")).alias("lines"), F.lit("").alias("hints"))
    found, _ = _asked(body, wanted, answer, prompt, model, need_text=False)
    spans = resolve.widest_spans(found.where("line_from is not null")).join(sections, KEYS, "left_anti")
    heads = segment.headings(segment.split_lines(docs), keys=keys).select("case_id", F.col("id").alias("param_id"), F.col("i").alias("at"))
    opens = spans.join(heads, KEYS).where("at + 1 between line_from and least(line_to, line_from + 4)").select(*KEYS).distinct().withColumn("opens", F.lit(True))
    text = X.strip(F.array_join(F.slice("lines", F.col("line_from"), F.col("line_to") - F.col("line_from") + 1), "\n"))
    spans = spans.join(opens, KEYS, "left").withColumn("text", text)
    good = F.col("opens").isNotNull() & (F.col("text") != "")
    new = spans.where(good).select(*KEYS, "text", F.col("line_from").alias("start_line"), F.col("line_to").alias("end_line"), F.lit("model").alias("origin"))
    why = F.when(F.col("opens").isNull(), "no-heading").otherwise("empty")
    return resolve.gap_fill(sections, new, KEYS), spans.where(~good).select(*KEYS, why.alias("reason"))


def full_register(notice_docs: DataFrame, reply_texts: DataFrame, order_texts: DataFrame, answer_reply: Answer, answer_order: Answer, answer_repair: Answer | None = None, only_case: str | None = None) -> dict[str, DataFrame]:
    """All tables of a run: notices, sections, replies, findings, repairs (or None), register."""
    if only_case:
        notice_docs, reply_texts, order_texts = (d.where(F.col("case_id") == only_case) for d in (notice_docs, reply_texts, order_texts))
    n, s = notices(notice_docs)
    s = s.cache()
    r, f = replies(reply_texts, s, answer_reply), findings(order_texts, s, answer_order)
    fix = repairs(s, answer_repair) if answer_repair else None
    return {"notices": n, "sections": s, "replies": r, "findings": f, "repairs": fix, "register": register.register(s, n, r, f, fix)}
