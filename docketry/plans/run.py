"""From a folder of cases to the workbook, stage by stage; a stage whose inputs did not change is not run again.

Every stage writes its table under the work folder and a record of what it was made from:
its settings and the digests of its input tables. A digest is that of the rows, whatever
their order, so a stage that came to the same rows as before does not disturb those after it.
Texts are extracted file by file, and answers asked request by request, only where missing.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import files as ops
from ..operators import pages as page_ops
from ..operators import register as reg
from ..sources import completions, ledger, page_reads, readers, sinks
from . import gate, stages

Ask = Callable[[DataFrame], DataFrame]


def digest(df: DataFrame) -> str:
    """A digest of the rows of df in any order, repeated ones counted."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0)
    one, two = F.xxhash64(row), F.xxhash64(F.lit("2"), row)
    r = df.agg(F.count("*").alias("n"), F.sum(one.cast("decimal(38,0)")).cast("string").alias("a"), F.sum(two.cast("decimal(38,0)")).cast("string").alias("b")).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{r['n']}|{r['a']}|{r['b']}".encode()).hexdigest()


@dataclass
class Stages:
    """Tables of a work folder, each with a record of what it was made from."""

    spark: SparkSession
    work: str
    ran: list[str] = field(default_factory=list)
    digests: dict[str, str] = field(default_factory=dict)

    def last(self, name: str) -> dict | None:
        """The latest record of a stage whose table is still there."""
        for r in reversed(ledger.records(self.spark, f"{self.work}/ledger/{name}")):
            if ledger.exists(self.spark, f"{r['path']}/_SUCCESS"):
                return r
        return None

    def table(self, name: str) -> DataFrame | None:
        r = self.last(name)
        return self.spark.read.parquet(r["path"]) if r else None

    def made(self, name: str, build: Callable[[], DataFrame], inputs: tuple[str, ...] = (), settings: str = "", again: Callable[[DataFrame], bool] | None = None) -> DataFrame:
        """The table of a stage, built only if its settings or inputs differ from those of the last one.

        again: whether a table that was just built is unfinished, as with failed requests; the
        stage is then run again the next time although nothing changed.
        """
        source = hashlib.sha256("|".join([name, settings, *(f"{i}={self.digests[i]}" for i in inputs)]).encode()).hexdigest()
        last = self.last(name)
        if last is None or last["source"] != source or not last["whole"]:
            path = f"{self.work}/tables/{name}/{ledger.stamp()}"
            build().write.parquet(path)
            df = self.spark.read.parquet(path)
            last = {"path": path, "source": source, "digest": digest(df), "whole": not (again and again(df)), "at": time.time()}
            ledger.put(self.spark, f"{self.work}/ledger/{name}", last)
            self.ran.append(name)
        self.digests[name] = last["digest"]
        return self.spark.read.parquet(last["path"])

    def sweep(self, keep: int = 2, lease: float = 86_400) -> list[str]:
        """Remove tables that are neither among the last `keep` of their stage nor younger than the lease in seconds."""
        gone = []
        for name in ledger.names(self.spark, f"{self.work}/tables"):
            known = ledger.records(self.spark, f"{self.work}/ledger/{name}")
            stay = {r["path"] for r in known[-keep:]}
            for table in ledger.names(self.spark, f"{self.work}/tables/{name}"):
                path = f"{self.work}/tables/{name}/{table}"
                if path not in stay and int(table.partition("-")[0]) / 1e9 < time.time() - lease:
                    ledger.remove(self.spark, path)
                    gone.append(path)
        return gone


@dataclass(frozen=True)
class Adapters:
    """What a deployment provides. Without `vision`, scanned replies keep the words of OCR; without `repair`, tables stay as printed.

    reply, finding and repair answer requests (request_id, system, prompt, max_tokens); what
    they answer is stored in the work folder, under the name of the model.
    """

    reply: Ask
    finding: Ask
    repair: Ask | None = None
    model: str = "replay"
    native: readers.Extractor = readers.pdf_text
    ocr: readers.Extractor = readers.pdf_ocr
    vision: page_reads.PageReader | None = None
    render: page_reads.Renderer = page_reads.rendered
    witness: page_reads.PageReader = page_reads.witnessed
    read: Callable[[str], bytes] = readers.read_bytes
    prompts: dict[str, stages.Prompt] = field(default_factory=dict)
    descriptions: DataFrame | None = None


@dataclass(frozen=True)
class Result:
    """The tables of a run by name, the stages that had to run, and the outcome of the checks."""

    tables: dict[str, DataFrame]
    ran: list[str]
    outcome: gate.Outcome

    @property
    def status(self) -> int:
        return self.outcome.status


def _failed(df: DataFrame) -> bool:
    return not df.where("status = 'failed'").isEmpty()


def texts_of(jobs: DataFrame, before: DataFrame | None, adapters: Adapters) -> DataFrame:
    """jobs with native_pages, text, how and error: texts of files that are as they were are taken from before.

    A text file is read plainly; a PDF by its text layer, and by OCR where that is poor.
    """
    same = ["path", "bytes", "modified"]
    got = ["native_pages", "text", "how", "error"]
    todo = jobs
    kept = None
    if before is not None:
        known = before.where("error is null").select(*same, *got).dropDuplicates(same)
        kept = jobs.join(known, same)
        todo = jobs.join(known.select(*same), same, "left_anti")
    plain = readers.extracted(todo.where(F.lower("file").endswith(".txt")), readers.plain_text, read=adapters.read).withColumn("how", F.lit("native"))
    native = readers.extracted(todo.where(~F.lower("file").endswith(".txt")), adapters.native, read=adapters.read).withColumnsRenamed({"text": "native", "pages": "native_pages", "error": "native_error"})
    poor = F.coalesce(X.needs_reread("native", F.coalesce("native_pages", F.lit(1))), F.lit(True))
    good = native.where(~poor).select(*todo.drop("pages").columns, "native_pages", F.col("native").alias("text"), F.lit("native").alias("how"), F.col("native_error").alias("error"))
    again = readers.extracted(native.where(poor), adapters.ocr, out="ocr", read=adapters.read)
    chosen = F.when(F.col("ocr").isNull(), F.struct(F.col("native").alias("text"), F.lit("native").alias("how"))).when(F.col("native").isNull(), F.struct(F.col("ocr").alias("text"), F.lit("ocr").alias("how")))
    chosen = chosen.otherwise(ops.choose_text("native", "ocr", F.coalesce("native_pages", F.lit(1))))
    again = again.withColumn("c", chosen).select(*todo.drop("pages").columns, F.coalesce("native_pages", "pages").alias("native_pages"), F.col("c.text").alias("text"), F.col("c.how").alias("how"), F.when(F.col("c.text").isNull(), F.coalesce("native_error", "error")).alias("error"))
    out = plain.withColumnRenamed("pages", "native_pages").select(again.columns).unionByName(good.select(again.columns)).unionByName(again)
    return out.unionByName(kept.select(out.columns)) if kept is not None else out


def run_folder(spark: SparkSession, root: str, work: str, workbook: str, adapters: Adapters, only_case: str | None = None, notice_only: bool = False) -> Result:
    """Files of <root>/<case>/<role>/ (PDF or text) to a workbook, and the status of all checks.

    A second run over the same files asks nothing, extracts nothing and writes nothing but
    the outcome. only_case: the key of one case, for which all later tables are made.
    """
    s = Stages(spark, work)
    folders = readers.case_folders(spark, root)
    listed = readers.pdf_files(spark, root, ("pdf", "txt")).withColumn("pages", F.lit(None).cast("long"))
    inventory = s.made("inventory", lambda: ops.inventory(listed, folders, r"(?i)\.(pdf|txt)$", ("path", "modified")), settings=f"{root}|{digest(listed)}|{digest(folders)}")
    only = f"case_id = {only_case!r}" if only_case else "true"
    jobs = ops.extraction_jobs(inventory.where("file is not null"))
    before = s.table("texts")

    def read_texts() -> DataFrame:
        mine = texts_of(jobs.where(only), before, adapters)
        if not only_case or before is None:
            return mine
        others = jobs.where(f"not ({only})").select("path", "bytes", "modified")  # what is known of other cases stays
        return mine.unionByName(before.join(others, ["path", "bytes", "modified"], "left_semi").select(mine.columns))

    texts = s.made("texts", read_texts, ("inventory",), only, again=lambda t: not t.where("error is not null").isEmpty()).where(only)

    reads = None
    if adapters.vision:
        scans = ops.scanned_replies(texts).select("case_id", "file", "path", F.col("native_pages").alias("pages"))
        witness = s.made("witness_pages", lambda: page_reads.witness_reads(scans, adapters.render, adapters.witness, read=adapters.read), ("texts",), only)
        vision = s.made("vision_pages", lambda: page_reads.vision_reads(witness, f"{work}/answers/vision", adapters.vision, adapters.model, adapters.render, read=adapters.read), ("witness_pages",), adapters.model, again=lambda v: not v.where("response is null").isEmpty())
        judged = s.made("pages", lambda: page_ops.judged(vision, witness), ("vision_pages", "witness_pages"))
        reads = s.made("page_texts", lambda: page_ops.reassembled(judged), ("pages",))
        s.digests["read"] = hashlib.sha256((s.digests["texts"] + s.digests["page_texts"]).encode()).hexdigest()
        better = reads.select("case_id", "file", F.col("text").alias("page_text"))
        texts = texts.join(better, ["case_id", "file"], "left").withColumns({"text": F.when((F.col("role") == "reply") & F.col("page_text").isNotNull(), F.col("page_text")).otherwise(F.col("text")), "how": F.when((F.col("role") == "reply") & F.col("page_text").isNotNull(), "vision").otherwise(F.col("how"))}).drop("page_text")
    else:
        s.digests["read"] = s.digests["texts"]

    words = texts.withColumn("text", F.coalesce("text", F.lit("")))
    # the notice is the spine: a case without one has no rows further on
    notice_docs = words.where("role = 'scn' and size_rank = 1").select("case_id", "file", "text")
    reply_texts = words.where("role = 'reply'").select("case_id", "file", "text", "size_rank")
    order_texts = words.where("role = 'order' and size_rank = 1").select("case_id", "file", "text")

    notices = s.made("notices", lambda: stages.notices(notice_docs)[0], ("read",), only)
    sections = s.made("sections", lambda: stages.notices(notice_docs)[1], ("read",), only)

    def asking(name: str, ask: Ask) -> stages.Answer:
        return completions.cache_through(f"{work}/answers/{name}", ask)

    def options(name: str) -> dict:
        return {"prompt": adapters.prompts[name]} if name in adapters.prompts else {}

    told = digest(adapters.descriptions) if adapters.descriptions is not None else ""

    def settings(name: str) -> str:
        return f"{adapters.model}|{adapters.prompts.get(name)}|{told}|{only}"

    repairs = None
    if adapters.repair:
        repairs = s.made("repairs", lambda: stages.repairs(sections, asking("repair", adapters.repair), model=adapters.model, **options("repair")), ("sections",), settings("repair"))
    replies = s.made("replies", lambda: stages.replies(reply_texts, sections, asking("reply", adapters.reply), model=adapters.model, descriptions=adapters.descriptions, **options("reply")), ("read", "sections"), settings("reply"), again=_failed)
    findings = s.made("findings", lambda: stages.findings(order_texts, sections, asking("finding", adapters.finding), model=adapters.model, descriptions=adapters.descriptions, **options("finding")), ("read", "sections"), settings("finding"), again=_failed)
    parts = ("sections", "notices", "replies", "findings", *(("repairs",) if repairs is not None else ()))
    register = s.made("register", lambda: reg.register(sections, notices, replies, findings, repairs), parts)
    contents = s.made("contents", lambda: reg.contents(register, reg.param_dim(spark)), ("register",))
    book = ledger.records(spark, f"{work}/ledger/workbook")
    source = f"{workbook}|{s.digests['register']}|{notice_only}"
    if not book or book[-1]["source"] != source or not ledger.exists(spark, workbook):
        sinks.register_workbook(register, contents, workbook, notice_only, f"{work}/sheets")
        ledger.put(spark, f"{work}/ledger/workbook", {"source": source, "path": workbook})
        s.ran.append("workbook")

    witness_text = reads.select("case_id", "file", "text", "witness_text") if reads is not None else None
    found = s.made("violations", lambda: gate.violations(notice_docs, notices, sections, replies, findings, repairs, witness_text), ("read", *parts))
    outcome = gate.judge(spark, found, sections, f"{work}/marks" + (f"/{only_case}" if only_case else ""))
    tables = {"inventory": inventory, "texts": texts, "notices": notices, "sections": sections, "repairs": repairs, "replies": replies, "findings": findings, "register": register, "contents": contents, "violations": found, "page_texts": reads}
    return Result({k: v for k, v in tables.items() if v is not None}, s.ran, outcome)
