"""Page rows, answers through a store, the gate, and the run from a folder to the workbook."""

from __future__ import annotations

import http.server
import json
import threading
import uuid
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docketry.operators import checks, pages
from docketry.plans import gate, run
from docketry.sources import completions, ledger, page_reads

KEY = "case_id string, file string, page int"
NOTICE = """(Legal Name: (Tvl. Sun Mills (India) Private Limited, 12 Road))
1. Short paid of tax on taxable supplies reported
in GSTR-09:
Turnover 12,34,567 was not paid in time by the dealer.
Scrutiny of ITC reversal s
Rule 42 reversals fall short by 98765 rupees in all.
Summary :
"""
REPLY = "We submit that turnover 12,34,567 was paid in April as the books show clearly\nKindly drop.\n" + "We submit that the books were kept in order. " * 12
ORDER = "It is proposed to be taxed at 18 percent\nthe demand of 98765 rupees is hereby confirmed by me\n"


# ------------------------------------------------------------------ pages

def test_pages_are_fanned_out_judged_and_put_together(spark):
    files = spark.createDataFrame([("c", "f", 35), ("c", "g", 1), ("c", "h", 0), ("c", "i", None)], "case_id string, file string, pages int")
    assert sorted((r["file"], r["first_page"], r["last_page"]) for r in pages.page_ranges(files).collect()) == [("f", 1, 16), ("f", 17, 32), ("f", 33, 35), ("g", 1, 1)]
    words = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"made{k}" for k in range(200))
    witness = [("c", "f", p, t) for p, t in enumerate([words, words, words, "", "", None, words, words, "x"], 1)] + [("c", "g", 1, words)]
    model = [(words + " end", None), ("<<BLANK>>", None), (other, None), (other, None), ("few words", None), (None, "TimeoutError: slow"), (None, None), (" ", None)]
    model = [("c", "f", p, t, e) for p, (t, e) in enumerate(model, 1)]
    got = pages.judged(spark.createDataFrame(model, f"{KEY}, response string, error string"), spark.createDataFrame(witness, f"{KEY}, text string"))
    rows = {(r["file"], r["page"]): (r["text"], r["verdict"]) for r in got.collect()}
    assert rows["f", 1] == (words + " end", "ok-0.98") and rows["f", 2] == (words, "blank") and rows["f", 3] == (words, "drift-0.00")
    assert rows["f", 4] == ("", "invented-on-blank-page") and rows["f", 5] == ("few words", "ok-sparse") and rows["f", 6] == ("", "model-failed-TimeoutError")
    assert rows["f", 7] == (words, "model-failed-unknown") and rows["f", 8] == (words, "blank") and rows["f", 9] == ("x", "model-failed-missing") and rows["g", 1] == (words, "model-failed-missing")
    whole = {r["file"]: r for r in pages.reassembled(got.repartition(3)).collect()}
    assert whole["f"]["pages"] == 9 and whole["f"]["text"] == "\n".join([words + " end", words, words, "few words", words, words, "x"])
    assert whole["f"]["caught"][:3] == ["p2:blank", "p3:drift-0.00", "p4:invented-on-blank-page"] and len(whole["f"]["caught"]) == 7
    assert {r["verdict"]: r["pages"] for r in pages.verdict_tally(got).collect()} == {"ok": 1, "blank": 2, "drift": 1, "invented-on-blank-page": 1, "ok-sparse": 1, "model-failed": 4}
    empty = spark.createDataFrame([], f"{KEY}, text string")
    assert pages.reassembled(pages.judged(spark.createDataFrame([], f"{KEY}, response string, error string"), empty)).collect() == []


def scans(tmp_path, n=2):
    """Files whose pages stand between form feeds, and readers of them that note each call."""
    words = " ".join(f"word{k}" for k in range(40))
    for k in range(n):
        (tmp_path / f"s{k}.pdf").write_bytes("\f".join([f"{words} first {k}", "same page " + words, "bad"]).encode())
    calls = tmp_path / "calls"
    calls.mkdir(exist_ok=True)
    where = str(calls)

    def render(pdf, first, last):
        return pdf.split(b"\f")[first - 1 : last]

    def vision(image):
        (Path(where) / uuid.uuid4().hex).write_bytes(image)
        if image == b"bad":
            raise ValueError("unreadable")
        return image.decode() + " seen"

    return render, vision, (lambda image: image.decode()), calls


def test_page_reads_go_through_the_store(spark, tmp_path):
    render, vision, witness, calls = scans(tmp_path)
    files = spark.createDataFrame([(f"c{k}", f"s{k}.pdf", f"file:{tmp_path}/s{k}.pdf", 3) for k in range(2)] + [("c9", "gone.pdf", f"file:{tmp_path}/gone.pdf", 1)], "case_id string, file string, path string, pages int")
    seen = page_reads.witness_reads(files, render, witness).cache()
    assert seen.count() == 7 and seen.where("digest is null").first()["error"].startswith("FileNotFoundError")
    read = page_reads.vision_reads(seen, f"{tmp_path}/store", vision, "m", render)
    got = {(r["case_id"], r["page"]): (r["response"], r["error"]) for r in read.collect()}
    assert got["c0", 2] == got["c1", 2] and got["c0", 1][0].endswith("first 0 seen") and got["c0", 3] == (None, "ValueError: unreadable") and got["c9", 1][0] is None
    assert len(list(calls.iterdir())) == 4  # three pages differ, one cannot be read; equal pages are read once
    page_reads.vision_reads(seen, f"{tmp_path}/store", vision, "m", render).collect()
    assert len(list(calls.iterdir())) == 5  # only the failed one again
    verdicts = {(r["case_id"], r["page"]): r["verdict"] for r in pages.judged(read, seen).collect()}
    assert verdicts["c0", 1].startswith("ok-") and verdicts["c1", 3] == "model-failed-ValueError" and verdicts["c9", 1] == "model-failed-FileNotFoundError"


# ------------------------------------------------------------------ the store of answers

def requests_of(spark, n, words="q"):
    return completions.with_request_id(spark.range(n).select(F.lit("s").alias("system"), F.concat(F.lit(words), F.col("id").cast("string")).alias("prompt"), F.lit(5).alias("max_tokens")), "m")


def counting(folder, stop=None, bad=()):
    folder.mkdir(exist_ok=True)
    where = str(folder)

    def ask(system, user, n):
        (Path(where) / uuid.uuid4().hex).write_text(user)
        if user in bad:
            raise ValueError("no")
        if stop and Path(stop).exists() and user == "q7":
            import os

            os._exit(1)  # the worker dies
        return f"<think>hm</think>{user}!"

    return lambda r: completions.complete(r, ask, parallel=2)


def test_answers_are_asked_once_and_failed_ones_again(spark, tmp_path):
    ask, calls = counting(tmp_path / "calls", bad=("q3",)), tmp_path / "calls"
    requests = requests_of(spark, 10)
    got = completions.cached(requests.union(requests), f"{tmp_path}/store", ask, batch=3)
    rows = {r["response"]: r["error"] for r in got.collect()}
    assert len(rows) == 10 and rows["q1!"] is None and rows[None] == "ValueError: no" and len(list(calls.iterdir())) == 10
    assert completions.cached(requests_of(spark, 12), f"{tmp_path}/store", counting(calls), batch=3).where("error is null").count() == 12
    assert len(list(calls.iterdir())) == 13 and ledger.names(spark, f"{tmp_path}/store-pending") == []
    completions.compact(spark, f"{tmp_path}/store")
    assert len(ledger.whole(spark, f"{tmp_path}/store")) == 1 and completions.stored(spark, f"{tmp_path}/store").where("error is null").count() == 12
    assert completions.cached(requests, f"{tmp_path}/store", counting(calls)).where("response is null").count() == 0 and len(list(calls.iterdir())) == 13
    silent = completions.cached(requests_of(spark, 1, "new"), f"{tmp_path}/other", lambda r: spark.createDataFrame([], completions.ANSWER))
    assert silent.first()["error"] == "no answer stored"


def test_a_run_that_was_killed_goes_on(spark, tmp_path):
    (tmp_path / "stop").write_text("")
    calls, requests = tmp_path / "calls", requests_of(spark, 30)
    with pytest.raises(Exception):  # noqa: B017, PT011 - whatever Spark makes of a dead worker
        completions.cached(requests, f"{tmp_path}/store", counting(calls, f"{tmp_path}/stop"), batch=4)
    kept = completions.stored(spark, f"{tmp_path}/store").count()
    (tmp_path / "stop").unlink()
    before = len(list(calls.iterdir()))
    assert completions.cached(requests, f"{tmp_path}/store", counting(calls, f"{tmp_path}/stop"), batch=4).where("error is null").count() == 30
    assert len(list(calls.iterdir())) - before == 30 - kept


def test_the_http_client_streams_and_tries_again(tmp_path):
    asked = []

    class Model(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(500 if len(asked) == 1 else 200)
            self.end_headers()
            if len(asked) > 1:
                for part in ("He", "llo"):
                    self.wfile.write(f"data: {json.dumps({'choices': [{'delta': {'content': part}}]})}\n\n".encode())
                self.wfile.write(b"data: not json\n\ndata: [DONE]\n\n")

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    assert completions.http_completer(url, "m", "k", json_mode=True)("s", "u", 9) == "Hello"
    assert len(asked) == 2 and asked[1]["temperature"] == 0 and asked[1]["messages"][1]["content"] == "u" and asked[1]["response_format"] == {"type": "json_object"}
    assert page_reads.vision_reader(url, "m", "transcribe")(b"png") == "Hello"
    assert asked[2]["messages"][0]["content"][1]["image_url"]["url"] == "data:image/png;base64,cG5n" and len(asked[2]["messages"]) == 1
    server.shutdown()


# ------------------------------------------------------------------ the gate

def test_the_mark_is_the_best_of_all_clean_runs(spark, tmp_path):
    marks = f"{tmp_path}/marks"
    section = spark.createDataFrame([(f"c{k}", "A1") for k in range(10)], "case_id string, param_id string")
    none = spark.createDataFrame([], "check string, case_id string, param_id string, detail string")
    assert gate.mark(spark, marks).collect() == []
    first = gate.judge(spark, none, section, marks)
    assert first.status == 0 and first.lines()[-1] == "all checks passed" and gate.mark(spark, marks).first()["cells"] == 10
    ledger.put(spark, marks, {"cases": 8, "cells": 20})  # another run, at the same time
    assert tuple(gate.mark(spark, marks).first()) == (10, 20)
    (tmp_path / "marks" / "00.json").write_text("{cut off")
    (tmp_path / "marks" / "01.json").write_text('{"cases": "x"}')
    short = gate.judge(spark, none, section, marks)
    assert short.status == 1 and short.lines()[-1] == "1 check(s) failed: cells floor" and len(ledger.records(spark, marks)) == 3
    bad = spark.createDataFrame([("verdict", "c1", "A1", "settled"), *(("verbatim", f"c{k}", "B1", "") for k in range(9))], none.schema)
    out = gate.judge(spark, bad, section, f"{tmp_path}/new")
    rows = {r["check"]: r for r in out.report.collect()}
    assert out.status == 1 and len(rows) == len(gate.CHECKS) and rows["verbatim"]["violations"] == 9 and rows["verbatim"]["examples"][0] == "c0/B1" and len(rows["verbatim"]["examples"]) <= 4
    assert "FAIL verdict: 1: c1/A1:settled" in out.lines() and gate.mark(spark, f"{tmp_path}/new").collect() == []


# ------------------------------------------------------------------ folder to workbook

def case(root, name, reply=REPLY, kind="txt"):
    for role, text in (("DRC01_SCN", NOTICE), ("DRC 01 Reply", reply), ("DRC 01 Order", ORDER)):
        (root / name / role).mkdir(parents=True)
        ending = kind if role == "DRC 01 Reply" else "txt"
        (root / name / role / f"{role[-3:]} 1.{ending}").write_text(text)


def answering(folder, rules, fail=None):
    folder.mkdir(exist_ok=True)
    where = str(folder)

    def ask(system, user, n):
        (Path(where) / uuid.uuid4().hex).write_text(user)
        if fail and Path(fail).exists():
            raise TimeoutError("busy")
        return next((a for words, a in rules if words in user), '{"items": []}')

    return lambda r: completions.complete(r, ask, parallel=2)


REPLIES = [("1| We submit", '{"items": [{"id": "A1", "lines": [1, 1], "text": "turnover 12,34,567 was paid in April as the books show clearly"}]}')]
FINDINGS = [("1| It is proposed", '{"items": [{"id": "B6", "lines": [2, 2], "text": "the demand of 98765 rupees is hereby confirmed by me", "verdict": "confirmed"}]}')]


def test_a_folder_becomes_a_workbook_and_a_second_run_does_nothing(spark, tmp_path):
    root, calls = tmp_path / "cases", tmp_path / "calls"
    case(root, "33ABCDE1234F1Z5 one")
    case(root, "plain")
    (root / "empty").mkdir()
    (tmp_path / "busy").write_text("")
    adapters = run.Adapters(answering(calls, REPLIES, f"{tmp_path}/busy"), answering(calls, FINDINGS))
    args = (spark, str(root), f"{tmp_path}/work", f"{tmp_path}/out.xlsx", adapters)
    first = run.run_folder(*args)
    assert first.status == 1 and {r["check"] for r in first.tables["violations"].collect()} == {"reply request"}  # a busy model is no silence
    asked = len(list(calls.iterdir()))
    (tmp_path / "busy").unlink()
    second = run.run_folder(*args)
    assert second.status == 0 and second.ran == ["replies", "register", "contents", "workbook", "violations"] and second.outcome.lines()[-1] == "all checks passed"
    assert len(list(calls.iterdir())) > asked
    rows = {(r["case_id"], r["param_id"]): r for r in second.tables["register"].collect()}
    assert len(rows) == 4 and rows["33ABCDE1234F1Z5", "A1"]["reply"].startswith("turnover") and rows["plain", "B6"]["finding"].startswith("the demand") and rows["plain", "B6"]["reply"] == "No reply"
    assert len(zipfile.ZipFile(f"{tmp_path}/out.xlsx").namelist()) > 22
    asked, made = len(list(calls.iterdir())), Path(f"{tmp_path}/out.xlsx").stat().st_mtime_ns
    third = run.run_folder(*args)
    assert third.ran == [] and third.status == 0 and len(list(calls.iterdir())) == asked and Path(f"{tmp_path}/out.xlsx").stat().st_mtime_ns == made

    case(root, "later", REPLY.replace("April", "June"))
    fourth = run.run_folder(*args)
    assert {"inventory", "texts", "replies", "register"} <= set(fourth.ran) and fourth.tables["register"].count() == 6
    assert len(list(calls.iterdir())) == asked + 1  # the new reply; its order was asked about before, word for word
    names = run.Stages(spark, f"{tmp_path}/work")
    assert names.sweep(keep=1, lease=0) and names.table("register").count() == 6 and names.sweep(keep=1, lease=0) == []
    alone = run.run_folder(*args, only_case="plain")
    assert alone.status == 0 and {r["case_id"] for r in alone.tables["register"].collect()} == {"plain"} and len(list(calls.iterdir())) == asked + 1
    texts = run.Stages(spark, f"{tmp_path}/work").table("texts")
    assert texts.select("case_id").distinct().count() == 4 - 1  # the texts of the other cases stay


def test_scanned_replies_are_read_page_by_page(spark, tmp_path):
    root = tmp_path / "cases"
    case(root, "c1", "\f".join([REPLY, "second page " + REPLY]), kind="pdf")
    render, vision, witness, calls = scans(tmp_path, 0)
    adapters = run.Adapters(answering(tmp_path / "asked", REPLIES), answering(tmp_path / "asked", FINDINGS), native=lambda b: ("", b.count(b"\f") + 1), ocr=lambda b: (b.decode().replace("\f", "\n"), b.count(b"\f") + 1), vision=vision, render=render, witness=witness)
    args = (spark, str(root), f"{tmp_path}/work", f"{tmp_path}/out.xlsx", adapters)
    got = run.run_folder(*args)
    assert got.status == 0 and len(list(calls.iterdir())) == 2
    page = got.tables["page_texts"].first()
    assert page["pages"] == 2 and page["text"] == f"{REPLY} seen\nsecond page {REPLY} seen" and page["caught"] == []
    assert {(r["role"], r["how"]) for r in got.tables["texts"].collect()} == {("scn", "native"), ("reply", "vision"), ("order", "native")}
    assert run.run_folder(*args).ran == [] and len(list(calls.iterdir())) == 2
    answer = got.tables["replies"].where("param_id = 'A1'").first()
    assert answer["status"] == "verified" and answer["file"].endswith(".pdf")
    doubt = got.tables["replies"].withColumn("text", F.concat("text", F.lit(" 7,77,777")))
    seen = got.tables["page_texts"].select("case_id", "file", "text", "witness_text")
    assert {r["check"] for r in checks.answer_checks(doubt, got.tables["sections"].select(*checks.KEYS), "reply", seen).collect()} == {"reply witnessed"}
