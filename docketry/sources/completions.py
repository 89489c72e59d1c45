"""Model requests and answers. The model is an adapter; tests and repeats replay a table of answers."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from . import ledger

#: (system, user, max_tokens) -> answer
Completer = Callable[[str, str, int], str]
ANSWER = "request_id string, response string, error string"


def with_request_id(requests: DataFrame, model: str) -> DataFrame:
    """requests with request_id, a digest of the model and all that it is asked."""
    return requests.withColumn("request_id", F.sha2(F.concat_ws("\x1f", F.lit(model), "system", "prompt", F.col("max_tokens").cast("string")), 256))


def http_completer(url: str, model: str, key: str = "", json_mode: bool = False, think: bool = False, tries: int = 3, timeout: int = 900) -> Completer:
    """A chat endpoint that streams, asked at temperature 0; waits 2, 4, 6 s between tries."""

    def ask(system: str, user: str, max_tokens: int) -> str:
        body = {"model": model, "messages": [*([{"role": "system", "content": system}] if system else []), {"role": "user", "content": user}], "max_tokens": max_tokens, "temperature": 0, "stream": True, "chat_template_kwargs": {"enable_thinking": think}}
        if json_mode:
            body["response_format"] = {"type": "json_object"}
        head = {"Content-Type": "application/json", "Accept": "text/event-stream"} | ({"Authorization": f"Bearer {key}"} if key else {})
        last: Exception | None = None
        for k in range(tries):
            try:
                said = []
                with urllib.request.urlopen(urllib.request.Request(f"{url}/chat/completions", json.dumps(body).encode(), head), timeout=timeout) as answer:
                    for line in answer:
                        line = line.decode("utf-8", "replace").strip()
                        if line.startswith("data:") and line != "data: [DONE]":
                            try:
                                said.append(json.loads(line[5:])["choices"][0].get("delta", {}).get("content") or "")
                            except (ValueError, LookupError):
                                continue
                return "".join(said)
            except Exception as e:  # noqa: BLE001 - any failure of a call is tried again
                last = e
                time.sleep(2 * (k + 1))
        raise RuntimeError(f"no answer after {tries} tries: {last}")

    return ask


def complete(requests: DataFrame, completer: Completer, parallel: int = 6) -> DataFrame:
    """(request_id, response, error) of requests (request_id, system, prompt, max_tokens), `parallel` at a time."""

    def run(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    out.append((r.request_id, completer(r.system, r.prompt, int(r.max_tokens)), None))
                except Exception as e:  # noqa: BLE001 - a failure is a row of its own kind
                    out.append((r.request_id, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["request_id", "response", "error"])

    asked = requests.select("request_id", "system", "prompt", "max_tokens").dropDuplicates(["request_id"]).repartition(parallel)
    done = asked.mapInPandas(run, ANSWER)
    return done.withColumn("response", X.strip_think("response"))


def replay(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """(request_id, response, error) from stored answers; a request without one is an error, not a silence."""
    known = answers.select("request_id", "response", "error")
    r = requests.select("request_id").distinct().join(known, "request_id", "left")
    return r.withColumn("error", F.when(F.col("response").isNull(), F.coalesce("error", F.lit("no answer stored"))))


def pending(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that no answer satisfies yet; a failed one does not."""
    return requests.join(answers.where("error is null").select("request_id"), "request_id", "left_anti")


def best_answers(rows: DataFrame) -> DataFrame:
    """(request_id, response, error, asked_at): of several answers to a request a good one, of these the latest."""
    best = F.max_by(F.struct("response", "error", "asked_at"), F.struct(F.col("error").isNull(), "asked_at")).alias("a")
    return rows.groupBy("request_id").agg(best).select("request_id", "a.*")


def stored(spark: SparkSession, store: str) -> DataFrame:
    """(request_id, response, error) of all stored batches, the best of several answers to a request."""
    found = ledger.whole(spark, store)
    if not found:
        return spark.createDataFrame([], ANSWER)
    return best_answers(spark.read.schema(f"{ANSWER}, asked_at long").parquet(*found)).drop("asked_at")


def cached(requests: DataFrame, store: str, ask: Callable[[DataFrame], DataFrame], batch: int = 2000) -> DataFrame:
    """(request_id, response, error) of requests, asking only for what no good answer is stored.

    What is missing is asked in batches of about `batch` requests; each is stored as a folder
    of its own when it is whole, so a run that dies loses the batch it was at and the next one
    goes on from there. Failed requests are asked again. A request for which ask returned no
    row is an error, not a silence. Runs at the same time do no harm but ask twice.
    """
    spark = requests.sparkSession
    wanted = requests.dropDuplicates(["request_id"])
    scratch = f"{store}-pending/{ledger.stamp()}"
    todo = pending(wanted, stored(spark, store)).withColumn("batch_key", F.pmod(F.xxhash64("request_id"), F.lit(1 << 20)))
    todo.write.parquet(scratch)  # the requests as they are asked; none is computed twice
    try:
        todo = spark.read.schema(todo.schema).parquet(scratch)
        parts = -(-todo.count() // batch)
        for k in range(parts):
            part = ask(todo.where(F.col("batch_key") % parts == k).drop("batch_key"))
            part.select("request_id", "response", "error", F.lit(time.time_ns()).alias("asked_at")).write.parquet(f"{store}/{ledger.stamp()}")
    finally:
        ledger.remove(spark, scratch)
    return replay(requests, stored(spark, store))


def cache_through(store: str, ask: Callable[[DataFrame], DataFrame], batch: int = 2000) -> Callable[[DataFrame], DataFrame]:
    """An answer to requests that goes through a store: for the stages, in place of a model."""
    return lambda requests: cached(requests, store, ask, batch)


def compact(spark: SparkSession, store: str) -> None:
    """Put the batches of a store together into one; only batches that it holds are removed."""
    found = ledger.whole(spark, store)
    if len(found) > 1:
        rows = spark.read.schema(f"{ANSWER}, asked_at long").parquet(*found)
        best_answers(rows).write.parquet(f"{store}/{ledger.stamp()}")
        for f in found:
            ledger.remove(spark, f)
