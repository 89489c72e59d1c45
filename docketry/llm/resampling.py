"""Importance resampling toward a target distribution (operator 11).

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased: digits, a-z
and everything beyond ASCII. A text's features are its runs of 1 to n words, joined by one
space; a feature's bucket is the unsigned crc32 of its bytes modulo the number of buckets.

The ring: one scan of a text keeps the running crc32 states of the last n starts. Each new
word extends them by a space and the word and opens a state of its own, so no feature is
ever put together as a string. The first scan counts buckets (map-side, one row a bucket and
task); the second sums the gains of a text's buckets and needs one number a bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Longest run of words, number of buckets, fewest words of a document that can be drawn, percent drawn, seed.
RUN, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: Bytes of a text whose words are held at once.
PIECE = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a whole text, in lists of a piece each."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


def ring(text: bytes, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of each piece of a text."""
    states: list[int] = []
    for piece in words(text):
        out: list[int] = []
        for word in piece:
            after = b" " + word
            states = [crc32(after, s) for s in states[len(states) - n + 1 :]] if n > 1 else []
            states.append(crc32(word))
            out += states
        yield len(piece), np.array(out, np.uint32) % np.uint32(buckets)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for text in batch.column(column).cast(pa.large_binary()):
        yield text.as_py() or b""


def bucket_counts(df: DataFrame, n: int = RUN, buckets: int = BUCKETS, column: str = "text") -> DataFrame:
    """(bucket, n) over all texts; buckets without a feature are absent, null texts have none."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch, 0):
                for _, found in ring(text, n, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    return df.select(column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, n: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): how much likelier a feature of the bucket is in target than in docs, in thousandths of a nat."""
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(bucket_counts(docs, n, buckets).withColumnRenamed("n", "s"), "bucket", "left").join(bucket_counts(target, n, buckets).withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    whole = Window.partitionBy()  # one row a bucket
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    all_s, all_t = F.sum("s").over(whole).cast("double"), F.sum("t").over(whole).cast("double")
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(((t + 1) * (all_s + float(buckets))) / ((s + 1) * (all_t + float(buckets))))).alias("gain"))


def weighted(docs: DataFrame, gain: DataFrame, n: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of docs; weight is the mean gain of its features, rounded down."""
    by_bucket = np.zeros(buckets, np.int64)
    for row in gain.collect():  # one number a bucket: bounded by the parameter
        by_bucket[row["bucket"]] = row["gain"]

    def run(batches):
        for batch in batches:
            rows = []
            for text in _texts(batch, 1):
                count = features = total = 0
                for m, found in ring(text, n, buckets):
                    count, features, total = count + m, features + len(found), total + int(by_bucket[found].sum())
                rows.append((count, features, total // features if features else 0))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, n: int = RUN, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_features, weight, score, rank.

    target has a column text. score is weight plus Gumbel noise that depends on seed and
    doc_id alone; of the N documents with at least least_words words the floor(percent*N/100)
    with the highest scores are drawn, ties to the smaller doc_id, and rank numbers them from
    1; the others have a null rank. Null, empty and wordless texts have no features and
    weight 0. A row without a doc_id counts among the features, has null score and is never
    drawn nor counted in N. Repeated rows are rows of their own; of equal ones any comes
    first. Empty docs give no rows, an empty target leaves plain add-one gains. Other columns
    are not read.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    rows = cut(weighted(docs, gains(docs, target, n, buckets), n, buckets).withColumn("score", F.col("weight") + noise), "resample")
    # Scores are whole numbers in a range that ln() of 64-bit counts and of h bounds (some 10^5 values),
    # so a histogram of them finds the last score drawn and where the ranks of each score begin.
    able = F.col("n_words") >= least_words
    histogram = rows.where(able & F.col("score").isNotNull()).groupBy("score").agg(F.count("*").alias("held"))
    down = Window.orderBy(F.col("score").desc())
    draw = F.floor(F.sum("held").over(Window.partitionBy()) * percent / 100)
    begin = histogram.select("score", (F.sum("held").over(down) - F.col("held")).alias("before"), draw.alias("draw")).where("before < draw")
    begin = begin.select(F.col("score").alias("at"), "before", "draw")
    # Noise spreads any group of texts over many scores: no score holds more than some 0.04 % of the documents.
    tops = rows.where(able).join(F.broadcast(begin), F.col("score") == F.col("at"))
    tops = tops.withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")))
    tops = tops.withColumn("rank", F.when(F.col("rank") <= F.col("draw"), F.col("rank")))
    rest = rows.join(F.broadcast(begin), able & (F.col("score") == F.col("at")), "left_anti").withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return tops.select(out).unionByName(rest.select(out))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The crc32 of one byte with only bit 0, 1, ... 7 set, before it is shifted in.
_BITS = (0x77073096, 0xEE0E612C, 0x076DC419, 0x0EDB8832, 0x1DB71064, 0x3B6E20C8, 0x76DC4190, 0xEDB88320)


def _sql() -> str:
    """crc32 is linear: a step xors the constants of the bits set in the lowest byte."""
    step = "c >> 8"
    for bit, constant in enumerate(_BITS):
        step = f"xor({step}, ((xor(c, b) >> {bit}) & 1) * {constant})"
    hexed = "hex(encode(f))"
    data = f"list_prepend(4294967295::bigint, list_transform(range(1, length({hexed}), 2), lambda i: ('0x' || substr({hexed}, i, 2))::bigint))"
    return rf"""
with texts as (select 0 as side, doc_id, row_number() over () as r, text from documents union all select 1, null, row_number() over (), text from benchmark),
w as (select side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
e as (select side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from w),
d as (select f, xor(list_reduce({data}, lambda c, b: {step}), 4294967295) % {BUCKETS} as bucket from (select distinct f from e)),
k as (select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from e join d using (f) group by 1),
n as (select sum(s)::double as ss, sum(t)::double as tt from k),
g as (select bucket, floor(1000::double * ln(((t + 1)::double * (tt.ss + {BUCKETS}::double)) / ((s + 1)::double * (tt.tt + {BUCKETS}::double))))::bigint as gain from k cross join n as tt),
p as (select r, count(*) as n_features, sum(gain) as total from e join d using (f) join g using (bucket) where side = 0 group by 1),
x as (select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(((total - (((total % n_features) + n_features) % n_features)) // n_features), 0)::bigint as weight from w left join p using (r) where side = 0),
y as (select *, weight + floor(-1000::double * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score from x),
z as (select *, row_number() over (partition by n_words >= {LEAST_WORDS} and score is not null order by score desc, doc_id, n_features, weight) as k, count(*) filter (n_words >= {LEAST_WORDS} and score is not null) over () as n from y)
select doc_id, n_features, weight, score, case when n_words >= {LEAST_WORDS} and score is not null and k <= {PERCENT} * n // 100 then k end as rank from z"""


ORACLE_SQL = _sql()
