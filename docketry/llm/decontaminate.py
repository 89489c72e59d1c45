"""Benchmark decontamination by template canonicalisation (operator 5), DataFrame functions only.

Numbers, names (a run of capitalised words is one) and units become typed placeholders, so a
question asked again with other figures or names has the same template. Template windows of five words are hashed
and joined with those of the benchmark; a document covers an item when it holds at least
three quarters of the item's windows. Aligned windows then show which value stands in the
place of which: a true copy replaces each value of the item by one value throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

WINDOW, COVER, CONSISTENT = 5, 0.75, 0.75
#: Benchmark windows are broadcast up to this many (some tens of MB), else joined by shuffle.
BROADCAST_WINDOWS = 500_000
# The units that become a placeholder.
UNITS = "km|cm|mm|kg|mg|ml|kb|mb|gb|tb|km/h|mph|hours?|minutes?|seconds?|days?|weeks?|months?|years?|meters?|metres?|miles?|grams?|liters?|litres?|percent|dollars?|euros?|usd|eur|%|€|\\$"
# _NAME is the SQL twin's pattern of single names; here a run of them is first tied into one word.
# A capital is looked for first, then what stands before it, as most characters are none.
_TIE, _TIED = "(\\p{Lu}(?<![^\\s(\"\\[]\\p{Lu})[\\p{L}'-]*)\\s+(?=\\p{Lu})", "\\p{Lu}(?<![^\\s(\"\\[]\\p{Lu})[\\p{L}'-]*+(?:\\x1f\\p{Lu}[\\p{L}'-]*+)*+"
_NAME, _NUMBER, _UNIT = "([\\p{Ll}0-9,;] )\\p{Lu}[\\p{L}'-]*", "(^|[^\\p{L}0-9§])[0-9]+([.,:/][0-9]+)*", f"(§num ?)({UNITS})([^\\p{{L}}]|$)"
#: Here the longest unit that fits counts (km/h before km); the twin tries them in the order above.
_LONGEST = _UNIT.replace(UNITS, "|".join(sorted(UNITS.split("|"), key=lambda u: -len(u))))
_TAIL, _HEAD = '[.,;:!?()"\\[\\]]+(\\s|$)', '(^|\\s)[("\\[]+'
#: The same matches as those of _NUMBER and _TAIL, but runs are taken whole: Java recurses for each
#: turn of a group that may give back, and a long list of numbers or names would overflow the stack of a task.
_NUMBERS, _TAILS = "(^|[^\\p{L}0-9§])[0-9]++(?:[.,:/][0-9]++)*+", '(?<![.,;:!?()"\\[\\]])[.,;:!?()"\\[\\]]++(\\s|$)'


def templates(text: F.Column) -> tuple[F.Column, F.Column]:
    """(template words, plain words): two arrays with a template word for each plain word."""
    text = F.coalesce(text, F.lit(""))
    figures, openings = text.rlike("[0-9]"), text.rlike('[("\\[]')  # most texts have neither, and passes over them are saved

    def words(t):
        t = F.regexp_replace(t, _TAILS, "$1")
        t = F.when(openings, F.regexp_replace(t, _HEAD, "$1")).otherwise(t)
        return F.filter(F.split(F.lower(t), r"\s+"), lambda w: w != "")

    tied = F.regexp_replace(text, _TIE, "$1\x1f")
    named = F.regexp_replace(tied, _TIED, "§name")
    marked = F.when(figures, F.regexp_replace(F.regexp_replace(named, _NUMBERS, "$1§num"), _LONGEST, "$1§unit$3")).otherwise(named)
    return words(marked), words(tied)


def windows(frame: DataFrame, key: str, n: int = WINDOW) -> DataFrame:
    """(key, pos, h, plain): the template windows of (key, text); a shorter text is one window."""
    t, w = templates(F.col("text"))
    # not deterministic to the optimizer, so that no filter on t is pushed below and takes the template twice
    once = F.when(F.spark_partition_id() >= 0, F.struct(t.alias("t"), w.alias("w")))
    frame = frame.select(key, once.alias("x")).select(key, "x.t", "x.w").where(F.size("t") > 0)
    frame = frame.select(key, "t", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("t") - n, F.lit(0)))).alias("pos"))
    part = [F.get("t", F.col("pos") + k) for k in range(n)]
    return frame.select(key, "pos", F.xxhash64(*part).alias("h"), F.slice("w", F.col("pos") + 1, n).alias("plain"), F.slice("t", F.col("pos") + 1, n).alias("marks"))


def contamination(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, consistent: float = CONSISTENT) -> DataFrame:
    """(doc_id, item_id, cover, consistency) of every document (doc_id, text) that holds a benchmark item (item_id, text).

    Null, empty and wordless texts match nothing. Repeated items count as one by their
    windows. Items without a placeholder are consistent. Rows without an id are left out.
    """
    item = windows(benchmark.select("item_id", "text").where("item_id is not null"), "item_id")
    item = item.where(F.exists("marks", lambda w: ~w.startswith("§")))  # placeholders alone say nothing
    item = item.groupBy("item_id", "h").agg(F.min_by(F.struct(F.col("pos").alias("pos"), "plain", "marks"), "pos").alias("i"))
    item = cut(item.select("item_id", "h", F.col("i.pos").alias("item_pos"), F.col("i.plain").alias("item_plain"), "i.marks"), "items")
    total = item.groupBy("item_id").agg(F.count("*").alias("total"))
    side = F.broadcast(item) if item.count() <= BROADCAST_WINDOWS else item
    doc = windows(docs.select("doc_id", "text").where("doc_id is not null"), "doc_id").drop("marks")
    hit = cut(doc.join(side, "h"), "hits")
    held = hit.groupBy("doc_id", "item_id").agg(F.count_distinct("h").alias("found")).join(total, "item_id")
    held = held.select("doc_id", "item_id", (F.col("found") / F.col("total")).alias("cover")).where(F.col("cover") >= cover)
    slot = F.filter(F.arrays_zip("marks", F.col("item_plain"), "plain"), lambda s: s["marks"].startswith("§"))
    slots = hit.join(held, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), F.explode(slot).alias("s"))
    slots = slots.groupBy("doc_id", "item_id", "shift", F.col("s.item_plain").alias("value")).agg(F.min("s.plain").alias("low"), F.max("s.plain").alias("high"))
    slots = slots.groupBy("doc_id", "item_id").agg(F.avg((F.col("low") == F.col("high")).cast("double")).alias("consistency"))
    both = held.join(slots, ["doc_id", "item_id"], "left").withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
    return both.where(F.col("consistency") >= consistent)


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_items, item_id (the lowest held), contaminated."""
    found = contamination(docs, benchmark).groupBy("doc_id").agg(F.count("*").alias("n_items"), F.min("item_id").alias("item_id"))
    out = docs.select("doc_id").where("doc_id is not null").join(found, "doc_id", "left")
    return out.select("doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id", F.col("item_id").isNotNull().alias("contaminated"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    def words(t):
        return f"list_filter(string_split_regex(lower(regexp_replace(regexp_replace({t}, '{_TAIL}', '\\1', 'g'), '{_HEAD}', '\\1', 'g')), '\\s+'), lambda w: w <> '')"

    marked = f"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{_NAME.replace(chr(39), chr(39) * 2)}', '\\1§name', 'g'), '{_NUMBER}', '\\1§num', 'g'), '{_UNIT}', '\\1§unit\\3', 'g')"

    def wins(key, frame):
        return f"""select {key}, pos, array_to_string(t[pos + 1 : pos + {WINDOW}], ' ') as h, w[pos + 1 : pos + {WINDOW}] as plain, t[pos + 1 : pos + {WINDOW}] as marks
  from (select {key}, t, w, unnest(range(0, greatest(len(t) - {WINDOW}, 0) + 1)) as pos from (select {key}, {words(marked)} as t, {words("coalesce(text, '')")} as w from {frame}) where len(t) > 0)"""

    return f"""
with iw as (select * from ({wins("item_id", "benchmark")}) where len(list_filter(marks, lambda w: not starts_with(w, '§'))) > 0),
item as (select item_id, h, min(pos) as item_pos, arg_min(plain, pos) as item_plain, arg_min(marks, pos) as marks from iw group by 1, 2),
total as (select item_id, count(*) as total from item group by 1),
doc as ({wins("doc_id", "documents")}),
hit as (select doc.doc_id, doc.pos, doc.plain, item.* from doc join item using (h)),
held as (select doc_id, item_id, count(distinct h) / total as cover from hit join total using (item_id) group by doc_id, item_id, total having count(distinct h) / total >= {COVER}),
slots as (select doc_id, item_id, pos - item_pos as shift, unnest(range(1, len(marks) + 1)) as k, marks, item_plain, plain from hit semi join held using (doc_id, item_id)),
s1 as (select doc_id, item_id, shift, item_plain[k] as value, min(plain[k]) as low, max(plain[k]) as high from slots where starts_with(marks[k], '§') group by 1, 2, 3, 4),
s2 as (select doc_id, item_id, avg((low = high)::int) as consistency from s1 group by 1, 2),
found as (select doc_id, count(*) as n_items, min(item_id) as item_id from held left join s2 using (doc_id, item_id) where coalesce(consistency, 1) >= {CONSISTENT} group by 1)
select doc_id, coalesce(n_items, 0)::bigint as n_items, item_id, item_id is not null as contaminated from documents left join found using (doc_id)"""


ORACLE_SQL = _sql()
