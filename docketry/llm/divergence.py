"""Audit of how the term frequencies of sources diverge within a language (operator 12).

Plain relational: matches are exploded and counted by group; the groups of a language are
joined with its kept vocabulary, which makes the zeros explicit; the dense table is joined
with itself on language and term, summed and ranked. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

TERM, BETWEEN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A term is kept from this many documents of its language on; frequencies are in units of 1/SCALE, counts smoothed by ALPHA.
LEAST_DOCS, ALPHA, SCALE = 3, 1, 1_000_000_000
TOP_TERMS = 200
#: Groups up to which their table is broadcast; beyond, it is joined by shuffling on salted languages.
BROADCAST_GROUPS, SALTS = 20_000, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text) -> F.Column:
    """The matches of TERM in a text in order, only A-Z lower-cased: what stands between matches of its complement; the first and the last can be empty."""
    return F.split(F.translate(text, _UPPER, _LOWER), BETWEEN, -1)


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and documents of the group that have it."""
    found = docs.select("lang", "source", terms("text").alias("found"))
    rows = found.select("lang", "source", F.size("found").alias("size"), F.posexplode(F.concat("found", F.array_distinct("found"))).alias("at", "term")).where("term <> ''")
    once = F.col("at") >= F.col("size")  # behind all occurrences stands each term once
    return rows.groupBy("lang", "source", "term").agg(F.count_if(~once).alias("n"), F.count_if(once).alias("docs"))


def frequency(n, total, kept) -> F.Column:
    """1 + floor(SCALE * (n + ALPHA) / (total + ALPHA * kept)), exact for counts of any size."""
    top = (n + ALPHA).cast("decimal(18,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, (total + ALPHA * kept).cast("decimal(28,0)"))


def excess(p, q) -> F.Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _with_groups(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Each kept term with every group of its language; a language with very many terms is dealt over salts."""
    if groups.count() <= BROADCAST_GROUPS:
        return kept.join(F.broadcast(groups), "lang")
    salts = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salts, ["lang", "salt"]).drop("salt")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for docs (text, lang, source).

    Part `pair`: every other source of the language by its divergence from the group, all of
    them, 0 where the language keeps no term. Part `term`: the terms that the group has more
    often than its language, at most top_terms. Ranks start at 1 in each group and part, by
    value downwards, then item by its UTF-8 bytes. Null text, lang and source are read as
    empty. Every row is a document, repeated or not. A group without terms takes part with
    counts of 0; a language with one source has no pairs. Empty docs give no rows. Other
    columns are not read.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    groups = docs.select("lang", "source").distinct()
    here = Window.partitionBy("lang", "term")
    has = counted(docs).withColumns({"docs": F.sum("docs").over(here), "all_n": F.sum("n").over(here)}).where(F.col("docs") >= least_docs)
    has = cut(has.select("lang", "source", "term", "n", "all_n"), "terms")
    kept = has.groupBy("lang", "term").agg(F.first("all_n").alias("all_n"))
    size = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("all_total"))
    total = has.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut(groups.join(total, ["lang", "source"], "left").join(size, "lang", "left").na.fill(0, ["total", "kept", "all_total"]), "groups")

    dense = _with_groups(kept.select("lang", "term"), groups.select("lang", "source", "total", "kept"))
    dense = dense.join(has.select("lang", "term", "source", "n"), ["lang", "term", "source"], "left")
    dense = cut(dense.select("lang", "term", "source", frequency(F.coalesce("n", F.lit(0)), F.col("total"), F.col("kept")).alias("p")).repartition("lang", "term"), "dense")
    a, b = dense.alias("a"), dense.alias("b")
    same = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") != F.col("b.source"))
    far = a.join(b, same).groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")).agg(F.sum(excess(F.col("a.p"), F.col("b.p"))).alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.join(far, ["lang", "source", "item"], "left").na.fill(0, ["value"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    p, q = frequency(F.col("n"), F.col("total"), F.col("kept")), frequency(F.col("all_n"), F.col("all_total"), F.col("kept"))
    own = has.join(F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups, ["lang", "source"])
    own = own.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), "item", excess(F.col("p"), F.col("q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)  # each task sends at most that many of a group
    return pairs.unionByName(own)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') as w from documents),
g as (select distinct lang, source from d),
o as (select r, lang, source, unnest(w) as term from d),
c as (select lang, source, term, count(*) as n from o group by all),
k as (select lang, term, count(*) as n from o group by all having count(distinct r) >= {LEAST_DOCS}),
v as (select lang, count(*) as v, sum(n) as total from k group by all),
x as (select g.lang, g.source, k.term, k.n as all_n, coalesce(c.n, 0) as n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
t as (select lang, source, sum(n) as total from x group by all),
p as (select x.lang, x.source, x.term, x.n, (1 + ({SCALE}::hugeint * (x.n + {ALPHA})) // (t.total + {ALPHA} * v.v))::hugeint as p, (1 + ({SCALE}::hugeint * (x.all_n + {ALPHA})) // (v.total + {ALPHA} * v.v))::hugeint as q from x join t on t.lang = x.lang and t.source = x.source join v on v.lang = x.lang),
f as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
i as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
union all select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from p where n > 0 and p > q)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from i qualify part = 'pair' or rank <= {TOP_TERMS}"""
