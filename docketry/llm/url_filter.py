"""URL filter by empirical-Bayes host reputation (operator 7), DataFrame functions only.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix. Each
level is shrunk toward the one above it: suffix toward all pages, domain toward its suffix,
host toward its domain, as the mean of a beta-binomial whose strength is estimated from how
much more the hosts differ than chance. A page is blocked when the lower bound of its host's
posterior bad rate exceeds a threshold. Explicit rules come first; the longest that fits wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The rules of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The bad rate beyond which a host is blocked, the width of the bound in standard deviations, and the bounds of the prior's strength.
LIMIT, WIDTH, LEAST, MOST = 0.3, 1.645, 2.0, 500.0
#: The bad rate believed before any outcome, worth one page.
PRIOR = 0.1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path) of a url; both empty without '://'."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_for(host: F.Column, path: F.Column, rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits, else null. The rules are a list held by the caller."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last that fits stands outermost
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, bad_rate, bad_low) for every host of pages (page_id, host, domain, suffix)."""
    known = pages.join(outcomes, "page_id")
    count = [F.count("*").alias("n"), F.sum("bad").alias("k")]
    host = known.groupBy("host", "domain", "suffix").agg(*count)
    total = host.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n0"), F.coalesce(F.sum("k"), F.lit(0)).alias("k0"), F.count("*").alias("hosts"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"))
    m0 = (F.col("k0") + PRIOR) / (F.col("n0") + 1)
    between = F.col("kk") - F.col("n0") * m0 * m0  # weighted squares of host rates around the mean
    spread = (between - (F.col("hosts") - 1) * m0 * (1 - m0)) / F.nullif(F.col("n0") - F.col("nn") / F.nullif(F.col("n0"), F.lit(0)), F.lit(0.0))
    strength = F.when(spread > 0, F.least(F.greatest(m0 * (1 - m0) / spread - 1, F.lit(LEAST)), F.lit(MOST))).otherwise(F.lit(MOST))
    total = total.select(m0.alias("m0"), F.coalesce(strength, F.lit(MOST)).alias("s")).first()  # two numbers
    top, s = F.lit(total["m0"]), F.lit(total["s"])

    def shrunk(above):
        return (F.coalesce("k", F.lit(0)) + s * above) / (F.coalesce("n", F.lit(0)) + s)

    suffix = host.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domain = host.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    all_ = pages.select("host", "domain", "suffix").distinct()
    all_ = all_.join(suffix, "suffix", "left").withColumn("m1", shrunk(top)).drop("n", "k")
    all_ = all_.join(domain, "domain", "left").withColumn("m2", shrunk(F.col("m1"))).drop("n", "k")
    all_ = all_.join(host.select("host", "n", "k"), "host", "left").withColumn("mean", shrunk(F.col("m2")))
    mean, n = F.col("mean"), F.coalesce("n", F.lit(0)) + s
    return all_.select("host", mean.alias("bad_rate"), F.greatest(mean - WIDTH * F.sqrt(mean * (1 - mean) / (n + 1)), F.lit(0.0)).alias("bad_low"))


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """One row per row of pages (page_id, url): page_id, host, path, rule, verdict.

    A registered domain is taken to be the last two labels of a host, a suffix the last one.
    Each row counts as a page where outcomes are counted, also rows with the same page_id.

    outcomes: (page_id, bad 0/1); null or other values are not used, repeated ones count
    once by their highest. A url that is null or lacks '://' has an empty host and path,
    fits no rule, and gets the method's verdict for the empty host. Rows without a page_id
    are kept. Without outcomes every host has the prior and is allowed. Other columns are
    not read.
    """
    host, path = split_url(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    p = p.withColumns({"suffix": F.element_at(labels, -1), "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))})
    bad = outcomes.where("bad in (0, 1)").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    rate = reputation(p, bad)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return p.join(rate, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the quality label under its number: 0 is bad."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes)


def _sql() -> str:
    rules = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    fits = [(what, text, f"(host = '{text.partition('/')[0]}' or ends_with(host, '.{text.partition('/')[0]}')) and starts_with(path, '/{text.partition('/')[2]}')") for what, text in rules]
    rule = "case " + " ".join(f"when {w} then '{t}'" for _, t, w in fits) + " end"
    verdict = "case " + " ".join(f"when {w} then '{v}'" for v, _, w in fits) + f" when bad_low > {LIMIT} then 'block' else 'allow' end"
    return rf"""
with u as (select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from u),
q as (select *, string_split(host, '.')[-1] as suffix, case when contains(host, '.') then string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] else host end as domain from p),
o as (select doc_id as page_id, max(1 - quality) as bad from labels where quality in (0, 1) group by 1),
h as (select host, domain, suffix, count(*) as n, sum(bad) as k from q join o using (page_id) group by 1, 2, 3),
t0 as (select coalesce(sum(n), 0) as n0, coalesce(sum(k), 0) as k0, count(*) as hosts, sum(n * n)::double as nn, sum(k * k::double / n) as kk from h),
t1 as (select *, (k0 + {PRIOR}::double) / (n0 + 1) as m0 from t0),
t2 as (select m0, (kk - n0 * m0 * m0 - (hosts - 1) * m0 * (1 - m0)) / nullif(n0 - nn / nullif(n0, 0), 0) as spread from t1),
t as (select m0, coalesce(case when spread > 0 then least(greatest(m0 * (1 - m0) / spread - 1, {LEAST}::double), {MOST}::double) else {MOST}::double end, {MOST}::double) as s from t2),
sx as (select suffix, sum(n) as n, sum(k) as k from h group by 1),
dm as (select domain, sum(n) as n, sum(k) as k from h group by 1),
a as (select distinct host, domain, suffix from q),
a1 as (select a.*, t.s, (coalesce(sx.k, 0) + s * m0) / (coalesce(sx.n, 0) + s) as m1 from a cross join t left join sx using (suffix)),
a2 as (select a1.*, (coalesce(dm.k, 0) + s * m1) / (coalesce(dm.n, 0) + s) as m2 from a1 left join dm using (domain)),
a3 as (select a2.host, s, (coalesce(h.k, 0) + s * m2) / (coalesce(h.n, 0) + s) as mean, coalesce(h.n, 0) + s as nn from a2 left join h using (host)),
r as (select host, greatest(mean - {WIDTH}::double * sqrt(mean * (1 - mean) / (nn + 1)), 0) as bad_low from a3)
select page_id, host, path, {rule} as rule, {verdict} as verdict from q left join r using (host)"""


ORACLE_SQL = _sql()
