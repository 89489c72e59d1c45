"""Mixing sources to target weights by iterative proportional fitting (operator 10), DataFrame functions only.

Tokens are counted by cell of source, language and topic. Raking multiplies the cells in
turn so that each marginal meets its target; the fitted share of a cell over its tokens is
the probability with which its documents are kept. Where that is above 1 the cell is drawn
whole and the others make up for it. A document's draw is a hash of its id,
so a run can be repeated and no state is held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, named, table

MARGINALS = ("source", "lang", "topic")
#: Share of all tokens to draw, and power by which default targets flatten the present shares.
SHARE, TEMPER = 0.5, 0.7
#: Rounds of four turns at most, and the share of all tokens by which a marginal may be off; raking ends
#: there, or where a round leaves more than NEARER of the rest: then no cells meet all targets at once.
MOST, CLOSE, NEARER = 20, 1e-5, 0.95
# The marks by which a text has its topic, first match wins.
TOPICS = (("table", " | "), ("secret", 'token = "'), ("license", "icens"))


def topic_of(text: F.Column) -> F.Column:
    out = F.lit("prose")
    for name, mark in reversed(TOPICS):
        out = F.when(F.contains(text, F.lit(mark)), F.lit(name)).otherwise(out)
    return out


def weighed(docs: DataFrame, *more, topic: F.Column | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens): words of the whole text; null marks count as ''.

    topic: a column of docs, such as a classifier's; without, the topic is told by marks in the text.
    """
    return docs.where("doc_id is not null").select(
        "doc_id", *[F.coalesce(F.col(m), F.lit("")).alias(m) for m in MARGINALS[:2]], (topic_of(F.coalesce("text", F.lit(""))) if topic is None else F.coalesce(topic, F.lit(""))).alias("topic"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^ \t\n\r]+")).cast("long").alias("n_tokens"),
        *more,
    )


def _held(frame: DataFrame) -> DataFrame:
    """The cells cut to a table and taken as one part: sums over all of them need that anyway, and those by mark no shuffle then."""
    return cut(frame, "cells").coalesce(1)


def _off(frame: DataFrame, now: str, want: str) -> float:
    """By what share of all tokens a marginal of a column is off the wanted one at most."""
    sums = frame.select("tokens", *[(F.sum(now).over(Window.partitionBy(m)) - F.col(f"{want}{m}")).alias(m) for m in MARGINALS])
    off = F.greatest(*[F.max(F.abs(m)) for m in MARGINALS])
    return sums.agg(F.coalesce(off / F.nullif(F.sum("tokens"), F.lit(0)), F.lit(0.0)).alias("off")).first()["off"]


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, turns: int | None = None) -> DataFrame:
    """cells (source, lang, topic, tokens) with x, the fitted tokens.

    targets: of a marginal, the wanted weight of each value (others 0); without, the present
    tokens to the power TEMPER. Turns go on until all marginals are met, or as many as said.
    Targets that cells cannot meet at once end with the last marginal met. One row per cell, so the frame stays as small as the marks.
    """
    frame = cells.withColumn("x", F.col("tokens").cast("double"))
    every = Window.partitionBy()
    for m in MARGINALS:
        if targets and m in targets:
            want = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for p in targets[m].items() for v in p]), F.col(m)), F.lit(0.0))
        else:
            want = F.pow(F.sum("tokens").over(Window.partitionBy(m)).cast("double"), F.lit(TEMPER))
        frame = frame.withColumn(f"t_{m}", want).withColumn("n", F.count("*").over(Window.partitionBy(m)))
        frame = frame.withColumn(f"t_{m}", F.coalesce(F.col(f"t_{m}") / F.nullif(F.sum(F.col(f"t_{m}") / F.col("n")).over(every), F.lit(0.0)), F.lit(0.0))).drop("n")
        frame = frame.withColumn(f"a_{m}", F.col(f"t_{m}") * F.sum("tokens").over(every))
    frame, off = _held(frame), float("inf")
    for turn in range(turns or 4 * MOST):
        for m in MARGINALS:
            now = F.sum("x").over(Window.partitionBy(m))
            frame = frame.withColumn("x", F.when(now > 0, F.col("x") * F.col(f"a_{m}") / now).otherwise(F.lit(0.0)))
        if turn % 4 == 3:
            frame = _held(frame)
            if turns is None:
                last, off = off, _off(frame, "x", "a_")
                if off <= CLOSE or off > NEARER * last:
                    break
    frame = frame.drop(*[f"a_{m}" for m in MARGINALS])
    return frame.withColumn("x", F.coalesce(F.col("x") / F.nullif(F.sum("x").over(every), F.lit(0.0)) * F.sum("tokens").over(every), F.lit(0.0)))


def drawn(cells: DataFrame, targets=None, share: float = SHARE) -> DataFrame:
    """cells (source, lang, topic, tokens) with y, the tokens to draw of each, at most those it has.

    Raked cells that ask for more than they have are drawn whole, and what they lack goes
    to the others of their marginals, until the marginals of y meet share times the
    targets. A value that asks for more than all its cells have is drawn whole and the
    rest of its target goes to the other values of the marginal.
    """
    every = Window.partitionBy()
    frame = rake(cells, targets).withColumn("x", F.lit(share) * F.col("x"))
    frame = _held(frame.withColumn("y", F.least("x", "tokens")))
    if frame.where("x > tokens").isEmpty():
        return frame.select(*MARGINALS, "tokens", "y")
    for m in MARGINALS:
        frame = _feasible(frame, m, share)
    off = float("inf")
    for _ in range(MOST):  # x is the product of all factors, y what of it can be drawn
        for _ in range(4):
            for m in MARGINALS:
                now = F.sum("y").over(Window.partitionBy(m))
                frame = frame.withColumn("x", F.when(now > 0, F.least(F.col("x") * F.col(f"w_{m}") / now, F.lit(1e200))).otherwise(F.lit(0.0))).withColumn("y", F.least("x", "tokens"))
        frame = _held(frame)
        last, off = off, _off(frame, "y", "w_")
        if off <= CLOSE or off > NEARER * last:
            break
    return frame.select(*MARGINALS, "tokens", "y")


def _feasible(frame: DataFrame, m: str, share: float) -> DataFrame:
    """frame with w_m, the tokens wanted of a value of m: share of all by t_m, but none has more than there are."""
    value = Window.orderBy(F.col("has") / F.col("t"), m)
    per = frame.groupBy(m).agg(F.sum("tokens").cast("double").alias("has"), F.first(f"t_{m}").alias("t"))
    per = per.withColumn("total", F.lit(share) * F.sum("has").over(Window.partitionBy())).where("has > 0 and t > 0")
    # By tokens per wanted weight, a value is drawn whole while the level that the rest would have is above its own.
    before = F.coalesce(F.sum("has").over(value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("t").over(value.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - before) / rest).withColumn("full", F.col("level") * F.col("t") >= F.col("has"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    per = per.select(m, F.when(F.col("full"), F.col("has")).otherwise(level * F.col("t")).alias(f"w_{m}"))
    return frame.join(F.broadcast(per), m, "left").fillna(0.0, [f"w_{m}"])


def report(docs: DataFrame, targets=None, share: float = SHARE) -> DataFrame:
    """(marginal, value, tokens, target, achieved): wanted and expected share of the drawn tokens of each value."""
    cells = cut(weighed(docs).groupBy(*MARGINALS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    got = cut(drawn(cells, targets, share).join(rake(cells, targets).select(*MARGINALS, *[f"t_{m}" for m in MARGINALS]), list(MARGINALS)), "cells")
    out = None
    for m in MARGINALS:
        total = Window.partitionBy()
        one = got.groupBy(F.lit(m).alias("marginal"), F.col(m).alias("value")).agg(F.sum("tokens").alias("tokens"), F.first(f"t_{m}").alias("target"), F.sum("y").alias("y"))
        one = one.select("marginal", "value", "tokens", (F.col("target") / F.sum("target").over(total)).alias("target"), (F.col("y") / F.sum("y").over(total)).alias("achieved"))
        out = one if out is None else out.union(one)
    return out


def _rated(rows: DataFrame, targets, share: float) -> DataFrame:
    cells = rows.groupBy(*MARGINALS).agg(F.sum("n_tokens").alias("tokens"))
    fitted = drawn(cut(cells, "cells"), targets, share)
    rate = F.coalesce(F.least(F.lit(1.0), F.col("y") / F.nullif(F.col("tokens"), F.lit(0))), F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    out = rows.join(fitted.select(*MARGINALS, rate.alias("exact")), list(MARGINALS))
    return out.withColumn("sampled", draw < F.col("exact")).withColumn("rate", F.round("exact", 6)).drop("exact")


def mixture(docs: DataFrame, targets=None, share: float = SHARE, topic: F.Column | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text, lang, source): n_tokens, rate, sampled and the marks.

    The rate is drawn / present tokens of the cell (see drawn). Texts without words
    have no tokens to weigh: a cell of only such texts has the rate 1, as they change no weight. Rows without a doc_id
    are left out; rows with the same doc_id are drawn alike. An empty table gives no rows.
    """
    return _rated(weighed(docs, topic=topic), targets, share).select("doc_id", *MARGINALS, "n_tokens", "rate", "sampled")


def sampled_documents(docs: DataFrame, targets=None, share: float = SHARE, topic: F.Column | None = None) -> DataFrame:
    """The drawn rows of docs, with the columns of docs."""
    whole = F.struct(*named(docs))
    return _rated(weighed(docs, whole.alias("whole"), topic=topic), targets, share).where("sampled").select("whole.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same turns and the same ends of them as recursive tables: a row is a cell in a turn."""
    topic = "case " + " ".join(f"when contains(coalesce(text, ''), '{mark}') then '{name}'" for name, mark in TOPICS) + " else 'prose' end"
    wants = ", ".join(f"pow(sum(tokens) over (partition by {m}), {TEMPER}) as w_{m}, count(*) over (partition by {m}) as n_{m}" for m in MARGINALS)
    shares = ", ".join(f"coalesce(w_{m} / nullif(sum(w_{m} / n_{m}) over (), 0), 0) as t_{m}" for m in MARGINALS)
    goals = ", ".join(f"t_{m} * sum(tokens) over () as a_{m}" for m in MARGINALS)

    def turns(name: str, start: str, now: str, want: str, most: int) -> str:
        """A recursive table of turns over the marginals; every fourth one says how far off they are and whether that was the last."""
        step = f"(select * from {name} where not done)"
        for m in MARGINALS:
            x = f"x * {want}_{m} / sum({now}) over (partition by {m})"
            step = f"(select * replace (case when sum({now}) over (partition by {m}) > 0 then {x if now == 'x' else f'least({x}, 1e200)'} else 0 end as x) from {step})"
            step = step if now == "x" else f"(select * replace (least(x, tokens) as y) from {step})"
        off = "greatest(" + ", ".join(f"abs(sum({now}) over (partition by {m}) - {want}_{m})" for m in MARGINALS) + ")"
        step = f"(select *, max(d) over () / sum(tokens) over () as now_off from (select *, {off} as d from {step}))"
        check = "turn % 4 = 3"
        return f"""{name} as (select *, 0 as turn, 'inf'::double as off, false as done from {start}
union all select * exclude (now_off, d) replace (turn + 1 as turn, case when {check} then now_off else off end as off, case when {check} then now_off <= {CLOSE}::double or now_off > {NEARER}::double * off or turn + 1 >= {most} else false end as done) from {step})"""

    def feasible(m: str) -> str:
        """The tokens wanted of each value of a marginal, none more than there are."""
        order = f"order by has / t, {m}"
        return f"""p_{m} as (select * from (select *, {SHARE}::double * sum(has) over () as total from (select {m}, sum(tokens) as has, any_value(t_{m}) as t from y0 group by 1)) where has > 0 and t > 0),
l_{m} as (select *, (total - coalesce(sum(has) over ({order} rows between unbounded preceding and 1 preceding), 0)) / sum(t) over ({order} rows between current row and unbounded following) as level from p_{m}),
f_{m} as (select {m}, case when level * t >= has then has else max(case when level * t < has then level end) over () * t end as w_{m} from l_{m})"""

    return f"""
with recursive d as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, {topic} as topic, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+'))::bigint as n_tokens from documents where doc_id is not null),
cells as (select source, lang, topic, sum(n_tokens)::double as tokens from d group by 1, 2, 3),
w as (select *, {wants} from cells),
c0 as (select source, lang, topic, tokens, tokens as x, {shares} from w),
c1 as (select *, {goals} from c0),
{turns("r", "c1", "x", "a", 4 * MOST)},
y0 as (select source, lang, topic, tokens, x, least(x, tokens) as y, {", ".join(f"t_{m}" for m in MARGINALS)} from (select * replace ({SHARE}::double * coalesce(x / nullif(sum(x) over (), 0) * sum(tokens) over (), 0) as x) from r where turn = (select max(turn) from r))),
{", ".join(feasible(m) for m in MARGINALS)},
s0 as (select y0.*, {", ".join(f"coalesce(w_{m}, 0) as w_{m}" for m in MARGINALS)} from y0 {" ".join(f"left join f_{m} using ({m})" for m in MARGINALS)} where (select count(*) from y0 where x > tokens) > 0),
{turns("s", "s0", "y", "w", 4 * MOST)},
y as (select source, lang, topic, tokens, y from y0 where (select count(*) from s0) = 0 union all select source, lang, topic, tokens, y from s where turn = (select max(turn) from s)),
f as (select source, lang, topic, coalesce(least(1, y / nullif(tokens, 0)), 0) as rate from y)
select doc_id, source, lang, topic, n_tokens, round(rate, 6) as rate, (('0x' || md5(doc_id::varchar)[1:8])::ubigint / 4294967296.0::double) < rate as sampled from d join f using (source, lang, topic)"""


ORACLE_SQL = _sql()
