"""Evidence: what in an answer the source document bears out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V


def payload_text(text, tables) -> Column:
    """All words of an answer: text, titles, headers and cells, a line each."""
    cells = F.flatten(F.transform(F.coalesce(X.col(tables), F.array().cast(TABLES)), lambda t: F.concat(F.array(t["title"]), t["headers"], F.flatten(t["rows"]))))
    return F.array_join(F.concat(F.array(F.coalesce(X.col(text), F.lit(""))), cells), "\n")


TABLE = "struct<title:string,headers:array<string>,rows:array<array<string>>>"
TABLES = f"array<{TABLE}>"


def damaged(c) -> Column:
    """A section whose table was broken by line wrapping."""
    return F.exists(X.lines(c), lambda x: x.rlike(V.CONTINUED) & (X.strip(x) != "")) | X.col(c).rlike(V.SPLIT_NUMBER)


def reconstructible(figure: Column, source: Column) -> Column:
    """Whether a figure's digits stand in the source together, or as two parts that begin or end a run of digits there."""
    runs = F.regexp_extract_all(source, F.lit(r"\d+"), F.lit(0))

    def split(d, runs):
        def at_edge(part):
            return F.exists(runs, lambda r: r.startswith(part) | r.endswith(part))

        cuts = F.when(F.length(d) >= 3, F.sequence(F.lit(2), F.length(d) - 1)).otherwise(F.array().cast("array<int>"))
        return F.exists(cuts, lambda i: at_edge(F.substring(d, F.lit(1), i)) & at_edge(F.substring(d, i + 1, F.length(d))))

    return X.let(X.digits(figure), lambda d: (d == "") | F.contains(X.digits(source), d) | X.let(runs, lambda r: split(d, r)))


def bad_repairs(payload, source) -> Column:
    """Figures of 5 to 14 digits in a repair that its section cannot give, at most six."""
    found = F.regexp_extract_all(X.col(payload), F.lit(V.LONG_FIGURE), F.lit(0))
    return F.slice(F.filter(found, lambda f: F.length(X.digits(f)).between(5, 14) & ~reconstructible(f, X.col(source))), 1, 6)


def lost_figures(source, text) -> Column:
    return F.slice(F.sort_array(F.array_except(X.figures(source), X.figures(text))), 1, 8)


def invented_figures(source, text) -> Column:
    return lost_figures(text, source)


def verified(text, tables, source) -> Column:
    """(bad_figures, ground, table_ground, verified) of an answer against the lines it was taken from."""
    bad = X.unseen_figures(payload_text(text, tables), source)
    ground = F.bround(X.overlap(text, source), 3)
    return F.struct(bad.alias("bad_figures"), ground.alias("ground"), F.bround(X.overlap(payload_text(F.lit(""), tables), source), 3).alias("table_ground"), ((F.size(bad) == 0) & (ground >= V.MIN_GROUND)).alias("verified"))


#: Parts into which the sources of every run are dealt, so that a run that most of them have is no task of its own.
RUN_PARTS = 8


def grounding_join(claims: DataFrame, sources: DataFrame, claim: str, source: str, n: int = V.GROUND_WORDS, least: float = V.MIN_GROUND, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(claim, source, ground) of every pair of texts with at least this share of the claim's word runs in the source.

    A source with the share `least` of a claim's k runs misses at most k - ceil(least * k) of
    them, so among that many runs and one more it has one: the claim's rarest runs name the
    candidates, and only for these all runs are counted. Rows with the same id count as one text. Runs travel as 64-bit hashes, texts
    not at all. Claims' runs are broadcast while they are few, else joined by run and part.
    """
    c = claims.select(claim, F.explode(X.shingles("text", n)).alias("run")).distinct().persist()
    part = F.pmod(F.xxhash64(F.col(source)), F.lit(RUN_PARTS)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(RUN_PARTS - 1)))
    few = c.count() <= broadcast_rows
    s = sources.select(source, part.alias("part"), F.explode(X.shingles("text", n)).alias("run"))
    known = c.select("run").distinct()
    hits = s.join(F.broadcast(known), "run", "left_semi") if few else s.join(known.withColumn("part", parts), ["run", "part"], "left_semi")
    hits = hits.distinct().persist()  # what sources have of any claim
    spread = c.join(hits.groupBy("run").agg(F.count("*").alias("held")), "run", "left").na.fill(0, ["held"])
    by_claim = Window.partitionBy(claim)
    spread = spread.withColumns({"k": F.row_number().over(by_claim.orderBy("held", "run")), "total": F.count("*").over(by_claim)})
    needed = F.ceil(F.lit(least) * F.col("total") - F.lit(1e-9))
    rare = spread.where((F.col("held") > 0) & (F.col("k") <= F.col("total") - needed + 1))
    named = hits.join(rare.select(claim, "run", parts.alias("part")), ["run", "part"]).select(claim, source).distinct()
    hit = named.join(spread.select(claim, "run", "total"), claim).join(hits.select(source, "run"), [source, "run"])
    hit = hit.groupBy(claim, source).agg(F.count("*").alias("hit"), F.first("total").alias("total"))
    return hit.select(claim, source, (F.col("hit") / F.col("total")).alias("ground")).where(F.col("ground") >= least)


def judge_page(model, witness) -> Column:
    """(text, verdict) of two reads of a page; the witness cannot invent, so it decides whether words are there."""
    m, w = X.strip(model), X.strip(witness)
    model, witness = X.col(model), X.col(witness)
    m = F.when(m == V.BLANK, F.lit("")).otherwise(m)
    seen = F.length(w) >= V.MIN_WITNESS

    def out(text, verdict):
        return F.struct(text.alias("text"), verdict.alias("verdict"))

    def compared(ov):
        mark = F.format_string("%.2f", ov)
        drift = (ov < V.MIN_OVERLAP) & (F.length(model) > V.LONGER * F.length(witness))
        return F.when(drift, out(witness, F.concat(F.lit("drift-"), mark))).otherwise(out(model, F.concat(F.lit("ok-"), mark)))

    return (
        F.when(m == "", out(F.when(seen, witness).otherwise(F.lit("")), F.lit("blank")))
        .when(~seen & (F.length(m) > V.SPARSE), out(F.lit(""), F.lit("invented-on-blank-page")))
        .when(~seen, out(model, F.lit("ok-sparse")))
        .otherwise(X.let(X.overlap(model, witness, 3), compared))
    )


def judge_verdict(word, text, supports=None) -> Column:
    """(verdict, supported): the word only where the passage bears it out, else 'unclear'."""
    w = F.lower(X.strip(F.coalesce(X.col(word), F.lit(""))))
    ok = F.lit(False)
    for v, pattern in (supports or V.SUPPORTS).items():
        ok = F.when(w == v, X.col(text).rlike(pattern)).otherwise(ok)
    ok = ok | (w == "unclear")
    return F.struct(F.when(ok, w).otherwise(F.lit("unclear")).alias("verdict"), ok.alias("supported"))


def is_recital(text, pattern: str = V.RECITAL) -> Column:
    """The notice's or the taxpayer's voice, not the officer's."""
    return F.coalesce(X.col(text).rlike(pattern), F.lit(False))
