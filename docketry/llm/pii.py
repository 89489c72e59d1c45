"""Personal data by bootstrapped contextual extraction (operator 4).

Base identifiers (email, ip, card, phone) are found by fixed patterns. They seed a
bootstrap over lexical patterns: the word or two before an identifier, or the word before
and the one after it, each with its coarse shape, and the word or two before with the @ or
else the class of its last character. An instance is any digit- or @-bearing token, or
several tokens of digits and marks in a row. Spark scores the pattern-instance graph in
turns: a pattern is as good as the share of its instances known to be of a kind, an instance as good as its confident
patterns together. An instance that is good enough is known from then on and supports
patterns as a seed does, until a turn adds none. Confident patterns mark identifiers that
the base patterns miss (broken check digits, missing prefixes). Every occurrence is kept;
nothing is bounded but the texts themselves.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, table

KINDS = ("email", "ip", "card", "phone")
#: Least score of a pattern, least instances known of it, weight of doubt, and least belief in an instance that is then known.
CONFIDENT, SEEDS, DOUBT, KNOWN = 0.6, 3, 1.0, 0.75

# The base patterns of the contract. A match can only begin where a run of
# digits begins, so the look-behind and possessive runs leave the results as they are.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\s]+")
_RUNS = ((re.compile(r"[0-9]+"), "9"), (re.compile(r"[^\W\d_]+"), "a"))
_NUMERIC = re.compile(r"[0-9()+.-]*[0-9][0-9()+.-]*")

_SPAN = "struct<start:long,kind:int,end:long>"
_CASE = "struct<start:long,end:long,kind:int,value:string,patterns:array<string>>"
SCHEMA = f"doc_id long, row long, spans array<{_SPAN}>, cases array<{_CASE}>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base identifiers, ordered."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _key(text, most=24):
    """The text, or for a long one its beginning and a hash of the whole: equal only for equal texts."""
    return text if len(text) <= most else f"{text[:most]}#{xxhash.xxh3_128_hexdigest(text.encode('utf-8', 'surrogatepass'))}"


def _shape(value):
    for run, mark in _RUNS:
        value = run.sub(mark, value)
    return _key(value)


def _word(w):
    return _key(_RUNS[0][0].sub("9", w.lower()))


def cases(text: str, spans) -> list[dict]:
    """Identifiers and other digit- or @-bearing tokens with the patterns around them."""
    if not spans and "@" not in text and not _DIGIT.search(text):
        return []
    units, k, cover = [], 0, sorted((a, b, kind) for a, kind, b in spans)
    joined = []
    for a, b, kind in cover:  # overlapping identifiers: the first and longest stands for the context
        if not joined or a >= joined[-1][1]:
            joined.append((a, b, kind))
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while k < len(joined) and joined[k][1] <= a:
            k += 1
        if k < len(joined) and joined[k][0] < b:
            if not units or units[-1][3] != k:
                units.append((joined[k][0], joined[k][1], joined[k][2], k))
        else:
            whole = _NUMERIC.fullmatch(text, a, b)
            while a < b and text[b - 1] in ".,;:!?)]}\"'":
                b -= 1
            if whole and units and units[-1][3] == -2 and text[units[-1][1] : a] in (" ", ") "):
                units[-1] = (units[-1][0], b, -1, -2)  # one more group of digits
                continue
            while a < b and text[a] in "([{\"'":
                a += 1
            units.append((a, b, -1, -2 if whole else -1))
    out = []
    for j, (a, b, kind, _) in enumerate(units):
        value = text[a:b]
        if kind < 0 and "@" not in value and not _DIGIT.search(value):
            continue
        left = [_word(text[units[i][0] : units[i][1]]) if i >= 0 else "^" for i in (j - 2, j - 1)]
        right = _word(text[units[j + 1][0] : units[j + 1][1]]) if j + 1 < len(units) else "$"
        s, kind_of = _shape(value), "@" if "@" in value else _shape(value[-1])
        out.append({"start": a, "end": b, "kind": kind, "value": _key(value, 200), "patterns": [f"l1 {left[1]} {s}", f"l2 {left[0]} {left[1]} {s}", f"lr {left[1]} {right} {s}", f"c1 {left[1]} {kind_of}", f"c2 {left[0]} {left[1]} {kind_of}"]})
    return out


def _scan(batches):
    from pyspark import TaskContext

    row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    for part in chunks(batches):
        out = []
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            text = text or ""
            spans = base_spans(text)
            out.append({"doc_id": doc_id, "row": row, "spans": [{"start": a, "kind": k, "end": b} for a, k, b in spans], "cases": cases(text, spans)})
            row += 1
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        case = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
        yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("spans", pa.list_(span)), ("cases", pa.list_(case))]))


def bootstrap(edges: DataFrame, confident: float = CONFIDENT, least_seeds: int = SEEDS) -> DataFrame:
    """(pattern, kind, score, seeds, support) over edges (pattern, value, kind; -1: unknown), all patterns with a known value.

    seeds counts the values that the base patterns know, support those known in the end.
    """
    edges = cut(edges.distinct(), "edges")
    plain = edges.select("pattern", "value").distinct()
    sizes = plain.groupBy("pattern").agg(F.count("*").alias("n"))
    plain = cut(plain, "plain")
    known = base = cut(edges.where("kind >= 0").select("value", "kind").distinct(), "known")
    while True:
        score = plain.join(known, "value").groupBy("pattern", "kind").agg(F.count("*").alias("support")).join(sizes, "pattern")
        score = cut(score.select("pattern", "kind", "support", (F.col("support") / (F.col("n") + DOUBT)).alias("score")), "scores")
        good = score.where((F.col("score") >= confident) & (F.col("support") >= least_seeds))
        belief = plain.join(good, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("belief"))
        best = belief.groupBy("value").agg(F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("kind"), F.max("belief").alias("belief"))
        new = cut(best.where(F.col("belief") >= KNOWN).join(known.select("value"), "value", "left_anti").select("value", "kind"), "known")
        if new.isEmpty():
            break
        known = cut(known.union(new), "known")
    seeds = plain.join(base, "value").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    return score.join(seeds, ["pattern", "kind"], "left").select("pattern", "kind", "score", F.coalesce("seeds", F.lit(0)).cast("long").alias("seeds"), "support")


def personal_data(docs: DataFrame, confident: float = CONFIDENT, least_seeds: int = SEEDS) -> DataFrame:
    """One row per row of docs (doc_id, text): counts and digest of base spans, and all spans.

    Null and empty texts have no spans (the digest is that of an empty string). Spans of
    different kinds may overlap. Found spans that touch a base span are not added. Rows
    without a doc_id are left out; repeated rows give a row each. Other columns are not read.
    """
    found = cut(docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(_scan, SCHEMA), "spans")
    case = found.where(F.size("cases") > 0).select("row", F.explode("cases").alias("c"))
    case = case.select("row", "c.start", "c.end", "c.kind", "c.value", F.explode("c.patterns").alias("pattern"))
    good = bootstrap(case.select("pattern", "value", "kind"), confident, least_seeds).where((F.col("score") >= confident) & (F.col("support") >= least_seeds))
    new = case.where("kind < 0").select("row", "start", "end", "pattern").join(good.select("pattern", F.col("kind").alias("as_kind"), "score"), "pattern")
    new = new.groupBy("row", "start", "end").agg(F.max_by("as_kind", F.struct("score", -F.col("as_kind"))).alias("kind"))
    new = new.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    kind = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    both = found.select("doc_id", "row", "spans").join(new, "row", "left")
    more = F.coalesce("more", F.array().cast(f"array<{_SPAN}>"))
    # taken out first: a second parameter of a lambda, even one with a default, would be the place in the array
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return both.select("doc_id", *counts, F.sha2(joined(F.col("spans")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("spans", more))).alias("spans"), F.size(more).cast("long").alias("n_found"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
