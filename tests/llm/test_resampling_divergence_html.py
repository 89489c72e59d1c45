"""Operators 11 to 13 against brute force, their SQL, and the cases that their docstrings define."""

from __future__ import annotations

import collections
import hashlib
import html
import math
import random
import re
import zlib

import duckdb
import pytest

from docketry.llm import divergence, html_text, resampling

DOCS = "doc_id long, text string, lang string, source string, score long, Term string, p long"


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["The", "the", "Éa", "éa", "x-y", "don't", "a1b2", "ÄÖ", "日本", "%%%"]
    rows = []
    for k in range(120):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 90)))
        rows.append((k, text, rng.choice(["en", "de", None, "fr"]), "hot" if k % 3 else rng.choice(["a", "b", None]), 1, "t", 2))
    rows += [(200, None, "en", "a", 1, "t", 2), (201, "", "xx", "only", 1, "t", 2), (202, "%% 12 --", "yy", "s1", 1, "t", 2), (203, "12", "yy", "s2", 1, "t", 2)]
    rows += [(204, " ".join(rng.choice(vocabulary) for _ in range(30000)), "en", "a", 1, "t", 2)]
    return [*rows, rows[5], rows[5]]


TARGET = ["w1 w2 w3 the éa", "The W1 w2", None, "", "日本 w9"]


def twin(sql, rows, target=()):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    if rows:
        con.executemany("insert into documents values (?, ?, ?, ?)", [r[:4] for r in rows])
    con.execute("create table benchmark (item_id bigint, text varchar)")
    if target:
        con.executemany("insert into benchmark values (?, ?)", list(enumerate(target)))
    return con.sql(sql)


def key(row):
    return tuple((x is not None, x) for x in row)


# ------------------------------------------------------------------ operator 11

def features(text, n=2):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return w, [" ".join(w[k : k + m]) for k in range(len(w)) for m in range(1, n + 1) if k + m <= len(w)]


def brute_resampling(rows, target, n=2, buckets=10000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = collections.Counter(bucket(f) for r in rows for f in features(r[1], n)[1])
    t = collections.Counter(bucket(f) for x in target for f in features(x, n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for r in rows:
        w, f = features(r[1], n)
        total = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, f))
        weight = total // len(f) if f else 0
        score = None
        if r[0] is not None:
            h = int(hashlib.sha256(f"7:{r[0]}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(f), weight, score, len(w)])
    able = sorted((x for x in out if x[4] >= 20 and x[3] is not None), key=lambda x: (-x[3], x[0], x[1]))
    rank = {id(x): k + 1 for k, x in enumerate(able[: len(able) * 25 // 100])}
    return sorted((tuple(x[:4]) + (rank.get(id(x)),) for x in out), key=key)


def test_resampling_equals_brute_force_and_sql(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    target = spark.createDataFrame([(k, t) for k, t in enumerate(TARGET)], "item_id long, text string")
    got = resampling.resampled(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    got = sorted(map(tuple, got.collect()), key=key)
    assert got == brute_resampling(rows, TARGET)
    assert any(r[4] for r in got) and len(got) == len(rows)
    assert sorted(twin(resampling.ORACLE_SQL, rows, TARGET).fetchall(), key=key) == got


def test_resampling_without_id_ties_and_empty_tables(spark):
    long = " ".join(f"w{k}" for k in range(25))
    rows = [(k, long, "", "", 0, "", 0) for k in range(40)] + [(None, long, "", "", 0, "", 0), (7, long, "", "", 0, "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    got = sorted(map(tuple, resampling.resampled(docs, none).collect()), key=key)
    assert got == brute_resampling(rows, [])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 11)) and got[0][:1] + got[0][3:] == (None, None, None)
    assert resampling.resampled(spark.createDataFrame([], DOCS), none).collect() == []


def test_ring_over_pieces_and_longer_runs(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 7)
    text = "Aa bb ccc éé dddddddddddddddd e, f\n1 Z"
    for n in (1, 2, 3):
        got = [b for _, found in resampling.ring(text.encode(), n, 2**32 - 1) for b in found]
        assert sorted(got) == sorted(zlib.crc32(f.encode()) % (2**32 - 1) for f in features(text, n)[1])


# ------------------------------------------------------------------ operator 12

def brute_audit(rows, top=200):
    rows = [(r[1] or "", r[2] or "", r[3] or "") for r in rows]
    found = [re.findall(divergence.TERM, "".join(c.lower() if c.isascii() else c for c in t)) for t, _, _ in rows]
    groups, count, docs = sorted({(g, s) for _, g, s in rows}), collections.Counter(), collections.Counter()
    for (_, g, s), f in zip(rows, found, strict=True):
        count.update((g, s, w) for w in f)
        docs.update((g, w) for w in set(f))
    out = []
    for g, s in groups:
        kept = sorted(w for (x, w), n in docs.items() if x == g and n >= 3)

        def p(name, kept=kept, g=g):
            n = {w: sum(count[g, x, w] for _, x in groups if _ == g and name in (None, x)) for w in kept}
            return {w: 1 + 10**9 * (c + 1) // (sum(n.values()) + len(kept)) for w, c in n.items()}

        own, whole = p(s), p(None)
        pairs = []
        for x, other in groups:
            if x == g and other != s:
                q = p(other)
                pairs.append((other, sum((own[w] - q[w]) ** 2 // q[w] for w in kept)))
        found_terms = [(w, (own[w] - whole[w]) ** 2 // whole[w]) for w in kept if count[g, s, w] and own[w] > whole[w]]
        for part, items in (("pair", pairs), ("term", found_terms)):
            items = sorted(items, key=lambda i: (-i[1], i[0].encode()))
            out += [(g, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit_equals_brute_force_and_sql(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
        monkeypatch.setattr(divergence, "SALTS", 3)
    rows = corpus()
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(5))
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    got = sorted(map(tuple, got.collect()))
    assert got == brute_audit(rows)
    assert {r[2] for r in got} == {"pair", "term"} and ("yy", "s1", "pair", "s2", 0, 1) in got
    assert sorted(twin(divergence.ORACLE_SQL, rows).fetchall()) == got


def test_audit_of_counts_beyond_products_of_64_bits_and_of_nothing(spark):
    n = spark.range(1).selectExpr("9000000000000000 as n", "9000000000000001 as total", "3L as kept")
    assert n.select(divergence.frequency(n.n, n.total, n.kept)).first()[0] == 1 + 10**9 * (9 * 10**15 + 1) // (9 * 10**15 + 4)
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(k, "same words here", "en", "s", 0, "", 0) for k in range(2)] * 2
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, DOCS)).collect())) == brute_audit(rows) == []  # one source, like its language


def test_audit_keeps_the_first_terms_of_a_group(spark):
    rows = [(k, " ".join("v" + "abcdefghij"[x // 10] + "abcdefghij"[x % 10] for x in range(k % 2, 100, 1 + k % 2)), "en", f"s{k % 2}", 0, "", 0) for k in range(8)]
    got = divergence.audit(spark.createDataFrame(rows, DOCS), top_terms=5).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, 5)


# ------------------------------------------------------------------ operator 13

LONG = "Thank you for the long and careful reading of this text, which is about the sea and what we know of it today."
PAGES = [
    (f"<div id=header><a href=/>Home</a></div><div class=content><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div id=footer>&copy; 2020 by the owners of this site and all of the others who made it</div>", f"Title {LONG} Short. {LONG}"),
    (f"<div><a href=/>Home</a> <a href=/a>About</a></div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div>&copy; 2020 Us</div>", f"Title {LONG} Short. {LONG}"),
    (f"<article><h1>T</h1><p>{LONG}</p><section id=comments><h2>Comments</h2><p>{LONG} X</p></section></article><section class=comments><article><p>{LONG} Y</p></article></section>", f"T {LONG}"),
    (f"<article><p>{LONG}</p><h2>3 Comments</h2><p>{LONG} I agree.</p></article>", LONG),
    (f"<form><div><article><p>{LONG}</p><form><input><label>Name</label><select><option>One</select></form></article></div></form>", LONG),
    (f"<div class='cookie-banner'><p>We use cookies. {LONG}</p></div><main><p>{LONG}</p><aside><p>{LONG}A</p></aside><p>x &lt; y &amp; z &nbsp; &#233;&#x20AC;</p></main>", f"{LONG} x < y & z é€"),
    (f"<nav><ul><li><a href=a>a</a><article><p>{LONG}<p>b</article>", f"{LONG} b"),
    (f"<article><p>{LONG}<script>if (a<b) document.write('</p>')</script><style>p > b {{}}</style><p>ok</article>", f"{LONG} ok"),
    (f"<header><h1>Site</h1><p>{LONG}</p></header><article><header><h1>Art</h1><p class=byline>By me</p></header><p>{LONG}</p><footer>tags</footer></article>", f"Art {LONG}"),
    (f"<article><p>a<b>b</b>c <i>d</i>\n\n e<br>f</p><!-- x > y --><p>1 < 2 and \"3\" > 2</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", 'abc d e f 1 < 2 and "3" > 2 one two x y'),
    (f"<article><p>{LONG}</p><ul><li><a href=1>Read one</a><li><a href=2>Read two</a><li><a href=3>Read three</a></ul><p>{LONG}</p><p><a href=x>a link alone</a></p></article>", f"{LONG} {LONG} a link alone"),
    (f"<body class='has-sidebar'><div class=ad><p>{LONG}<article><p title=\"a>b\">{LONG}</p></article>", LONG),
    ("<article><p>Один два.</p></article>", "Один два."),
    ("", ""), (None, ""), ("   ", ""), ("<p", ""), ("<!-- never closed <p>x</p>", ""), ("<nav><a href=/>x</a></nav>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_pages_keep_rows_and_other_columns_do_not_matter(spark):
    schema = "page_id long, url string, html string, text string, N_chars int"
    rows = [(k, f"u{k}", p, "other", 1) for k, (p, _) in enumerate(PAGES)] + [(0, None, PAGES[0][0], None, None)] * 2 + [(None, None, None, None, None)]
    got = html_text.extracted(spark.createDataFrame(rows, schema).repartition(3))
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    want = [(r[0], r[1], html_text.main_text(r[2])) for r in rows]
    assert sorted(map(tuple, got.collect()), key=key) == sorted([(*w, len(w[2])) for w in want], key=key)
    assert html_text.extracted(spark.createDataFrame([], schema)).collect() == []
    labels = {(r["text"], r["label"]) for r in html_text.judged_blocks(spark.createDataFrame(rows[:1], schema)).collect()}
    assert ("Home", "bad") in labels and ("Short.", "good") in labels


def test_articles_of_given_pages_are_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in html_text.op13_html_text(spark, "/root/testdata/sf0.001").collect()}
    for p in pages:  # these pages mark their article plainly
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S).group(1)
        assert got[p["page_id"]] == " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())


def test_a_very_long_page_and_deep_nesting():
    many = "".join(f"<p>{LONG} {k}</p>" for k in range(20000))
    assert len(html_text.main_text(f"<article>{many}</article>").split()) > 400000
    assert html_text.main_text("<div>" * 20000 + LONG) == LONG
