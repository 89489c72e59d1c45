"""Each operator against a brute-force version and on the cases its docstring defines."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import common, decontaminate, embedding_dedup, jaccard_join, mixing, pii, substring_dedup, token_codec, token_counts, toxicity, url_filter

tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, x string"


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=1):
    """Random texts, exact and near copies, shared passages, short, empty, null and repeated rows, one very long text."""
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randrange(1, 120))) for _ in range(60)]
    base = words(rng, 100)
    for k in range(12):
        t = list(base)
        for _ in range(k % 4):
            t[rng.randrange(100)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    passage = words(rng, 70)
    texts += [" ".join(words(rng, 40) + passage + words(rng, 30)) for _ in range(6)]
    texts += ["", "   ", None, "a b", "A  B", "a b c", " ".join(words(rng, 20000)), "one two three four five", "one two three four five"]
    return [(k, t, "en" if k % 3 else None, "hot" if k % 3 else f"s{k % 5}", None, k, "x") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return spark.createDataFrame([*rows, rows[3], (None, "no id", "en", "s", 1, 1, "x")], DOCS)


def tokens(t):
    return (t or "").encode().lower().split()


def shingle_set(t, k=5):
    w = tokens(t)
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def groups(pairs, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def brute_components(rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    ids = sorted(sets)
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, groups(linked, ids)


def test_jaccard_join_is_exact(docs):
    sets, want = brute_components(corpus())
    got = jaccard_join.jaccard_components(docs).collect()
    assert len(got) == len(corpus()) + 1
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(i, len(sets[i]), want[i]) for i in sets}


def test_jaccard_join_splits_large_regions(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 150)
    monkeypatch.setattr(jaccard_join, "HOT_IN_PACK", 3)
    sets, want = brute_components(corpus())
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()} == set(want.items())


@pytest.mark.parametrize("block", [100_000, 150])
def test_jaccard_join_counts_all_links(docs, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "COUNT_SHINGLES", block)
    rows = [*corpus(), corpus()[3]]
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    want = sorted((i, sum(j != k and 100 * len(a & b) >= 75 * len(a | b) for k, (_, b) in enumerate(sets)) if a else 0) for j, (i, a) in enumerate(sets))
    assert sorted((r["doc_id"], r["n_links"]) for r in jaccard_join.jaccard_components(docs, count=True).collect()) == want
    assert sum(n for _, n in want) > 60


def test_local_links_connects_what_all_pairs_connect():
    rng = random.Random(5)
    base = [rng.randrange(2**62) for _ in range(60)]
    sets = []
    for _ in range(80):
        s = set(base)
        for _ in range(rng.randrange(30)):
            s.discard(rng.choice(base))
            s.add(rng.randrange(2**62))
        sets.append(np.sort(np.array(list(s), np.uint64)).view(np.int64))
    pairs = [(a, b) for a in range(80) for b in range(a) if 4 * len(set(sets[a]) & set(sets[b])) >= 3 * len(set(sets[a]) | set(sets[b]))]
    assert groups(jaccard_join.local_links(list(range(80)), sets), range(80)) == groups(pairs, range(80))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 300)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_follow_the_text_rules():
    import pyarrow as pa

    a = common.Words(pa.array(["The  Cat\tsat", None, "", "the\x0bcat sat", "thecat sat", "Ünï x"]))
    assert list(np.diff(a.first)) == [3, 0, 0, 3, 2, 2]
    assert (a.hash[:3] == a.hash[3:6]).all() and a.hash[6] not in a.hash[:6]


def test_toxicity_learns_and_keeps_held_out_apart(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(900):
        bad = k % 6 == 0
        w = words(rng, 60, 300)
        if bad:
            w[rng.randrange(60)] = rng.choice(["Vile.", "rotten", "VILE"])
        rows.append((k, " ".join(w), "en", "s", 1, 1, "x"))
        labels.append((k, 1, int(bad)))
    rows += [(1000, None, None, None, None, None, None), (1001, "", "en", "s", 1, 1, "x"), (None, "vile", "en", "s", 1, 1, "x")]
    labels += [(1, 1, None), (2, 1, 7), (None, 1, 1), (5000, 0, 1)]
    d, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(d, lab).collect()}
    assert len(got) == 902 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in range(900) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == int(i % 6 == 0) for i in held]) > 0.97
    assert got[1000]["score"] == got[1001]["score"]
    flipped = lab.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(d, flipped).collect()} == {i: r["score"] for i, r in got.items()}
    none = toxicity.toxicity_scores(d, lab.where("false")).collect()
    assert {round(r["score"], 9) for r in none} == {0.25} and {r["predicted"] for r in none} == {0}
    assert toxicity.with_score(d, lab, "s").columns == [*d.columns, "s"]


def test_embedding_dedup_finds_all_links(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1):
        for _ in range(60):
            v = rng.standard_normal(32)
            for s in [0.0] + [0.3] * int(rng.integers(0, 4)):
                rows.append((k, [float(x) for x in (v + s * rng.standard_normal(32) * np.linalg.norm(v) / np.sqrt(32))], label))
                k += 1
    rows += [(k, rows[0][1], 0), (k + 1, rows[0][1], 1), (k + 2, rows[0][1], None), (k + 3, None, 0), (k + 4, [], 0), (k + 5, [0.0] * 32, 0), (k + 6, [float("nan")] * 32, 0), (k + 7, [None, 1.0], 0), (k + 8, [float("inf")] * 32, 0), (k + 9, [1.0, 0.0], 0), (k + 10, [1.0, 0.0], 0)]
    frame = spark.createDataFrame([*rows, (None, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    ok = {i: (np.array(e, np.float32).astype(float), lab) for i, e, lab in rows if lab is not None and e and None not in e and np.isfinite(e).all() and any(e)}
    pairs = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] / np.linalg.norm(ok[a][0]) / np.linalg.norm(ok[b][0]) >= 0.93]
    n = collections.Counter(x for p in pairs for x in p)
    want = groups(pairs, [r[0] for r in rows])
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert set(got) == set(want) and all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(n.values()) and all(r["n_links"] <= n[i] for i, r in got.items())
    assert np.mean([got[i]["component_id"] == want[i] for i in want]) > 0.97
    assert got[k]["n_links"] >= 1 and got[k + 10]["component_id"] == k + 9 and got[k + 5]["n_links"] == 0


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(9)
    parts = ["a.b@c-d.com", "x@y", "@", ".", "+1 (234) 555-0199", "4111 1111 1111 1111", "4111111111111112", "10.0.0.255", "1.2.3.256", "007.1.1.1", "é@b.co", "_d@e.f", "12", " ", "-", "+", "1.2.3.4.5.6.7.8", "word", "\n", "a@b.c@d.e"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert pii.base_spans(t) == brute_pii(t), t


def test_pii_counts_each_kind(spark):
    card, phone = "4111 1111 1111 1111", "+44 20 7946 0958"
    texts = {1: f"{card}, a@b.co, c@d.org", 2: f"10.0.0.1 10.0.0.2 {phone}", 3: None, 4: f"e@f.g; {card}; {phone}; 1.2.3.4; h@i.j; k@l.m", 5: "none", 6: f"{phone} {phone}.", 7: "\U0001F600 x@y.z\x00 999.1.1.1"}
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for doc, text in texts.items():
        spans = pii.base_spans(text or "")
        assert [got[doc][f"n_{name}"] for name in pii.KINDS] == [sum(kind == k for _, kind, _ in spans) for k in range(4)]
        assert got[doc]["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
    assert [got[4][f"n_{name}"] for name in pii.KINDS] == [3, 1, 1, 1] and [got[1][f"n_{name}"] for name in pii.KINDS] == [2, 0, 1, 0]


def test_pii_bootstraps_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(k, f"{' '.join(words(rng, 5))} call +1 (2{k:02d}) 555-01{k:02d} now", None, None, None, None, None) for k in range(40)]
    rows += [(50, "say call 1 (212) 555-0123 now", "en", "s", 1, 1, "x"), (51, None, "en", "s", 1, 1, "x"), (52, "", "en", "s", 1, 1, "x"), (53, "at 12 o'clock " * 2000, "en", "s", 1, 1, "x"), (54, "lost x@y card 4111 1111 1111 1111, a@b.co", "en", "s", 1, 1, "x"), (None, "a@b.co", "en", "s", 1, 1, "x")]
    rows += [(60 + k, f"pay card 4111 1111 1111 {1111 + 0 * k} end{k}", "en", "s", 1, 1, "x") for k in range(3)] * 2
    got = collections.defaultdict(list)
    for r in pii.personal_data(spark.createDataFrame(rows, DOCS)).collect():
        got[r["doc_id"]].append(r)
    assert None not in got and len(got[60]) == 2
    for i, t, *_ in rows:
        if i is not None:
            base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_pii(t or ""))
            r = got[i][0]
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r["spans"].split(","))
    assert got[51][0]["spans"] == got[52][0]["spans"] == "" and got[53][0]["n_found"] == 0


def test_long_tokens_are_kept_apart():
    long = ["x" * 150 + "-1" * 60 + end for end in ("a", "-", "a")]
    one, two, same = (pii.cases(f"see {t} now", [])[0] for t in long)
    assert one["value"] != two["value"] and not set(one["patterns"]) & set(two["patterns"])
    assert one == same and len(one["value"]) < 250
    assert pii.cases("w" * 24 + "a 12", [])[0]["patterns"] != pii.cases("w" * 24 + "b 12", [])[0]["patterns"]


def test_bootstrap_scores_shared_contexts(spark):
    edges = [("p", f"v{k}", 1) for k in range(8)] + [("p", "new", -1), ("q", "new", -1), ("q", "v0", 1), ("r", "other", -1)]
    got = {(r["pattern"], r["kind"]): r for r in pii.bootstrap(spark.createDataFrame(edges, "pattern string, value string, kind int")).collect()}
    assert got["p", 1]["score"] > 0.8 and got["p", 1]["seeds"] == 8 and ("r", 1) not in got


def test_bootstrap_equals_a_plain_one(spark):
    rng = random.Random(17)
    edges = {(f"p{p}", f"v{(v - v % 2 + p % 2) if rng.random() < 0.9 else v}") for p, v in ((rng.randrange(30), min(rng.randrange(90), rng.randrange(90))) for _ in range(330))}
    kinds = {f"v{k}": k % 2 for k in range(36)}
    rows = [(p, v, kinds.get(v, -1)) for p, v in sorted(edges)]
    rows += rows[:3]
    known, turns = dict(kinds), 0
    of = collections.defaultdict(set)
    for p, v in edges:
        of[p].add(v)
    while True:
        score = {(p, k): (sum(known.get(v) == k for v in vs) / (len(vs) + pii.DOUBT), sum(known.get(v) == k for v in vs)) for p, vs in of.items() for k in (0, 1)}
        new = {}
        for v in {v for _, v in edges} - set(known):
            belief = {k: 1 - np.prod([1 - score[p, k][0] for p in of if v in of[p] and score[p, k][0] >= 0.4 and score[p, k][1] >= 3]) for k in (0, 1)}
            k = max(belief, key=lambda k: (belief[k], -k))
            if belief[k] >= pii.KNOWN:
                new[v] = k
        if not new:
            break
        known |= new
        turns += 1
    got = {(r["pattern"], r["kind"]): (round(r["score"], 9), r["support"], r["seeds"]) for r in pii.bootstrap(spark.createDataFrame(rows, "pattern string, value string, kind int"), 0.4, 3).collect()}
    assert turns >= 2 and got == {(p, k): (round(s, 9), n, sum(kinds.get(v) == k for v in of[p])) for (p, k), (s, n) in score.items() if n}


def test_pii_finds_broken_identifiers_where_contexts_tell(spark):
    rng = random.Random(41)

    def card(good):
        d = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        last = next(c for c in "0123456789" if pii.luhn(d + c) == good)
        return d + last

    makers = {
        "email": (["mail to", "write", "contact"], lambda: f"u{rng.randrange(10**6)}@m{rng.randrange(99)}.org", lambda: f"u{rng.randrange(10**6)}@m{rng.randrange(99)}"),
        "card": (["card number", "visa", "charged"], lambda: card(True), lambda: card(False)),
        "phone": (["call", "phone no.", "ring"], lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", lambda: f"1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"),
        "ip": (["host", "address", "ping"], lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)), lambda: f"{rng.randrange(300, 999)}.{rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(255)}"),
    }
    rows, planted = [], []
    for k in range(600):
        kind = rng.choice(sorted(makers))
        marks, whole, broken = makers[kind]
        bad = k % 6 == 0
        value = broken() if bad else whole()
        before = " ".join([*words(rng, 6), rng.choice(marks)]) + " "
        rows.append((k, before + value + " " + " ".join(words(rng, 5))))
        if bad:
            planted.append((k, f"{kind}:{len(before)}:{len(before) + len(value)}"))
    rows += [(1000 + k, " ".join([*words(rng, 5), rng.choice(["year", "room", "version"]), str(rng.choice([rng.randrange(10**4), rng.randrange(10**16)])), *words(rng, 5)])) for k in range(200)]
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = sum(span in got[k]["spans"].split(",") for k, span in planted)
    assert hits >= 0.9 * len(planted) and not any(got[1000 + k]["n_found"] for k in range(200))


def test_decontamination_catches_other_figures_and_leaves_clean_text(spark):
    item = "A train leaves Delhi at 60 km per hour and another train leaves after 5 hours at 90 km per hour in the same direction today"
    same = item.replace("60", "75").replace("90", "110").replace("5 ", "7 ")
    mixed = "A train leaves Delhi at 60 km per hour and another train leaves after 5 hours at 60 km per hour in the same direction today"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "short one"), (4, item), (None, item)], "item_id long, text string")
    rng = random.Random(1)
    rows = [(0, " ".join(words(rng, 50)) + " " + same + " " + " ".join(words(rng, 50))), (1, " ".join(words(rng, 3000))), (2, None), (3, ""), (4, item), (5, "short one"), (6, "short one more"), (7, mixed), (4, item), (None, item)]
    d = spark.createDataFrame([(i, t, "en", "s", 1, 1, "x") for i, t in rows], DOCS)
    got = sorted((r["doc_id"], r["n_items"], r["item_id"], r["contaminated"]) for r in decontaminate.flagged(d, bench).collect())
    assert [g for g in got if g[0] == 4] == [(4, 2, 1, True)] * 2
    flags = {g[0]: g[3] for g in got}
    assert flags == {0: True, 1: False, 2: False, 3: False, 4: True, 5: True, 6: False, 7: True} and len(got) == 9
    assert decontaminate.flagged(d.where("false"), bench).count() == 0 and not any(r["contaminated"] for r in decontaminate.flagged(d, bench.where("false")).collect())


def test_decontamination_refuses_mixed_up_slots(spark):
    item = " ".join(f"value {k % 2 + 10} stands with sign {k % 2 + 10} here" for k in range(8))
    odd = " ".join(f"value {k + 100} stands with sign {k + 200} here" for k in range(8))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    d = spark.createDataFrame([(1, item), (2, odd)], "doc_id long, text string")
    assert {r["doc_id"]: r["contaminated"] for r in decontaminate.flagged(d, bench).collect()} == {1: True, 2: False}


def test_decontamination_catches_other_names(spark):
    item = "In the morning John Smith and Dr. Lee sold eggs to the baker (Anna Maria Berg) before John Smith went back to the farm of Dr. Lee"
    other = item.replace("John Smith", "Mary\n Jane Jones").replace("Lee", "Van Horn").replace("Anna Maria Berg", "Otto")
    mixed = item.replace("John Smith", "Mary Jones", 1).replace("Lee", "Horn", 1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item), (2, other), (3, "so it was. " + other + " and more"), (4, mixed), (5, "In the evening nothing was sold")]
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.flagged(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False}


def naive_count(word, scores):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        top = (best[end - 1][0] + token_counts.BYTE_SCORE * size, -(size - best[end - 1][1]))
        for a in range(end):
            if word[a:end] in scores:
                top = max(top, (best[a][0] + scores[word[a:end]], best[a][1] - 1))
        best.append(top)
    return -best[-1][1]


def test_token_counts_equal_separate_programmes(spark, docs, monkeypatch):
    path = tokenizers.path(token_counts.VOCABULARY)
    scores = token_counts.load(path)
    rng = random.Random(8)
    sample = {"▁" + "".join(rng.choice("abcdeéß漢🙂xyz") for _ in range(rng.randrange(1, 14))) for _ in range(400)} | {"▁"}
    assert token_counts.trie_counts(sample, scores) == {w: naive_count(w, scores) for w in sample}
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    got = token_counts.token_counts(docs, path).collect()
    cache = {}
    text = {r[0]: r[1] for r in corpus()}
    for r in got:
        w = (text[r["doc_id"]] or "").split()
        assert r["n_words"] == len(w) and r["n_tokens"] == sum(cache.setdefault(x, naive_count("▁" + x, scores)) for x in w)
    assert len(got) == len(text) + 1


def test_url_rules_and_parts(spark):
    urls = ["https://a.Example.NET/en/1?x#y", "http://example.net/fr/", "https://example.net", "ftp://x.example.com/de/1", "http://b.org/fr/?q", "b.org/fr/", None, "", "x://", "y://H.net?/", "a://b://c.net/z", "http://badexample.com/de/", "http://net/", "h://u@E.com:80/P#/en/"]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judged(pages, spark.createDataFrame([(0, 0)], "page_id long, bad int")).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[1][2:] == ("net/", "block")
    assert got[2][:3] == ("example.net", "", None) and got[3][2:] == ("example.com/de/", "block") and got[4][2:] == ("org/fr/", "allow")
    assert got[5][:3] == got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None) and got[9][:3] == ("h.net", "", None)
    assert got[10][:2] == ("b:", "//c.net/z") and got[11][2] is None and got[12][2] == "net/" and got[13][:2] == ("u@e.com:80", "/P")


def test_reputation_blocks_bad_hosts_only(spark):
    rows = [(k, f"http://{'spam' if k % 2 else 'good'}.example.com/{k}") for k in range(200)] + [(500, "http://new.example.com/"), (501, None)]
    bad = [(k, k % 2) for k in range(200)] + [(0, None), (1, 1), (900, 1)]
    out = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad int")).collect()
    assert {r["verdict"] for r in out if r["host"].startswith("spam")} == {"block"} and {r["verdict"] for r in out if r["host"].startswith("good")} == {"allow"}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r["verdict"] for r in url_filter.judged(pages, none).collect()} == {"allow"} and url_filter.judged(pages.where("false"), none).count() == 0


@pytest.mark.parametrize("top", [3, 300, 49_408, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 7001])
def test_codec_round_trip(n, top):
    x = np.random.default_rng(n + top).integers(0, top, n).astype(np.uint32)
    assert (token_codec.decode(token_codec.encode(x)) == x).all()


def test_codec_blocks_are_independent_checked_and_smaller():
    rng = np.random.default_rng(1)
    x = np.tile(rng.integers(0, 49_000, 300), 40).astype(np.uint32)
    data = token_codec.encode(x)
    assert len(data) < 1.5 * len(x)
    assert token_codec.encode(x[:2048])[20:] == data[8 + 12 * 6 :][: len(token_codec.encode(x[:2048])) - 20]
    for k in (len(data) - 9, 8 + 12 * 6 + 40):
        with pytest.raises(ValueError, match="checksum"):
            token_codec.decode(data[:k] + bytes([data[k] ^ 255]) + data[k + 1 :])
    with pytest.raises(ValueError, match="format"):
        token_codec.decode(b"none" + data[4:])


def test_token_files_hold_the_library_s_ids(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_codec, "SEGMENT", 3000)
    path = tokenizers.path(token_codec.VOCABULARY)
    t = Tokenizer.from_file(path)
    rows = [(i, x) for i, x, *_ in corpus()] + [(900, "Don't İstanbul ΣΑΣ áb ＦＵＬＬ ﬁ 日本 <|endoftext|> a<|startoftext|>b 1,234.50 x! \x1ca\x85b été."), (901, "\n\t")]
    got = token_codec.token_ids(spark.createDataFrame(rows[::-1], "doc_id long, text string"), path).orderBy("doc_id").collect()
    at = 0
    for (i, x), r in zip(sorted(rows), got, strict=True):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_codec.token_ids(docs, path).count() == len(corpus()) + 1
    assert token_codec.token_ids(docs.where("false"), path).count() == 0


def test_chain_takes_the_best_ordered_matches():
    rng = random.Random(6)
    for _ in range(60):
        m = [(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randrange(1, 14))]
        m = sorted(set(m))
        x, r = np.array([a for a, _ in m]), np.array([b for _, b in m])
        best = [0.0] * len(m)
        for i, (a, b) in enumerate(m):
            gains = [best[j] - substring_dedup.GAP * (a - c + b - e) for j, (c, e) in enumerate(m) if c < a and e < b]
            best[i] = substring_dedup.K + max([0.0, *gains])
        chains = substring_dedup.chain(x, r)
        assert sum(c[4] for c in chains) == len(m) and max(c[4] for c in chains) >= 1 and all(c[1] > c[0] and c[3] > c[2] for c in chains)
    line = np.arange(0, 100, 7)
    assert substring_dedup.chain(line, line + 50) == [(0, 98 + substring_dedup.K, 50, 148 + substring_dedup.K, len(line))]


def test_passages_are_found_whole_and_fuzzy(spark):
    rng = random.Random(12)
    passage = words(rng, 60, 10**6)
    fuzzy = [w for w in passage if rng.random() > 0.05]
    rows = [(1, words(rng, 50, 10**6) + passage + words(rng, 50, 10**6)), (2, words(rng, 80, 10**6) + passage), (3, fuzzy + words(rng, 10, 10**6)), (4, words(rng, 200, 10**6)), (5, words(rng, 20000, 10**6)), (6, [])]
    d = spark.createDataFrame([(i, " ".join(w), "en", "s", 1, 1, "x") for i, w in rows] + [(7, None, "en", "s", 1, 1, "x"), (None, " ".join(passage), "en", "s", 1, 1, "x")], DOCS)
    got = {r["doc_id"]: r for r in substring_dedup.duplicated(d).collect()}
    assert set(got) == set(range(1, 8))
    assert got[2]["spans"] == "80:140:1" and got[2]["dup_words"] == 60 and got[1]["n_passages"] == 0 and got[1]["n_copied"] == 2
    assert got[3]["dup_words"] >= 0.8 * len(fuzzy) and all(got[k]["n_passages"] == 0 for k in (4, 5, 6, 7))
    assert substring_dedup.duplicated(d.where("false")).count() == 0


def test_passages_whose_pieces_stood_elsewhere_are_found(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for k in range(40):
        one, two = words(rng, 34, 10**6), words(rng, 34, 10**6)
        fill = [words(rng, 60, 10**6) for _ in range(8)]
        rows += [(4 * k + j, " ".join(fill[2 * j] + p + fill[2 * j + 1])) for j, p in enumerate((one, two, one + two, one + two))]
        want.add(4 * k + 3)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substring_dedup.duplicated(d).collect()}
    assert all(got[i]["dup_words"] >= 62 and f":{i - 1}" in got[i]["spans"] for i in want)
    assert not any(got[i]["n_passages"] for i in got if i not in want)


def test_evenly_edited_passages_are_found(spark):
    rng = random.Random(22)
    rows = []
    for k in range(60):
        p = words(rng, 60, 10**6)
        q = [f"e{rng.randrange(10**9)}" if i % 8 == k % 8 else w for i, w in enumerate(p)]
        rows += [(2 * k, " ".join(words(rng, 60, 10**6) + p + words(rng, 60, 10**6))), (2 * k + 1, " ".join(words(rng, 60, 10**6) + q + words(rng, 60, 10**6)))]
    got = substring_dedup.duplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = [r for r in got if r["doc_id"] % 2 and r["dup_words"] >= 45]
    assert len(found) >= 57 and sum(r["n_copied"] for r in got) == sum(r["n_passages"] for r in got)


def test_edited_passages_whose_pieces_stand_all_around_are_found(spark):
    rng = random.Random(23)
    rows, want = [], set()
    for k in range(30):
        p = words(rng, 80, 10**6)
        q = [f"e{rng.randrange(10**9)}" if i % 14 == 13 else w for i, w in enumerate(p)]
        pieces = [q[i : i + 14] for i in range(0, 80, 14)]

        def strewn():
            return sum((w + words(rng, 20, 10**6) for w in rng.sample(pieces, len(pieces))), [])

        texts = [strewn() for _ in range(8)] + [words(rng, 30, 10**6) + p] + [strewn() for _ in range(8)] + [q + words(rng, 30, 10**6)]
        rows += [(18 * k + j, " ".join(t)) for j, t in enumerate(texts)]
        want.add(18 * k + 17)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substring_dedup.duplicated(d).collect()}
    found = [i for i in want if got[i]["dup_words"] >= 75 and f":{i - 9}" in got[i]["spans"]]
    assert len(found) >= 27, len(found)
    assert not any(got[i]["n_passages"] for i in got if i not in want)


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([(s, lang, t, 100 + 37 * k) for k, (s, lang, t) in enumerate((s, lang, t) for s in "abc" for lang in "xy" for t in "pq")], "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 1.0, "b": 1.0, "c": 2.0}, "lang": {"x": 3.0, "y": 1.0}, "topic": {"p": 1.0, "q": 1.0}}
    rows = mixing.rake(cells, want, turns=30).collect()
    total = sum(r["x"] for r in rows)
    assert abs(total - sum(r["tokens"] for r in rows)) < 1e-6
    for m, share in want.items():
        for v, w in share.items():
            assert abs(sum(r["x"] for r in rows if r[m] == v) / total - w / sum(share.values())) < 1e-6


def test_mixture_draws_by_rate(spark, docs):
    out = mixing.mixture(docs).collect()
    text = {r[0]: r[1] for r in corpus()}
    assert len(out) == len(text) + 1 and all(0 <= r["rate"] <= 1 and r["n_tokens"] == len(re.findall(r"[^ \t\n\r]+", text[r["doc_id"]] or "")) for r in out)
    for r in out:
        draw = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:8], 16) / 2**32
        assert r["sampled"] == (draw < r["rate"]) or abs(draw - r["rate"]) < 1e-5
    kept = mixing.sampled_documents(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if r["sampled"]}
    assert mixing.mixture(docs.where("false")).count() == 0


def test_draw_meets_the_targets_where_cells_are_too_small(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10_000), ("a", "y", "p", 4000), ("b", "x", "p", 3000), ("b", "y", "p", 300), ("b", "y", "q", 500)], "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 1.0, "b": 1.0}, "lang": {"x": 3.0, "y": 1.0}, "topic": {"p": 8.0, "q": 2.0}}
    rows = mixing.drawn(cells, want, 0.4).collect()
    total = sum(r["y"] for r in rows)
    assert all(r["y"] <= r["tokens"] for r in rows) and abs(total - 0.4 * 17_800) < 1
    assert sum(r["y"] for r in rows if r["topic"] == "q") > 499  # has less than its target: drawn whole
    for m, v, w in (("source", "b", 0.5), ("lang", "y", 0.25)):
        assert abs(sum(r["y"] for r in rows if r[m] == v) / total - w) < 1e-3
    half = spark.createDataFrame([("a", "", "", 0), ("b", "", "", 10)], "source string, lang string, topic string, tokens long")
    assert {r["source"]: r["y"] for r in mixing.drawn(half, None, 0.5).collect()} == {"a": 0.0, "b": 5.0}


@pytest.mark.parametrize("make", [lambda d: jaccard_join.jaccard_components(d), lambda d: substring_dedup.duplicated(d), lambda d: pii.personal_data(d)])
def test_empty_tables_give_no_rows(docs, make):
    assert make(docs.where("false")).count() == 0


def test_empty_vectors(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_pipeline_equals_its_parts_by_hand(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(31)
    item = " ".join(words(rng, 30, 10**6))
    rows = [(k, " ".join(words(rng, 40, 500)), "en", f"s{k % 3}", 1) for k in range(80)]
    rows += [(100, rows[5][1], "en", "s1", 1), (101, " ".join(rows[6][1].split()[:-1]), "en", "s1", 1), (102, "x " + item, "en", "s1", 1), (103, None, "en", "s1", 1), (104, "foul " + rows[7][1] + " x y z q r s t u v w" * 3, "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    _, component = brute_components(rows)
    left = [r for r in rows if component[r[0]] == r[0] and r[0] != 102]
    drawn = {r["doc_id"] for r in mixing.mixture(spark.createDataFrame(left, "doc_id long, text string, lang string, source string, n_chars long")).collect() if r["sampled"]}
    assert set(got) == drawn and sorted(r["start"] for r in got.values())[0] == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "decontamination", "mixing", "token_ids"]


def test_jaccard_join_leaves_boilerplate_out_of_its_regions(spark):
    rng = random.Random(33)
    block = words(rng, 60, 10**6)
    rows = [(k, " ".join(block + words(rng, 60, 10**7))) for k in range(300)] + [(400, " ".join(block)), (401, " ".join(block[:-2]))]
    sets = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(jaccard_join._sets, "id long, n long, set array<long>")
    assert [tuple(r) for r in jaccard_join.links(sets).collect()] == [(400, 401)]
    assert {r["component_id"] for r in jaccard_join.jaccard_components(spark.createDataFrame([*rows, (400, "x")], "doc_id long, text string")).where("doc_id >= 400 and n_shingles > 1").collect()} == {400}


def test_templates_take_the_longest_unit_and_runs_of_names(spark):
    texts = ["A car does 60 km/h or 35 mph on 5 km of road", "Natalia sold 12 eggs. John Smith (Anna Berg) paid 3.50 euros", 'He said "Mary" 9kg', "", None, "word " * 30_000 + "at 7 km/h"]
    d = spark.createDataFrame([(t,) for t in texts], "text string").select(*[c.alias(n) for n, c in zip("tw", decontaminate.templates(F.col("text")), strict=True)])
    got = [(r["t"], r["w"]) for r in d.collect()]
    assert got[0][0] == "§name car does §num §unit or §num §unit on §num §unit of road".split()
    assert got[1][0] == "§name sold §num eggs §name §name paid §num §unit".split() and got[1][1][0] == "natalia"
    assert got[2][0] == "§name said §name §num§unit".split() and got[3] == got[4] == ([], []) and got[5][0][-2:] == ["§num", "§unit"] and len(got[5][1]) == 30_003
    assert all(len(t) == len(w) for t, w in got)


def test_long_lists_of_names_and_numbers_are_read(spark):
    item = "Which river runs through the old town of Vienna and then meets the sea"
    rows = [(1, "Anna Berta " * 20000 + item), (2, "x " + "1." * 50000 + "1 " + item), (3, ".,;" * 30000 + "x"), (4, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.contamination(docs, bench).collect()} == {1, 2, 4}


def test_runs_taken_whole_match_what_the_plain_patterns_match(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choice(sign) for _ in range(rng.randint(0, 30))),) for sign in ("1a§ .,:/é", '.,;:!?()"[] x\n', "A\x1fb'- (é", "12. ,") for _ in range(500)]
    plain = decontaminate._TIED.replace("*+", "*")
    for old, new in ((decontaminate._NUMBER, decontaminate._NUMBERS), (decontaminate._TAIL, decontaminate._TAILS), (plain, decontaminate._TIED)):
        mark = "$1#" if old != plain else "#"
        both = spark.createDataFrame(rows, "t string").select("t", F.regexp_replace("t", old, mark).alias("a"), F.regexp_replace("t", new, mark).alias("b"))
        assert not both.where("a <> b").collect() and both.where("a <> t").count() > 100


def test_learning_equals_a_plain_learner(spark):
    rng = random.Random(19)
    rows = [(np.array(sorted({0, *(rng.randrange(1, 40) for _ in range(rng.randrange(1, 12)))})), rng.randrange(2)) for _ in range(150)]
    rows = [(i, int(3 in i or y and 7 in i)) for i, y in rows]
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        bound = 0.0 if i == toxicity.BIAS else toxicity.L1
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - (1 if z[i] > 0 else -1) * bound) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for at, y in rows:
            w = {int(i): weight(int(i)) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in w:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    got = toxicity.fit(rows)
    assert np.allclose(got[:40], [weight(i) for i in range(40)], atol=1e-9) and not got[40:].any() and got[3] > 0 and (got[1:40] == 0).sum() > 20


def test_learning_is_bounded_and_takes_a_text_once(spark):
    rng = random.Random(20)
    rows = [(k, " ".join(words(rng, 30, 200) + ["vile"] * (k % 4 == 0)), "en", "s", 1, 1, "x") for k in range(300)]
    d, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(300)], "doc_id long, quality int, toxic int")
    want = sorted(toxicity.train(d, lab))
    assert want == sorted(toxicity.train(d.union(d), lab)) and want != sorted(toxicity.train(d, lab, max_bytes=9000))
    assert toxicity.train(d, lab, max_bytes=3) == [] and toxicity.toxicity_scores(d.where("false"), lab).count() == 0
    clash = d.selectExpr("*", "1 as toxic", "'z' as score", "2 as rank")
    assert {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(clash.union(clash), lab).collect()} == {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(d, lab).collect()}


def test_raking_goes_on_until_the_targets_are_met(spark):
    rng = random.Random(23)
    cells = [(f"s{a}", f"l{b}", f"t{c}", rng.randrange(1, 10**rng.randrange(1, 6))) for a in range(6) for b in range(3) for c in range(3) if rng.random() < 0.8]
    rows = mixing.rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")).collect()
    total = sum(r["tokens"] for r in rows)
    x = {c[:3]: float(c[3]) for c in cells}
    for _ in range(400):
        for m in range(3):
            have, now = collections.Counter(), collections.Counter()
            for c in cells:
                have[c[m]] += c[3]
                now[c[m]] += x[c[:3]]
            scale = sum(v**mixing.TEMPER for v in have.values())
            x = {c: v * total * have[c[m]] ** mixing.TEMPER / scale / now[c[m]] for c, v in x.items()}
    assert max(abs(r["x"] - x[r["source"], r["lang"], r["topic"]]) for r in rows) < 1e-3 * total


def test_topics_may_come_from_a_column(spark, docs):
    out = mixing.mixture(docs.withColumn("kind", F.when(F.col("doc_id") % 2 == 0, "even")), topic=F.col("kind")).collect()
    assert {r["topic"] for r in out} == {"even", ""} and all((r["topic"] == "even") == (r["doc_id"] % 2 == 0) for r in out)


def _tables(spark, path, rows, columns, labels, items):
    spark.createDataFrame(rows, columns).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_drops_toxic_and_repeated_rows_and_keeps_other_columns(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(37)
    rows = [(k, " ".join(words(rng, 40, 3000) + ["vile"] * (k % 4 == 0)), "en", f"s{k % 3}", 1, "a", 1, None) for k in range(300)]
    rows += [(400, None, None, None, None, None, None, None), (401, "", "en", "s", 0, "b", 2, "c"), (None, "x", "en", "s", 1, "b", 2, "c"), rows[1], rows[1], rows[2]]
    columns = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, rank int, `a.b` string"
    _tables(spark, tmp_path, rows, columns, [(k, 1, int(k % 4 == 0)) for k in range(300)], [(1, "no such thing is here at all")])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = corpus_pipeline.clean(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    left = sorted(r["doc_id"] for r in clean.collect())
    assert left == sorted(r[0] for r in rows if r[0] is not None and (r[0] >= 400 or r[0] % 4))
    one = corpus_pipeline.distinct(spark, clean, str(tmp_path))
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == sorted(set(left))
    for stage in (corpus_pipeline.uncontaminated, corpus_pipeline.mixed):
        assert stage(spark, one, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 20


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    _tables(spark, tmp_path, [], "doc_id long, text string, lang string, source string, n_chars long", [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_embedding_dedup_recall_at_the_threshold(spark):
    assert embedding_dedup.recall() > 0.99
    rng = np.random.default_rng(14)
    v = rng.standard_normal((1500, 48))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    o = rng.standard_normal((1500, 48))
    o -= (o * u).sum(axis=1, keepdims=True) * u
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    c = rng.uniform(0.9301, 0.936, (1500, 1))
    w = (c * u + np.sqrt(1 - c**2) * o) * rng.uniform(0.1, 9, (1500, 1))
    rows = [(2 * k + j, [float(x) for x in row], k % 2) for k in range(1500) for j, row in enumerate((v[k], w[k]))]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sum(r["n_links"] for r in got) >= 0.985 * 3000 and all(r["component_id"] >= r["vec_id"] - 1 for r in got)


def test_repeated_pages_and_long_urls(spark):
    long = "http://a.b.example.org/" + "x/" * 40_000
    pages = spark.createDataFrame([(1, long), (1, long), (2, "http://a.b.example.org/"), (None, "http://c.net/en/")], "page_id long, url string")
    got = url_filter.judged(pages, spark.createDataFrame([(1, 1), (1, 0)], "page_id long, bad int")).collect()
    assert sorted((r["page_id"] or 0, r["host"], len(r["path"]), r["rule"]) for r in got) == [(0, "c.net", 4, "net/"), (1, "a.b.example.org", 80_001, None), (1, "a.b.example.org", 80_001, None), (2, "a.b.example.org", 1, None)]


def test_coder_is_smaller_than_zlib_and_order_0():
    rng = np.random.default_rng(3)
    odds = 1 / np.arange(4, 3004)  # ids as in text: some very frequent, and phrases that a page repeats
    some, pieces = rng.choice(3000, 400_000, p=odds / odds.sum()), []
    for page in range(100):
        phrases = [some[page * 4000 + 7 * k :][: rng.integers(3, 7)] for k in range(40)]
        at = page * 4000 + 300
        for r in rng.random(450):
            pieces.append(phrases[int(r * 160)] if r < 0.25 else some[at : at + 4])
            at += 4
    x = rng.permutation(48_000)[:3000].astype(np.uint32)[np.concatenate(pieces)]
    assert len(x) > token_codec.LARGE
    data = token_codec.encode(x)
    p = np.unique(x, return_counts=True)[1] / len(x)
    assert (token_codec.decode(data) == x).all()
    assert len(data) < len(zlib.compress(x.astype("<u2").tobytes(), 6)) and 8 * len(data) / len(x) < -(p * np.log2(p)).sum()


@pytest.mark.parametrize("n", [token_codec.LARGE - 1, token_codec.LARGE, token_codec.LARGE + 5000])
def test_coder_keeps_rare_ids_of_large_segments(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 60_000, n).astype(np.uint32)  # more ids than the table takes
    x[rng.integers(0, n, 50)] = 2**32 - 1 - rng.integers(0, 9, 50)
    assert (token_codec.decode(token_codec.encode(x)) == x).all()


def test_segments_are_small_however_large_the_file(spark):
    path = tokenizers.path(token_codec.VOCABULARY)
    docs = spark.range(8).coalesce(1).selectExpr("id as doc_id", "repeat('a b c d ', 200000) as text")  # one task, 6,400,008 ids
    rows = docs.mapInArrow(token_codec._writer(path, 1), "shard long, segment long, n_ids long, docs array<long>, sizes array<long>, payload binary").select("segment", "n_ids", "docs").collect()
    assert sum(r["n_ids"] for r in rows) == 8 * 800_001 and max(r["n_ids"] for r in rows) <= 4 << 20
    assert [r["segment"] for r in rows] == list(range(len(rows))) and [d for r in rows for d in r["docs"]] == list(range(8))


def test_words_of_passages_are_asked_for_by_ranges_and_not_shuffled_again(spark, docs):
    import pandas as pd

    chains = np.array([[7, 7, 9], [3, 4, 3], [0, 500, 640], [9000, 560, 700], [100, 0, 0], [9100, 60, 60]])  # x, r, xs, xe, rs, re
    got = pd.DataFrame(substring_dedup._bounds(5, chains))
    block = substring_dedup.BLOCK
    near = {(d, k) for x, r, xs, xe, rs, re in chains.T for d, a, b in ((x, xs, xe), (r, rs, re)) for k in range(max(a - substring_dedup.REACH, 0) // block, (b + substring_dedup.REACH) // block + 1)}
    asked = got[~got["chain"]]
    assert sorted((d, k) for d, a, b in zip(asked["x"], asked["r"], asked["xs"]) for k in range(a, b + 1)) == sorted(near)  # each block once
    assert len(asked) == 4 and (got[got["chain"]][list(substring_dedup._CHAIN)].to_numpy().T == chains).all()
    code = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (np.diff(substring_dedup._short(code).view(np.int64)) >= 0).all() and (substring_dedup._short(code) & np.uint64(3) == code & np.uint64(3)).all()
    words = common.stored(docs.select("doc_id", "text"), 5, "doc_id")
    assert sorted(map(tuple, words.collect()), key=repr) == sorted(map(tuple, docs.select("doc_id", "text").collect()), key=repr)
    plan = words.join(spark.range(90).withColumnRenamed("id", "doc_id").hint("merge"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and common.stored(docs.where("false"), 5, "doc_id").count() == 0


def test_special_tokens_are_told_from_their_look_alikes(spark):
    from tokenizers import Tokenizer

    path = tokenizers.path(token_codec.VOCABULARY)
    t, w = Tokenizer.from_file(path), token_codec.remembered(path)
    w.forget()
    import pyarrow as pa

    for texts in (["a <|ENDOFTEXT|> B <|endoftext|>, <|EndOfText|>", "The THE the, The!!", None], ["<|endoftext|>", "été Été ÉTÉ. x'S don't 12th a\u0301 \u212a"], ["", "   "], ["the THE <|EndOfText|> İ ﬁ"]):
        ids, size = w.encode(token_codec.words_of(pa.array(texts, pa.string())))
        want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert ids.tolist() == [i for x in want for i in x] and size.tolist() == list(map(len, want))


def test_passages_cover_every_exact_run(spark):
    rng = random.Random(51)
    pool = [words(rng, rng.randrange(8, 90), 10**6) for _ in range(60)]
    rows = []
    for k in range(160):
        t = words(rng, rng.randrange(5, 40), 10**6)
        for _ in range(rng.randrange(4)):
            t += rng.choice(pool)[rng.randrange(6) :] + words(rng, rng.randrange(30), 10**6)
        rows.append((k, t + (["so"] * rng.randrange(200) if k % 7 == 0 else [])))
    got = {r["doc_id"]: r["spans"] for r in substring_dedup.duplicated(spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string")).collect()}
    seen, all_, found = {}, 0, 0
    for k, t in rows:
        runs = [tuple(t[i : i + 43]) for i in range(len(t) - 42)]
        cover = {j for i, r in enumerate(runs) if r in seen and seen[r] != k for j in range(i, i + 43)}
        spans = {j for s in filter(None, got[k].split(",")) for j in range(*map(int, s.split(":")[:2]))}
        all_, found = all_ + len(cover), found + len(cover & spans)
        assert not any(all(j + i in cover - spans for i in range(substring_dedup.WINDOW)) for j in cover)  # a few words at an end at most
        for r in runs:
            seen.setdefault(r, k)
    assert all_ > 1500 and found > 0.995 * all_


def test_chain_score_is_that_of_all_orders():
    rng = random.Random(61)
    for _ in range(60):
        m = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randrange(1, 14))})
        best = []
        for a, b in m:
            best.append(substring_dedup.K + max([0.0, *(best[j] - substring_dedup.GAP * (a - c + b - e) for j, (c, e) in enumerate(m[: len(best)]) if c < a and e < b)]))
        chains = substring_dedup.chain(np.array([a for a, _ in m]), np.array([b for _, b in m]))
        top = m[max(range(len(m)), key=lambda i: (best[i], -i))] if m else None
        ends = {(c[1] - substring_dedup.K, c[3] - substring_dedup.K) for c in chains}
        near = {m[i] for i in range(len(m)) if best[i] > max(best) - 1e-9}
        assert near & ends and top in near


def test_word_memory_forgets_without_a_trace(monkeypatch):
    from tokenizers import Tokenizer
    import pyarrow as pa

    monkeypatch.setattr(token_codec, "REMEMBERED", 60)
    path, rng = tokenizers.path(token_codec.VOCABULARY), random.Random(77)
    t, w = Tokenizer.from_file(path), token_codec.WordIds(path)
    pool = ["often", "seen,", "again!!", "über", "naïve.", "x1y2", "Don't"]
    for _ in range(40):
        texts = [" ".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdeé,.1") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(30))) for _ in range(2)]
        ids, size = w.encode(token_codec.words_of(pa.array(texts)))
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert ids.tolist() == [i for x in want for i in x] and size.tolist() == list(map(len, want))
    assert len(w.hash) <= 60 and len(w.size) <= 130
