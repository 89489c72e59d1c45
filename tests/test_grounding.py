"""The containment join against every pair, and runs of words against plain Python."""

from __future__ import annotations

import random
import re

import pytest

from docketry.functions import text as X
from docketry.operators import evidence


def runs(text, n):
    w = re.findall("[a-z0-9]+", text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
@pytest.mark.parametrize("least", [0.55, 1.0, 0.1])
def test_containment_equals_every_pair(spark, broadcast_rows, least):
    rng = random.Random(7)
    hot = "every text has these words in it"
    source = {k: f"{hot} " + " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 60))) for k in range(80)}
    claim = {}
    for k in range(40):
        w = source[rng.randrange(80)].split()
        claim[k] = " ".join(x if rng.random() > 0.08 else "New-" + x for x in w[: rng.randrange(1, 50)])
    claim |= {100: "", 101: "two words", 102: hot, 103: hot + " and nothing else", 104: None}
    source |= {200: "", 201: None, 202: hot}
    frame = lambda rows, key: spark.createDataFrame([*rows.items(), next(iter(rows.items()))], f"{key} long, text string").repartition(5)
    got = evidence.grounding_join(frame(claim, "item"), frame(source, "doc"), "item", "doc", 3, least, broadcast_rows)
    want = {}
    for a, x in claim.items():
        for b, y in source.items():
            have, held = runs(x or "", 3), runs(y or "", 3)
            if have and len(have & held) / len(have) >= least:
                want[a, b] = len(have & held) / len(have)
    assert {(r["item"], r["doc"]): r["ground"] for r in got.collect()} == want and len(want) > 20


def test_runs_of_words(spark):
    for t in ("", "  ", "A-b c", "1,2;3 FOUR five", "é one é two éé three four", "x" * 10, " lead and trail ! "):
        row = spark.createDataFrame([(t,)], "t string").select(X.words("t").alias("w"), X.shingles("t", 2).alias("s")).first()
        assert row["w"] == re.findall("[a-z0-9]+", t.lower()) and len(row["s"]) == len(runs(t, 2))
