"""Operator 10 against its SQL where cells ask for more than they have."""

from __future__ import annotations

import random

import duckdb

from docketry.llm import mixing


def test_mixing_equals_its_sql_on_scarce_and_empty_cells(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for k in range(1200):
        mark = rng.choice(["", "", "", " a | b", ' token = "x"', " license"])
        source, lang = ("hot", "en") if k % 40 else (rng.choice(["s1", "s2", None]), rng.choice(["de", "en", None]))
        rows.append((k, None if k % 500 == 0 else " ".join("w" for _ in range(rng.randrange(0, 60))) + mark, lang, source))
    rows += [(2000, "", "xx", "none"), rows[3], (None, "no id", "en", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, mixing.op10_mixing(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    columns = "doc_id, source, lang, topic, n_tokens, rate, sampled"
    want = sorted(con.sql(f"select {columns} from ({mixing.ORACLE_SQL})").fetchall())
    assert len(got) == len(want) == 1202 and {r[5] for r in got if r[4]} > {1.0}
    assert [r[4:] for r in got if r[0] == 2000] == [(0, 1.0, True)]
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-6 and a[6] == b[6]
    con.execute("create or replace view documents as select 1::bigint as doc_id, ''::varchar as text, ''::varchar as lang, ''::varchar as source where false")
    assert con.sql(mixing.ORACLE_SQL).fetchall() == []
