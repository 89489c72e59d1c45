"""Merged tables: only touched parts are rewritten, versions are whole, writers do not lose each other's rows."""

from __future__ import annotations

from pathlib import Path

from docketry.sources import ledger, sinks


def frame(spark, rows):
    return spark.createDataFrame(rows, "case_id string, v string")


def folders(path):
    return {k: f for k, f in sinks._manifest(path[0], path[1])[1]["held"].items()}


def test_a_merge_of_one_case_writes_one_part(spark, tmp_path):
    at = f"{tmp_path}/t"
    sinks.merge_table(frame(spark, [(f"c{k}", "old") for k in range(200)]), at, ["case_id"], parts=16)
    before = folders((spark, at))
    assert len(before) == 16
    got = sinks.merge_table(frame(spark, [("c7", "new")]), at, ["case_id"])
    after = folders((spark, at))
    assert sum(before[k] != after[k] for k in before) == 1 and after.keys() == before.keys()
    rows = {r["case_id"]: r["v"] for r in got.collect()}
    assert len(rows) == got.count() == 200 and rows["c7"] == "new" and set(rows.values()) == {"old", "new"}

    assert not any(Path(at, "staged").iterdir())
    assert sinks.merge_table(frame(spark, []), at, ["case_id"]).count() == 200 and len(ledger.records(spark, f"{at}/manifest")) == 2


def test_the_first_merge_may_be_empty_and_columns_may_come_later(spark, tmp_path):
    at = f"{tmp_path}/t"
    assert sinks.merge_table(frame(spark, []), at, ["case_id"]).collect() == []
    sinks.merge_table(frame(spark, [("a", "1"), ("b", "2")]), at, ["case_id"], parts=3)
    more = spark.createDataFrame([("b", 5)], "case_id string, n long")
    got = sorted((r["case_id"], r["v"], r["n"]) for r in sinks.merge_table(more, at, ["case_id"]).collect())
    assert got == [("a", "1", None), ("b", None, 5)]


def test_a_writer_that_comes_second_merges_on_top(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/t"
    sinks.merge_table(frame(spark, [("a", "1"), ("b", "1")]), at, ["case_id"], parts=1)
    own, calls = ledger.claim, []

    def late(spark_, folder, name, record):
        calls.append(name)
        if len(calls) == 1:  # another writer is faster
            monkeypatch.setattr(ledger, "claim", own)
            sinks.merge_table(frame(spark, [("c", "other"), ("b", "other")]), at, ["case_id"])
            monkeypatch.setattr(ledger, "claim", late)
        return own(spark_, folder, name, record)

    monkeypatch.setattr(ledger, "claim", late)
    got = sinks.merge_table(frame(spark, [("a", "mine")]), at, ["case_id"])
    assert sorted(map(tuple, got.collect())) == [("a", "mine"), ("b", "other"), ("c", "other")]
    assert calls == ["00000001.json", "00000002.json"] and not own(spark, f"{at}/manifest", "00000002.json", {})


def test_old_folders_go_after_their_lease(spark, tmp_path):
    at = f"{tmp_path}/t"
    for v in "123":
        sinks.merge_table(frame(spark, [("a", v)]), at, ["case_id"])
    assert sinks.sweep_table(spark, at) == [] and len(sinks.sweep_table(spark, at, lease=0)) == 2
    assert [tuple(r) for r in sinks.read_table(spark, at).collect()] == [("a", "3")]
    (tmp_path / "t" / "data" / "00000000000000000001-dead").mkdir()  # of a run that died
    assert len(sinks.sweep_table(spark, at)) == 1
