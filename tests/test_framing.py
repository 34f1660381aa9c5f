"""Records of files that span lines: the same rows whatever the length, in time that grows with the lines."""

from __future__ import annotations

import re

from tradewind.sources import framing


def plans_of(monkeypatch):
    plans, stage = [], framing.stage

    def kept(df, label):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return stage(df, label)

    monkeypatch.setattr(framing, "stage", kept)
    return plans


def frames_to_the_end(plans):
    """Frames that end unbounded but don't begin so: Spark reads on to the end of the split for each of its rows."""
    return [f for p in plans for f in re.findall(r"specifiedwindowframe\(RowFrame, (?!unboundedpreceding)[^,]*, unboundedfollowing", p)]


def test_csv_frames_do_not_run_to_the_end_of_a_split(spark, tmp_path, monkeypatch):
    plans = plans_of(monkeypatch)
    (tmp_path / "a.csv").write_text('id,note\n1,"one\ntwo"\n2,"never\n3,plain\n4,"a\n\nb"\n')
    found = framing.csv_records(framing.lines_of(spark, [f"{tmp_path}/a.csv"]))
    told = {(r["text"], r["broken"]) for r in found.collect()}
    assert told == {("id,note", False), ('1,"one\ntwo"', False), ('2,"never', True), ("3,plain", False), ('4,"a\n\nb"', False)}
    assert plans and not frames_to_the_end(plans)


def test_json_frames_do_not_run_to_the_end_of_a_split(spark, tmp_path, monkeypatch):
    plans = plans_of(monkeypatch)
    (tmp_path / "a.json").write_text('[\n{"a": 1,\n"b": [2\n]},\n{"a": 2}\n]\n')
    found = framing.json_records(framing.lines_of(spark, [f"{tmp_path}/a.json"]))
    assert found.count() == 2
    assert plans and not frames_to_the_end(plans)
