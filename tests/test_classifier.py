"""The ledger of classifier answers: nothing is asked twice, failures stay open, the budget holds."""

import glob
import json
import os

import pytest

from viewpulse.operators import keywords as K
from viewpulse.plans import classifier as CL
from viewpulse.plans.daily_run import refresh_keyword_map
from viewpulse.sources import dictionary as D
from viewpulse.sources import logs as L


def words(spark, names):
    return spark.createDataFrame([(n,) for n in names], "keyword string").repartition(3)


def teller(folder, fails=lambda batch, before: False, says=lambda w: "Music"):
    """A classifier that leaves a file for each call, so that calls in tasks can be counted."""
    os.makedirs(folder, exist_ok=True)

    def classify(batch):
        import glob as g
        import json as j
        import os as o
        import uuid as u

        before = sum(j.load(open(f)) == sorted(batch) for f in g.glob(f"{folder}/*.json"))
        with open(f"{folder}/{u.uuid4().hex}.json", "w") as f:
            j.dump(sorted(batch), f)
        o.sync()
        if fails(batch, before):
            raise RuntimeError("service down")
        return {w.upper(): says(w) for w in batch}

    return classify


def calls(folder):
    return sorted(json.load(open(f)) for f in glob.glob(f"{folder}/*.json"))


def test_answers_are_kept_and_not_asked_for_again(spark, scratch):
    ask = lambda n: dict(map(tuple, CL.ask(words(spark, n), teller(f"{scratch}/calls"), f"{scratch}/ledger", batch=2).collect()))
    names = [f"kw{i}" for i in range(7)]
    assert ask([*names, "kw0"]) == dict.fromkeys(names, "Music")  # names are compared in lower case
    first = calls(f"{scratch}/calls")
    assert sorted(w for c in first for w in c) == names and max(map(len, first)) <= 2
    assert ask(names) == dict.fromkeys(names, "Music") and calls(f"{scratch}/calls") == first
    # a task that is run again finds what its first attempt stored
    todo = CL.batches(words(spark, names), 2).toPandas()
    again = CL._asking(lambda b: 1 / 0, CL.Ledger(f"{scratch}/ledger"))
    assert next(again(iter([todo])))["called"].sum() == 0


def test_failed_calls_are_repeated_and_then_left_open(spark, scratch):
    once = teller(f"{scratch}/once", fails=lambda batch, before: "kw3" in batch and before == 0)
    got = CL.ask(words(spark, [f"kw{i}" for i in range(6)]), once, f"{scratch}/l1", batch=1, backoff_seconds=0.01)
    assert {r.category for r in got.collect()} == {"Music"} and calls(f"{scratch}/once").count(["kw3"]) == 2
    never = teller(f"{scratch}/never", fails=lambda batch, before: "kw3" in batch)
    got = CL.ask(words(spark, [f"kw{i}" for i in range(6)]), never, f"{scratch}/l2", batch=1, attempts=2, backoff_seconds=0.01)
    assert {r.keyword: r.category for r in got.collect()}["kw3"] is None and calls(f"{scratch}/never").count(["kw3"]) == 2


def test_budget_of_calls(spark, scratch):
    names = [f"kw{i}" for i in range(9)]
    for total in (4, 8, 9):
        got = CL.ask(words(spark, names), teller(f"{scratch}/calls"), f"{scratch}/ledger", batch=1, call_budget=4)
        assert len(calls(f"{scratch}/calls")) == total == sum(r.category is not None for r in got.collect())
    failing = teller(f"{scratch}/failing", fails=lambda batch, before: True)
    CL.ask(words(spark, names), failing, f"{scratch}/l3", batch=1, call_budget=11, attempts=5, backoff_seconds=0.01)
    assert len(calls(f"{scratch}/failing")) == 11  # failed calls count


def test_awkward_keywords_and_answers(spark, scratch):
    odd = ["", "a\nb", "é", "it's", '"']
    got = CL.ask(words(spark, [*odd, None]), lambda batch: {w: None if w == "é" else "Other" for w in batch}, f"{scratch}/ledger", batch=2)
    assert {r.keyword: r.category for r in got.collect()} == {w: None if w == "é" else "Other" for w in odd}
    assert CL.ask(words(spark, odd), lambda batch: None, f"{scratch}/l2").where("category IS NOT NULL").count() == 0
    assert CL.ask(words(spark, odd).limit(0), lambda batch: 1 / 0, f"{scratch}/l3").collect() == []
    with pytest.raises(ValueError):
        CL.classify_open(words(spark, odd), classifier=lambda b: {})


def test_rules_come_first(spark, scratch):
    got = {r[0]: r[1] for r in CL.classify_open(words(spark, ["vtv9", "love", "kw"]), teller(f"{scratch}/calls"), f"{scratch}/ledger").collect()}
    assert got == {"vtv9": "TV Channel", "love": "Romance", "kw": "Music"} and calls(f"{scratch}/calls") == [["kw"]]
    assert {r[1] for r in CL.classify_open(words(spark, ["kw"])).collect()} == {"Other"}
    assert K.classify(words(spark, ["kw"]), fallback=None).first()["category"] is None


def test_a_failing_refresh_is_filled_by_the_next(spark, scratch):
    """A classifier that fails gives no entry; the next refresh asks for what is missing, and only that."""
    from fixtures import END, START
    from test_io_run import _write_daily_logs

    _write_daily_logs(spark, scratch)
    log = L.read_search_log(spark, f"{scratch}/search", START, END)
    refresh = lambda old, new, c: {r[0]: r[1] for r in refresh_keyword_map(
        spark, log, END, old, new, START, c, f"{scratch}/ledger", batch=1, attempts=1).collect()}
    open_words = {r[0] for r in D.read_keyword_map(spark, f"{scratch}/map/mapping.csv").collect()}
    broken = teller(f"{scratch}/broken", fails=lambda batch, before: True)
    v1 = refresh(f"{scratch}/map/mapping.csv", f"{scratch}/map/v1", broken)
    assert "zzz" not in v1 and "Other" not in {c for w, c in v1.items() if w not in open_words}
    v2 = refresh(f"{scratch}/map/v1", f"{scratch}/map/v2", teller(f"{scratch}/works", says=lambda w: "Other"))
    assert v2["zzz"] == "Other" and {k: v2[k] for k in v1} == v1
    works = len(calls(f"{scratch}/works"))
    assert refresh(f"{scratch}/map/v2", f"{scratch}/map/v3", teller(f"{scratch}/works")) == v2 and len(calls(f"{scratch}/works")) == works
