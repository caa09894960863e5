import datetime as dt
import random

import pytest

from flowframe.operators.aggregate import aggregate
from flowframe.plans import ordered
from flowframe.streaming.hot import read_regrouped, regroup_each

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp, i int, closing boolean, p string"


@pytest.fixture(autouse=True, scope="module")
def many_borders():
    before, ordered.BORDER_SAMPLE = ordered.BORDER_SAMPLE, 1
    yield
    ordered.BORDER_SAMPLE = before


@pytest.mark.parametrize("rule", [{"count": 4}, {"closes": "closing"}, {"closes": "closing", "count": 5}, {"gap": "20 seconds", "time": "at"},
                                  {"closes": "closing", "gap": "20 seconds", "time": "at"}])
def test_batches_give_what_one_frame_gives(spark, tmp_path, rule):
    rng = random.Random(str(rule))
    rows, second = [], 0
    for i in range(160):
        second += rng.choice([1, 5, 30])
        rows.append((rng.choice(["hot", "hot", "hot", "a", None]), START + dt.timedelta(seconds=second), i, rng.random() < 0.2, str(i)))
    path, cuts = str(tmp_path / "out"), [0, 40, 40, 41, 100, 160]
    each = regroup_each(path, {"k": "k"}, ["at", "i"], payload="p", **rule)
    for batch_id, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        part = spark.createDataFrame(rows[low:high], SCHEMA)
        each(part, batch_id)
        if batch_id in (0, 3):
            each(part, batch_id)  # a batch that is run again changes nothing
    got = sorted((r["k"] or "", r["group_start"], r["position"], r["n"], r["payload"]) for r in read_regrouped(spark, path, ["k"], partial=True).collect())
    df = spark.createDataFrame(rows, SCHEMA)
    whole = aggregate(df, {"k": "k"}, ["at", "i"], payload="p", partial=True, **rule).collect()
    want = []
    for r in whole:
        if "payloads" in r:
            want += [(r["k"] or "", r["group_start"], r["group_start"] + k, r["n"], p) for k, p in enumerate(r["payloads"])]
        else:
            want.append((r["k"] or "", r["group_start"], r["position"], r["n"], r["payload"]))
    assert got == sorted(want)
    if "gap" not in rule:
        released = aggregate(df, {"k": "k"}, ["at", "i"], payload="p", **rule)
        released = {(r["k"], r["group_start"]) for r in released.collect()}
        assert {(r["k"], r["group_start"]) for r in read_regrouped(spark, path, ["k"]).collect()} == released
    assert len(list((tmp_path / "out/state").iterdir())) == 3
