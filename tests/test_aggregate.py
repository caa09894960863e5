import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowframe.operators.aggregate import aggregate, aggregate_sequence
from flowframe.plans import ordered

START = dt.datetime(2024, 1, 1)


def fold(rows, *, count=None, closes=False, gap=None, size=False, partial=False):
    """The rules as a plain loop over (key, second, closing, size, payload) in order."""
    out, open_rows = [], {}
    for key, second, closing, expected, payload in rows:
        held = open_rows.setdefault(key, [])
        if gap is not None and held and second - held[-1][0] > gap:
            out.append((key, [p for _, p in held]))
            held.clear()
        held.append((second, payload))
        limit = expected if size else count
        if (limit is not None and len(held) == limit) or (closes and closing):
            out.append((key, [p for _, p in held]))
            held.clear()
    if partial or gap is not None:
        out += [(key, [p for _, p in held]) for key, held in open_rows.items() if held]
    return sorted(out, key=repr)


def groups(spark, rows, **options):
    data = [
        (key, START + dt.timedelta(seconds=second), i, closing, size, payload)
        for i, (key, second, closing, size, payload) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data, "k string, ts timestamp, i int, closing boolean, size int, payload int"
    )
    out = aggregate(df, {"k": "k"}, ["ts", "i"], **options).collect()
    return out


@pytest.fixture(autouse=True, scope="module")
def many_borders():
    """Every row may become a border between chunks."""
    before, ordered.BORDER_SAMPLE = ordered.BORDER_SAMPLE, 1
    yield
    ordered.BORDER_SAMPLE = before


def as_pairs(out):
    """Groups as (key, payloads), from rows of any of the three shapes; ``n`` is always the whole group's."""
    whole, sizes = {}, {}
    for row in sorted(map(lambda r: r.asDict(), out), key=lambda r: (repr(r["k"]), r["group_start"], r.get("part", 0), r.get("position", 0))):
        place = (row["k"], row["group_start"])
        whole.setdefault(place, []).extend(row["payloads"] if "payloads" in row else [row["payload"]])
        sizes[place] = row["n"]
    assert all(sizes[place] == len(found) for place, found in whole.items())
    return sorted([(key, found) for (key, _), found in whole.items()], key=repr)


RULES = [
    (dict(count=3), dict(count=3)),
    (dict(count=3, partial=True), dict(count=3, partial=True)),
    (dict(closes="closing"), dict(closes=True)),
    (dict(closes="closing", partial=True, list_rows=2), dict(closes=True, partial=True)),
    (dict(gap="10 seconds", time="ts"), dict(gap=10)),
    (dict(gap="10 seconds", time="ts", count=2), dict(gap=10, count=2)),
    (dict(gap="10 seconds", time="ts", closes="closing"), dict(gap=10, closes=True)),
    (dict(count=2, closes="closing"), dict(count=2, closes=True)),
    (dict(gap="10 seconds", time="ts", count=2, closes="closing"), dict(gap=10, count=2, closes=True)),
]


@st.composite
def streams(draw):
    n = draw(st.integers(1, 25))
    second, rows = 0, []
    for i in range(n):
        second += draw(st.sampled_from([0, 1, 10, 11]))
        key = draw(st.sampled_from(["a", "a", "b", None]))
        rows.append((key, second, draw(st.booleans()) if draw(st.booleans()) else None, 2, i))
    return rows


@pytest.mark.parametrize("rule,plain", RULES)
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=streams())
def test_rules_match_a_plain_fold(spark, rule, plain, rows):
    wanted = fold(rows, **plain)
    # However many chunks the rows are cut into.
    for chunks in (1, 7):
        assert as_pairs(groups(spark, rows, chunks=chunks, **rule)) == wanted


@pytest.mark.parametrize("rule,plain", RULES)
def test_one_key_with_most_rows(spark, rule, plain):
    rows = [("hot" if i % 3 else f"k{i}", i * (1 if i % 7 else 12), i % 11 == 0, 2, i) for i in range(400)]
    rows = [(k, s, c, z, i) for i, (k, s, c, z, _) in enumerate(sorted(rows, key=lambda r: r[1]))]
    assert as_pairs(groups(spark, rows, chunks=9, **rule)) == fold(rows, **plain)


SEQUENCE = "payload string, correlation_id string, at int, sequence_number int, sequence_size int"


@pytest.mark.parametrize("order", [["at"], None])
def test_sequence_out_of_order(spark, order):
    rows = [("third", "order-9", 1, 3, 3), ("first", "order-9", 2, 1, 3), ("lonely", "order-4", 3, 1, 2), ("second", "order-9", 4, 2, 3)]
    out = aggregate_sequence(spark.createDataFrame(rows, SEQUENCE), order).collect()
    assert [(r["correlation_id"], r["n"], r["payloads"]) for r in out] == [("order-9", 3, ["first", "second", "third"])]


@pytest.mark.parametrize("chunks", [1, 5])
def test_an_id_used_again_starts_a_new_group(spark, chunks):
    told = [("a1", 1, 2), ("a2", 2, 2), ("b3", 3, 3), ("b1", 1, 3), ("b2", 2, 3), ("c1", 1, 1), ("d2", 2, 2), ("d1", 1, 2), ("e1", 1, 2)]
    rows = [(name, "k", at, place, size) for at, (name, place, size) in enumerate(told)]
    out = aggregate_sequence(spark.createDataFrame(rows, SEQUENCE), ["at"], chunks=chunks).orderBy("group_start").collect()
    assert [r["payloads"] for r in out] == [["a1", "a2"], ["b1", "b2", "b3"], ["c1"], ["d1", "d2"]]


def test_release_and_output_expressions(spark):
    df = spark.createDataFrame([("pear", 1), ("plum", 2), ("stop", 3)], "payload string, i int")
    out = aggregate(df, {"k": "1"}, ["i"], closes="payload = 'stop'", where="payload like 'p%'").orderBy("position").collect()
    assert [(r["n"], r["payload"]) for r in out] == [(3, "pear"), (3, "plum")]
    out = aggregate(df, {"k": "1"}, ["i"], closes="payload = 'stop'", output={"top": F.max("payload")}).collect()
    assert [(r["n"], r["top"]) for r in out] == [(3, "stop")]


@pytest.mark.parametrize("rows", [10, 20_000])
def test_the_shape_does_not_depend_on_the_size(spark, rows):
    df = spark.range(rows).selectExpr("id", "id AS payload")
    out = aggregate(df, {"k": "0"}, ["id"], closes=f"id = {rows - 1}")
    assert out.columns == ["k", "group_start", "position", "n", "payload"]
    assert out.agg(F.count("*"), F.min("n"), F.max("n"), F.max("position")).first() == (rows,) * 4
    pages = aggregate(df, {"k": "0"}, ["id"], closes=f"id = {rows - 1}", list_rows=4).orderBy("part").collect()
    assert {r["n"] for r in pages} == {rows}
    assert [x for r in pages for x in r["payloads"]] == list(range(rows)) and max(len(r["payloads"]) for r in pages) == 4


def test_timeout_told_by_each_message(spark):
    data = [(0, 5), (4, 100), (90, 1), (92, 50), (140, 1)]
    df = spark.createDataFrame([(START + dt.timedelta(seconds=s), w, s) for s, w in data], "ts timestamp, wait int, payload int")
    gap = F.expr("make_dt_interval(0, 0, 0, wait)")
    out = aggregate(df, {"k": "1"}, ["ts"], gap=gap, time="ts").collect()
    assert as_pairs(out) == [(1, [0, 4, 90]), (1, [92, 140])]


def test_settings_are_checked(spark):
    df = spark.range(1).selectExpr("id", "id AS payload")
    with pytest.raises(ValueError):
        aggregate(df, {"k": "0"}, ["id"])
    with pytest.raises(ValueError):
        aggregate(df, {"k": "0"}, ["id"], count=2, size="2")
    with pytest.raises(ValueError):
        aggregate(df, {"k": "0"}, ["id"], gap="1 second")
