import random

from cargotide.operators import events as E
from conftest import day, days

EVENTS = [day(t) for t in ("2024-02-08", "2024-02-09", "2024-02-20", "2024-09-17", "2025-01-28")]


def setup(spark):
    table = spark.createDataFrame([(d, n) for n, d in enumerate(EVENTS)], "date date, event_order int")
    frame = spark.createDataFrame([(d,) for d in days("2024-01-20", 420)], "d date")
    return frame, table


def test_next_and_last_event_equal_a_scan(spark):
    frame, table = setup(spark)
    out = E.next_event(frame, table, "strict", "d")
    out = E.next_event(out, table, "incl", "d", strict=False)
    out = E.last_event(out, table, "last", "d")
    for r in out.collect():
        later = [e for e in EVENTS if e > r.d]
        same = [e for e in EVENTS if e >= r.d]
        past = [e for e in EVENTS if e <= r.d]
        assert r.strict == ((min(later) - r.d).days if later else 365)
        assert r.incl == ((min(same) - r.d).days if same else 365)
        assert r["last"] == ((r.d - max(past)).days if past else 365)


def test_lookback_and_lookahead_hide_events(spark):
    frame = spark.createDataFrame([(d,) for d in days("2024-03-01", 30)], "d date")
    _, table = setup(spark)
    out = E.last_event(frame, table, "seen", "d", lookback_days=0)
    assert {r.seen for r in out.collect()} == {365}
    out = E.next_event(frame, table, "ahead", "d", lookahead_days=10)
    assert {r.ahead for r in out.collect()} == {365}


def test_nearest_event_with_ties(spark):
    frame, table = setup(spark)
    rng = random.Random(1)
    ranks = list(range(len(EVENTS)))
    rng.shuffle(ranks)
    table = spark.createDataFrame(list(zip(EVENTS, ranks)), "date date, event_order int")
    for r in E.nearest_event(frame, table, "near", "d").collect():
        best = min(zip(EVENTS, ranks), key=lambda e: (abs((e[0] - r.d).days), e[1]))[0]
        assert r.near == (best - r.d).days, r.d


def test_operational_status_order(spark):
    cal = spark.createDataFrame([("business", 2025, "x", day("2025-01-05"))], "kind string, key_year int, name string, date date")
    frame = spark.createDataFrame([(d, v) for d, v in zip(days("2025-01-04", 4), [None, 3.0, 0.0, 7.0])], "d date, v double")
    rows = E.operational_status(frame, cal, "v", "d").orderBy("d").collect()
    assert [r.operational_status for r in rows] == ["Operational_Anomaly", "Holiday_OFF", "Operational_Anomaly", "Business_Day_Normal"]
    assert [r.is_expected_zero for r in rows] == [0, 1, 0, 0] and rows[0].v == 0.0
