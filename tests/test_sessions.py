"""Session operators on hand-written rows and against plain Python on random events."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.constants import BROWSING_EVENTS, LEVEL_1_EVENTS, LEVEL_2_EVENTS
from riskflow.operators import sessions as S
from riskflow.operators import skew

EVENTS = "session_id string, event_type string, event_time timestamp"
DAY = dt.datetime(2024, 3, 1)


def at(seconds):
    return DAY + dt.timedelta(seconds=seconds)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


@pytest.fixture
def small_tasks(monkeypatch):
    """Treat keys with more than 5 rows as heavy."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5)


@pytest.fixture
def unit_events(spark):
    return events_df(
        spark,
        [
            ("s1", "HP", at(0.9)),
            ("s1", None, at(10.1)),
            ("s1", "SER", at(10.1)),
            ("s1", "AP", at(5 * 3600 + 59 * 60 + 59)),
            ("s2", "VP", at(3)),
            ("s3", "SCR", at(4)),
            (None, "SCR", at(5)),
        ],
    )


@pytest.fixture
def unit_transactions(spark):
    return spark.createDataFrame(
        [("t1", "s1"), ("t1", "s2"), ("t2", "s2"), ("t3", "s3"), ("t4", "s4"), ("t5", None)],
        "transaction_id string, session_id string",
    )


def rows(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)


def test_levels_count_unknown_and_missing_types_as_l3(unit_events):
    got = rows(S.session_level_counts(unit_events), "session_id", "L1", "L2", "L3")
    assert got == [("s1", 1, 1, 2), ("s2", 0, 1, 0), ("s3", 0, 0, 1)]


def test_level_counts_sum_over_repeated_ids_and_are_null_without_events(unit_transactions, unit_events):
    got = rows(S.add_event_level_features(unit_transactions, unit_events), "transaction_id", "session_id", *S.COUNTS)
    assert got == sorted(
        [
            ("t1", "s1", 1, 2, 2),
            ("t1", "s2", 1, 2, 2),
            ("t2", "s2", 0, 1, 0),
            ("t3", "s3", 0, 0, 1),
            ("t4", "s4", None, None, None),
            ("t5", None, None, None, None),
        ],
        key=repr,
    )


def test_level_absent_from_all_data_counts_zero(spark, unit_transactions):
    events = events_df(spark, [("s2", "VP", at(1))])
    got = rows(S.add_event_level_features(unit_transactions, events), "transaction_id", *S.COUNTS)
    assert ("t2", 0, 1, 0) in got


def test_ratios_round_to_two_decimals_and_keep_nulls(spark):
    df = spark.createDataFrame([(1, 2, 0), (0, 0, 0), (None, None, None)], "L1_count int, L2_count int, L3_count int")
    got = S.add_event_level_ratios(df)
    assert [f.dataType.simpleString() for f in got.schema.fields[-2:]] == ["float", "float"]
    values = [(r.L1_ratio, r.L2_ratio) for r in got.collect()]
    assert values[0] == pytest.approx((33.33, 66.67), abs=1e-4)
    assert values[1:] == [(None, None), (None, None)]


def test_session_times_round_half_microseconds_up_and_name_the_time_of_day(spark):
    micro = dt.timedelta(microseconds=1)
    df = events_df(
        spark,
        [("a", "HP", at(0)), ("a", "HP", at(0) + micro), ("b", "HP", at(6 * 3600)), ("c", "HP", at(12 * 3600)),
         ("d", "HP", at(18 * 3600)), ("e", "HP", None)],
    )
    got = {r.session_id: r for r in S.calculate_session_times(df).collect()}
    assert got["a"].midpoint_time == at(0) + micro
    assert [got[k].time_of_day for k in "abcde"] == ["night", "morning", "afternoon", "evening", "evening"]
    assert got["e"].hour is None


def test_browsing_time_credits_the_later_event(unit_transactions, unit_events):
    got = rows(S.calculate_browsing_time(unit_transactions, unit_events), "transaction_id", "total_browsing_time")
    # s1: SER ties with an event without type and takes the gap 10 - 0. s2 has no browsing event and drops out.
    assert got == [("t1", 10), ("t3", 0)]


def random_events(seed, n=1500, sessions=12):
    rng = random.Random(seed)
    types = [*LEVEL_1_EVENTS, *LEVEL_2_EVENTS, *BROWSING_EVENTS, "XYZ", None]
    out = []
    for _ in range(n):
        # A third of the events in one session; times over several days, with many equal ones.
        session = "hot" if rng.random() < 0.34 else f"s{rng.randrange(sessions)}"
        time = at(rng.choice([rng.randrange(300), rng.randrange(4 * 86_400)]) + rng.choice([0, 0.25, 0.999999]))
        out.append((session, rng.choice(types), time))
    copy = ("hot", "SCR", at(1234.5))
    return out + [copy] * 400


def brute_gaps(events):
    by_session = defaultdict(list)
    for session, kind, time in events:
        by_session[session].append((time or dt.datetime.min, kind not in BROWSING_EVENTS, kind is not None, kind or "", kind))
    out = []
    for session, items in by_session.items():
        before = None
        for time, _, _, _, kind in sorted(items):
            time = None if time == dt.datetime.min else time
            gap = None if before is None or time is None else int(time.timestamp() // 1) - int(before.timestamp() // 1)
            out.append((session, kind, time, before, gap))
            before = time
    return out


def with_gaps_in_data(events):
    """Also events without a session, without a time, and without both."""
    rng = random.Random(9)
    spots = [(None, 0), ("hot", 0), ("s1", 0), (None, 1)]
    return events + [
        (session, rng.choice(["HP", "AP", None]), at(rng.randrange(90_000)) if timed else None) for session, timed in spots * 15
    ]


# With a low limit all sessions are heavy, with one in between some are, with a high one none is.
@pytest.mark.parametrize("seed,limit", [(1, 0), (2, 200), (2, 10**6)])
def test_gaps_equal_brute_force(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(S, "COPIES_PER_CHUNK", 7)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit or 1)
    events = with_gaps_in_data(random_events(seed))
    got = rows(
        S.event_gaps(events_df(spark, events).repartition(5)),
        "session_id", "event_type", "event_time", "previous_event_time", "time_spent",
    )
    assert got == sorted(brute_gaps(events), key=repr)


@pytest.mark.parametrize("seed,limit", [(3, 1), (4, 200), (4, 10**6)])
def test_rollup_equals_brute_force(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    events = random_events(seed)
    expected = {}
    for session, kind, time, _, gap in brute_gaps(events):
        e = expected.setdefault(session, [0, 0, 0, 0, time, time, 0])
        e[0 if kind in LEVEL_1_EVENTS else 1 if kind in LEVEL_2_EVENTS else 2] += 1
        e[4], e[5] = min(e[4], time), max(e[5], time)
        if kind in BROWSING_EVENTS:
            e[3] += 1
            e[6] += gap or 0
    got = {
        r.session_id: [r.L1, r.L2, r.L3, r.listed, r.start_time, r.finish_time, r.total_browsing_time]
        for r in S.session_rollup(events_df(spark, events).repartition(5)).collect()
    }
    assert got == expected


def test_events_without_time_keep_the_session(spark):
    df = events_df(spark, [("s", "SCR", None), ("s", "HP", at(7)), ("s", "HP", at(9))])
    row = S.session_rollup(df).collect()[0]
    assert (row.listed, row.total_browsing_time, row.start_time) == (3, 2, at(7))


def test_times_before_1970(spark):
    old = dt.datetime(1969, 12, 30, 23, 59, 58, 500_000)
    df = events_df(spark, [("s", "AP", old), ("s", "HP", old + dt.timedelta(seconds=5)), ("s", "HP", old + dt.timedelta(days=4))])
    row = S.session_rollup(df).collect()[0]
    assert (row.start_time, row.total_browsing_time) == (old, 4 * 86_400)


def test_heavy_sessions_are_split_and_give_the_same_rows(spark, small_tasks):
    rng = random.Random(5)
    transactions = spark.createDataFrame(
        [(f"t{i}", "hot" if i % 3 == 0 else None if i % 3 == 1 else f"s{rng.randrange(40)}") for i in range(300)],
        "transaction_id string, session_id string",
    ).repartition(6)
    events = events_df(spark, random_events(6)).repartition(4)
    heavy = skew.heavy_keys(transactions, "session_id")["session_id"]
    assert heavy.parts() == {"hot": 20, None: 20}
    plain = transactions.join(S.session_level_counts(events), "session_id", "left")
    got = skew.lookup(transactions, S.session_level_counts(events), "session_id", heavy, "left")
    columns = ["transaction_id", "session_id", *S.LEVELS]
    assert rows(got, *columns) == rows(plain, *columns)
    spread = skew.to_part(transactions, "session_id", heavy, "part", "transaction_id")
    assert spread.filter("session_id = 'hot'").select("part").distinct().count() > 10
    assert spread.filter("session_id is null").select("part").distinct().count() > 10
    inner = skew.lookup(transactions, S.session_level_counts(events), "session_id", heavy)
    assert rows(inner, *columns) == rows(plain.filter("L1 is not null"), *columns)


def test_session_event_join_counts_every_pair(spark, unit_transactions, unit_events):
    got = rows(S.session_event_join(unit_transactions, unit_events), "transaction_id", "session_id", "event_type", "events")
    pairs = unit_transactions.join(unit_events, "session_id").groupBy("transaction_id", "session_id", "event_type")
    assert got == rows(pairs.agg(F.count("*").alias("events")), "transaction_id", "session_id", "event_type", "events")


def test_more_heavy_keys_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 3)
    rows_ = spark.range(9_000).selectExpr("concat('k', id % 1500) as session_id", "id as n")
    left = rows_.unionByName(spark.sql("select cast(null as string) as session_id, id as n from range(100)"))
    right = spark.range(1_500).selectExpr("concat('k', id) as session_id", "id as m")
    expected = rows(left.join(right, "session_id", "left"), "session_id", "n", "m")
    for listed in (10_000, 100):  # all on the driver, or as a stored table
        monkeypatch.setattr(skew, "LISTED_KEYS", listed)
        heavy = skew.heavy_keys(left, "session_id")["session_id"]
        assert len(heavy.parts()) == 1_501 and set(heavy.parts().values()) == {2, 34}
        assert rows(skew.lookup(left, right, "session_id", heavy, "left"), "session_id", "n", "m") == expected
        parts = skew.to_part(left, "session_id", heavy, "part", "n").filter("session_id is not null")
        assert parts.groupBy("session_id", "part").count().agg({"count": "max"}).first()[0] < 7


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(1 for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line and "hashpartitioning" in line)


def test_ordinary_sessions_are_shuffled_once(spark, tmp_path):
    events_df(spark, random_events(1)).repartition(4).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    assert exchanges(S.session_rollup(events)) == 1
    assert exchanges(S.event_gaps(events)) == 1


def test_even_keys_are_not_measured(spark):
    events = events_df(spark, random_events(2))
    assert rows(S.session_rollup(events, heavy=skew.EvenKeys()), "session_id", "total_browsing_time") == rows(
        S.session_rollup(events), "session_id", "total_browsing_time"
    )


def test_measuring_keys_moves_no_more_than_the_cells(spark, monkeypatch):
    monkeypatch.setattr(skew, "CELLS", 64)
    monkeypatch.setattr(skew, "SMALLEST_SHARE", 1 / 4)
    rows = spark.range(40_000).selectExpr("cast(if(id % 2 = 0, 7, id) as string) as session_id", "cast(null as int) as customer_id")
    # Half of the rows and one more have one id, the others one each; all customers are unknown.
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    heavy = skew.heavy_keys(rows, "session_id", "customer_id")
    assert heavy["session_id"].parts() == {"7": 3} and heavy["customer_id"].parts() == {None: 4}
    # A limit that is asked for holds, also where cells hold more than it.
    assert skew.heavy_keys(rows, "session_id", rows_per_task=5_000)["session_id"].parts() == {"7": 5}
    assert skew.heavy_keys(rows, "session_id", rows_per_task=50_000)["session_id"].parts() == {}
    assert not any(skew.heavy_keys(rows.limit(0), "session_id", "customer_id").values())
