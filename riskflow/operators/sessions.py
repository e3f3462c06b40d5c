"""Operators on the browsing events of a session.

Counts, first and last times are plain aggregates. For gaps between events, the events of an ordinary session are
ordered in one window after one shuffle. A session may hold any share of all events, so those of heavy sessions are
handled in three steps of falling size: events of one second, then the at most 86,400 seconds of a day, then the days of
a session. Both ways give the same rows.

Events at the same instant have no given order. Here a browsing event comes first and takes the gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.constants import BROWSING_EVENTS
from riskflow.functions import columns as X
from riskflow.operators.skew import COPIES_PER_CHUNK, Heavy, heavy_keys, lookup, split_rows

LEVELS = ["L1", "L2", "L3"]
COUNTS = ["L1_count", "L2_count", "L3_count"]


def with_event_level(events: DataFrame) -> DataFrame:
    return events.withColumn("event_level", X.event_level(F.col("event_type")))


def session_event_join(transactions: DataFrame, events: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Transactions with the events of their session, one row per event type and its number of events.

    Pairing every transaction with every single event grows with the square of a session; the counts hold the same
    information.
    """
    by_type = events.groupBy("session_id", "event_type").agg(F.count(F.lit(1)).alias("events"))
    heavy = heavy if heavy is not None else heavy_keys(transactions, "session_id")
    return lookup(transactions, by_type, "session_id", heavy["session_id"], spread_by="transaction_id")


def session_level_counts(events: DataFrame) -> DataFrame:
    level = X.event_level(F.col("event_type"))
    return (
        events.filter("session_id is not null")
        .groupBy("session_id")
        .agg(*[F.count_if(level == name).alias(name) for name in LEVELS])
    )


def event_level_pivot(transactions: DataFrame, events: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Number of events of each level per transaction id, for ids whose session has events."""
    heavy = heavy if heavy is not None else heavy_keys(transactions, "session_id")
    matched = lookup(
        transactions.select("transaction_id", "session_id"),
        session_level_counts(events),
        "session_id",
        heavy["session_id"],
        spread_by="transaction_id",
    )
    return matched.groupBy("transaction_id").agg(*[F.sum(name).alias(name) for name in LEVELS])


def add_event_level_features(transactions: DataFrame, events: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Add L1_count, L2_count and L3_count; null where the session of the transaction has no events.

    `heavy` are the heavy keys, measured on `transactions` if not given; measure them on a stored table when
    `transactions` is derived.
    """
    heavy = heavy if heavy is not None else heavy_keys(transactions, "session_id", "transaction_id")
    counts = event_level_pivot(transactions, events, heavy).select(
        "transaction_id", *[F.col(level).cast("int").alias(count) for level, count in zip(LEVELS, COUNTS)]
    )
    return lookup(transactions, counts, "transaction_id", heavy["transaction_id"], "left")


def add_event_level_ratios(features: DataFrame) -> DataFrame:
    """Add L1_ratio and L2_ratio, the share of each level in all events of the transaction, in percent."""
    total = F.col("L1_count") + F.col("L2_count") + F.col("L3_count")
    return features.withColumns({f"{level}_ratio": X.percent(F.col(f"{level}_count"), total) for level in LEVELS[:2]})


def with_session_clock(sessions: DataFrame) -> DataFrame:
    """Add midpoint_time, hour and time_of_day to start_time and finish_time."""
    return (
        sessions.withColumn("midpoint_time", X.midpoint(F.col("start_time"), F.col("finish_time")))
        .withColumn("hour", F.hour("midpoint_time"))
        .withColumn("time_of_day", X.time_of_day(F.col("hour")))
    )


def calculate_session_times(events: DataFrame) -> DataFrame:
    """First and last event time of each session, their midpoint, its hour and the time of day."""
    return with_session_clock(
        events.groupBy("session_id").agg(
            F.min("event_time").alias("start_time"), F.max("event_time").alias("finish_time")
        )
    )


def _is_listed(browsing_events: Sequence[str]) -> Column:
    return F.coalesce(F.col("event_type").isin(list(browsing_events)), F.lit(False))


def session_rollup(
    events: DataFrame, browsing_events: Sequence[str] = BROWSING_EVENTS, heavy: Heavy | None = None
) -> DataFrame:
    """One row per session: level counts, first and last time, browsing seconds and number of browsing events.

    Gives everything the feature table needs from the events. `heavy` are the heavy sessions, measured on `events` if not
    given.
    """
    heavy = heavy if heavy is not None else heavy_keys(events, "session_id")
    rows = events.filter("session_id is not null")
    if not heavy["session_id"]:
        return _rollup_in_window(rows, browsing_events)
    usual, large = split_rows(rows, "session_id", heavy["session_id"])
    return _rollup_in_window(usual, browsing_events).unionByName(_rollup_in_steps(large, browsing_events))


def _moments(events: DataFrame, browsing_events: Sequence[str]) -> DataFrame:
    return events.select(
        "session_id",
        F.expr("cast(event_time as long) as second"),
        F.expr("unix_micros(event_time) as micros"),
        X.event_level(F.col("event_type")).alias("level"),
        _is_listed(browsing_events).alias("listed"),
    )


def _rollup_in_window(events: DataFrame, browsing_events: Sequence[str]) -> DataFrame:
    before = Window.partitionBy("session_id").orderBy("micros", F.col("listed").desc())
    return (
        _moments(events, browsing_events)
        .withColumn("spent", F.when(F.col("listed"), F.col("second") - F.lag("second").over(before)))
        .groupBy("session_id")
        .agg(
            *[F.expr(f"count_if(level = '{name}') as {name}") for name in LEVELS],
            F.expr("count_if(listed) as listed"),
            F.expr("timestamp_micros(min(micros)) as start_time"),
            F.expr("timestamp_micros(max(micros)) as finish_time"),
            F.expr("coalesce(sum(spent), 0L) as total_browsing_time"),
        )
    )


def _rollup_in_steps(events: DataFrame, browsing_events: Sequence[str]) -> DataFrame:
    sums = [F.expr(f"sum({name}) as {name}") for name in [*LEVELS, "listed"]]
    seconds = (
        _moments(events, browsing_events)
        .groupBy("session_id", "second")
        .agg(
            *[F.expr(f"count_if(level = '{name}') as {name}") for name in LEVELS],
            F.expr("count_if(listed) as listed"),
            F.expr("min(micros) as start"),
            F.expr("max(micros) as finish"),
            # The smallest moment, with a last bit of 0 for a browsing event, so that those win ties.
            F.expr("min(micros * 2 + if(listed, 0, 1)) as first"),
        )
        .selectExpr("*", "floor(second / 86400) as day", "first & 1 = 0 as led")
    )
    days = (
        seconds.selectExpr(
            "*", "if(led, second - lag(second) over (partition by session_id, day order by second), null) as spent"
        )
        .groupBy("session_id", "day")
        .agg(
            *sums,
            F.expr("min(start) as start"),
            F.expr("max(finish) as finish"),
            F.expr("sum(spent) as spent"),
            F.expr("min(second * 2 + if(led, 0, 1)) as first"),
            F.expr("max(second) as last_second"),
        )
        .selectExpr("*", "shiftright(first, 1) as first_second", "first & 1 = 0 as led")
    )
    return (
        days.selectExpr(
            "*",
            "if(led, first_second - lag(last_second) over (partition by session_id order by day), null) as pause",
        )
        .groupBy("session_id")
        .agg(
            *sums,
            F.expr("timestamp_micros(min(start)) as start_time"),
            F.expr("timestamp_micros(max(finish)) as finish_time"),
            F.expr("sum(coalesce(spent, 0L) + coalesce(pause, 0L)) as total_browsing_time"),
        )
    )


def session_browsing_time(
    events: DataFrame, browsing_events: Sequence[str] = BROWSING_EVENTS, heavy: Heavy | None = None
) -> DataFrame:
    """Browsing seconds of each session that has a browsing event."""
    rollup = session_rollup(events, browsing_events, heavy)
    return rollup.filter("listed > 0").select("session_id", "total_browsing_time")


def calculate_browsing_time(
    features: DataFrame,
    events: DataFrame,
    browsing_events: Sequence[str] = BROWSING_EVENTS,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Add total_browsing_time, the seconds before each browsing event of the session since the event before it.

    Rows whose session has no browsing event are dropped.
    """
    heavy = heavy if heavy is not None else heavy_keys(features, "session_id")
    times = session_browsing_time(events, browsing_events)
    return lookup(features, times, "session_id", heavy["session_id"], spread_by="transaction_id")


def event_gaps(
    events: DataFrame, browsing_events: Sequence[str] = BROWSING_EVENTS, heavy: Heavy | None = None
) -> DataFrame:
    """Each event with the time of the event before it in the session, and the whole seconds between the two.

    Events without a session are one session of their own. Events without a time come first in theirs; neither they nor
    the first event with a time have a gap. `heavy` are the heavy sessions, measured on `events` if not given.
    """
    heavy = heavy if heavy is not None else heavy_keys(events, "session_id")
    rows = events.select("session_id", "event_type", "event_time")
    usual, large = split_rows(rows, "session_id", heavy["session_id"]) if heavy["session_id"] else (rows, None)
    in_session = Window.partitionBy("session_id").orderBy(
        "event_time", F.when(_is_listed(browsing_events), 1).otherwise(2), "event_type"
    )
    found = usual.withColumn("previous_event_time", F.lag("event_time").over(in_session))
    if large is not None:
        found = found.unionByName(_gaps_in_steps(large, browsing_events))
    return found.withColumn(
        "time_spent", F.col("event_time").cast("long") - F.col("previous_event_time").cast("long")
    )


def _gaps_in_steps(events: DataFrame, browsing_events: Sequence[str]) -> DataFrame:
    """The time before each event of heavy sessions.

    Equal events are counted first, so copies cost one row each in the window, which runs over one second of a session.
    Every second starts from the last time of the seconds before it, every day from that of the days before it.
    """
    second = F.col("event_time").cast("long")
    in_day, across_days = Window.partitionBy("session_id", "day").orderBy("second"), Window.partitionBy("session_id").orderBy("day")
    seconds = (
        events.groupBy("session_id", second.alias("second"))
        .agg(F.max("event_time").alias("last_time"))
        .withColumn("day", F.floor(F.col("second") / 86_400))
    )
    days = (
        seconds.groupBy("session_id", "day")
        .agg(F.max("last_time").alias("last_time"), F.min("second").alias("second"))
        .select("session_id", "second", F.lag("last_time").over(across_days).alias("event_time"))
    )
    starts = (
        seconds.select("session_id", "second", F.lag("last_time").over(in_day).alias("event_time"))
        .unionByName(days)
        .filter("event_time is not null")
        .withColumns({"copies": F.lit(0).cast("long"), "piece": F.lit(0).cast("long")})
    )
    distinct = (
        events.groupBy("session_id", "event_type", "event_time")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("second", second)
        # A large group of copies goes to several tasks; only its first piece needs the event before.
        .withColumn(
            "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES_PER_CHUNK)))
        )
        .withColumn(
            "copies", F.least(F.col("n") - F.col("piece") * COPIES_PER_CHUNK, F.lit(COPIES_PER_CHUNK).cast("long"))
        )
        .drop("n")
    )
    in_second = Window.partitionBy("session_id", "second", "piece").orderBy(
        "event_time", F.when(F.col("copies") == 0, 0).when(_is_listed(browsing_events), 1).otherwise(2), "event_type"
    )
    before = F.when((F.col("piece") == 0) & (F.col("copy") == 1), F.col("before")).otherwise(F.col("event_time"))
    return (
        distinct.unionByName(starts, allowMissingColumns=True)
        .withColumn("before", F.lag("event_time").over(in_second))
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("session_id", "event_type", "event_time", before.alias("previous_event_time"))
    )
