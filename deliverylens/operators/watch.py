"""Who has gone quiet: streaks of missed working days, told once for each worsening."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import VersionedTable

STATE = "person string, roster_since date, alerted_streak long"
#: A person's start is looked for among so many days back.
LOOKBACK = 400


def working_days(today: dt.date, days: set[int], count: int) -> list[dt.date]:
    """The last ``count`` working days before today, the latest first (0 is Monday); none lies over LOOKBACK days back."""
    back = (today - dt.timedelta(days=k) for k in range(1, LOOKBACK + 1))
    return [d for d in back if d.weekday() in days][:count]


def silence(objects: DataFrame, roster: DataFrame, state: DataFrame, today: dt.date, *, days: set[int] = frozenset(range(5)), threshold: int = 3, offset: str = "+07:00") -> DataFrame:
    """A row a person of the roster: missed, last_reported, settled, alerting.

    objects: (person, uploaded_at); roster: (person). ``missed`` counts the working days
    in a row up to yesterday without an upload, by the local day of its arrival. A person
    is settled once the threshold's working days have passed since the first evidence
    of them: an upload or the day that they came on the roster. Alerting: settled, missed
    at least the threshold, and more than was told last. Uploads without a person or a
    time, and roster rows without a name, are left out; names are compared trimmed and in lower case.
    """
    expected = working_days(today, set(days), threshold + 7)
    elapsed = working_days(today, set(days), LOOKBACK)
    name = F.lower(F.trim("person"))
    day = F.to_date(F.from_utc_timestamp("uploaded_at", offset))
    seen = objects.where("person IS NOT NULL AND uploaded_at IS NOT NULL").select(name.alias("person"), day.alias("day")).groupBy("person")
    seen = seen.agg(F.max("day").alias("last_reported"), F.min("day").alias("first"), F.max(F.when(F.col("day").isin(expected), F.col("day"))).alias("met"))
    people = roster.select(name.alias("person")).where("person != ''").distinct().join(seen, "person", "left").join(state.select("person", "roster_since", "alerted_streak"), "person", "left")
    array = lambda ds: F.array(*[F.lit(d) for d in ds]) if ds else F.array().cast("array<date>")
    missed = F.size(F.filter(array(expected), lambda d: F.col("met").isNull() | (d > F.col("met")))).cast("long")
    start = F.least("first", "roster_since")
    settled = F.size(F.filter(array(elapsed), lambda d: d >= start)) >= threshold
    settled = start.isNotNull() & settled
    alerting = settled & (missed >= threshold) & (missed > F.coalesce("alerted_streak", F.lit(0)))
    return people.select("person", missed.alias("missed"), "last_reported", settled.alias("settled"), alerting.alias("alerting"))


def next_state(report: DataFrame, state: DataFrame, today: dt.date) -> DataFrame:
    """What is known after the alerts of a report are sent: first sightings, told streaks; a person who reports again starts anew."""
    old = state.select("person", "roster_since", F.col("alerted_streak").alias("was"))
    both = report.join(old, "person", "full")
    told = F.when(F.col("alerting"), F.col("missed")).when(F.col("missed") == 0, F.lit(None)).otherwise(F.col("was"))
    return both.select("person", F.coalesce("roster_since", F.lit(today)).alias("roster_since"), told.cast("long").alias("alerted_streak"))


def check(objects: DataFrame, roster: DataFrame, table: VersionedTable, today: dt.date, send=None, **rules) -> DataFrame:
    """One run: the report, after its alerts are sent and the state is put in place.

    ``send`` gets the alerting rows; if it fails the state stays, so they are told at
    the next run. Returns the report, read from what was decided before the state moved.
    """
    seen = table.version()
    state = table.read(seen)
    report = silence(objects, roster, state, today, **rules)
    held = report.checkpoint() if report.sparkSession.sparkContext._jsc.sc().getCheckpointDir().nonEmpty() else report.persist()
    if send is not None:
        send(held.where("alerting"))
    table.replace(next_state(held, state, today), seen)
    return held
