"""Sessions by a dated calendar: intervals between instants, with holidays and early closes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZONE = "America/New_York"
#: Session, first and last minute of a full day, local time.
FULL_DAY = (("PRE_MARKET", "04:00", "09:30"), ("REGULAR", "09:30", "16:00"), ("AFTER_HOURS", "16:00", "20:00"))
#: The same of a day that closes early.
HALF_DAY = (("PRE_MARKET", "04:00", "09:30"), ("REGULAR", "09:30", "13:00"), ("AFTER_HOURS", "13:00", "17:00"))


def intervals(spark, first: str, last: str, holidays: list[str] = (), early: list[str] = (), full_day=FULL_DAY, half_day=HALF_DAY, zone: str = ZONE) -> DataFrame:
    """session_date, session, opens, closes: what every weekday from first to last has, as instants. Nothing stands for
    holidays; days in `early` have `half_day`. Some hundred rows a year."""
    days = spark.sql("select explode(sequence(cast(:first as date), cast(:last as date))) session_date", args={"first": first, "last": last}).filter("dayofweek(session_date) between 2 and 6")
    kinds = spark.createDataFrame([(half, *s) for half, day in ((False, full_day), (True, half_day)) for s in day], "half boolean, session string, from string, to string")
    told = days.withColumn("half", F.col("session_date").cast("string").isin(list(early)) if early else F.lit(False))
    if holidays:
        told = told.filter(~F.col("session_date").cast("string").isin(list(holidays)))
    at = lambda c: F.to_utc_timestamp(F.concat_ws(" ", F.col("session_date").cast("string"), c), zone)
    return told.join(kinds, "half").select("session_date", "session", at("from").alias("opens"), at("to").alias("closes"))


def in_sessions(bars: DataFrame, calendar: DataFrame, time: str = "bar_start", zone: str = ZONE) -> DataFrame:
    """bars with session_date (the local date) and session: that whose interval [opens, closes) holds the bar's instant,
    else CLOSED. Joined by date, so a bar meets the few sessions of its day."""
    dated = bars.withColumn("session_date", F.to_date(F.from_utc_timestamp(time, zone)))
    named = calendar.groupBy("session_date").agg(F.collect_list(F.struct("session", "opens", "closes")).alias("__day"))
    held = F.filter("__day", lambda s: (F.col(time) >= s["opens"]) & (F.col(time) < s["closes"]))
    session = F.coalesce(F.try_element_at(held, F.lit(1))["session"], F.lit("CLOSED"))
    return dated.join(named, "session_date", "left").withColumn("session", session).drop("__day")
