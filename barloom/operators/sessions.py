"""Exchange sessions: the calendar as a table, bars inside sessions, sessions that are complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.keys import NEW_YORK, session_date_et

CALENDAR_VERSION = "xnys-rules:1"

# Days on which the exchange was closed beside the rules.
SPECIAL_CLOSINGS = [
    "1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09",
]


def _easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian year."""
    div = lambda a, b: F.floor(a / b)
    a, b, c = year % 19, div(year, F.lit(100)), year % 100
    h = (19 * a + b - div(b, F.lit(4)) - div(b - div(b + 8, F.lit(25)) + 1, F.lit(3)) + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * div(c, F.lit(4)) - h - c % 4) % 7
    m = div(a + 11 * h + 22 * k, F.lit(451))
    n = h + k - 7 * m + 114
    return F.make_date(year, div(n, F.lit(31)).cast("int"), (n % 31 + 1).cast("int"))


def session_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row for each date of [start, end]: REGULAR, EARLY_CLOSE or CLOSED, with open and close in UTC.

    Weekends, the exchange's holidays by rule (with the weekday on which each is observed) and the listed closings are
    CLOSED; the day after Thanksgiving, and 24 December and 3 July from Monday to Thursday, close at 13:00. A date that
    is not in the table is unknown, not closed.
    """
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS session_date")
    d = F.col("session_date")
    y, m, day, dow = F.year(d).cast("int"), F.month(d), F.dayofmonth(d), F.dayofweek(d)  # Sunday is 1
    nth = lambda month, weekday, n: (m == month) & (dow == weekday) & (F.floor((day - 1) / 7) == n - 1)

    def fixed(month: int, of: int, saturday: bool = True) -> Column:
        on = (m == month) & (day == of) & ~dow.isin(1, 7)
        monday = (m == month) & (day == of + 1) & (dow == 2)
        friday = F.date_add(d, 1)
        before = (F.month(friday) == month) & (F.dayofmonth(friday) == of) & (dow == 6)
        return on | monday | before if saturday else on | monday

    holiday = (
        fixed(1, 1, saturday=False)
        | (nth(1, 2, 3) & (y >= 1998))
        | nth(2, 2, 3)
        | (d == F.date_sub(_easter(y), 2))
        | ((m == 5) & (dow == 2) & (day >= 25))
        | (fixed(6, 19) & (y >= 2022))
        | fixed(7, 4)
        | nth(9, 2, 1)
        | nth(11, 5, 4)
        | fixed(12, 25)
        | F.date_format(d, "yyyy-MM-dd").isin(SPECIAL_CLOSINGS)
    )
    closed = dow.isin(1, 7) | holiday
    thanksgiving = F.date_sub(d, 1)
    after = (dow == 6) & (F.month(thanksgiving) == 11) & (F.floor((F.dayofmonth(thanksgiving) - 1) / 7) == 3)
    early = after | (((m == 12) & (day == 24) | (m == 7) & (day == 3)) & dow.between(2, 5))
    kind = F.when(closed, "CLOSED").when(early, "EARLY_CLOSE").otherwise("REGULAR")
    at = lambda minutes: F.to_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(d.cast("timestamp")) + minutes * 60), NEW_YORK)
    return days.select(
        "session_date",
        kind.alias("session_type"),
        F.when(kind != "CLOSED", at(9 * 60 + 30)).alias("opens_at"),
        F.when(kind == "REGULAR", at(16 * 60)).when(kind == "EARLY_CLOSE", at(13 * 60)).alias("closes_at"),
        F.lit(CALENDAR_VERSION).alias("calendar_version"),
    )


def in_session(bars: DataFrame, sessions: DataFrame, ts: str = "bar_start_at") -> DataFrame:
    """bars with opens_at and closes_at of the session that holds them; others go. The close is not in the session.

    The session table has a row for each day, so it is a dimension; the date is an equi key and the range a filter."""
    s = sessions.where("opens_at IS NOT NULL").select(F.col("session_date").alias("_day"), "opens_at", "closes_at")
    joined = bars.join(s, session_date_et(ts) == F.col("_day"))
    return joined.where((F.col(ts) >= F.col("opens_at")) & (F.col(ts) < F.col("closes_at"))).drop("_day")


def regular_session_filter(bars: DataFrame, sessions: DataFrame, ts: str = "bar_start_at", need_volume: bool = True) -> DataFrame:
    """Bars of regular sessions; with need_volume those without volume go, if there is such a column."""
    out = in_session(bars, sessions, ts)
    return out.where("volume > 0") if need_volume and "volume" in bars.columns else out


def completed_sessions(sessions: DataFrame, after: str | None, now: str) -> DataFrame:
    """Sessions that closed in (after, now]."""
    out = sessions.where(F.col("closes_at") <= F.lit(now).cast("timestamp"))
    return out.where(F.col("closes_at") > F.lit(after).cast("timestamp")) if after else out


def nth_last_session(sessions: DataFrame, n: int, now: str) -> DataFrame:
    """The n-th last completed session: one row, or none if there are fewer."""
    last = completed_sessions(sessions, None, now).orderBy(F.desc("closes_at")).limit(n)
    return last.groupBy().agg(F.min("session_date").alias("session_date"), F.count("*").alias("n")).where(F.col("n") == n).select("session_date")


def expected_bars(sessions: DataFrame, minutes: int = 30) -> DataFrame:
    """(session_date, bar_start_at) of every bar that a full session has."""
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    return sessions.where("opens_at IS NOT NULL").select("session_date", F.explode(F.sequence("opens_at", F.col("closes_at") - step, step)).alias("bar_start_at"))
