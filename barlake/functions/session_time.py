"""Trading-session arithmetic on exchange-local timestamps.

All clock arguments are exchange-local ``TIMESTAMP_NTZ`` values, so no result
depends on the session time zone.  The day is 09:30-11:30 and 13:00-15:00.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.functions.numeric import col

# Session boundaries in minutes since midnight, minutes per day.
OPEN, LUNCH_START, LUNCH_END, CLOSE = 570, 690, 780, 900
DAY_MINUTES = 240
PHASES = ("intraday_1300", "intraday_1400", "intraday_1430", "lunch_break", "post_close")


def ntz(c: Column | str) -> Column:
    """Exchange-local timestamp; a Python string is taken as a literal."""
    return (F.lit(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def minute_of_day(ts: Column | str) -> Column:
    t = col(ts)
    return (F.hour(t) * 60 + F.minute(t)).cast("int")


def second_of_day(ts: Column | str) -> Column:
    t = col(ts)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def in_session(m: Column) -> Column:
    """Minute belongs to a bar of the day (09:30..11:29, 13:00..14:59)."""
    return ((m >= OPEN) & (m < LUNCH_START)) | ((m >= LUNCH_END) & (m < CLOSE))


def minute_index(m: Column) -> Column:
    """Trading minutes elapsed before minute-of-day ``m`` (0..240), closed form."""
    morning = F.least(F.greatest(m - OPEN, F.lit(0)), F.lit(LUNCH_START - OPEN))
    afternoon = F.least(F.greatest(m - LUNCH_END, F.lit(0)), F.lit(CLOSE - LUNCH_END))
    return (morning + afternoon).cast("int")


def hhmm(m: Column) -> Column:
    return F.concat(
        F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0")
    )


def expected_minutes(start: Column, end: Column) -> Column:
    """Trading minutes in [start, end) with the lunch break removed; unbounded by the day."""
    morning = F.greatest(F.lit(0), F.least(F.lit(LUNCH_START), end) - F.greatest(start, F.lit(0)))
    afternoon = F.greatest(F.lit(0), end - F.greatest(F.lit(LUNCH_END), start))
    return (morning + afternoon).cast("int")


def is_weekday(d: Column | str) -> Column:
    return F.weekday(col(d)) < 5


def trading_day(d: Column | str, is_open: Column | None = None) -> Column:
    """Calendar answer when there is one, else Monday to Friday."""
    return is_weekday(d) if is_open is None else F.coalesce(is_open, is_weekday(d))


def session_status(ts: Column, trading: Column | None = None) -> Column:
    """live_session / lunch_break / post_close / pre_open / non_trading_day."""
    t = second_of_day(ts)
    open_day = is_weekday(ts) if trading is None else trading
    return (
        F.when(~open_day, "non_trading_day")
        .when((t >= LUNCH_START * 60) & (t < LUNCH_END * 60), "lunch_break")
        .when((t >= OPEN * 60) & (t <= CLOSE * 60), "live_session")
        .when(t > CLOSE * 60, "post_close")
        .otherwise("pre_open")
    )


def in_market_session(ts: Column, trading: Column | None = None) -> Column:
    """Trading day and 09:15..15:30 inclusive."""
    t = second_of_day(ts)
    open_day = is_weekday(ts) if trading is None else trading
    return open_day & (t >= 555 * 60) & (t <= 930 * 60)


def session_phase(ts: Column) -> Column:
    """Collection phase by clock; an explicit phase that disagrees is corrected to this."""
    t = second_of_day(ts)
    return (
        F.when(t <= LUNCH_START * 60, "intraday_1300")
        .when(t < LUNCH_END * 60, "lunch_break")
        .when(t < 840 * 60, "intraday_1300")
        .when(t < 870 * 60, "intraday_1400")
        .when(t < CLOSE * 60, "intraday_1430")
        .otherwise("post_close")
    )


def elapsed_minutes(ts: Column, trading: Column | None = None) -> Column:
    """Completed trading minutes, 0..240; a closed day counts as complete."""
    open_day = is_weekday(ts) if trading is None else trading
    return F.when(~open_day, F.lit(DAY_MINUTES)).otherwise(minute_index(minute_of_day(ts)))
