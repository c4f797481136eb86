"""Column expressions whose exact rule differs from the nearest Spark built-in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Text that counts as a number. try_cast alone would also take '10d' and 'NaN'.
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Two exact decimals, for one amount that is shown; sums take ``exact``."""
    return _col(c).cast("decimal(18,2)")


def exact(c: Column | str) -> Column:
    """Six exact decimals: sums do not depend on the order of rows, and parts of a cent add up."""
    return _col(c).cast("decimal(28,6)")


def money_sum(c: Column | str) -> Column:
    """Exact sum of money, rounded once to two decimals and shown as a double."""
    return F.round(F.sum(exact(c)), 2).cast("double")


def money_mean(c: Column | str) -> Column:
    """Exact sum over the number of non-NULL values; NULL when there are none."""
    return F.try_divide(F.sum(exact(c)).cast("double"), F.count(_col(c)).cast("double"))


def safe_double(c: Column | str) -> Column:
    """Text to double; anything that is not plainly a number gives NULL."""
    return F.when(_col(c).rlike(NUMBER), _col(c).try_cast("double"))


def safe_int(c: Column | str) -> Column:
    return F.when(_col(c).rlike(INTEGER), _col(c).try_cast("int"))


def safe_timestamp(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to zoneless timestamp by pattern; NULL when it does not fit."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("timestamp_ntz")


def greatest_strict(*cols: Column | str) -> Column:
    """The largest value, NULL as soon as one input is NULL."""
    columns = [_col(c) for c in cols]
    missing = columns[0].isNull()
    for c in columns[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.greatest(*columns))


def boundary_minutes(later: Column | str, earlier: Column | str) -> Column:
    """How many minute marks lie between two times (00:00:59 to 00:01:01 is one)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _col(earlier)),
                            F.date_trunc("minute", _col(later)))


def month_start(c: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_col(c), "month")


def local_date(moment: Column | str, zone: str) -> Column:
    """The calendar day at a UTC moment as seen in a time zone."""
    return F.to_date(F.from_utc_timestamp(_col(moment), zone))


def on_day_at(day: Column | str, hour: int, minute: int = 0) -> Column:
    """A zoneless timestamp at a clock time of a day."""
    return _col(day).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))


def clock(c: Column | str) -> Column:
    return F.date_format(_col(c), "HH:mm:ss")


def last_n_days(c: Column | str, n: int, today: dt.date) -> Column:
    """The n days before today as a plain range, the form that always prunes partitions."""
    return _col(c).between(F.lit(today - dt.timedelta(days=n)), F.lit(today - dt.timedelta(days=1)))


def text_or_null(pattern: str, *cols: Column) -> Column:
    """format_string, but NULL when any argument is NULL."""
    missing = cols[0].isNull()
    for c in cols[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.format_string(pattern, *cols))


def fare_quote(pickup: Column | str, dropoff: Column | str, base: float) -> Column:
    """Fixed values of the quote: 0.85 a unit, (distance mod 40) + 1 units."""
    units = F.abs(_col(pickup) - _col(dropoff)) % 40 + 1
    return F.round(F.lit(base).cast("decimal(10,2)") + F.lit(0.85).cast("decimal(10,2)") * units, 2)


def fuel_cost(mpg: Column | str, miles: float = 20.0, price: float = 3.20) -> Column:
    return F.try_divide(F.lit(miles), _col(mpg)) * F.lit(price)
