import datetime as dt

from sparkmart.operators.calendar import build_dim_date, dim_date_for


def _by_date(df):
    return {r.full_date: r for r in df.collect()}


def test_one_year_and_leap_day(spark):
    cal = _by_date(build_dim_date(spark, 2000, 2000))
    assert len(cal) == 366
    leap = cal[dt.date(2000, 2, 29)]
    assert (leap.year, leap.quarter, leap.month, leap.month_name, leap.day_of_month) == (2000, 1, 2, "February", 29)
    assert cal[dt.date(2000, 1, 1)].date_key == 1 and cal[dt.date(2000, 12, 31)].date_key == 366


def test_weekday_numbering_default_is_sunday_first(spark):
    cal = _by_date(build_dim_date(spark, 2025, 2025))
    fri, sat, sun, mon = (cal[dt.date(2025, 1, d)] for d in (3, 4, 5, 6))
    assert (sun.day_of_week, mon.day_of_week, fri.day_of_week, sat.day_of_week) == (1, 2, 6, 7)
    # DATEPART(WEEKDAY) IN (6, 7) under the US default: Friday and Saturday.
    assert fri.is_weekend and sat.is_weekend and not sun.is_weekend


def test_weekday_numbering_monday_first(spark):
    cal = _by_date(build_dim_date(spark, 2025, 2025, first_day_of_week=1))
    fri, sat, sun, mon = (cal[dt.date(2025, 1, d)] for d in (3, 4, 5, 6))
    assert (mon.day_of_week, sat.day_of_week, sun.day_of_week) == (1, 6, 7)
    assert sat.is_weekend and sun.is_weekend and not fri.is_weekend


def test_calendar_from_data_covers_whole_years(spark):
    dates = spark.createDataFrame([(dt.date(1999, 6, 1),), (dt.date(2001, 2, 3),)], "d date")
    cal = dim_date_for(dates, "d").collect()
    assert len(cal) == 365 + 366 + 365
    assert min(r.full_date for r in cal) == dt.date(1999, 1, 1)
    assert max(r.date_key for r in cal) == 1096
