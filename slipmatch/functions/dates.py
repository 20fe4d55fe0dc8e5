"""Alignment of the emission date, the sale day and the ticket number."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

YMD = "yyyyMMdd"


def yesterday() -> dt.date:
    """Default run date, resolved at each call."""
    return dt.date.today() - dt.timedelta(days=1)


def as_date(day: dt.date | dt.datetime | None) -> dt.date:
    if day is None:
        return yesterday()
    return day.date() if isinstance(day, dt.datetime) else day


def to_ymd(day: Column) -> Column:
    return F.date_format(day, YMD)


def from_ymd(text: Column | str) -> Column:
    """NULL, not an error, when the text is no date: such a row never equals a run date."""
    text = F.col(text) if isinstance(text, str) else text
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike("^[0-9]{8}$"), dashed.try_cast("date"))


def sale_day(emission: Column | str) -> Column:
    """Activity of the day before the emission date is what a ticket declares."""
    return F.date_sub(emission, 1)


def emitted_between(text: Column, first: dt.date | None, last: dt.date | None) -> Column:
    """Range test on yyyymmdd text; plain comparisons, so the scan can take them."""
    test = text.isNotNull()
    if first is not None:
        test = test & (text >= first.strftime("%Y%m%d"))
    if last is not None:
        test = test & (text <= last.strftime("%Y%m%d"))
    return test


def sold_between(moment: Column, first: dt.date | None, last: dt.date | None) -> Column:
    """Half-open range [first - 1 day, last) in terms of the emission dates."""
    test = moment.isNotNull()
    if first is not None:
        test = test & (moment >= F.lit(_midnight(first - dt.timedelta(days=1))))
    if last is not None:
        test = test & (moment < F.lit(_midnight(last)))
    return test


def _midnight(day: dt.date) -> Column:
    # TIMESTAMP_NTZ text keeps the wall-clock day whatever the session time zone.
    return F.to_timestamp_ntz(F.lit(f"{day.isoformat()} 00:00:00"))
