"""Date functions over Lisbon wall-clock time without zone; ``as_of`` is always given, never the clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipfold.functions.text import col

#: Names in Portuguese.
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")
WEEKDAYS = ("segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado", "domingo")


def at(moment: datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")), F.lit("yyyy-MM-dd HH:mm:ss"))


def parse_minute(c: Column | str) -> Column:
    """Persisted times ``yyyy-MM-dd HH:mm``; null for anything else."""
    text = col(c)
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))).cast("timestamp_ntz")


def parse_rfc(c: Column | str, as_of: datetime, zone: str = "Europe/Lisbon") -> Column:
    """Mail dates in ``zone``'s wall clock, never later than ``as_of``; without an offset they are taken as they are."""
    text = F.regexp_replace(F.trim(col(c)), r"^\w{3},\s*", "")
    zoned = F.coalesce(F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss z")))
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), zoned.cast("timestamp_ntz"))
    plain = F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")
    seen = F.coalesce(local, plain)
    return F.when(seen.isNotNull(), F.least(seen, at(as_of)))


def long_date(c: Column | str) -> Column:
    d = col(c)
    return F.when(d.isNull(), "").otherwise(_spelled(d))


def _spelled(d: Column) -> Column:
    return F.concat_ws(" de ", F.dayofmonth(d).cast("string"), month_name(d), F.year(d).cast("string"))


def day_label(c: Column | str, as_of: datetime) -> Column:
    """``Hoje``, the day and month, or ``Sem data``."""
    d = col(c).cast("date")
    return F.when(d.isNull(), "Sem data").when(d == F.lit(as_of.date()), "Hoje").otherwise(F.concat_ws(" de ", F.dayofmonth(d).cast("string"), month_name(d)))


def month_name(d: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(d))


def auto_window_hours(day: Column | str) -> Column:
    """Mondays look back over the weekend."""
    return F.when(F.weekday(col(day)) == 0, 72).otherwise(24)


def next_report_day(moment: Column | str, hour: int = 10) -> Column:
    """The day itself on weekdays before ``hour``, else the next weekday."""
    d, wd = col(moment).cast("date"), F.weekday(col(moment))
    ahead = F.when((wd < 5) & (F.hour(col(moment)) < hour), 0).when(wd < 4, 1).otherwise(7 - wd)
    return F.date_add(d, ahead)


def period_start(c: Column | str, by: str) -> Column:
    d = col(c)
    return d if by == "day" else F.trunc(d, {"week": "week", "month": "month", "quarter": "quarter", "year": "year"}[by])


def period_end(c: Column | str, by: str) -> Column:
    """The last day of the period that starts at ``c``; weeks end on Sunday."""
    d = col(c)
    return {
        "day": d,
        "week": F.date_add(d, 6),
        "month": F.last_day(d),
        "quarter": F.last_day(F.add_months(d, 2)),
        "year": F.make_date(F.year(d), F.lit(12), F.lit(31)),
    }[by]


STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTHS", "year": "INTERVAL 1 YEAR"}


def first_report(moment: Column | str, hour: int = 10) -> Column:
    """When the first report comes, in words: this morning, tomorrow, or the weekday."""
    m = col(moment)
    day = next_report_day(m, hour)
    ahead = F.date_diff(day, m.cast("date"))
    name = F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day) + 1)
    at_hour = f", às {hour:02d}h00"
    return F.when(ahead == 0, "ainda esta manhã" + at_hour).when(ahead == 1, "a partir de amanhã" + at_hour).otherwise(F.concat(F.lit("a partir de "), name, F.lit(at_hour)))
