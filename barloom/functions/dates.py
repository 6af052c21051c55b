"""Market holidays and weekdays as date arithmetic."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _weekday(day: Column) -> Column:
    return F.weekday(day)  # Monday is 0


def _bind(value: Column, use) -> Column:
    """Compute `value` once and use it by name, instead of repeating its expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def easter_sunday(year: Column) -> Column:
    """Gregorian computus (the Meeus form), bound step by step."""
    def whole(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    def finish(golden: Column, epact: Column, lead: Column) -> Column:
        total = epact + lead - whole(golden + epact * 11 + lead * 22, 451) * 7 + 114
        return _bind(total, lambda t: F.make_date(year, whole(t, 31), t % 31 + 1))

    def from_epact(golden: Column, century: Column, rest: Column, epact: Column) -> Column:
        lead = (F.lit(32) + (century % 4) * 2 + whole(rest, 4) * 2 - epact - rest % 4) % 7
        return _bind(lead, lambda x: finish(golden, epact, x))

    golden, century, rest = year % 19, whole(year, 100), year % 100
    correction = whole(century - whole(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - whole(century, 4) - correction + 15) % 30
    return _bind(epact, lambda e: from_epact(golden, century, rest, e))


#: The exchange's published holidays. Month, earliest day of the month on which the holiday can fall, and
#: its weekday (Monday 0); a holiday without a weekday has that date, moved off a weekend to the nearest working day.
HOLIDAY_RULES = (
    (1, 1, None), (1, 15, 0), (2, 15, 0), (5, 25, 0), (6, 19, None),
    (7, 4, None), (9, 1, 0), (11, 22, 3), (12, 25, None),
)
#: Days from Easter Sunday to Good Friday.
GOOD_FRIDAY = -2
#: Days by which a date on Monday ... Sunday moves off the weekend.
OFF_WEEKEND = (0, 0, 0, 0, 0, -1, 1)


def _by_rule(year: Column, rule: Column) -> Column:
    """The date of one rule: its earliest day, then forward to its weekday or off the weekend."""
    day = F.make_date(year, rule["month"], rule["day"])
    forward = F.pmod(rule["weekday"] - _weekday(day), F.lit(7))
    shift = F.element_at(F.array(*[F.lit(d) for d in OFF_WEEKEND]), _weekday(day) + 1)
    return F.date_add(day, F.coalesce(forward, shift))


def us_holidays(year: Column) -> Column:
    rules = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(d).alias("day"), F.lit(w).cast("int").alias("weekday")) for m, d, w in HOLIDAY_RULES])
    return F.array_append(F.transform(rules, lambda rule: _by_rule(year, rule)), F.date_add(easter_sunday(year), GOOD_FRIDAY))


def holiday_table(years: DataFrame) -> DataFrame:
    """Market holidays of each year (column `year`): ten rows a year."""
    return years.select("year", F.explode(us_holidays(F.col("year"))).alias("date"))


def us_open_days(starts: DataFrame, span: int = 96) -> DataFrame:
    """Weekdays that are no holiday in the `span` days from each start (column `start`).

    Holidays of the start's year and the next are looked at; they form a table with ten
    rows a year, which is broadcast.
    """
    days = starts.select("start", F.year("start").alias("start_year"),
                         F.explode(F.sequence("start", F.date_add("start", span - 1))).alias("date"))
    years = starts.select(F.explode(F.array(F.year("start"), F.year("start") + 1)).alias("year")).distinct()
    closed = holiday_table(years).select("date", F.explode(F.array("year", F.col("year") - 1)).alias("start_year"))
    return (days.filter(_weekday(F.col("date")) < 5)
            .join(F.broadcast(closed.distinct()), ["start_year", "date"], "left_anti").select("start", "date"))


def session_closed(day: Column, local_now: Column) -> Column:
    """The session of `day` is over: an earlier day, or 17:30 local time has come."""
    today = local_now.cast("date")
    minutes = F.hour(local_now) * 60 + F.minute(local_now)
    return (day < today) | ((day == today) & (minutes >= 17 * 60 + 30))


def local_time(utc: Column, market: Column) -> Column:
    """Market-local wall clock of a UTC wall clock (both without zone)."""
    zone = F.when(market == "US", "America/New_York").otherwise("Asia/Hong_Kong")
    return F.convert_timezone(F.lit("UTC"), zone, utc)
