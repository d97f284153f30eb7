"""Dates of many spellings, time zones, and the start of a collection window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .terms import LABEL_CLOSE

# Zone names of RFC 822 and their offsets; others count as UTC.
ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
# The English months of mail dates, short and long.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
SEOUL, NEW_YORK = "Asia/Seoul", "America/New_York"
_WEEKDAY = r"(?:(?:[^\s,]*,|(?i:mon|tue|wed|thu|fri|sat|sun))\s*)?"
_CLOCK = r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?"
_ZONE = r"(?:(?:\s+|(?=[+-]))(\S+)(?:\s.*)?)?"
_ISO_DATE = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)"
_ISO_CLOCK = r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?\s*(?:Z|([+-]\d{2})(?::?(\d{2}))?)?)?"
#: Spellings, and how each gives year|month|day|hour|minute|second|week|weekday|ISO offset|mail zone.
_SPELLINGS = (
    # day, month, year, clock, zone; what follows the zone (a comment, say) is passed over
    (rf"^{_WEEKDAY}(\d{{1,2}})[\s-]+([A-Za-z]+)[\s-]+(\d{{2}}|\d{{4}}),?\s+{_CLOCK}{_ZONE}$", "$3|$2|$1|$4|$5|$6||||$7"),
    (rf"^{_ISO_DATE}{_ISO_CLOCK}$", "$1|$2$4|$3$5|$10|$11|$12.$13|$6$8|$7$9|$14$15|"),
    # month, day, clock, zone, year; month, day, year, clock, zone
    (rf"^{_WEEKDAY}([A-Za-z]+)\s+(\d{{1,2}}),?\s+{_CLOCK}(?:\s+([A-Za-z]+))?\s+(\d{{4}})$", "$7|$1|$2|$3|$4|$5||||$6"),
    (rf"^{_WEEKDAY}([A-Za-z]+)\s+(\d{{1,2}}),?\s+(\d{{2}}|\d{{4}}),?\s+{_CLOCK}{_ZONE}$", "$3|$1|$2|$4|$5|$6||||$7"),
    # numbers without leading zeros: dashes or slashes with seconds, dots without
    (r"^(\d{4})(?:-(\d{1,2})-(\d{1,2})(?:\s+(\d{1,2}):(\d{1,2}):(\d{1,2}))?|/(\d{1,2})/(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})|\.(\d{1,2})\.(\d{1,2})\s+(\d{1,2}):(\d{1,2}))$", "$1|$2$7$12|$3$8$13|$4$9$14|$5$10$15|$6$11||||"),
)


def parse_date(raw: Column) -> Column:
    """Instant of a date as in mail, ISO 8601 or plain numbers; without a zone UTC; null for anything else.

    Mail dates take two-digit years (1969 to 2068), short and long months and weekdays, dashes between day, month and
    year, the month first, clocks without seconds, zone names or numbers (others count as UTC) and trailing
    comments.  ISO dates are of the extended and the basic form, by day or by week, with or without a clock,
    fraction and offset.
    """
    raw = F.regexp_replace(raw, r"^\s+|\s+$", "")
    fields = None
    for pattern, form in _SPELLINGS:
        own = F.regexp_replace(raw, F.lit(pattern), F.lit(form))
        fields = F.when(raw.rlike(pattern), own) if fields is None else fields.when(raw.rlike(pattern), own)
    part = F.split(fields, r"\|", 10)

    def number(k: int, kind: str = "int") -> Column:
        return part[k].try_cast(kind)

    year = number(0) + F.when(F.length(part[0]) > 2, 0).when(number(0) > 68, 1900).otherwise(2000)
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for name in sorted({m, m[:3]}) for x in (name, k + 1)])
    month = F.coalesce(number(1), F.try_element_at(months, F.lower(part[1])))
    # the fourth of January is always in the first week; the day within the year of the week may fall in another year
    first = F.try_to_timestamp(F.concat(part[0], F.lit("-01-04")), F.lit("yyyy-MM-dd")).cast("date")
    by_week = F.date_add(F.date_sub(first, F.weekday(first)), number(6) * 7 + F.coalesce(number(7), F.lit(1)) - 8)
    in_week = F.coalesce(number(7), F.lit(1)).between(1, 7) & (F.weekofyear(by_week) == number(6))
    week = F.when(part[6] != "", F.when(in_week, by_week))
    day = F.when(part[6] != "", week).otherwise(F.try_make_timestamp(year, month, number(2), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8, 6)"), F.lit("UTC")).cast("date"))
    hour, minute, second = F.coalesce(number(3), F.lit(0)), F.coalesce(number(4), F.lit(0)), F.coalesce(number(5, "decimal(8, 6)"), F.lit(0).cast("decimal(8, 6)"))
    zones = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    offset = F.coalesce(F.coalesce(F.try_element_at(zones, F.upper(part[9])), part[9]).try_cast("int"), F.rpad(part[8], 5, "0").try_cast("int"), F.lit(0))
    size = F.abs(offset)
    shift = F.signum(offset) * (F.floor(size / 100) * 3600 + size % 100 * 60)
    seconds = F.unix_date(day) * F.lit(86_400).cast("long") + hour * 3600 + minute * 60 - shift.cast("long")
    at = F.timestamp_micros((seconds * 1_000_000 + (second * 1_000_000).cast("long")).cast("long"))
    return F.when((hour < 24) & (minute < 60) & (second < 60) & (F.abs(shift) < 86_400), at)


def seoul(ts: Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    return F.concat(F.date_format(F.from_utc_timestamp(ts, SEOUL), pattern), F.lit(" KST"))


def last_close(now: Column) -> Column:
    """The last weekday 16:00 of New York strictly before ``now``."""
    local = F.from_utc_timestamp(now, NEW_YORK)

    def close(days: Column) -> Column:
        day = F.date_sub(local.cast("date"), days.cast("int"))
        return F.struct(F.to_utc_timestamp(day.cast("timestamp") + F.expr("INTERVAL 16 HOURS"), NEW_YORK).alias("at"), F.weekday(day).alias("weekday"))

    tried = F.transform(F.sequence(F.lit(0), F.lit(9)), close)
    return F.filter(tried, lambda c: (c["at"] < now) & (c["weekday"] < 5))[0]["at"]


def close_label(close: Column) -> Column:
    """Words for a window that begins at a market close: its day, hour and New York's zone then."""
    local = F.from_utc_timestamp(close, NEW_YORK)
    summer = (F.unix_seconds(local) - F.unix_seconds(close)) == -4 * 3600
    return F.concat(F.lit(LABEL_CLOSE[0]), F.date_format(local, "yyyy-MM-dd HH:mm"), F.when(summer, " EDT").otherwise(" EST"), F.lit(LABEL_CLOSE[1]))


def window_start(now: Column) -> Column:
    """The earlier of a day before ``now`` and the last market close."""
    return F.least(now - F.expr("INTERVAL 24 HOURS"), last_close(now))


def within(ts: Column, start: Column, end: Column) -> Column:
    """Closed on both ends; rows without a time pass."""
    return ts.isNull() | ts.between(start, end)
