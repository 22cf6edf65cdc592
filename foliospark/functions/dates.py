"""Date parsing: ISO timestamps, and the loose date layouts found on invoices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.binding import let

_ISO = (
    r"(?s)^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})"
    r"(?:.(?:[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?|[0-9]{4}|[0-9]{6}(?:[.,][0-9]+)?))?$"
)
_ISO_PARTS = r"(?s)^([0-9]{4})-?([0-9]{2})-?([0-9]{2})(?:.([0-9:]+)(?:[.,]([0-9]+))?)?$"
_DAY_MICROS = 86_400_000_000


def iso_timestamp(c: Column) -> Column:
    """ISO date or date-time without offset, `Z` ignored; NULL for everything else."""
    text = F.replace(c, F.lit("Z"), F.lit(""))

    def from_parts(p: Column) -> Column:
        clock = F.rpad(F.replace(F.get(p, 3), F.lit(":"), F.lit("")), 6, "0")
        return F.concat(
            F.get(p, 0), F.lit("-"), F.get(p, 1), F.lit("-"), F.get(p, 2), F.lit(" "),
            F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":"),
            F.substring(clock, 5, 2), F.lit("."), F.rpad(F.left(F.get(p, 4), F.lit(6)), 6, "0"),
        ).try_cast("timestamp_ntz")

    parts = F.split(F.regexp_replace(text, _ISO_PARTS, "$1|$2|$3|$4|$5"), "[|]")
    return F.when(text.rlike(_ISO), let(parts, from_parts))


def days_between(as_of: Column, then: Column) -> Column:
    """Whole days from `as_of` to `then`, rounded down (so earlier on the same day is -1)."""
    micros = F.timestamp_diff("MICROSECOND", as_of, then)
    return ((micros - F.pmod(micros, F.lit(_DAY_MICROS))) / _DAY_MICROS).cast("int")


_MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)


_MONTH_NUMBERS = {w: n for n, m in enumerate(_MONTHS, 1) for w in (m, m[:3])} | {"sept": 9}


def _month_number(word: Column) -> Column:
    numbers = F.create_map(*(F.lit(x) for pair in _MONTH_NUMBERS.items() for x in pair))
    return F.try_element_at(numbers, F.lower(word))


def _full_year(y: Column, this_year: int) -> Column:
    """Two-digit years fall within fifty years of `this_year`."""
    base = y.try_cast("int") + this_year // 100 * 100
    near = (
        F.when(base >= this_year + 50, base - 100)
        .when(base < this_year - 50, base + 100)
        .otherwise(base)
    )
    return F.when(F.length(y) > 2, y.try_cast("int")).otherwise(near)


def _date(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a valid date; NULL when a part is missing or out of range."""
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    text = F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), two(month), F.lit("-"), two(day)
    )
    return F.when(year.try_cast("int").between(1, 9999), text.try_cast("date").cast("string"))


_CLOCK = r"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?(?:\s*[ap][.]?m\b[.]?)?"
_WEEK = r"(?<![0-9a-z])([0-9]{4})-?w([0-9]{2})(?:-?([1-7]))?(?![0-9a-z])"
_TOKEN = "([0-9]+|[a-z]+)"


def _week_date(year: Column, week: Column, day: Column) -> Column:
    """The date of an ISO week and day, Monday if none is given; NULL if the year has no such week."""
    fourth = F.make_date(year.cast("int"), F.lit(1), F.lit(4))  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    days = (week.cast("int") - 1) * 7 + F.coalesce(F.nullif(day, F.lit("")).cast("int"), F.lit(1)) - 1
    there = F.date_add(monday, days)
    # a date and its week have the year of the Thursday between them
    thursday = F.date_add(there, 3 - F.weekday(there))
    valid = (week.cast("int") >= 1) & (F.year(thursday) == year.cast("int"))
    return F.when(valid, there.cast("string"))


def _date_parts(c: Column) -> Column:
    """Array of (text, month): numbers, and names of months, in order. All other words are passed
    over, weekdays and endings of ordinals among them, and times of day. A run of eight digits
    stands for year, month and day."""
    plain = F.regexp_replace(F.lower(c), _CLOCK, " ")
    plain = F.regexp_replace(plain, r"(?<![0-9])([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9])", "$1 $2 $3")
    tokens = F.regexp_extract_all(plain, F.lit(_TOKEN), F.lit(1))
    parts = F.transform(
        tokens,
        lambda t: F.struct(
            F.when(t < "a", t).alias("text"), F.when(t >= "a", _month_number(t)).alias("month")
        ),
    )
    return F.filter(parts, lambda p: p["text"].isNotNull() | p["month"].isNotNull())


def _resolved(parts: Column, this_year: int) -> Column:
    """The date that three parts make, by what each of them can be."""
    a, b, c = (F.get(parts, F.lit(i)) for i in range(3))

    def number(p: Column) -> Column:
        return p["text"].try_cast("int")

    def year(p: Column) -> Column:
        return _full_year(p["text"], this_year)

    def named(name: Column, one: Column, two: Column) -> Column:
        """One of the numbers is the year: the one that can be no day, else the later."""
        first = (F.length(one["text"]) > 2) | (number(one) > 31)
        return F.when(first, _date(year(one), name["month"], number(two))).otherwise(
            _date(year(two), name["month"], number(one))
        )

    months = F.size(F.filter(parts, lambda p: p["month"].isNotNull()))
    numbers = (
        F.when((number(a) > 31) | (F.length(a["text"]) > 2), _date(year(a), number(b), number(c)))
        # the month comes first unless that is impossible
        .when(number(a) > 12, _date(year(c), number(b), number(a)))
        .otherwise(_date(year(c), number(a), number(b)))
    )
    return (
        F.when(months == 0, numbers)
        .when(months != 1, None)
        .when(a["month"].isNotNull(), named(a, b, c))
        .when(b["month"].isNotNull(), named(b, a, c))
        .otherwise(named(c, a, b))
    )


def loose_date(c: Column, this_year: int) -> Column:
    """`YYYY-MM-DD` of a date written in any usual way, with other words around it.

    The text is split into numbers and words; names of months are read, other words are passed over,
    so weekdays, ordinals (`the 5th of January, 2024`) and labels do no harm. Three parts make a
    date: a year that is told by its length or size, else month first unless that is impossible
    (`25/12/2024`). ISO weeks (`2024-W01-1`) are read as well. NULL where parts are missing, where
    there are more than three, and where they are no date; `this_year` decides two-digit years.
    """
    week = F.split(F.regexp_replace(F.regexp_extract(F.lower(c), _WEEK, 0), _WEEK, "$1|$2|$3"), "[|]")
    in_week = let(week, lambda w: _week_date(F.get(w, F.lit(0)), F.get(w, F.lit(1)), F.get(w, F.lit(2))))
    three = let(_date_parts(c), lambda p: F.when(F.size(p) == 3, _resolved(p, this_year)))
    return F.when(F.lower(c).rlike(_WEEK), in_week).otherwise(three)


def compact_stamp(ts: Column) -> Column:
    """`yyyyMMdd_HHmmss`, independent of the session time zone."""
    text = F.left(ts.cast("timestamp_ntz").cast("string"), F.lit(19))
    return F.translate(text, " -:", "_")


def iso_stamp(ts: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ss`, with microseconds where there are any; no time zone."""
    return F.replace(ts.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
