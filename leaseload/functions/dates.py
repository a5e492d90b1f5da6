"""Dates out of text.

All results are ``timestamp_ntz`` or ``date``: the exports hold wall-clock times
without a zone, and a zoned type would move them with the session zone.

A cell is first brought to year-month-day order by one regular expression and
then cast. That costs one cast per cell that fits, where a list of formatters
tried in turn would raise and drop one parse error per format that does not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaseload.functions.text import squeeze

_CLOCK = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
_FRACTION = r"\.[0-9]{1,6}"
_ANY_YEAR = "[0-9]{4}"
_SINCE_1970 = "(?:19[7-9][0-9]|[2-9][0-9]{3})"
_DAY_MONTH = "[0-9]{1,2}"
_MONTH_FIRST = r"^([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})"


def _shapes(year: str, slashed: str, dashed: str, year_first: str) -> str:
    """One pattern for m/d/y, m-d-y and y-m-d, each with the clock it may carry."""
    return (
        f"^(?:{_DAY_MONTH}/{_DAY_MONTH}/{year}{slashed}|{_DAY_MONTH}-{_DAY_MONTH}-{year}{dashed}"
        f"|{year}-{_DAY_MONTH}-{_DAY_MONTH}{year_first})$"
    )


# The cell shapes each parser accepts, and the cells that mean no date.
_SECONDS = f"(?: {_CLOCK}(?:{_FRACTION})?)?"
_MINUTES = f"(?: (?:{_CLOCK}(?:{_FRACTION})?|[0-9]{{1,2}}:[0-9]{{1,2}}))?"
_ISO_CLOCK = f"(?:[ T](?:{_CLOCK}(?:{_FRACTION})?|[0-9]{{1,2}}:[0-9]{{1,2}}))?"
PAYMENT_SHAPES = _shapes(_SINCE_1970, _MINUTES, _MINUTES, _SECONDS)
BILLING_SHAPES = _shapes(_ANY_YEAR, "", _SECONDS, _SECONDS)
ISO_TEXT_SHAPES = _shapes(_SINCE_1970, "", "", _SECONDS)
# A cast that fails costs more than the rest of the cell, so months and days are in range here.
_MONTH, _DAY = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
_ISO_DAY = f"{_ANY_YEAR}-{_MONTH}-{_DAY}"
_US_DATE = f"(?:{_MONTH}/{_DAY}/{_ANY_YEAR}|{_MONTH}-{_DAY}-{_ANY_YEAR})"
FREE_SHAPES = f"^(?:{_US_DATE}{_MINUTES}|{_ISO_DAY}{_ISO_CLOCK})$"
# Shapes that are brought to a common one without a look at their tokens.
HALF_DAY_SHAPE = f"^(?:{_US_DATE}|{_ISO_DAY}) {_MONTH}:[0-9]{{1,2}}(?::[0-9]{{1,2}}(?:{_FRACTION})?)? ?[AaPp][Mm]$"
MACHINE_SHAPE = f"^({_ISO_DAY}[ T]{_CLOCK}(?:{_FRACTION})?)[0-9]*(?:Z|UTC|GMT|[+-][0-9]{{2}}:?[0-9]{{2}})?$"
SLASHED_SHAPE = f"^([12][0-9]{{3}})/({_MONTH})/({_DAY})$"
DIGITS_SHAPE = "^([12][0-9]{3})(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"
SHORT_US_SHAPE = f"^({_MONTH})/({_DAY})/([0-9]{{2}})$"
NAMED_MONTH_SHAPE = f"^({_DAY})[ -]([A-Za-z]{{3}})[ -]({_ANY_YEAR})$"
_READ_DAY = f"^[0-9]{{4}}-{_MONTH}-{_DAY} "
SHORT_YEAR_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"
# Tokens of a free-form date: a clock with its meridiem and zone at the end, words, numbers.
MONTHS = "january february march april may june july august september october november december".split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()
ORDINALS = ("st", "nd", "rd", "th")
_ZONE = r"(?:\s*(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?"
_MERIDIEM = r"([ap])\.?m\.?"
CLOCK_TOKEN = (
    rf"(?i)(?:^|[\sT,])\s*([0-9]{{1,2}})(?::([0-9]{{1,2}}))(?::([0-9]{{1,2}})(?:[.,]([0-9]+))?)?\s*(?:{_MERIDIEM})?{_ZONE}$"
)
HOUR_TOKEN = rf"(?i)[\s,]([0-9]{{1,2}})\s*{_MERIDIEM}{_ZONE}$"
NO_DATE_CELLS = ("", "nan", "NaT", "None", "1/1/1900", "1900-01-01")
EPOCH_DAY = "1900-01-01"


def _shaped(text: Column, shapes: str) -> Column:
    """Cast of a cell that has one of the shapes, null for any other cell."""
    return F.when(text.rlike(shapes), F.regexp_replace(text, _MONTH_FIRST, "$3-$1-$2").try_cast("timestamp_ntz"))


def payment_timestamp(value: Column | str) -> Column:
    """Ordered list of payment formats; years before 1970 count as no date."""
    return _shaped(squeeze(value), PAYMENT_SHAPES)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` over a value that is computed once and stands for itself in the plan."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _begun_by(names: list[str], word: Column) -> Column:
    """Place (from 1) of the name that a word of three letters or more begins, else 0."""
    listed = F.array(*[F.lit(n) for n in names])
    return F.when(F.length(word) >= 3, F.array_position(F.transform(listed, lambda n: n.startswith(word)), True)).otherwise(0)


def _long_year(year: Column) -> Column:
    """A two-digit year in full; 69-99 mean the 1900s."""
    number = year.try_cast("int")
    short = F.when(number >= 69, number + 1900).otherwise(number + 2000)
    return F.lpad(F.when(F.length(year) <= 2, short).otherwise(number).cast("string"), 4, "0")


def _of_clock(text: Column) -> Column:
    """Struct of the ending of a text that is a clock, and the clock as h:m:s with a fraction; null if it is none."""
    clock, hour_only = F.regexp_extract(text, CLOCK_TOKEN, 0), F.regexp_extract(text, HOUR_TOKEN, 0)

    def group(n: int) -> Column:
        return F.regexp_extract(text, CLOCK_TOKEN, n)

    parts = F.when(
        clock != "",
        F.struct(clock.alias("ending"), group(1).alias("h"), group(2).alias("m"), group(3).alias("s"), group(4).alias("f"), group(5).alias("half")),
    ).otherwise(
        F.struct(
            hour_only.alias("ending"), F.regexp_extract(text, HOUR_TOKEN, 1).alias("h"), F.lit("").alias("m"), F.lit("").alias("s"),
            F.lit("").alias("f"), F.regexp_extract(text, HOUR_TOKEN, 2).alias("half"),
        )
    )

    def shown(c: Column) -> Column:
        # Without a clock there is no hour; a cast that fails costs more than the rest of the cell.
        hour, half = F.when(c["h"] != "", c["h"].try_cast("int")), F.lower(c["half"])
        full = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), 0).otherwise(hour)
        fits = (half == "") | hour.between(1, 12)
        fraction = F.when(c["f"] != "", F.concat(F.lit("."), F.substring(c["f"], 1, 6))).otherwise("")
        minutes = [F.when(x != "", x).otherwise("0") for x in (c["m"], c["s"])]
        spelled = F.concat(F.concat_ws(":", full.cast("string"), *minutes), fraction)
        return F.struct(c["ending"].alias("ending"), F.when(c["ending"] == "", "0:0:0").when(fits, spelled).alias("time"))

    return _let(parts, shown)


def _of_day(text: Column) -> Column:
    """The date in a lower-case text without a clock, as y-m-d; null if it is none."""

    def ordered(t: Column) -> Column:
        month, n_words, n = t["month"], t["n_words"], F.size(t["numbers"])
        first, second, third = (F.get(t["numbers"], F.lit(i)) for i in range(3))

        def ymd(year: Column, of_year: Column, day: Column) -> Column:
            return F.concat_ws("-", _long_year(year), of_year.cast("string"), day)

        worded = (
            F.when((n == 2) & (F.length(first) >= 3), ymd(first, month, second))
            .when(n == 2, ymd(second, month, first))
            .when((n == 1) & (F.length(first) == 4), ymd(first, month, F.lit("1")))
        )
        day_first = (first.try_cast("int") > 12) & (second.try_cast("int") <= 12)
        numbered = (
            F.when((n == 3) & (F.length(first) == 4), ymd(first, second, third))
            .when((n == 3) & day_first, ymd(third, second, first))
            .when(n == 3, ymd(third, first, second))
            .when((n == 1) & first.rlike("^[12][0-9]{7}$"), F.regexp_replace(first, "^([0-9]{4})([0-9]{2})", "$1-$2-"))
        )
        return F.when((n_words == 1) & (month > 0), worded).when(n_words == 0, numbered)

    words = F.regexp_extract_all(text, F.lit("[a-z]+"), F.lit(0))
    # Weekdays and the endings of a day say nothing.
    left = F.filter(words, lambda w: ~w.isin(*ORDINALS) & (_begun_by(WEEKDAYS, w) == 0))
    tokens = _let(
        left,
        lambda ws: F.struct(
            F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)).alias("numbers"),
            F.size(ws).alias("n_words"),
            F.coalesce(_begun_by(MONTHS, F.get(ws, F.lit(0))), F.lit(0)).alias("month"),
        ),
    )
    # Between the tokens stand blanks and the usual marks only.
    return F.when(text.rlike(r"^[0-9a-z\s/,.-]+$"), _let(tokens, ordered))


def _spelled_timestamp(text: Column) -> Column:
    """Date and clock read by classes of tokens, in any order people and machines write them.

    The clock (hours, minutes, seconds, fraction, AM or PM, zone) stands at the end. What
    is left are numbers and words. Words are a month, a weekday or the ending of a day; any
    other word means no date. A number of three digits or more is the year. With a month
    word the other number is the day; without one, three numbers are year first, month
    first, or day first where the first cannot be a month, and eight digits are a date.
    Fractions are cut at microseconds; a zone is dropped, since times are wall-clock.
    """

    def whole(x: Column) -> Column:
        def joined(c: Column) -> Column:
            rest = F.substr(x, F.lit(1), F.length(x) - F.length(c["ending"]))
            day = _let(F.lower(rest), _of_day)
            spelled = F.when(c["time"].isNotNull(), F.concat(day, F.lit(" "), c["time"]))
            return _let(spelled, lambda s: F.when(s.rlike(_READ_DAY), s.try_cast("timestamp_ntz")))

        return _let(_of_clock(x), joined)

    return _let(text, whole)


def _usual_timestamp(text: Column) -> Column:
    """The shapes clerks and machines use most, rewritten by patterns alone, which Spark
    compiles; null for all others. The tokens would give the same."""
    hour = F.regexp_extract(text, " ([0-9]{1,2}):", 1).cast("int") % 12 + F.when(F.lower(text).endswith("pm"), 12).otherwise(0)
    day = F.regexp_replace(F.substring_index(text, " ", 1), _MONTH_FIRST, "$3-$1-$2")
    half_day = F.concat(day, F.lit(" "), hour.cast("string"), F.regexp_extract(text, ":[0-9:.]+", 0))
    short_year = F.regexp_extract(text, SHORT_US_SHAPE, 3)
    century = F.when(short_year >= "69", "19").otherwise("20")
    place = F.instr(F.lit("".join(m[:3] for m in MONTHS)), F.lower(F.regexp_extract(text, NAMED_MONTH_SHAPE, 2)))
    of_year = F.when(place % 3 == 1, F.floor(place / 3) + 1)
    named = F.concat_ws("-", F.regexp_extract(text, NAMED_MONTH_SHAPE, 3), of_year.cast("string"), F.regexp_extract(text, NAMED_MONTH_SHAPE, 1))
    spelled = (
        F.when(text.rlike(HALF_DAY_SHAPE), half_day)
        .when(text.rlike(MACHINE_SHAPE), F.regexp_extract(text, MACHINE_SHAPE, 1))
        .when(text.rlike(SLASHED_SHAPE) | text.rlike(DIGITS_SHAPE), F.regexp_replace(F.replace(text, F.lit("/"), F.lit("-")), DIGITS_SHAPE, "$1-$2-$3"))
        .when(text.rlike(SHORT_US_SHAPE), F.regexp_replace(text, SHORT_US_SHAPE, "-$1-$2"))
    )
    spelled = F.when(spelled.startswith("-"), F.concat(century, short_year, spelled)).otherwise(spelled)
    return F.coalesce(spelled, F.when(text.rlike(NAMED_MONTH_SHAPE) & of_year.isNotNull(), named)).try_cast("timestamp_ntz")


def unread(value: Column | str, parsed: Column) -> Column:
    """Error text for a cell that is filled and holds no readable date."""
    text = squeeze(value)
    return F.when((text != "") & ~text.isin(*NO_DATE_CELLS) & parsed.isNull(), F.lit("no readable date"))


def free_timestamp(value: Column | str) -> Column:
    """Free-form date: the common shapes by one pattern, the usual other ones by a few, the
    rest by their tokens (see :func:`_spelled_timestamp`). Anything that is no date is null."""
    text = squeeze(value)
    spelled = F.when(text.rlike("[0-9]") & (F.length(text) < 80), F.coalesce(_usual_timestamp(text), _spelled_timestamp(text)))
    return F.coalesce(_shaped(text, FREE_SHAPES), spelled)


def free_date(value: Column | str) -> Column:
    return free_timestamp(value).cast("date")


def after_epoch(value: Column | str) -> Column:
    """Free-form date where 1900-01-01 and earlier stand for no date."""
    parsed = free_timestamp(value)
    return F.when(parsed.cast("date") > F.lit(EPOCH_DAY).cast("date"), parsed)


def billing_date(value: Column | str) -> Column:
    """Billing formats with a two-digit year (69-99 mean the 1900s)."""
    text = squeeze(value)
    fitting = F.when(~text.isin(*NO_DATE_CELLS), text)
    short = F.regexp_extract(text, SHORT_YEAR_SHAPE, 0)
    long_form = F.regexp_replace(short, "/(69|[7-9][0-9])$", "/19$1")
    long_form = F.regexp_replace(long_form, "/([0-9]{2})$", "/20$1")
    return F.coalesce(_shaped(fitting, BILLING_SHAPES), _shaped(long_form, BILLING_SHAPES)).cast("date")


def iso_text(value: Column | str) -> Column:
    """Date as yyyy-MM-dd text, null before 1970."""
    return F.date_format(_shaped(squeeze(value), ISO_TEXT_SHAPES), "yyyy-MM-dd")


def not_before(value: Column, floor: Column) -> Column:
    return F.greatest(value, floor)


def charge_day(value: Column, max_day: int | None = None) -> Column:
    """Day of month, held to ``max_day`` where one is given."""
    day = F.dayofmonth(value)
    return day if max_day is None else F.least(day, F.lit(max_day))


def next_billing_date(today: Column, day: Column) -> Column:
    """Next time a day of month comes round, held to the month's last day."""

    def in_month(first: Column) -> Column:
        return F.date_add(first, F.least(day, F.dayofmonth(F.last_day(first))) - F.lit(1))

    this_month = in_month(F.trunc(today, "MM"))
    following = in_month(F.add_months(F.trunc(today, "MM"), 1))
    return F.when(this_month >= today, this_month).otherwise(following)


def duration_text(started: Column, finished: Column) -> Column:
    """Run length as "32s" or "4m 18s"; empty where a time is missing."""
    whole = F.floor(
        (F.unix_micros(finished.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))) / F.lit(1000000)
    )
    minutes = F.floor(whole / F.lit(60))
    text = F.when(whole < 60, F.concat(whole.cast("string"), F.lit("s"))).otherwise(
        F.concat(minutes.cast("string"), F.lit("m "), (whole - minutes * 60).cast("string"), F.lit("s"))
    )
    return F.coalesce(text, F.lit(""))
