from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leaseload.functions import dates, enums, numbers, records, text


def test_clean_text(values):
    assert values(text.clean_text("x"), " a ", "nan", "NONE", "", "\t", None, "\xa0b\n") == [
        "a", None, None, None, None, None, "b",
    ]


def test_full_name(spark):
    rows = [("John", "A"), ("John", ""), ("", "A"), ("nan", "A"), (" John ", None)]
    frame = spark.createDataFrame(rows, "f string, m string").select(text.full_name("f", "m").alias("y"))
    assert [r.y for r in frame.collect()] == ["John A", "John", None, None, "John"]


def test_truthy_and_filled(values):
    assert values(text.truthy("x"), "1", "True", " YES ", "t", "y", "0", "no", "", None) == [True] * 5 + [False] * 4
    assert values(text.has_value("x"), "a", "nat", "NaN", " ", None) == [True, False, False, False, False]


def test_access_code(values):
    assert values(text.access_code("x"), "12345678901", "nan", "ABC123") == ["1234567890", None, "ABC123"]


def test_whole_number(values):
    cells = ("779153.0", "91", " 7.9 ", "-3.9", "1e3", "abc", "", None, "inf", "nan", "9007199254740993", "12d", "+5", "99999999999999999999")
    assert values(numbers.whole_number("x"), *cells) == [
        779153, 91, 7, -3, 1000, None, None, None, None, None, 9007199254740993, None, 5, None,
    ]


def test_id_text(values):
    assert values(numbers.id_text("x"), "779153.0", "29021.0", "C-7", " ", None) == ["779153", "29021", "C-7", None, None]
    assert values(numbers.id_before_point("x"), "779153.0", "12", " ") == ["779153", "12", None]


def test_cents_round_ties_to_even(values):
    cells = ("225.00", "$225", "1,250", None, "0.125", "0.005", "2.675", "0.375", "x", "-1.5", "$ 7", " $1,000.10 ")
    assert values(numbers.cents("x"), *cells) == [22500, 22500, 125000, 0, 12, 0, 268, 38, 0, -150, 700, 100010]


def test_cents_equal_python_rounding(values):
    cells = [f"{n / 1000:.3f}" for n in range(-500, 500, 7)]
    assert values(numbers.signed_cents("x"), *cells) == [int(round(float(c) * 100)) for c in cells]


def test_cents_floors_and_signs(values):
    assert values(numbers.floored_cents("x"), "-5", "5", "x") == [0, 500, 0]
    assert values(numbers.negative_cents("x"), "-5", "5", "x") == [-500, -500, 0]
    assert values(numbers.cents_or_null("x"), "$5", "5") == [None, 500]


def test_dollars_and_rates(values):
    assert values(numbers.dollars("x"), "$225", "1,250", "", "1.125", "x") == [
        Decimal("225.00"), Decimal("1250.00"), Decimal("0.00"), Decimal("1.12"), Decimal("0.00"),
    ]
    assert values(numbers.dollars("x", marks=False), "$225", "10") == [Decimal("0.00"), Decimal("10.00")]
    value, error = numbers.rate("x")
    assert values(value, "1.125", "x", "", None) == [Decimal("1.12"), None, None, None]
    assert [e is not None for e in values(error, "1.125", "x", "", None)] == [False, True, False, False]


def test_payment_timestamp(values):
    cells = (
        "3/4/2020", "03/04/2020 5:06", "3/4/2020 5:06:07", "3/4/2020 5:06:07.5", "2020-03-04", "2020-3-4 5:6:7",
        "3-4-2020 5:06", "31/12/2020", "2/30/2020", "3/4/1969", "2020", "2020-03-04 5:06", "nat", "", None,
    )
    base = datetime(2020, 3, 4)
    assert values(dates.payment_timestamp("x"), *cells) == [
        base, base.replace(hour=5, minute=6), datetime(2020, 3, 4, 5, 6, 7), datetime(2020, 3, 4, 5, 6, 7, 500000),
        base, datetime(2020, 3, 4, 5, 6, 7), base.replace(hour=5, minute=6), None, None, None, None, None, None, None, None,
    ]


def test_free_timestamp(values):
    cells = ("2018-04-15", "not a date", "3/4/2020 3:15:00 PM", "3/4/2020 12:05 am", "2020-03-04T05:06:07.25", "25/3/2020", "1/1/1900")
    assert values(dates.free_timestamp("x"), *cells) == [
        datetime(2018, 4, 15), None, datetime(2020, 3, 4, 15, 15), datetime(2020, 3, 4, 0, 5),
        datetime(2020, 3, 4, 5, 6, 7, 250000), datetime(2020, 3, 25), datetime(1900, 1, 1),
    ]
    assert values(dates.after_epoch("x"), "1/1/1900", "1900-01-02", "") == [None, datetime(1900, 1, 2), None]


def test_wall_clock_time_survives_a_zone_with_summer_time(values):
    # 2:30 does not exist on that day in the session zone; a zoned type would move it.
    assert values(dates.payment_timestamp("x"), "3/8/2020 2:30") == [datetime(2020, 3, 8, 2, 30)]


def test_billing_date(values):
    cells = ("7/4/1999", "7/4/99", "7/4/68", "1/1/1900", "1900-01-01", "2020-02-03 04:05:06", "2-3-2020 4:5:6.7", "7/4/2020 1:00", "7-4-20")
    assert values(dates.billing_date("x"), *cells) == [
        date(1999, 7, 4), date(1999, 7, 4), date(2068, 7, 4), None, None, date(2020, 2, 3), date(2020, 2, 3), None, None,
    ]


def test_iso_text(values):
    assert values(dates.iso_text("x"), "3/4/2020", "1969-01-01", "nan", "3-4-2020") == ["2020-03-04", None, None, "2020-03-04"]


@pytest.mark.parametrize(
    ("day", "expected"), [(5, date(2026, 2, 5)), (31, date(2026, 1, 31)), (29, date(2026, 2, 28)), (30, date(2026, 1, 30))]
)
def test_next_billing_date(spark, day, expected):
    today = F.lit("2026-01-30").cast("date")
    row = spark.range(1).select(dates.next_billing_date(today, F.lit(day)).alias("y")).first()
    assert row.y == expected


def test_next_billing_date_over_new_year(spark):
    today = F.lit("2025-12-20").cast("date")
    assert spark.range(1).select(dates.next_billing_date(today, F.lit(3)).alias("y")).first().y == date(2026, 1, 3)


def test_charge_day(values):
    assert values(dates.charge_day(F.to_date("x"), 30), "2012-07-27", "2022-01-31") == [27, 30]
    assert values(dates.charge_day(F.to_date("x")), "2022-01-31") == [31]


def test_billing_day_chain(spark):
    rows = [(15, "20", date(2020, 1, 5)), (0, "20", date(2020, 1, 5)), (None, "0", date(2020, 1, 31)), (None, "x", None), (30, None, None)]
    frame = spark.createDataFrame(rows, "r bigint, p string, l date")
    result = frame.select(records.billing_day(F.col("r"), "p", F.col("l")).alias("y")).collect()
    assert [r.y for r in result] == [15, 20, 28, 1, 28]


def test_yes_no(values):
    value, error = enums.yes_no("x")
    assert values(value, "Yes", "n", "", None, "maybe") == [True, False, False, False, None]
    assert [e is not None for e in values(error, "Yes", "", None, "maybe")] == [False, False, False, True]
    assert values(enums.yes_no("x", nullable=True)[0], "", None, "1") == [None, None, True]


def test_strict_vocabularies(values):
    assert values(enums.unit_access("x")[0], "Driveup Interior Parking", "by boat", "") == ["DRIVEUP_INTERIOR_PARKING", None, None]
    assert values(enums.door_type_id("x")[0], "Roll Up", "swing", "x") == [1, 2, None]
    assert [e is not None for e in values(enums.door_type_id("x")[1], "Roll Up", "x", "")] == [False, True, False]
    assert values(enums.power_timer("x")[0], "continuous", "No", "24", "25", "1.9", "0.5") == [
        "CONTINUOUS", "NO", "HOURS_24", None, "HOURS_1", None,
    ]
    assert values(enums.floor_level("x")[0], "2", "2.0", "", "-1") == [2, None, None, -1]


def test_lenient_vocabularies(values):
    assert values(enums.unit_type_id("x"), "RV Parking", "Apartment", "thing", None) == [5, 4, 1, 1]
    assert values(enums.climate_controlled("x"), "Climate Control", "climate", "x", None) == [True, True, False, False]
    assert values(enums.size_name("x"), "10*30", "10 x 30", "") == ["10x30", "10x30", None]
    assert values(enums.invoice_type_id(F.col("x").cast("int")), "3", "1", "21", "13", "99", None) == [1, 2, 3, 4, 7, 7]
    assert values(enums.card_brand("x"), "Master Card", "VISA", "Diners", "") == ["mastercard", "visa", "diners", None]
    assert values(enums.billing_frequency("x"), "3.0", "6", "9", "soon") == ["MONTHLY", "ANNUAL", None, None]
    assert values(enums.insurance_option(F.col("x").cast("int")), "500", "0") == ["BASIC", "NONE"]


def test_unit_status_first_yes_wins(spark):
    rows = [("yes", "yes", "", ""), ("", "y", "yes", ""), ("", "", "Yes", "yes"), ("", "", "", "y"), ("no", None, "", "")]
    frame = spark.createDataFrame(rows, "a string, b string, c string, d string")
    status = enums.unit_status_id(rentable="a", rented="b", reserved="c", maintenance="d")
    assert [r.y for r in frame.select(status.alias("y")).collect()] == [1, 2, 4, 5, 1]


def test_payment_records(spark):
    rows = [("1", None), ("0", "1/2/2020"), ("yes", "soon"), (None, " ")]
    frame = spark.createDataFrame(rows, "nsf string, gone string")
    result = frame.select(records.payment_status("nsf", "gone").alias("s"), records.failure_reason("nsf", "gone").alias("r")).collect()
    assert [r.s for r in result] == ["FAILED", "FAILED", "FAILED", "COMPLETED"]
    assert [r.r for r in result] == [
        "NSF - Returned check", "Voided in SiteLink on 2020-01-02", "NSF - Returned check; Voided in SiteLink on soon", None,
    ]


def test_synthetic_id_is_stable(spark):
    import hashlib

    rows = [("doe", "Jane", " 555 ", "", ""), ("Doe ", "jane", "555", "777", "e"), ("Doe", None, None, "777", None)]
    frame = spark.createDataFrame(rows, "l string, f string, p string, m string, e string")
    ids = [r.y for r in frame.select(records.synthetic_external_id("l", "f", "p", "m", "e").alias("y")).collect()]
    digest = hashlib.sha256(b"DOE,JANE|555").hexdigest()[:12]
    assert ids[0] == ids[1] == f"FORMER-{digest}"
    assert ids[2] == "FORMER-" + hashlib.sha256(b"DOE|777").hexdigest()[:12]


def test_card_fields(values):
    assert values(records.card_last4("x"), "**** **** **** 1234", "12", "", None) == ["1234", "12", None, None]
    assert values(records.surname("x"), "Waldrop, J", "NoComma", " A , B, C") == ["Waldrop", None, "A"]
    assert values(records.card_expiry("x")[0], "3/4/2027", "never") == [3, None]


def test_gate_fields(values):
    assert values(records.granted("x"), " Granted ", "denied", None) == [True, False, False]
    assert values(records.gate_error("x"), "granted", "denied", "") == [None, "denied", None]


def test_invoice_states(spark):
    rows = [(0, 100), (50, 100), (100, 100), (150, 100)]
    frame = spark.createDataFrame(rows, "p bigint, t bigint")
    result = frame.select(records.invoice_status(F.col("p"), F.col("t")).alias("s"), records.open_balance(F.col("p"), F.col("t")).alias("b")).collect()
    assert [(r.s, r.b) for r in result] == [("UNPAID", 100), ("PARTIAL_PAID", 50), ("PAID", 0), ("PAID", 0)]


def test_reviewed_states(spark):
    day = F.lit("2020-01-10").cast("date")
    rows = [(100, 100, "2020-01-01"), (50, 100, "2020-01-01"), (0, 100, "2020-01-11"), (0, 100, "2020-01-10"), (0, 0, None), (5, 0, None)]
    frame = spark.createDataFrame(rows, "p bigint, t bigint, d string").withColumn("d", F.to_date("d"))
    cols = (F.col("p"), F.col("t"), F.col("d"), day)
    result = frame.select(records.reviewed_status(*cols).alias("s"), records.reviewed_status(*cols, swapped=True).alias("w")).collect()
    assert [r.s for r in result] == ["PAID", "PARTIAL_PAID", "UNPAID", "OVERDUE", "OVERDUE", "PARTIAL_PAID"]
    assert [r.w for r in result] == ["PAID", "PARTIAL_PAID", "OVERDUE", "UNPAID", "UNPAID", "PARTIAL_PAID"]


def test_run_duration(spark):
    rows = [("2020-01-01T00:00:00", "2020-01-01T00:00:32"), ("2020-01-01T00:00:00", "2020-01-01T00:04:18.9"), ("x", None)]
    frame = spark.createDataFrame(rows, "a string, b string")
    started, finished = (F.col(c).try_cast("timestamp_ntz") for c in "ab")
    assert [r.y for r in frame.select(dates.duration_text(started, finished).alias("y")).collect()] == ["32s", "4m 18s", ""]


def test_total_cents(spark):
    frame = spark.createDataFrame([("1.5", None, "x"), ("-5", "2", None)], "a string, b string, c string")
    assert [r.y for r in frame.select(numbers.total_cents(["a", "b", "c"]).alias("y")).collect()] == [150, 0]


def test_dates_as_machines_write_them(values):
    from datetime import datetime as at

    cells = ("2020-01-02 03:04:05.1234567", "2020-01-02T03:04:05Z", "2020/01/02", "20200102", "1/2/20", "1/2/70", "2-Jan-2020", "2-jan-69", "12345678", "2-xyz-2020", "2020/13/01")
    assert values(dates.free_timestamp("x"), *cells) == [
        at(2020, 1, 2, 3, 4, 5, 123456), at(2020, 1, 2, 3, 4, 5), at(2020, 1, 2), at(2020, 1, 2), at(2020, 1, 2), at(1970, 1, 2),
        at(2020, 1, 2), at(1969, 1, 2), None, None, None,
    ]
    assert values(dates.unread("x", dates.free_timestamp("x")), "soon", " ", "1/2/20", "NaT", None) == [
        "no readable date", None, None, None, None,
    ]


def test_ids_and_amounts_beyond_the_type(values):
    long_ids = ("1234567890123456789", "1234567890123456790", "12345678901234567890.0", "9223372036854775807")
    assert values(numbers.whole_number("x"), *long_ids) == [1234567890123456789, 1234567890123456790, None, 9223372036854775807]
    assert values(numbers.id_text("x"), *long_ids) == [
        "1234567890123456789", "1234567890123456790", "12345678901234567890", "9223372036854775807",
    ]
    assert values(numbers.dollars("x"), "99999999999.00", "$9,999,999,999.99", "x") == [None, Decimal("9999999999.99"), Decimal("0.00")]


SPELLED_DATES = [
    ("Jan 2, 2020", datetime(2020, 1, 2)), ("2 January 2020 3:04 PM", datetime(2020, 1, 2, 15, 4)),
    ("January 2nd, 2020", datetime(2020, 1, 2)), ("Thu, 2 Jan 2020 15:04:05 GMT", datetime(2020, 1, 2, 15, 4, 5)),
    ("2020-Jan-02", datetime(2020, 1, 2)), ("2020 January 2", datetime(2020, 1, 2)), ("02-JAN-20", datetime(2020, 1, 2)),
    ("Sept. 9, 1999 12:00 am", datetime(1999, 9, 9)), ("Jan 2020", datetime(2020, 1, 1)),
    ("2020-01-02T03:04:05+00:00", datetime(2020, 1, 2, 3, 4, 5)), ("2020-01-02 03:04:05.5-0500", datetime(2020, 1, 2, 3, 4, 5, 500000)),
    ("1/2/2020 3 PM", datetime(2020, 1, 2, 15)), ("1/2/2020 12:30 a.m.", datetime(2020, 1, 2, 0, 30)),
    ("13/2/2020 1:02", datetime(2020, 2, 13, 1, 2)), ("2020.01.02", datetime(2020, 1, 2)), ("20200102", datetime(2020, 1, 2)),
    ("Monday, March 2, 2020", datetime(2020, 3, 2)), ("May 5 2021", datetime(2021, 5, 5)),
    # No dates.
    ("13:00 PM", None), ("1/2/2020 13:00 PM", None), ("Ja 2, 2020", None), ("January", None), ("2 dogs 2020", None),
    ("31/31/2020", None), ("Feb 30, 2020", None), ("779153", None), ("12.5", None), ("Jan Feb 2020", None), ("5:30", None),
    ("1/2/2020 x", None), ("(1/2/2020)", None), ("12345678901234567890", None), ("just now", None),
]


def test_amounts_that_do_not_fit_are_null(values):
    cells = ("99999999999999999999", "1e30", "-1e30", "1e400", "90071992547409.93", "$90,071,992,547,409.93", "92233720368547758.07", "92233720368547758.08", "2.675", "x", None)
    exact, most = 9007199254740993, 9223372036854775807
    assert values(numbers.signed_cents("x"), *cells) == [None, None, None, None, exact, 0, most, None, 268, 0, 0]
    assert values(numbers.cents("x"), *cells) == [None, None, None, None, exact, exact, most, None, 268, 0, 0]
    assert values(numbers.floored_cents("x"), *cells) == [None, None, None, None, exact, exact, most, None, 268, 0, 0]
    assert values(numbers.cents_or_null("x"), *cells) == [None, None, None, None, exact, None, most, None, 268, None, None]
    assert values(numbers.negative_cents("x"), "-5", "5", "1e30") == [-500, -500, None]
    assert values(numbers.total_cents(["x", "x"]), "1e30", "-3", "0.05") == [None, 0, 10]


def test_dates_by_their_tokens(values):
    found = values(dates.free_timestamp("x"), *[cell for cell, _ in SPELLED_DATES])
    assert dict(zip((c for c, _ in SPELLED_DATES), found)) == dict(SPELLED_DATES)


@pytest.mark.parametrize("cell", [
    "1/2/2020 3:15:00 PM", "1/2/2020 12:15 am", "1-2-2020 12:00:01.25PM", "2020-01-02 1:02:03 Am", "1/2/2020 13:15 PM", "1/2/2020 0:15 PM",
    "13/2/2020 3:15 PM", "2/30/2020 3:15 PM", "2020-01-02 03:04:05.1234567", "2020-1-2T3:4:5Z", "2020-01-02 23:14:15.5+05:30",
    "2020-01-02T3:4:5-0530", "2020-01-02 24:14:15Z", "2020/1/2", "2020/13/2", "20200102", "20201302", "2/3/69", "2/3/68", "31/3/99",
    "2-Mar-1999", "31 feb 1999", "3-Abc-1999", "3-anf-1999", "03 JUN 2001", "32/32/2020", "13/5/2020", "0/5/2020", "5/0/2020", "2020-02-30",
])
def test_usual_dates_are_read_as_their_tokens_say(spark, cell):
    from leaseload.functions import dates

    row = spark.createDataFrame([(cell,)], "t string").select(
        dates._usual_timestamp(F.col("t")).alias("usual"), dates._spelled_timestamp(F.col("t")).alias("tokens"), dates.free_timestamp("t").alias("free")
    ).first()
    assert row.usual in (None, row.tokens)
    assert row.free == row.tokens


def test_usual_dates_need_no_tokens(spark):
    from leaseload.functions import dates

    cells = ["1/2/2020 3:15:00 PM", "2020-01-02 03:04:05.1234567", "2020-01-02T23:14:15Z", "2020/01/02", "20200102", "1/2/20", "2-Jan-2020"]
    rows = spark.createDataFrame([(c,) for c in cells], "t string").select(dates._usual_timestamp(F.col("t")).alias("at"))
    assert {str(r["at"])[:10] for r in rows.collect()} == {"2020-01-02"}
