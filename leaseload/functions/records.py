"""Derived record fields: receipt numbers, notes, statuses, synthetic ids, cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaseload.functions.dates import free_timestamp, iso_text, payment_timestamp
from leaseload.functions.numbers import whole_number
from leaseload.functions.text import (
    BLANK_DATE_WORDS,
    blank_to_null,
    clean_text,
    folded,
    has_value,
    joined,
    squeeze,
    trimmed_or_null,
    truthy,
)

# Fixed values written into target rows.
SOURCE_SYSTEM = "sitelink"
SOURCE_LABEL = "SiteLink"
RECEIPT_PREFIX = "SL-"
FORMER_PREFIX = "FORMER-"
NSF_REASON = "NSF - Returned check"
GRANTED_WORD = "granted"


def source_system() -> Column:
    return F.lit(SOURCE_SYSTEM)


def payment_receipt_number(payment_id: Column) -> Column:
    return F.concat(F.lit(RECEIPT_PREFIX), payment_id)


def receipt_number(number: Column | str, payment_id: Column) -> Column:
    return F.concat(F.lit(RECEIPT_PREFIX), trimmed_or_null(number), F.lit("-"), payment_id.cast("string"))


def payment_notes(ledger_id: Column, receipt_id: Column) -> Column:
    """Where a payment came from. Both ids are given as clean text."""
    return F.concat_ws(
        " ",
        F.lit(f"Imported from {SOURCE_LABEL}."),
        F.concat(F.lit("LedgerID: "), ledger_id, F.lit(".")),
        F.concat(F.lit("ReceiptID: "), receipt_id, F.lit(".")),
    )


def payment_status(nsf: Column | str, deleted: Column | str) -> Column:
    return F.when(truthy(nsf) | has_value(deleted), F.lit("FAILED")).otherwise(F.lit("COMPLETED"))


def failure_reason(nsf: Column | str, deleted: Column | str) -> Column:
    day = F.coalesce(
        F.date_format(payment_timestamp(deleted), "yyyy-MM-dd"), blank_to_null(deleted, BLANK_DATE_WORDS)
    )
    return joined(
        "; ",
        F.when(truthy(nsf), F.lit(NSF_REASON)),
        F.concat(F.lit(f"Voided in {SOURCE_LABEL} on "), day),
    )


def synthetic_external_id(
    last: Column | str, first: Column | str, phone: Column | str, mobile: Column | str, email: Column | str
) -> Column:
    """Stable id of a person without one: a digest of the name and one contact."""

    def plain(value: Column | str) -> Column:
        return F.coalesce(squeeze(value), F.lit(""))

    name = F.concat(F.upper(plain(last)), F.lit(","), F.upper(plain(first)))
    name = F.regexp_replace(name, "^,+|,+$", "")
    contact = F.coalesce(trimmed_or_null(phone), trimmed_or_null(mobile), trimmed_or_null(email), F.lit(""))
    digest = F.sha2(F.concat(name, F.lit("|"), contact), 256)
    return F.concat(F.lit(FORMER_PREFIX), F.substring(digest, 1, 12))


def stay_notes(unit: Column | str, moved_in: Column | str, moved_out: Column | str) -> Column:
    return joined(
        " | ",
        F.concat(F.lit("Last unit: "), clean_text(unit)),
        F.concat(F.lit("Move-in: "), iso_text(moved_in)),
        F.concat(F.lit("Move-out: "), iso_text(moved_out)),
    )


def granted(description: Column | str) -> Column:
    return F.coalesce(folded(description) == GRANTED_WORD, F.lit(False))


def gate_error(description: Column | str) -> Column:
    return F.when(~granted(description), trimmed_or_null(description))


def surname(name: Column | str) -> Column:
    """Text before the first comma; null where there is no comma."""
    text = squeeze(name)
    return F.when(F.contains(text, F.lit(",")), squeeze(F.substring_index(text, ",", 1)))


def card_last4(value: Column | str) -> Column:
    shown = F.regexp_replace(squeeze(value), "[* ]", "")
    return F.nullif(F.right(shown, F.lit(4)), F.lit(""))


def card_expiry(value: Column | str) -> tuple[Column, Column]:
    parsed = free_timestamp(value)
    return F.month(parsed), F.year(parsed)


def billing_day(rent_roll: Column, process_day: Column | str, lease: Column) -> Column:
    """Rent roll day, else process day, else day of the lease, else 1; at most 28."""
    zero = F.lit(0).cast("bigint")
    chosen = F.coalesce(
        F.nullif(rent_roll.cast("bigint"), zero),
        F.nullif(whole_number(process_day), zero),
        F.dayofmonth(lease).cast("bigint"),
        F.lit(1).cast("bigint"),
    )
    return F.least(chosen, F.lit(28)).cast("int")


def invoice_status(paid: Column, total: Column) -> Column:
    return F.when(paid <= 0, F.lit("UNPAID")).when(paid < total, F.lit("PARTIAL_PAID")).otherwise(F.lit("PAID"))


def open_balance(paid: Column, total: Column) -> Column:
    return F.greatest(total - paid, F.lit(0).cast("bigint"))


def reviewed_status(paid: Column, total: Column, due: Column, today: Column, swapped: bool = False) -> Column:
    """Status of a stored invoice. ``swapped`` gives the two open states the other way
    round, as one legacy preview report did."""
    later, past = ("OVERDUE", "UNPAID") if swapped else ("UNPAID", "OVERDUE")
    return (
        F.when((paid >= total) & (total > 0), F.lit("PAID"))
        .when(paid > 0, F.lit("PARTIAL_PAID"))
        .when(due > today, F.lit(later))
        .otherwise(F.lit(past))
    )
