"""Closed vocabularies: yes/no cells, unit attributes, charge, invoice and card codes.

A strict vocabulary gives a pair (value, error text); the plan keeps the row,
stores null and reports the error. A lenient one has a default and no error.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaseload.functions.numbers import id_text, number, whole_number
from leaseload.functions.text import BLANK_CELL_WORDS, _col, blank_to_null, clean_text, folded

# Input is trimmed and lower-cased before it is compared.
YES_WORDS = ("yes", "y", "true", "1")
NO_WORDS = ("no", "n", "false", "0")
SHORT_YES_WORDS = ("yes", "y")

UNIT_TYPE_IDS = {"apartment": 4, "vehicle parking": 5, "rv parking": 5, "boat parking": 5}
OTHER_UNIT_TYPE_ID = 1
CLIMATE_TYPES = ("climate control", "climate")
INSIDE_WORD = "interior"
UNIT_ACCESS = {
    "ground floor driveup": "GROUND_FLOOR_DRIVEUP",
    "ground floor interior walkable": "GROUND_FLOOR_INTERIOR_WALKABLE",
    "ground floor exterior walkable": "GROUND_FLOOR_EXTERIOR_WALKABLE",
    "driveup non-covered exterior parking": "DRIVEUP_NON_COVERED_EXT_PARKING",
    "driveup covered exterior parking": "DRIVEUP_COVERED_EXT_PARKING",
    "driveup interior parking": "DRIVEUP_INTERIOR_PARKING",
    "multi-floor/level elevator accessible": "MULTI_FLOOR_ELEVATOR_ACCESSIBLE",
    "multi-floor/level elevator no-accessible": "MULTI_FLOOR_ELEVATOR_NON_ACCESSIBLE",
    "multi-floor/level elevator non-accessible": "MULTI_FLOOR_ELEVATOR_NON_ACCESSIBLE",
}
POWER_LIGHTS = {"hallway": "HALLWAY", "inside unit": "INSIDE_UNIT", "no": "NO"}
ENTRY_LOCK = {
    "pad lock": "PAD_LOCK",
    "padlock": "PAD_LOCK",
    "smart lock": "SMART_LOCK",
    "rfid": "RFID",
    "bluetooth": "BLUETOOTH",
}
DOOR_TYPE_IDS = {"rollup": 1, "roll up": 1, "swing": 2}
MOBILE_UNIT = {
    "pod": "POD",
    "shipping container": "SHIPPING_CONTAINER",
    "non-permanent structure": "NON_PERMANENT_STRUCTURE",
    "no": "NO",
}
UNIT_STATUS_IDS = {"rentable": 1, "rented": 2, "reserved": 4, "maintenance": 5}
DEFAULT_UNIT_STATUS_ID = 1
CREDIT_MEMO_CHARGE_TYPES = {
    "waived current late fee 1.": 10000,
    "waived current late fee 2.": 10001,
    "reservation fee": 10002,
}
INVOICE_TYPE_BY_CHARGE_TYPE = {3: 1, 1: 2, 21: 3, 13: 4}
OTHER_INVOICE_TYPE_ID = 7
INVOICE_TYPE_NAMES = {
    1: "RENTAL",
    2: "DEPOSIT",
    3: "INSURANCE",
    4: "LATE_FEE",
    5: "MERCHANDISE",
    6: "CREDIT_MEMO",
    7: "MISC",
}
BILLING_FREQUENCIES = {
    "1": "DAILY",
    "2": "WEEKLY",
    "3": "MONTHLY",
    "4": "QUARTERLY",
    "5": "SEMI_ANNUALLY",
    "6": "ANNUAL",
    "7": "TWENTY_EIGHT_DAYS",
}
SUPPORTED_FREQUENCIES = ("MONTHLY", "QUARTERLY", "ANNUAL")
CARD_BRANDS = {
    "master card": "mastercard",
    "mastercard": "mastercard",
    "visa": "visa",
    "american express": "amex",
    "amex": "amex",
    "discover": "discover",
}


def mapped(key: Column, pairs: dict) -> Column:
    """Value a literal map holds for a key, null where it holds none."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    return F.try_element_at(literal, key)


def _strict(value: Column | str, pairs: dict, label: str) -> tuple[Column, Column]:
    text = F.lower(blank_to_null(value, BLANK_CELL_WORDS))
    result = mapped(text, pairs)
    return result, F.when(text.isNotNull() & result.isNull(), F.lit(f"Unrecognised {label}"))


def yes_no(value: Column | str, nullable: bool = False) -> tuple[Column, Column]:
    """Boolean; a blank cell is False, or null where the target column allows it."""
    text = F.lower(blank_to_null(value, BLANK_CELL_WORDS))
    blank = F.lit(None).cast("boolean") if nullable else F.lit(False)
    result = (
        F.when(text.isNull(), blank)
        .when(text.isin(*YES_WORDS), F.lit(True))
        .when(text.isin(*NO_WORDS), F.lit(False))
    )
    known = text.isin(*YES_WORDS, *NO_WORDS)
    return result, F.when(text.isNotNull() & ~known, F.lit("Unrecognised yes/no value"))


def unit_type_id(value: Column | str) -> Column:
    return F.coalesce(mapped(folded(value), UNIT_TYPE_IDS), F.lit(OTHER_UNIT_TYPE_ID))


def climate_controlled(value: Column | str) -> Column:
    return F.coalesce(folded(value).isin(*CLIMATE_TYPES), F.lit(False))


def inside(value: Column | str) -> Column:
    return F.coalesce(folded(value) == INSIDE_WORD, F.lit(False))


def unit_access(value: Column | str) -> tuple[Column, Column]:
    return _strict(value, UNIT_ACCESS, "unit access")


def power_lights(value: Column | str) -> tuple[Column, Column]:
    return _strict(value, POWER_LIGHTS, "power lights")


def entry_lock(value: Column | str) -> tuple[Column, Column]:
    return _strict(value, ENTRY_LOCK, "entry lock")


def door_type_id(value: Column | str) -> tuple[Column, Column]:
    return _strict(value, DOOR_TYPE_IDS, "door type")


def mobile_unit(value: Column | str) -> tuple[Column, Column]:
    return _strict(value, MOBILE_UNIT, "mobile unit")


def power_timer(value: Column | str) -> tuple[Column, Column]:
    """CONTINUOUS, NO or HOURS_1 .. HOURS_24 (a fraction is cut off)."""
    text = F.lower(blank_to_null(value, BLANK_CELL_WORDS))
    hours = number(text).try_cast("int")
    result = (
        F.when(text == "continuous", F.lit("CONTINUOUS"))
        .when(text == "no", F.lit("NO"))
        .when(hours.between(1, 24), F.concat(F.lit("HOURS_"), hours.cast("string")))
    )
    return result, F.when(text.isNotNull() & result.isNull(), F.lit("Unrecognised power timer"))


def floor_level(value: Column | str) -> tuple[Column, Column]:
    text = blank_to_null(value, BLANK_CELL_WORDS)
    result = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
    return result, F.when(text.isNotNull() & result.isNull(), F.lit("floor is not a whole number"))


def unit_status_id(**flags: Column | str) -> Column:
    """First yes among rentable, rented, reserved, maintenance decides."""
    chosen = [
        F.when(folded(flags[name]).isin(*SHORT_YES_WORDS), F.lit(code))
        for name, code in UNIT_STATUS_IDS.items()
    ]
    return F.coalesce(*chosen, F.lit(DEFAULT_UNIT_STATUS_ID))


def size_name(value: Column | str) -> Column:
    """"10 * 30" and "10x30" are the same size."""
    text = F.lower(blank_to_null(value, BLANK_CELL_WORDS))
    return F.replace(F.replace(text, F.lit("*"), F.lit("x")), F.lit(" "), F.lit(""))


def insurance_option(premium_cents: Column) -> Column:
    return F.when(premium_cents > 0, F.lit("BASIC")).otherwise(F.lit("NONE"))


def billing_frequency(value: Column | str) -> Column:
    return mapped(id_text(value), BILLING_FREQUENCIES)


def supported_frequency(frequency: Column) -> Column:
    return frequency.isin(*SUPPORTED_FREQUENCIES)


def credit_charge_type(memo: Column | str) -> Column:
    return mapped(folded(memo), CREDIT_MEMO_CHARGE_TYPES)


def invoice_type_id(charge_type: Column | str) -> Column:
    return F.coalesce(
        mapped(_col(charge_type).cast("int"), INVOICE_TYPE_BY_CHARGE_TYPE), F.lit(OTHER_INVOICE_TYPE_ID)
    )


def invoice_type_name(invoice_type: Column | str) -> Column:
    return F.coalesce(mapped(_col(invoice_type), INVOICE_TYPE_NAMES), F.lit("MISC"))


def card_brand(value: Column | str) -> Column:
    text = F.nullif(folded(value), F.lit(""))
    return F.coalesce(mapped(text, CARD_BRANDS), text)


def payment_method_id(value: Column | str) -> tuple[Column, Column]:
    result = whole_number(value).try_cast("int")
    missing = clean_text(value).isNull()
    return result, F.when(missing, F.lit("payment type is blank")).when(
        result.isNull(), F.lit("payment type is not a number")
    )
