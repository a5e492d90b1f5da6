"""Units export -> units table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.functions import enums
from leaseload.functions.numbers import rate
from leaseload.functions.text import BLANK_CELL_WORDS, blank_to_null, clean_text
from leaseload.operators.keys import attach, last_wins
from leaseload.operators.outcome import Known, Outcome, Rule, field_errors
from leaseload.params import Params
from leaseload.plans.common import classified, long
from leaseload.sources.contracts import UNIT_KEYS, bind

UNIT_TABLE = (
    "unit_number", "building", "unit_type_id", "climate_controlled", "inside", "unit_access", "floor_level",
    "power", "power_outlet", "power_lights", "power_timer_hr", "unit_access_hours", "entry_lock",
    "door_type_id", "alarm", "ada", "unit_area", "unit_size_id", "standard_rate", "push_rate", "weekly_rate",
    "unit_status_id", "box_truck_rental", "mobile_unit", "on_site_resident", "organization_id", "location_id",
    "reserved", "one_hour_timer", "drive_up", "lighting", "fire_suppression", "location_type_id", "created_by",
    "updated_by", "created_datetime", "updated_datetime",
)
UNIT_KEY = ("unit_number", "organization_id", "location_id")
# Flags a new unit starts with; an update leaves them as they are.
START_FLAGS = ("reserved", "one_hour_timer", "drive_up", "lighting", "fire_suppression")
UNIT_UPDATES = tuple(
    c for c in UNIT_TABLE
    if c not in (*UNIT_KEY, *START_FLAGS, "location_type_id", "created_by", "created_datetime")
)
FALLBACK_SIZE = "0x0"


def size_lookup(sizes: DataFrame) -> DataFrame:
    named = sizes.select(enums.size_name("value").alias("size_key"), F.col("id").alias("unit_size_id"))
    return last_wins(named, ["size_key"], ["unit_size_id"], F.col("unit_size_id"))


def fallback_size_id(sizes: DataFrame) -> Column:
    """Id of the 0x0 size, 0 where the table has none: one value, found by a scalar subquery."""
    zero = sizes.filter(enums.size_name("value") == FALLBACK_SIZE)
    return zero.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar()


def load_units(
    units: DataFrame, sizes: DataFrame, stored: DataFrame, params: Params, nullable_flags: bool = False
) -> Outcome:
    """Units with a name; a cell that cannot be read becomes null and is reported.

    A stored unit is always updated. A unit that stands in the file twice is
    inserted from its first row and updated from its last. ``nullable_flags`` keeps
    blank ADA, box truck and on-site cells null where False is stored by default.
    """
    cell = bind(units, UNIT_KEYS)
    strict = {
        "unit_access": (*enums.unit_access(cell["UNIT ACCESS"]), cell["UNIT ACCESS"]),
        "floor_level": (*enums.floor_level(cell["FLOOR"]), cell["FLOOR"]),
        "power": (*enums.yes_no(cell["POWER (YES"]), cell["POWER (YES"]),
        "power_outlet": (*enums.yes_no(cell["POWER_ELECTRICALOUTLET"]), cell["POWER_ELECTRICALOUTLET"]),
        "power_lights": (*enums.power_lights(cell["POWER_LIGHTS"]), cell["POWER_LIGHTS"]),
        "power_timer_hr": (*enums.power_timer(cell["POWER_TIMER_HR"]), cell["POWER_TIMER_HR"]),
        "entry_lock": (*enums.entry_lock(cell["ENTRYLOCK"]), cell["ENTRYLOCK"]),
        "door_type_id": (*enums.door_type_id(cell["DOORTYPE"]), cell["DOORTYPE"]),
        "alarm": (*enums.yes_no(cell["ALARM"]), cell["ALARM"]),
        "ada": (*enums.yes_no(cell["ADA"], nullable_flags), cell["ADA"]),
        "standard_rate": (*rate(cell["STANDARDRATE"]), cell["STANDARDRATE"]),
        "push_rate": (*rate(cell["PUSHRATE"]), cell["PUSHRATE"]),
        "weekly_rate": (*rate(cell["WEEKLYRATE"]), cell["WEEKLYRATE"]),
        "box_truck_rental": (*enums.yes_no(cell["BOX TRUCK RENTAL"], nullable_flags), cell["BOX TRUCK RENTAL"]),
        "mobile_unit": (*enums.mobile_unit(cell["MOBILE UNIT"]), cell["MOBILE UNIT"]),
        "on_site_resident": (*enums.yes_no(cell["ON-SITE RESIDENT"], nullable_flags), cell["ON-SITE RESIDENT"]),
    }
    rows = units.withColumn("_size", enums.size_name(cell["UNITSIZE"]))
    rows = attach(rows, size_lookup(sizes), [("_size", "size_key")])
    name = clean_text(cell["UNITNAME"])
    values = {
        **{column: value for column, (value, _, _) in strict.items()},
        "unit_number": name,
        "building": clean_text(cell["BLDG"]),
        "unit_type_id": enums.unit_type_id(cell["TYPE"]),
        "climate_controlled": enums.climate_controlled(cell["TYPE"]),
        "inside": enums.inside(cell["ENTRY LOCATION"]),
        "unit_access_hours": blank_to_null(cell["UNIT ACCESS HOURS"], BLANK_CELL_WORDS),
        "unit_area": clean_text(cell["AREA"]),
        "unit_size_id": F.coalesce("unit_size_id", fallback_size_id(sizes)),
        "unit_status_id": enums.unit_status_id(
            rentable=cell["RENTABLE"], rented=cell["RENTED"], reserved=cell["RESERVED"],
            maintenance=cell["MAINTENANCE"],
        ),
        "organization_id": params.organization,
        "location_id": params.location,
        **{flag: F.lit(False) for flag in START_FLAGS},
        "location_type_id": long(1),
        **params.audit(),
    }
    before = [Rule("no_unit_name", name.isNull(), "UNITNAME", cell["UNITNAME"], "error")]
    errors = F.when(name.isNotNull(), field_errors(strict))
    return Outcome(
        rows=classified(
            rows, cell["UNITNAME"], {c: values[c] for c in UNIT_TABLE}, before, extra={"_errors": errors}
        ),
        columns=UNIT_TABLE,
        key=UNIT_KEY,
        known=(Known(stored, tuple((k, k) for k in UNIT_KEY)),),
        on_match="update",
        update_columns=UNIT_UPDATES,
    )
