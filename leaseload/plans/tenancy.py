"""Tenancy exports -> leases and customer-unit links, active and historical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import charge_day, free_date, not_before
from leaseload.functions.enums import insurance_option
from leaseload.functions.numbers import RATE_TYPE, cents, dollars, id_before_point, whole_number, zero_takes
from leaseload.functions.records import source_system
from leaseload.functions.text import access_code, clean_text, cut, folded, squeeze, trimmed_or_null
from leaseload.operators.keys import attach
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, long, nothing
from leaseload.sources.contracts import LEASE_KEYS, LINK_KEYS, Binding, bind, optional, require
from leaseload.sources.tables import customers_by_text, units_by_name

LEASE_TABLE = (
    "customer_id", "unit_id", "facility_id", "move_in_date", "lease_date", "paid_through_date", "schedule_date",
    "move_out_date", "rental_rate_in_cents", "schedule_rate_in_cents", "rate_variance_in_cents",
    "security_deposit_in_cents", "insurance_option", "insurance_rate_in_cents", "charge_day", "status",
    "promo_code", "promo_discount_in_cents", "notes", "external_employee_id", "external_system", "created_by",
    "updated_by", "created_datetime", "updated_datetime", "version",
)
LINK_TABLE = (
    "customer_id", "unit_id", "lease_date", "move_out_date", "paid_through_date", "scheduled_date",
    "rental_rate", "rate_variance", "scheduled_rate", "charge_day", "access_code", "rental_contract_signed",
    "created_by", "updated_by", "created_datetime", "updated_datetime",
)
HISTORY_LEASE_UPDATES = (
    "paid_through_date", "schedule_date", "rental_rate_in_cents", "schedule_rate_in_cents",
    "security_deposit_in_cents", "insurance_option", "insurance_rate_in_cents", "updated_by", "updated_datetime",
)
LINK_UPDATES = (
    "lease_date", "paid_through_date", "rental_rate", "scheduled_rate", "charge_day", "access_code", "updated_by",
    "updated_datetime",
)
HISTORY_LINK_UPDATES = (
    "move_out_date", "paid_through_date", "rental_rate", "scheduled_rate", "updated_by", "updated_datetime",
)
ACTIVE, TERMINATED = "ACTIVE", "TERMINATED"
PAIR = ("customer_id", "unit_id")


def moved_out(tenancies: DataFrame) -> DataFrame:
    """Tenancies that have ended: a move-out cell that is filled and not "nat"."""
    return tenancies.filter(F.col("DMOVEDOUT").isNotNull() & (folded("DMOVEDOUT") != "nat"))


_DATE_KEYS = ("DMOVEDIN", "DLEASE", "DPAIDTHRU", "DMOVEDOUT", "DSCHEDOUT")


def _resolved(
    tenancies: DataFrame, tenant: Column, cell: Binding, customers: DataFrame, units: DataFrame
) -> DataFrame:
    """Rows with customer and unit found and every date cell parsed once."""
    rows = tenancies.withColumns(
        {"_tenant": tenant, "_unit": squeeze(cell["SUNITNAME"]), **{f"_{k}": free_date(cell[k]) for k in _DATE_KEYS}}
    )
    rows = attach(rows, customers_by_text(customers), [("_tenant", "tenant_key")])
    return attach(rows, units_by_name(units), [("_unit", "unit_name")])


def _owner_rules() -> list[Rule]:
    return [
        Rule("no_customer", F.col("customer_id").isNull(), "TENANTID", F.col("_tenant")),
        Rule("no_unit", F.col("unit_id").isNull(), "SUNITNAME", F.col("_unit")),
    ]


def _date_rule(reason: str, cell: Binding, name: str) -> Rule:
    return Rule(reason, F.col(f"_{name}").isNull(), name, cell[name])


def _rent_rule(cell: Binding) -> Rule:
    return Rule("no_rent", clean_text(cell["DCRENT"]).isNull(), "DCRENT", cell["DCRENT"])


def _amount_rule(name: str, cell: Binding, amount: Column) -> Rule:
    """An amount that does not fit its type stops the row; it is never stored as zero."""
    return Rule("amount_out_of_range", amount.isNull(), name, cell[name], "error")


LEASE_AMOUNTS = ("DCRENT", "DCSCHEDRENT", "DCSECDEPPAID", "DCINSURPREMIUM")


def _lease(cell: Binding, employee: Column, status: str, params: Params) -> dict[str, Column]:
    moved_in = F.col("_DMOVEDIN")
    rent = cents(cell["DCRENT"])
    premium = cents(cell["DCINSURPREMIUM"])
    scheduled = F.coalesce(F.col("_DSCHEDOUT"), moved_in)
    values = {
        "customer_id": F.col("customer_id"),
        "unit_id": F.col("unit_id"),
        "facility_id": params.location,
        "move_in_date": moved_in,
        "lease_date": F.coalesce(F.col("_DLEASE"), moved_in),
        "paid_through_date": F.col("_DPAIDTHRU"),
        "schedule_date": scheduled if status == ACTIVE else not_before(scheduled, moved_in),
        "move_out_date": F.col("_DMOVEDOUT"),
        "rental_rate_in_cents": rent,
        "schedule_rate_in_cents": zero_takes(cents(cell["DCSCHEDRENT"]), rent),
        "rate_variance_in_cents": long(0),
        "security_deposit_in_cents": cents(cell["DCSECDEPPAID"]),
        "insurance_option": insurance_option(premium),
        "insurance_rate_in_cents": premium,
        "charge_day": charge_day(moved_in, 30),
        "status": F.lit(status),
        "promo_code": nothing(),
        "promo_discount_in_cents": long(0),
        "notes": nothing(),
        "external_employee_id": whole_number(employee),
        "external_system": source_system(),
        "version": F.lit(1),
        **params.audit(),
    }
    return {c: values[c] for c in LEASE_TABLE}


def _link(
    cell: Binding, move_out: Column, rent: Column, scheduled: Column, code: Column, max_day: int | None, params: Params
) -> dict[str, Column]:
    moved_in = F.col("_DMOVEDIN")
    values = {
        "customer_id": F.col("customer_id"),
        "unit_id": F.col("unit_id"),
        "lease_date": F.coalesce(F.col("_DLEASE"), moved_in),
        "move_out_date": move_out,
        "paid_through_date": F.col("_DPAIDTHRU"),
        "scheduled_date": F.col("_DSCHEDOUT"),
        "rental_rate": rent,
        "rate_variance": F.lit(0).cast(RATE_TYPE),
        "scheduled_rate": zero_takes(scheduled, rent),
        "charge_day": charge_day(moved_in, max_day),
        "access_code": code,
        "rental_contract_signed": F.lit(False),
        **params.audit(),
    }
    return {c: values[c] for c in LINK_TABLE}


def load_links(
    tenancies: DataFrame, customers: DataFrame, units: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Active customer-unit links, one per customer and unit."""
    cell = bind(tenancies, LINK_KEYS)
    rows = _resolved(tenancies, squeeze(cell["TENANTID"]), cell, customers, units)
    rent, scheduled = dollars(cell["DCRENT"]), dollars(cell["DCSCHEDRENT"])
    rules = [
        *_owner_rules(),
        _date_rule("no_move_in", cell, "DMOVEDIN"),
        _rent_rule(cell),
        _amount_rule("DCRENT", cell, rent),
        _amount_rule("DCSCHEDRENT", cell, scheduled),
    ]
    derived = _link(
        cell, F.col("_DMOVEDOUT"), rent, scheduled,
        access_code(cell["SACCESSCODE"]), None, params,
    )
    return Outcome(
        rows=classified(rows, F.col("_unit"), derived, rules),
        columns=LINK_TABLE,
        key=PAIR,
        known=(Known(stored, tuple((k, k) for k in PAIR)),),
        on_match=params.on_match,
        update_columns=LINK_UPDATES,
    )


def load_history_links(
    tenancies: DataFrame, customers: DataFrame, units: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Links of ended tenancies, one per customer, unit and lease date."""
    require(tenancies, LINK_KEYS)
    ended = moved_out(tenancies)
    cell = bind(ended, LINK_KEYS, match="exact")
    rows = _resolved(ended, id_before_point(cell["TENANTID"]), cell, customers, units)
    rent, scheduled = dollars(cell["DCRENT"], marks=False), dollars(cell["DCSCHEDRENT"], marks=False)
    rules = [
        *_owner_rules(),
        _date_rule("no_move_in", cell, "DMOVEDIN"),
        _date_rule("no_move_out", cell, "DMOVEDOUT"),
        _rent_rule(cell),
        _amount_rule("DCRENT", cell, rent),
        _amount_rule("DCSCHEDRENT", cell, scheduled),
    ]
    derived = _link(
        cell, F.col("_DMOVEDOUT"), rent, scheduled, cut(trimmed_or_null(cell["SACCESSCODE"]), 10), 28, params,
    )
    key = (*PAIR, "lease_date")
    return Outcome(
        rows=classified(rows, F.col("_unit"), derived, rules),
        columns=LINK_TABLE,
        key=key,
        known=(Known(stored.filter("move_out_date IS NOT NULL"), tuple((k, k) for k in key)),),
        on_match=params.on_match,
        update_columns=HISTORY_LINK_UPDATES,
    )


def load_leases(
    tenancies: DataFrame, customers: DataFrame, units: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Active leases. A unit has one at most, so the first row of a free unit wins.

    A stored pair of customer and unit is always on an occupied unit as well, which
    is why the unit alone is the conflict key.
    """
    cell = bind(tenancies, LEASE_KEYS)
    rows = _resolved(tenancies, squeeze(cell["TENANTID"]), cell, customers, units)
    rules = [
        *_owner_rules(),
        _date_rule("no_move_in", cell, "DMOVEDIN"),
        _date_rule("no_paid_through", cell, "DPAIDTHRU"),
        _rent_rule(cell),
        *[_amount_rule(name, cell, cents(cell[name])) for name in LEASE_AMOUNTS],
    ]
    return Outcome(
        rows=classified(
            rows, F.col("_unit"), _lease(cell, optional(tenancies, "EMPLOYEEID"), ACTIVE, params), rules
        ),
        columns=LEASE_TABLE,
        key=("unit_id",),
        known=(Known(stored.filter(F.col("status") == ACTIVE), (("unit_id", "unit_id"),), "unit_occupied"),),
    )


def load_history_leases(
    tenancies: DataFrame, customers: DataFrame, units: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Ended leases, one per customer, unit, move-in and move-out; a running lease of
    the same customer, unit and move-in keeps an ended one out."""
    require(tenancies, LEASE_KEYS)
    ended = moved_out(tenancies)
    cell = bind(ended, LEASE_KEYS, match="exact")
    rows = _resolved(ended, id_before_point(cell["TENANTID"]), cell, customers, units)
    rules = [
        *_owner_rules(),
        _date_rule("no_move_in", cell, "DMOVEDIN"),
        _date_rule("no_move_out", cell, "DMOVEDOUT"),
        _date_rule("no_paid_through", cell, "DPAIDTHRU"),
        _rent_rule(cell),
        *[_amount_rule(name, cell, cents(cell[name])) for name in LEASE_AMOUNTS],
    ]
    stay = (*PAIR, "move_in_date")
    key = (*stay, "move_out_date")
    return Outcome(
        rows=classified(rows, F.col("_unit"), _lease(cell, optional(ended, "EMPLOYEEID"), TERMINATED, params), rules),
        columns=LEASE_TABLE,
        key=key,
        known=(
            Known(stored.filter("move_out_date IS NULL"), tuple((k, k) for k in stay), "active_lease"),
            Known(stored.filter("move_out_date IS NOT NULL"), tuple((k, k) for k in key)),
        ),
        on_match=params.on_match,
        update_columns=HISTORY_LEASE_UPDATES,
    )
