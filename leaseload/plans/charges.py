"""Charges and credits exports -> ledger_charges table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import after_epoch, free_timestamp, unread
from leaseload.functions.enums import credit_charge_type
from leaseload.functions.numbers import id_text, negative_cents, number, signed_cents, whole_number
from leaseload.functions.records import source_system
from leaseload.functions.text import BLANK_CELL_WORDS, folded, is_empty, squeeze, trimmed_or_null
from leaseload.operators.keys import attach, attach_code, last_wins, only_known
from leaseload.operators.outcome import Known, Outcome, Rule, field_errors, judged
from leaseload.params import Params
from leaseload.plans.common import classified, ledger_customers, nothing, told_rows
from leaseload.sources.contracts import CHARGE_COLUMNS, CREDIT_COLUMNS, optional, require
from leaseload.sources.exports import ROW_ORDER, drop_blank_key

CHARGE_TABLE = (
    "customer_id", "unit_id", "location_id", "organization_id", "charge_type_id", "amount_in_cents",
    "effective_date", "memo", "internal_note", "status", "invoice_id", "source_screen", "reversed_by_id",
    "reversed_at", "reversal_reason", "created_by", "created_at", "updated_at", "external_charge_id",
    "external_employee_id", "external_system",
)
_STORED_KEY = (("external_charge_id", "external_charge_id"),)


def charge_type_lookup(charge_types: DataFrame) -> DataFrame:
    """Charge description id -> charge type id; total and blank rows have no id."""
    pairs = charge_types.select(
        whole_number("CHARGEDESCID").alias("desc_id"), whole_number("ID").alias("charge_type_id"), F.col(ROW_ORDER)
    ).dropna(subset=["desc_id", "charge_type_id"])
    return last_wins(pairs, ["desc_id"], ["charge_type_id"], F.col(ROW_ORDER))


def _charge(params: Params, rows: DataFrame, **own: Column) -> dict[str, Column]:
    shared = {
        "customer_id": F.col("customer_id"),
        "unit_id": F.col("unit_id"),
        "location_id": params.location,
        "organization_id": params.organization,
        "internal_note": nothing(),
        "status": F.lit("POSTED"),
        "invoice_id": nothing("bigint"),
        "source_screen": F.lit("MIGRATION"),
        "reversed_by_id": nothing("bigint"),
        "reversed_at": nothing("timestamp_ntz"),
        "reversal_reason": nothing(),
        "created_by": params.author,
        "external_employee_id": whole_number(optional(rows, "EMPLOYEEID")),
        "external_system": source_system(),
    }
    merged = shared | own
    return {name: merged[name] for name in CHARGE_TABLE}


def load_charges(
    charges: DataFrame,
    charge_types: DataFrame,
    tenants: DataFrame,
    customers: DataFrame,
    units: DataFrame,
    stored: DataFrame,
    params: Params,
) -> Outcome:
    """Posted charges with a known type and customer; the unit may stay open."""
    require(charges, CHARGE_COLUMNS)
    rows = drop_blank_key(charges, "CHARGEID").withColumns(
        {
            "_ledger": whole_number("LEDGERID"),
            "_desc": whole_number("CHARGEDESCID"),
            "_created": free_timestamp(optional(charges, "DCREATED")),
        }
    )
    rows = attach_code(rows, charge_type_lookup(charge_types), [("_desc", "desc_id")])

    deleted = optional(rows, "DDELETED")
    created = F.col("_created")
    memo = squeeze(optional(rows, "SCHGDESC"))
    before = [
        Rule("deleted", ~is_empty(deleted), "DDELETED", deleted),
        Rule("bad_ids", F.col("_desc").isNull() | F.col("_ledger").isNull(), "LEDGERID", F.col("LEDGERID"), "error"),
        Rule("no_charge_type", F.col("charge_type_id").isNull(), "CHARGEDESCID", F.col("CHARGEDESCID")),
        Rule("no_customer", F.col("customer_id").isNull(), "LEDGERID", F.col("LEDGERID")),
        Rule("amount_out_of_range", signed_cents("DCAMT").isNull(), "DCAMT", F.col("DCAMT"), "error"),
    ]
    alone = rows
    rows, told = judged(rows, before, ("no_customer",), "before")
    rows = attach(rows, ledger_customers(tenants, customers, units), [("_ledger", "ledger_id")])
    started, updated = optional(rows, "DCHGSTRT"), optional(rows, "DUPDATED")
    # A stored run time that stands for a cell nobody could read is told.
    unread_dates = field_errors(
        {
            "effective_date": (created, unread(started, free_timestamp(started)), started),
            "created_at": (created, unread(optional(rows, "DCREATED"), created), optional(rows, "DCREATED")),
            "updated_at": (created, unread(updated, free_timestamp(updated)), updated),
        }
    )
    derived = _charge(
        params,
        rows,
        charge_type_id=F.col("charge_type_id"),
        amount_in_cents=signed_cents("DCAMT"),
        effective_date=F.coalesce(free_timestamp(optional(rows, "DCHGSTRT")), created, params.now),
        memo=F.when(~memo.isin(*BLANK_CELL_WORDS), memo),
        created_at=F.coalesce(created, params.now),
        updated_at=F.coalesce(free_timestamp(optional(rows, "DUPDATED")), params.now),
        external_charge_id=id_text("CHARGEID"),
    )
    return Outcome(
        rows=classified(rows, F.col("CHARGEID"), derived, before, extra={"_errors": unread_dates}, told=(told, []), early=told[0]),
        columns=CHARGE_TABLE,
        key=("external_charge_id",),
        known=(Known(stored, _STORED_KEY),),
        lean=lambda: told_rows(alone, "CHARGEID", ("external_charge_id", id_text("CHARGEID")), tenants, customers, before, []),
    )


def load_credits(
    credits: DataFrame, tenants: DataFrame, customers: DataFrame, units: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Credits with a known memo as negative charges.

    Credits and charges share one key column, so a credit whose id a charge
    already uses counts as stored; ``key_collisions`` tells how many there are.
    """
    require(credits, CREDIT_COLUMNS)
    rows = credits.withColumns(
        {
            "_ledger": whole_number("LEDGERID"),
            "charge_type_id": credit_charge_type("SMEMO"),
            "_amount": F.coalesce(number("DCCREDITAMT"), F.lit(0.0)),
            "_effective": F.coalesce(after_epoch("DCREDIT"), params.now),
            "_created": after_epoch(optional(credits, "DCREATED")),
        }
    )

    posting = F.coalesce(folded(optional(rows, "BNONPOSTING")), F.lit("")) != "true"
    deleted = optional(rows, "DDELETED")
    effective = F.col("_effective")
    created = F.coalesce("_created", effective)
    before = [
        Rule("amount_not_positive", F.col("_amount") <= 0, "DCCREDITAMT", F.col("DCCREDITAMT")),
        Rule("amount_out_of_range", signed_cents("DCCREDITAMT").isNull(), "DCCREDITAMT", F.col("DCCREDITAMT"), "error"),
        Rule("non_posting", ~posting, "BNONPOSTING", optional(rows, "BNONPOSTING")),
        Rule("deleted", ~is_empty(deleted), "DDELETED", deleted),
        Rule("no_ledger", is_empty("LEDGERID"), "LEDGERID", F.col("LEDGERID")),
    ]
    after = [
        Rule("no_memo_mapping", F.col("charge_type_id").isNull(), "SMEMO", F.col("SMEMO")),
        Rule("bad_ledger", F.col("_ledger").isNull(), "LEDGERID", F.col("LEDGERID"), "error"),
        Rule("no_customer", F.col("customer_id").isNull(), "LEDGERID", F.col("LEDGERID")),
    ]
    alone = rows
    rows, told_before = judged(rows, before, (), "before")
    rows, told_after = judged(rows, after, ("no_customer",), "after")
    rows = attach(rows, ledger_customers(tenants, customers, units), [("_ledger", "ledger_id")])
    made = optional(rows, "DCREATED")
    unread_dates = field_errors(
        {
            "effective_date": (effective, unread("DCREDIT", free_timestamp("DCREDIT")), F.col("DCREDIT")),
            "created_at": (created, unread(made, free_timestamp(made)), made),
        }
    )
    derived = _charge(
        params,
        rows,
        charge_type_id=F.col("charge_type_id").cast("bigint"),
        amount_in_cents=negative_cents("DCCREDITAMT"),
        effective_date=effective,
        memo=trimmed_or_null("SMEMO"),
        created_at=created,
        updated_at=created,
        external_charge_id=F.coalesce(id_text("CREDITID"), F.lit("")),
    )
    return Outcome(
        rows=classified(rows, F.col("CREDITID"), derived, before, after, {"_errors": unread_dates}, (told_before, told_after), told_before[0]),
        columns=CHARGE_TABLE,
        key=("external_charge_id",),
        known=(Known(stored, _STORED_KEY),),
        lean=lambda: told_rows(
            alone, "CREDITID", ("external_charge_id", F.coalesce(id_text("CREDITID"), F.lit(""))), tenants, customers, before, after
        ),
    )


def key_collisions(credits: DataFrame, stored_charges: DataFrame) -> DataFrame:
    """How many credit ids a stored charge (a row that is not negative) already uses."""
    ids = credits.select(id_text("CREDITID").alias("external_charge_id")).dropna()
    taken = stored_charges.filter("amount_in_cents >= 0")
    return only_known(ids, taken, list(_STORED_KEY)).agg(F.countDistinct("external_charge_id").alias("key_collision"))
