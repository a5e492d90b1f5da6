"""Tenant exports, active and former -> customer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import free_timestamp
from leaseload.functions.numbers import id_text, whole_number
from leaseload.functions.records import source_system, stay_notes, synthetic_external_id
from leaseload.functions.text import clean_text, folded, full_name, squeeze
from leaseload.operators.keys import latest_rows
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, nothing
from leaseload.sources.contracts import CUSTOMER_KEYS, FORMER_COLUMNS, bind, optional, require
from leaseload.sources.exports import ROW_ORDER

_CONTACT = ("address1", "address2", "city", "state", "zip", "country", "phone")
CUSTOMER_TABLE = (
    "external_id", "external_source", "external_employee_id", "external_system", "first_name", "last_name",
    "company_name", *_CONTACT, "alternate_first_name", "alternate_last_name",
    *[f"alternate_{c}" for c in _CONTACT], "email", "alternate_email", "mobile", "access_gate_code",
    "driver_license_id", "driver_license_issue_state", "organization_id", "location_id", "customer_status_id",
    "created_by", "updated_by", "created_datetime", "updated_datetime",
)
# Columns an update leaves alone.
_FIXED_ON_UPDATE = (
    "external_id", "external_employee_id", "external_system", "organization_id", "customer_status_id",
    "created_by", "created_datetime",
)
CUSTOMER_UPDATES = tuple(c for c in CUSTOMER_TABLE if c not in _FIXED_ON_UPDATE)
FORMER_NOTES_TABLE = (*[c for c in CUSTOMER_TABLE if c not in ("external_source", "customer_status_id")], "notes")

ACTIVE_STATUS, FORMER_STATUS = 1, 2
# Cells of the active-ledger count that mean "none".
NO_ACTIVE_LEDGERS = ("", "0")

# Target column -> export column, each cleaned as plain text.
_ACTIVE_TEXT = {
    "last_name": "SLNAME", "company_name": "SCOMPANY", "address1": "SADDR1", "address2": "SADDR2",
    "city": "SCITY", "state": "SREGION", "zip": "SPOSTALCODE", "country": "SCOUNTRY", "phone": "SPHONE",
    "alternate_last_name": "SLNAMEALT", "alternate_address1": "SADDR1ALT", "alternate_address2": "SADDR2ALT",
    "alternate_city": "SCITYALT", "alternate_state": "SREGIONALT", "alternate_zip": "SPOSTALCODEALT",
    "alternate_country": "SCOUNTRYALT", "alternate_phone": "SPHONEALT", "email": "SEMAIL",
    "alternate_email": "SEMAILALT", "mobile": "SMOBILE", "access_gate_code": "SACCESSCODE",
    "driver_license_id": "SLICENSE", "driver_license_issue_state": "SLICREGION",
}
_FORMER_TEXT = {
    "last_name": "LASTNAME", "company_name": "COMPANY", "address1": "ADDRESS1", "address2": "ADDRESS2",
    "city": "CITY", "state": "STATE", "zip": "ZIPCODE", "phone": "PHONE", "email": "EMAIL",
    "mobile": "MOBILE", "access_gate_code": "GATECODE",
}


def _record(params: Params, employee: Column, status: int, own: dict[str, Column]) -> dict[str, Column]:
    base = {c: nothing() for c in CUSTOMER_TABLE} | {
        "external_source": F.lit(params.external_source).cast("string"),
        "external_employee_id": whole_number(employee),
        "external_system": source_system(),
        "organization_id": params.organization,
        "location_id": params.location,
        "customer_status_id": F.lit(status),
        **params.audit(),
    }
    return base | own


def load_customers(tenants: DataFrame, stored: DataFrame, params: Params) -> Outcome:
    """Active tenants by tenant id; the first row of a tenant is the one inserted."""
    cell = bind(tenants, CUSTOMER_KEYS)
    external_id = clean_text(cell["TENANTID"])
    own = {
        "external_id": external_id,
        "first_name": full_name(cell["SFNAME"], cell["SMI"]),
        "alternate_first_name": full_name(cell["SFNAMEALT"], cell["SMIALT"]),
        **{target: clean_text(cell[key]) for target, key in _ACTIVE_TEXT.items()},
    }
    before = [Rule("no_tenant_id", external_id.isNull(), "TENANTID", cell["TENANTID"])]
    return Outcome(
        rows=classified(
            tenants, cell["TENANTID"], _record(params, optional(tenants, "EMPLOYEEID"), ACTIVE_STATUS, own), before
        ),
        columns=CUSTOMER_TABLE,
        key=("external_id",),
        known=(Known(stored, (("external_id", "external_id"),)),),
        on_match=params.on_match,
        update_columns=CUSTOMER_UPDATES,
    )


def split_former(former: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tenants without an active ledger, tenants with one, kept for review)."""
    require(former, FORMER_COLUMNS)
    gone = F.coalesce(squeeze("ACTIVELEDGERS"), F.lit("")).isin(*NO_ACTIVE_LEDGERS)
    return former.filter(gone), former.filter(~gone)


def _former_text(former: DataFrame) -> dict[str, Column]:
    return {
        "first_name": full_name("FIRSTNAME", optional(former, "MI")),
        **{target: clean_text(optional(former, name)) for target, name in _FORMER_TEXT.items()},
    }


def load_former_customers(former: DataFrame, stored: DataFrame, params: Params) -> Outcome:
    """Former tenants by tenant id; stored ids are skipped, rows without one are errors."""
    gone, _ = split_former(former)
    external_id = id_text(clean_text(optional(gone, "TENANTID")))
    own = {"external_id": external_id, **_former_text(gone)}
    before = [Rule("no_tenant_id", external_id.isNull(), "TENANTID", F.col("LASTNAME"), "error")]
    return Outcome(
        rows=classified(
            gone, optional(gone, "TENANTID"), _record(params, optional(gone, "EMPLOYEEID"), FORMER_STATUS, own), before
        ),
        columns=CUSTOMER_TABLE,
        key=("external_id",),
        known=(Known(stored, (("external_id", "external_id"),)),),
    )


def load_former_with_notes(former: DataFrame, stored: DataFrame, params: Params) -> Outcome:
    """Former tenants of an export without tenant ids: synthetic id and stay notes."""
    last = clean_text("LASTNAME")
    own = {
        "external_id": synthetic_external_id(
            "LASTNAME", "FIRSTNAME", optional(former, "PHONE"), optional(former, "MOBILE"), optional(former, "EMAIL")
        ),
        **_former_text(former),
    }
    record = _record(params, optional(former, "EMPLOYEEID"), FORMER_STATUS, own) | {
        "notes": stay_notes(
            optional(former, "UNITNAME"), optional(former, "DATEMOVEDIN"), optional(former, "DATEMOVEDOUT")
        )
    }
    return Outcome(
        rows=classified(
            former,
            F.col("LASTNAME"),
            {c: record[c] for c in FORMER_NOTES_TABLE},
            [Rule("no_last_name", last.isNull(), "LASTNAME", F.col("LASTNAME"))],
        ),
        columns=FORMER_NOTES_TABLE,
        key=("external_id",),
        known=(Known(stored, (("external_id", "external_id"),)),),
    )


def latest_per_person(former: DataFrame) -> DataFrame:
    """The newest stay of each person (name and best contact) by move-out date."""
    contact = F.coalesce(
        *[clean_text(optional(former, c)) for c in ("PHONE", "MOBILE", "EMAIL")], F.lit("")
    )
    keyed = former.withColumns(
        {
            "_last": F.coalesce(folded("LASTNAME"), F.lit("")),
            "_first": F.coalesce(folded("FIRSTNAME"), F.lit("")),
            "_contact": contact,
        }
    )
    newest = latest_rows(keyed, ["_last", "_first", "_contact"], free_timestamp("DATEMOVEDOUT"), [ROW_ORDER])
    return newest.drop("_last", "_first", "_contact")
