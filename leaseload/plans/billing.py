"""Tenancy export and rent roll -> billing_schedules table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import billing_date, next_billing_date
from leaseload.functions.enums import billing_frequency, supported_frequency
from leaseload.functions.numbers import id_text, whole_number
from leaseload.functions.records import billing_day, source_system
from leaseload.functions.text import is_empty, squeeze
from leaseload.operators.keys import attach, last_wins
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified
from leaseload.sources.contracts import BILLING_COLUMNS, optional, require
from leaseload.sources.exports import ROW_ORDER
from leaseload.sources.tables import customers_by_text, units_by_name

BILLING_TABLE = (
    "customer_id", "unit_id", "location_id", "organization_id", "billing_frequency", "charge_day", "start_date",
    "next_billing_date", "is_active", "created_by", "created_at", "updated_at", "rental_agreement_id",
    "external_employee_id", "external_system",
)


def running(tenancies: DataFrame) -> DataFrame:
    """Tenancies without a move-out whose ledger is not deleted."""
    return tenancies.filter(is_empty("DMOVEDOUT") & is_empty(optional(tenancies, "DDELETED2")))


def rent_roll_days(rent_roll: DataFrame) -> DataFrame:
    """Unit name -> charge day; the last numeric cell of a unit wins."""
    require(rent_roll, ("UNIT", "CHARGE DAY"))
    pairs = rent_roll.select(
        squeeze("UNIT").alias("unit_name"), whole_number("CHARGE DAY").alias("roll_day"), F.col(ROW_ORDER)
    ).filter("unit_name <> '' AND roll_day IS NOT NULL")
    return last_wins(pairs, ["unit_name"], ["roll_day"], F.col(ROW_ORDER))


def open_leases(leases: DataFrame) -> DataFrame:
    """(customer, unit) -> id of the lease without a move-out."""
    running_leases = leases.filter("move_out_date IS NULL").select(
        "customer_id", "unit_id", F.col("id").alias("rental_agreement_id")
    )
    return last_wins(running_leases, ["customer_id", "unit_id"], ["rental_agreement_id"], F.col("rental_agreement_id"))


def load_billing_schedules(
    tenancies: DataFrame,
    rent_roll: DataFrame,
    customers: DataFrame,
    units: DataFrame,
    leases: DataFrame,
    stored: DataFrame,
    params: Params,
) -> Outcome:
    """Schedules of running tenancies with a supported frequency and an open lease."""
    require(tenancies, BILLING_COLUMNS)
    rows = running(tenancies).withColumns(
        {
            "_tenant": id_text("TENANTID"),
            "_unit": squeeze("SUNITNAME"),
            "_frequency": billing_frequency("BILLINGFREQID"),
            "_lease": billing_date("DLEASE"),
        }
    )
    rows = attach(rows, customers_by_text(customers), [("_tenant", "tenant_key")])
    by_unit = units_by_name(units).join(rent_roll_days(rent_roll), "unit_name", "left")
    rows = attach(rows, by_unit, [("_unit", "unit_name")])
    rows = attach(rows, open_leases(leases), [("customer_id", "customer_id"), ("unit_id", "unit_id")])

    frequency, lease = F.col("_frequency"), F.col("_lease")
    rows = rows.withColumn("_day", billing_day(F.col("roll_day"), optional(rows, "IPROCESSDAYOFMONTH"), lease))
    day = F.col("_day")
    before = [
        Rule("unknown_frequency", frequency.isNull(), "BILLINGFREQID", F.col("BILLINGFREQID")),
        Rule("unsupported_frequency", ~supported_frequency(frequency), "BILLINGFREQID", F.col("BILLINGFREQID")),
        Rule("no_customer", F.col("customer_id").isNull(), "TENANTID", F.col("TENANTID")),
        Rule("no_unit", F.col("unit_id").isNull(), "SUNITNAME", F.col("SUNITNAME")),
        Rule("no_lease", F.col("rental_agreement_id").isNull(), "rental_agreement", F.col("SUNITNAME")),
        Rule("no_lease_date", lease.isNull(), "DLEASE", F.col("DLEASE")),
    ]
    derived = {
        "customer_id": F.col("customer_id"),
        "unit_id": F.col("unit_id"),
        "location_id": params.location,
        "organization_id": params.organization,
        "billing_frequency": frequency,
        "charge_day": day,
        "start_date": lease,
        "next_billing_date": next_billing_date(params.today, day),
        "is_active": F.lit(True),
        "created_by": params.author,
        "created_at": params.now,
        "updated_at": params.now,
        "rental_agreement_id": F.col("rental_agreement_id"),
        "external_employee_id": whole_number(optional(rows, "EMPLOYEEID")),
        "external_system": source_system(),
    }
    return Outcome(
        rows=classified(rows, F.col("_unit"), derived, before),
        columns=BILLING_TABLE,
        key=("rental_agreement_id",),
        known=(Known(stored, (("rental_agreement_id", "rental_agreement_id"),)),),
    )
