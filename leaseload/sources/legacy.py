"""Extract queries over the legacy tables that produce the exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output name -> legacy column, in output order.
PERSON_COLUMNS = {
    "LocationCode": "sLocationCode", "SiteName": "sSiteName", "UnitName": "sUnitName", "Salutation": "sMrMrs",
    "FirstName": "sFName", "MI": "sMI", "LastName": "sLName", "Company": "sCompany", "Address1": "sAddr1",
    "Address2": "sAddr2", "City": "sCity", "State": "sRegion", "Zipcode": "sPostalCode", "Email": "sEmail",
    "Phone": "sPhone", "Gatecode": "sAccessCode", "Birthdate": "dDOB", "TaxID": "sTaxID",
    "DateMovedIn": "dMovedIn", "DateMovedOut": "dMovedOut",
}


def tenancy_extract(
    tenants: DataFrame, units: DataFrame, ledgers: DataFrame, access: DataFrame, site_id: int
) -> DataFrame:
    """All columns of tenants, units, ledgers and access of one site; shared names once."""
    at_site = ledgers.filter(F.col("SiteID") == site_id)
    holders = access.drop(*[c for c in access.columns if c in ledgers.columns and c != "LedgerID"])
    joined = at_site.join(units, "UnitID").join(holders, "LedgerID")
    return joined.join(tenants.drop(*[c for c in tenants.columns if c in joined.columns and c != "TenantID"]), "TenantID")


def active_ledgers(access: DataFrame, ledgers: DataFrame, site_id: int) -> DataFrame:
    """Per tenant the number of ledgers and of those without a move-out."""
    primary = access.filter((F.col("SiteID") == site_id) & (F.col("bPrimary") == 1)).select("LedgerID", "TenantID")
    kept = ledgers.filter("dDeleted IS NULL").select("LedgerID", "dMovedOut")
    return (
        primary.join(kept, "LedgerID")
        .groupBy("TenantID")
        .agg(
            F.count("LedgerID").alias("TotalRentals"),
            F.sum(F.when(F.col("dMovedOut").isNull(), 1).otherwise(0)).alias("ActiveLedgers"),
        )
    )


def former_tenants_extract(
    tenants: DataFrame, units: DataFrame, ledgers: DataFrame, access: DataFrame, sites: DataFrame, site_id: int
) -> DataFrame:
    """Ended tenancies in non-permanent units with the tenant's open ledger count.

    The name is null where either part is, as text addition is in the source. The
    site is joined on its id, which the site filter makes the same thing as taking
    that one site.
    """
    ended = ledgers.filter(
        F.col("dDeleted").isNull() & F.col("dMovedOut").isNotNull() & (F.col("SiteID") == site_id)
    ).select("LedgerID", "UnitID", "SiteID", "dMovedIn", "dMovedOut")
    holders = access.filter("bPrimary = 1").select("LedgerID", "TenantID", "sAccessCode")
    joined = (
        ended.join(units.filter("bPermanent = 0").select("UnitID", "sUnitName"), "UnitID")
        .join(holders, "LedgerID")
        .join(tenants, "TenantID")
        .join(sites.select("SiteID", "sLocationCode", "sSiteName"), "SiteID")
        .join(active_ledgers(access, ledgers, site_id).select("TenantID", "ActiveLedgers"), "TenantID", "left")
    )
    shown = joined.select(
        "TenantID",
        *[F.col(source).alias(name) for name, source in PERSON_COLUMNS.items()],
        F.concat("sLName", F.lit(", "), "sFName").alias("Name"),
        "ActiveLedgers",
        "sMobile",
    )
    keys = [c for c in shown.columns if c != "sMobile"]
    return shown.groupBy(*keys).agg(F.min("sMobile").alias("Mobile"))


def credit_extract(credits: DataFrame, memos: DataFrame) -> DataFrame:
    """Credits with their memo text."""
    return credits.join(memos.select("MemoID", "SMemo"), "MemoID")


def invoice_extract(invoices: DataFrame, details: DataFrame) -> DataFrame:
    """Invoices with their detail rows; names both share are taken from the invoice."""
    own = details.drop(*[c for c in details.columns if c in invoices.columns and c != "InvoiceID"])
    return invoices.join(own, "InvoiceID")


def whole_table(table: DataFrame) -> DataFrame:
    """Charges and payments are extracted as they are."""
    return table.select("*")
