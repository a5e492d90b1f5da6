"""Card export -> payment_profiles table. Only the last four digits are ever kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.enums import card_brand
from leaseload.functions.records import card_expiry, card_last4, surname
from leaseload.functions.text import clean_text, folded
from leaseload.operators.keys import attach
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, long
from leaseload.sources.contracts import require

CARD_COLUMNS = ("Name", "CardNumber", "CardType", "ExpirationDate", "NameOnCard", "Address", "ZipCode")
PROFILE_TABLE = (
    "customer_id", "payment_method_type_id", "card_brand", "card_last4", "card_exp_month", "card_exp_year",
    "billing_name", "billing_address_line1", "billing_postal_code", "billing_country", "is_default", "is_active",
    "location_id", "organization_id", "created_at", "updated_at",
)
PROFILE_UPDATES = (
    "card_brand", "billing_name", "billing_address_line1", "billing_postal_code", "updated_at",
)


def with_profile_key(profiles: DataFrame) -> DataFrame:
    """Adds the key a card is recognised by: customer, last four, month and year.

    It is one text, so that a missing date matches another missing date.
    """
    parts = ("customer_id", "card_last4", "card_exp_month", "card_exp_year")
    return profiles.withColumn(
        "profile_key", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts])
    )


def match_holders(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Cards with the customer of the same surname, by address where several share it.

    Customers are counted per surname and per surname and address first. A common
    surname is one row in each lookup, and no pairs of cards and customers arise.
    """
    people = customers.filter("last_name IS NOT NULL").select(
        folded("last_name").alias("_surname"), F.coalesce(folded("address1"), F.lit("")).alias("_street"), "id"
    )
    by_name = people.groupBy("_surname").agg(F.count(F.lit(1)).alias("n_name"), F.max("id").alias("name_id"))
    by_street = people.groupBy("_surname", "_street").agg(
        F.count(F.lit(1)).alias("n_street"), F.max("id").alias("street_id")
    )
    rows = cards.withColumns(
        {"_holder": F.lower(surname("Name")), "_address": F.coalesce(folded("Address"), F.lit(""))}
    )
    rows = attach(rows, by_name, [("_holder", "_surname")])
    rows = attach(rows, by_street, [("_holder", "_surname"), ("_address", "_street")])
    return rows.withColumn(
        "customer_id",
        F.when(F.col("n_name") == 1, F.col("name_id")).when(F.col("n_street") == 1, F.col("street_id")),
    )


def load_profiles(
    cards: DataFrame, customers: DataFrame, stored: DataFrame, params: Params, payment_method_type_id: int = 1
) -> Outcome:
    """Card profiles of customers that can be told apart; a stored profile is updated."""
    require(cards, CARD_COLUMNS)
    rows = match_holders(cards, customers)
    month, year = card_expiry("ExpirationDate")
    before = [
        Rule("no_comma", F.col("_holder").isNull(), "Name"),
        Rule("no_customer", F.col("n_name").isNull(), "Name"),
        Rule("ambiguous_no_address", (F.col("n_name") > 1) & F.col("n_street").isNull(), "Address"),
        Rule("ambiguous_same_address", (F.col("n_name") > 1) & (F.col("n_street") > 1), "Address"),
    ]
    derived = {
        "customer_id": F.col("customer_id"),
        "payment_method_type_id": long(payment_method_type_id),
        "card_brand": card_brand("CardType"),
        "card_last4": card_last4("CardNumber"),
        "card_exp_month": month,
        "card_exp_year": year,
        "billing_name": clean_text("NameOnCard"),
        "billing_address_line1": clean_text("Address"),
        "billing_postal_code": clean_text("ZipCode"),
        "billing_country": F.lit("US"),
        "is_default": F.lit(False),
        "is_active": F.lit(True),
        "location_id": params.location,
        "organization_id": params.organization,
        "created_at": params.now,
        "updated_at": params.now,
    }
    return Outcome(
        rows=with_profile_key(classified(rows, F.col("Name"), derived, before)),
        columns=PROFILE_TABLE,
        key=("profile_key",),
        known=(Known(with_profile_key(stored), (("profile_key", "profile_key"),)),),
        on_match="update",
        update_columns=PROFILE_UPDATES,
    )
